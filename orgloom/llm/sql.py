"""DuckDB SQL for the results of the queries that SQL can express."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP3_SQL = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
b AS (SELECT item_id, {_TERMS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS k, array_to_string(w[i:i + 12], ' ') AS g
  FROM b, range(1, greatest(len(w) - 12, 1) + 1) t(i) WHERE len(w) > 0),
ks AS (SELECT DISTINCT k FROM win),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g FROM d, ks, range(1, len(w) - k + 2) t(i)),
hit AS (SELECT doc_id, item_id, i, dw.k FROM dw JOIN win USING (k, g)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, range(i, i + k) t(p) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s
  FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""

OP4_SQL = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g FROM d, range(1, len(w) - 6) t(i)),
rep AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
pos AS (SELECT doc_id, count(DISTINCT p) AS n FROM rep, range(i, i + 8) t(p) GROUP BY doc_id),
lin AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
c AS (
  SELECT d.doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM d JOIN lin USING (doc_id) LEFT JOIN pos USING (doc_id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c),
h AS (
  SELECT source, count(*)::DOUBLE AS n,
         sum(CASE WHEN base_failed OR 10 * n_symbols > word_chars OR 5 * n_dup_lines > n_words THEN 1 ELSE 0 END)::DOUBLE AS bad
  FROM f GROUP BY source),
m AS (SELECT sum(n) AS total, sum(bad) / sum(n) AS mean, count(*) AS hosts, sum(bad * bad / n) / sum(n) AS second FROM h),
e AS (SELECT mean, second - mean * mean - hosts * mean * (1 - mean) / total AS excess FROM m),
p AS (SELECT mean, CASE WHEN excess > 0 AND mean > 0 AND mean < 1 THEN least(greatest(mean * (1 - mean) / excess - 1, 10), 10000) ELSE 10000 END AS strength FROM e),
v AS (SELECT source, (bad + mean * strength) / (n + strength) <= 0.6 AS host_ok FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND host_ok AS kept
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""

OP10_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS g FROM d, range(1, len(w) - 33) t(i)),
rep AS (SELECT doc_id, i FROM win WHERE g IN (SELECT g FROM win GROUP BY g HAVING count(*) > 1)),
gone AS (SELECT DISTINCT doc_id, p FROM rep, range(i, i + 35) t(p)),
word AS (SELECT doc_id, p, w[p] AS x FROM d, range(1, len(w) + 1) t(p)),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS s, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def _op11_sql(rounds: int = 3, k: int = 16) -> str:
    """Each round: the nearest centroid of each vector, then exact floors of the means."""
    near = "list_min(list_transform(cs, lambda c: {'d': list_sum(list_transform(list_zip(q.p, c.p), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'c': c.c}))"
    parts = [
        f"""q AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS p FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, p) - 1 AS c, p FROM q ORDER BY c LIMIT {k}),
l0 AS MATERIALIZED (SELECT list({{'c': c, 'p': p}} ORDER BY c) AS cs FROM c0)"""
    ]
    for r in range(rounds + 1):
        parts.append(f"a{r} AS MATERIALIZED (SELECT vec_id, p, {near} AS m FROM q, l{r})")
        if r < rounds:
            parts.append(
                f"""s{r} AS (SELECT m.c AS c, i, sum(p[i]) AS s, count(*) AS n FROM a{r}, range(1, 65) t(i) GROUP BY ALL),
n{r} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS p FROM s{r} GROUP BY c),
c{r + 1} AS MATERIALIZED (SELECT c, coalesce(n{r}.p, c{r}.p) AS p FROM c{r} LEFT JOIN n{r} USING (c)),
l{r + 1} AS MATERIALIZED (SELECT list({{'c': c, 'p': p}} ORDER BY c) AS cs FROM c{r + 1})"""
            )
    return f"""
WITH {', '.join(parts)}
SELECT vec_id, CAST(m.c AS INTEGER) AS cluster, CAST(m.d AS BIGINT) AS distance,
       CAST(sum(m.d) OVER (PARTITION BY m.c) AS BIGINT) AS cluster_inertia, CAST(sum(m.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c{rounds}.p, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON c{rounds}.c = m.c
"""


OP11_SQL = _op11_sql()

#: CRC-32 by its definition: eight steps of a shift for each byte (the keys are ASCII).
_CRC = """xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(key, ''), lambda c: ascii(c)::UBIGINT)),
  lambda s, b: list_reduce(list_prepend(xor(s, b), list_transform(range(8), lambda i: 0::UBIGINT)), lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1::UBIGINT)))), 4294967295::UBIGINT)"""


def _op13_sql() -> str:
    """Best (cost, audit) of each state after each row, forwards; then the audit says which rows stay and who speaks."""
    far = "{'c': 1000000, 'a': ''}"
    best = lambda *arcs: f"list_min([{', '.join(arcs)}])"
    step = lambda cost, letter, s: f"{{'c': {s}.c + {cost}, 'a': {s}.a || '{letter}'}}"
    insert = lambda s: step(5, "I", s)
    may = lambda cond, arc: f"CASE WHEN {cond} THEN {arc} ELSE {far} END"
    keep = lambda i, s: may(f"fault < 2 AND ini = '{i}'", step("5 * fault", "K", s))
    rerole = lambda s: may("fault < 2", step("1 + 5 * fault", "R", s))
    # Turns that are put in before the row come first: p2 and p3 are states 2 and 3 with up to two of them.
    r2 = best("b2", insert("b0"), insert("b1"), insert("b3"))
    r3 = best("b3", insert("b2"), f"{{'c': {best('b0', 'b1')}.c + 10, 'a': {best('b0', 'b1')}.a || 'II'}}")
    n0 = step(2, "D", "b0")
    n1 = best(step(2, "D", "b1"), keep("s", "b0"))
    n2 = best(step(2, "D", "p2"), keep("u", "b0"), keep("u", "b1"), keep("u", "p3"), rerole("b0"), rerole("b1"), rerole("p3"))
    n3 = best(step(2, "D", "p3"), keep("a", "p2"), rerole("p2"))
    blank = "NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]')"
    return f"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
f AS (SELECT *, {_CRC} % 20 AS damage FROM k),
g AS (
  SELECT conv_id, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
         CASE damage WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, n
  FROM f, range(CASE damage WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) t(n)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, n) AS i FROM g),
w AS MATERIALIZED (
  SELECT *, left(role, 1) AS ini, {blank} AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair,
         CASE WHEN {blank} OR row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
              WHEN regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 0 ELSE 1 END AS fault FROM o),
dp(conv_id, i, b0, b1, b2, b3) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, {{'c': 0, 'a': ''}}, {far}, {far}, {far} FROM w
  UNION ALL
  SELECT conv_id, i, {n0}, {n1}, {n2}, {n3} FROM (
    SELECT w.conv_id, w.i, ini, fault, b0, b1, {r2} AS p2, {r3} AS p3 FROM dp JOIN w ON w.conv_id IS NOT DISTINCT FROM dp.conv_id AND w.i = dp.i + 1)),
e AS (SELECT conv_id, {best('b0', r3)} AS m FROM dp QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
l AS (SELECT conv_id, m.c AS cost, m.a AS audit, len(replace(m.a, 'D', '')) AS kept, j, m.a[j] AS letter FROM e, range(1, len(m.a) + 1) t(j)),
y AS (
  SELECT *, len(replace(left(audit, j), 'I', '')) AS i, len(replace(left(audit, j), 'D', '')) AS place FROM l WHERE letter <> 'D'),
z AS (
  SELECT y.conv_id, string_agg(CASE WHEN letter = 'K' THEN w.role WHEN (place + kept) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
                               CASE WHEN letter = 'I' THEN '' ELSE w.text END, chr(10) ORDER BY j) AS repaired
  FROM y LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM y.conv_id AND w.i = y.i GROUP BY y.conv_id),
c AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (fault = 1) AS truncated,
         count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM w GROUP BY conv_id)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(m.c, 0) AS BIGINT) AS cost,
       coalesce(m.a, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM a.conv_id
"""


OP13_SQL = _op13_sql()
