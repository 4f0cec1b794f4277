"""From raw records to staged tables: JSON, participants, write modes, catalog and scalar rules."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import joins, upserts
from ..sources import catalog
from ..sources.adapters import load, with_sql

COMMIT_JSON = "author struct<name:string,email:string,date:string>, message string"
USER_JSON = "id string, login string"


def flat_commits(raw: DataFrame) -> DataFrame:
    """Commit and author JSON as columns; what is missing, empty or broken is null, and so is an id of 0."""
    c, a = F.from_json("COMMIT", COMMIT_JSON), F.from_json("AUTHOR", USER_JSON)
    return raw.select("ID", F.nullif(a["id"], F.lit("0")).alias("AUTHOR_ID"), a["login"].alias("AUTHOR_LOGIN"), c["author"]["name"].alias("AUTHOR_NAME"), c["author"]["email"].alias("AUTHOR_EMAIL"), c["author"]["date"].alias("AUTHORED"), c["message"].alias("MESSAGE"))


def participants(prs: DataFrame) -> DataFrame:
    """One row for each role of each pull request: author, assignees, reviewers; repeats and nulls left out.

    prs: PR_ID, AUTHOR, ASSIGNEES (array), REQUESTED (array), REVIEWERS (array) of struct<id,login>."""
    tag = lambda c, role: F.transform(F.coalesce(F.col(c), F.array().cast("array<struct<id:string,login:string>>")), lambda x: F.struct(F.lit(role).alias("role"), x["id"].alias("id"), x["login"].alias("login")))
    author = F.array(F.struct(F.lit("AUTHOR").alias("role"), F.col("AUTHOR.id").alias("id"), F.col("AUTHOR.login").alias("login")))
    every = F.concat(author, tag("ASSIGNEES", "ASSIGNEE"), tag("REQUESTED", "REQUESTED_REVIEWER"), tag("REVIEWERS", "ACTUAL_REVIEWER"))
    return prs.select("PR_ID", F.inline(every)).filter("id IS NOT NULL AND login IS NOT NULL").dropDuplicates(["PR_ID", "id", "role"])


def _pulls(s, d) -> DataFrame:
    e = load(s, d, "events")
    user = lambda k: F.struct(F.expr(f"CAST((user_id * {k}) % 60 AS STRING)").alias("id"), F.expr(f"'l' || CAST((user_id * {k}) % 60 AS STRING)").alias("login"))
    return e.select(F.col("event_id").alias("PR_ID"), F.when(F.col("event_id") % 7 != 0, user(1)).alias("AUTHOR"), F.array(user(2), user(3), user(2)).alias("ASSIGNEES"), F.when(F.col("event_id") % 2 == 0, F.array(user(5))).alias("REQUESTED"), F.array(user(7)).alias("REVIEWERS"))


def _old_new(s, d) -> tuple[DataFrame, DataFrame]:
    o = load(s, d, "orders")
    old = o.filter("o_orderkey % 3 != 0").select("o_orderkey", F.expr("CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END").alias("status"), F.expr("'old'").alias("role"), F.expr("array('a', CAST(o_orderkey % 4 AS STRING))").alias("tags"))
    new = o.filter("o_orderkey % 2 = 0").select("o_orderkey", F.expr("CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'N' END").alias("status"), F.expr("'new'").alias("role"), F.expr("array('b', CAST(o_orderkey % 3 AS STRING))").alias("tags"))
    return old, new


def _flat(df: DataFrame) -> DataFrame:
    return df.withColumn("tags", F.array_join(F.sort_array("tags"), ","))


def _merge(**rules: str):
    return lambda s, d: _flat(upserts.merge(*_old_new(s, d), ["o_orderkey"], {"status": "new", "role": "new", "tags": "new"} | rules))


def scalar_rules(commits: DataFrame) -> DataFrame:
    """The scalar rules side by side, on one table."""
    c = F.col
    return commits.select(
        "COMMIT_SHA", text.squash(c("AUTHOR_NAME")).alias("squashed"), text.clean(c("COMMIT_MESSAGE")).alias("cleaned"), text.without_digits_at_end(c("AUTHOR_LOGIN")).alias("bare_login"),
        text.email(c("AUTHOR_EMAIL")).alias("email"), text.blank_to_null(c("COMMIT_MESSAGE")).alias("message"), text.repo_path(c("ORG"), c("REPO")).alias("repo"), text.safe_key(text.repo_path(c("ORG"), c("REPO"))).alias("repo_key"),
        text.fingerprint(c("AUTHOR_ID"), c("AUTHOR_EMAIL")).alias("fp"), text.link_hash(c("REPO"), c("AUTHOR_ID")).alias("hash"), text.first_filled(c("AUTHOR_ID"), c("AUTHOR_LOGIN")).alias("who"), text.name(c("AUTHOR_NAME")).alias("plain_name"),
    )


def jaccard_pairs(names: DataFrame, others: DataFrame) -> DataFrame:
    """Pairs of names that share a token, and their index. Distinct names are met and scored once, and their rows in parts."""
    rows = lambda df, i, name: df.filter("DISPLAY_NAME IS NOT NULL").select(F.col("ID").alias(i), F.col("DISPLAY_NAME").alias(name))
    a, b = rows(names, "A", "X"), rows(others, "B", "Y")
    x, y = a.select("X").distinct().withColumn("x_tokens", text.tokens(F.col("X"))), b.select("Y").distinct().withColumn("y_tokens", text.tokens(F.col("Y")))
    share = x.select("X", F.explode("x_tokens").alias("t")).join(y.select("Y", F.explode("y_tokens").alias("t")), "t").select("X", "Y").distinct()
    scored = share.join(x, "X").join(y, "Y").select("X", "Y", F.round(text.jaccard(F.col("x_tokens"), F.col("y_tokens")), 6).alias("jaccard"))
    return joins.in_parts(a, joins.spread(scored.join(b, "Y").drop("Y"), "B"), "X").select("A", "B", "jaccard")


def text_arrays(users: DataFrame) -> DataFrame:
    """Arrays of other names: appended to, joined without repeats, what only one has, membership, and as sorted JSON."""
    none = F.array().cast("array<string>")
    mail, login = F.coalesce("ALIAS_EMAIL", none), F.coalesce("ALIAS_LOGIN", none)
    both = F.array_distinct(F.concat(mail, login, mail))
    return users.select(
        "ID", F.to_json(F.sort_array(both)).alias("as_json"), F.array_join(F.array_append(mail, F.col("LOGIN")), ",").alias("appended"), F.array_join(F.sort_array(F.array_except(F.array_union(mail, F.array("EMAIL")), F.array("EMAIL"))), ",").alias("others"),
        F.array_contains(both, F.concat(F.lit("old"), "ID")).alias("has_old"), F.size(both).cast("bigint").alias("n"),
    )


def _sparse(s, d) -> DataFrame:
    """A table of which the first rows are empty in many ways."""
    return load(s, d, "orders").selectExpr(
        "o_orderkey AS ID", "CASE WHEN o_orderkey < 3 THEN NULL WHEN o_orderkey < 5 THEN '' WHEN o_orderkey < 7 THEN ' null ' WHEN o_orderkey < 9 THEN 'None' ELSE o_orderstatus END AS STATUS",
        "CASE WHEN o_orderkey < 40 THEN '[]' ELSE '[1]' END AS LIST", "CASE WHEN o_orderkey < 99 THEN '{}' ELSE '{\"a\": 1}' END AS DOC", "CASE WHEN o_orderkey < 100 THEN NULL ELSE 'late' END AS NEVER",
    )


def _times(s, d) -> DataFrame:
    return load(s, d, "events").selectExpr("event_id AS ID", "CASE event_id % 5 WHEN 0 THEN '2024-03-0' || CAST(1 + event_id % 9 AS STRING) || 'T10:00:00.000+0200' WHEN 1 THEN '2024-03-01T23:30:00-05:00' WHEN 2 THEN 'yesterday' WHEN 3 THEN NULL ELSE '2024-12-31T23:59:59.250Z' END AS STAMP")


def _scores(s, d) -> DataFrame:
    """The three ratios and the similarity of each account's name and that of the person of the same number."""
    from pyspark.sql import types as T

    from ..functions import similarity as kernel

    j = load(s, d, "jira_users").filter("DISPLAY_NAME IS NOT NULL").select(F.col("ORD"), F.col("DISPLAY_NAME").alias("a"))
    pairs = j.join(load(s, d, "github_users").select(F.col("ORD"), F.col("DISPLAY_NAME").alias("b")), "ORD")

    @F.pandas_udf(T.StructType([T.StructField(n, T.DoubleType()) for n in ("set_ratio", "sort_ratio", "sim")]))
    def run(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        rows = [(kernel.cleaned(x), kernel.cleaned(y), x, y) for x, y in zip(a, b, strict=True)]
        return pd.DataFrame([(round(kernel.token_set_ratio(p, q), 6), round(kernel.token_sort_ratio(p, q), 6), round(kernel.similarity(x, y), 6)) for p, q, x, y in rows], columns=["set_ratio", "sort_ratio", "sim"])

    return pairs.select("ORD", run("a", "b").alias("r")).select("ORD", "r.set_ratio", "r.sort_ratio", "r.sim")


QUERIES = {
    "json_flatten": lambda s, d: flat_commits(load(s, d, "raw")),
    "json_field_extract": lambda s, d: load(s, d, "raw").select("ID", F.get_json_object("PROPS", "$.k").alias("k")),
    "json_count": lambda s, d: load(s, d, "raw").groupBy(F.get_json_object("AUTHOR", "$.id").alias("author")).agg(F.count(F.lit(1)).alias("n")).filter("author IS NOT NULL"),
    "pr_participants": lambda s, d: participants(_pulls(s, d)),
    "scalar_rules": lambda s, d: scalar_rules(load(s, d, "commits")),
    "path_split": lambda s, d: load(s, d, "diffs").select("ORD", *[c.alias(n) for c, n in zip(text.path_parts(F.col("FILE_PATH")), ("folder", "file", "extension"), strict=True)]),
    "jaccard_match": lambda s, d: jaccard_pairs(load(s, d, "jira_users"), load(s, d, "github_users")),
    "url_org_repo": lambda s, d: load(s, d, "pages").select("page_id", *[c.alias(n) for c, n in zip(text.org_repo(F.col("url")), ("org", "repo"), strict=True)]),
    "iso_times": lambda s, d: load(s, d, "orders").select("o_orderkey", text.iso(F.col("o_orderdate")).alias("iso")),
    "recent_rows": lambda s, d: catalog.since_days(load(s, d, "orders"), "o_orderdate", "1998-08-02", 90).select("o_orderkey"),
    "work_queue": lambda s, d: load(s, d, "commits").filter("AUTHOR_ID IS NULL").orderBy("COMMIT_SHA").limit(50).select("COMMIT_SHA"),
    "name_search": lambda s, d: load(s, d, "jira_users").filter(text.contains_any_case(F.col("DISPLAY_NAME"), "EN")).orderBy("ORD").limit(5).select("ID", "DISPLAY_NAME"),
    "distinct_on_name": lambda s, d: upserts.first_by(load(s, d, "jira_users"), ["DISPLAY_NAME"], [F.asc("ORD")]).select("DISPLAY_NAME", "ID"),
    "upsert_overwrite": lambda s, d: _flat(upserts.overwrite(*_old_new(s, d), ["o_orderkey"])),
    "upsert_ignore": lambda s, d: _flat(upserts.insert_ignore(*_old_new(s, d), ["o_orderkey"], [F.asc_nulls_last("status")])),
    "upsert_coalesce": _merge(status="fill_new", role="fill_new"),
    "upsert_keep_old": _merge(status="fill_old", role="old"),
    "upsert_array_union": _merge(tags="union"),
    "delete_insert": lambda s, d: _flat(upserts.delete_then_insert(*_old_new(s, d), ["o_orderkey"])),
    "column_examples": lambda s, d: catalog.column_examples(_sparse(s, d), "ID"),
    "text_arrays": lambda s, d: text_arrays(load(s, d, "github_users")),
    "parsed_times": lambda s, d: _times(s, d).select("ID", text.iso(text.parse_iso(F.col("STAMP"))).alias("utc")),
    "name_scores": lambda s, d: _scores(s, d),
    "coerced": lambda s, d: load(s, d, "events").select("event_id", F.lower(F.col("user_id").cast("string")).alias("id_text"), F.expr("try_cast(CASE WHEN event_id % 3 = 0 THEN 'x' ELSE CAST(event_id AS STRING) END AS BIGINT)").alias("number")),
    "table_columns": lambda s, d: catalog.columns_of({n: load(s, d, n) for n in ("region", "nation", "labels")}).select("table_name", "ordinal", "column_name", "column_type"),
    "platform_union": lambda s, d: reduce(DataFrame.unionByName, [load(s, d, n).select(F.lit(n).alias("platform"), F.col("ID").alias("id")) for n in ("jira_users", "github_users")]).groupBy("platform").agg(F.count(F.lit(1)).alias("n")),
}
_OLD = "o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS status, 'old' AS role, ['a', CAST(o_orderkey % 4 AS VARCHAR)] AS tags FROM orders WHERE o_orderkey % 3 <> 0), n AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'N' END AS status, 'new' AS role, ['b', CAST(o_orderkey % 3 AS VARCHAR)] AS tags FROM orders WHERE o_orderkey % 2 = 0)"
_T = "array_to_string(list_sort({0}), ',') AS tags"
_FULL = f"WITH {_OLD} SELECT o_orderkey, {{0}} AS status, {{1}} AS role, {{2}} FROM o FULL JOIN n USING (o_orderkey)"
_NEW = "CASE WHEN n.role IS NOT NULL THEN n.{0} ELSE o.{0} END"
_TOKENS = r"list_distinct(list_concat(list_filter([regexp_replace(lower(coalesce(DISPLAY_NAME, '')), '[^a-z0-9]', '', 'g')], lambda q: length(q) > 1), list_transform(list_filter(regexp_split_to_array(lower(regexp_replace(coalesce(DISPLAY_NAME, ''), '([a-z])([A-Z])', '\1 \2', 'g')), '[.\s_\-]+'), lambda q: length(q) > 1), lambda q: regexp_replace(q, '[^a-z0-9]', '', 'g'))))"
ORACLES = {
    "json_flatten": with_sql("SELECT ID, nullif(json_extract_string(AUTHOR, '$.id'), '0') AS AUTHOR_ID, json_extract_string(AUTHOR, '$.login') AS AUTHOR_LOGIN, json_extract_string(COMMIT, '$.author.name') AS AUTHOR_NAME, json_extract_string(COMMIT, '$.author.email') AS AUTHOR_EMAIL, json_extract_string(COMMIT, '$.author.date') AS AUTHORED, json_extract_string(COMMIT, '$.message') AS MESSAGE FROM raw", "raw"),
    "json_field_extract": with_sql("SELECT ID, json_extract_string(PROPS, '$.k') AS k FROM raw", "raw"),
    "json_count": with_sql("SELECT json_extract_string(AUTHOR, '$.id') AS author, count(*) AS n FROM raw WHERE AUTHOR IS NOT NULL GROUP BY 1", "raw"),
    "pr_participants": "WITH x AS (SELECT event_id AS PR_ID, unnest([{'role': 'AUTHOR', 'k': CASE WHEN event_id % 7 <> 0 THEN 1 END}, {'role': 'ASSIGNEE', 'k': 2}, {'role': 'ASSIGNEE', 'k': 3}, {'role': 'REQUESTED_REVIEWER', 'k': CASE WHEN event_id % 2 = 0 THEN 5 END}, {'role': 'ACTUAL_REVIEWER', 'k': 7}]) AS r, user_id FROM events) SELECT DISTINCT PR_ID, r.role AS role, CAST((user_id * r.k) % 60 AS VARCHAR) AS id, 'l' || CAST((user_id * r.k) % 60 AS VARCHAR) AS login FROM x WHERE r.k IS NOT NULL",
    "scalar_rules": with_sql(r"SELECT COMMIT_SHA, regexp_replace(lower(AUTHOR_NAME), '[^a-z0-9]', '', 'g') AS squashed, trim(regexp_replace(lower(COMMIT_MESSAGE), '[^a-z0-9]+', ' ', 'g')) AS cleaned, regexp_replace(AUTHOR_LOGIN, '[0-9]+$', '') AS bare_login, lower(trim(AUTHOR_EMAIL)) AS email, nullif(trim(COMMIT_MESSAGE), '') AS message, ORG || '/' || REPO AS repo, replace(ORG || '/' || REPO, '/', '__') AS repo_key, coalesce(AUTHOR_ID, 'none') || '|' || coalesce(AUTHOR_EMAIL, 'none') AS fp, md5(REPO || '|' || AUTHOR_ID) AS hash, coalesce(AUTHOR_ID, AUTHOR_LOGIN) AS who, lower(trim(regexp_replace(regexp_replace(AUTHOR_NAME, '([a-z])([A-Z])', '\1 \2', 'g'), '[^A-Za-z]+', ' ', 'g'))) AS plain_name FROM commits", "commits"),
    "path_split": with_sql(r"SELECT ORD, regexp_extract(FILE_PATH, '^(.*)/', 1) AS folder, regexp_extract(FILE_PATH, '[^/]*$') AS file, CASE WHEN ORD % 3 = 0 THEN '.py' WHEN ORD % 3 = 1 THEN '.gz' ELSE '' END AS extension FROM diffs", "diffs"),
    "jaccard_match": with_sql(f"WITH a AS (SELECT ID AS A, {_TOKENS} AS x FROM jira_users), b AS (SELECT ID AS B, {_TOKENS} AS y FROM github_users) SELECT A, B, round(len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y))), 6) AS jaccard FROM a, b WHERE len(list_intersect(x, y)) > 0", "jira_users", "github_users"),
    "url_org_repo": r"SELECT page_id, nullif(regexp_extract(url, '^[a-z]+://[^/?#]+/([^/?#]+)', 1), '') AS org, CASE WHEN regexp_matches(url, '^[a-z]+://[^/?#]+/[^/?#]*/') THEN regexp_extract(url, '^[a-z]+://[^/?#]+/[^/?#]*/([^/?#]*)', 1) END AS repo FROM pages",
    "iso_times": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || CASE WHEN strftime(o_orderdate, '%f') = '000000' THEN '' ELSE '.' || strftime(o_orderdate, '%f') END AS iso FROM orders",
    "recent_rows": "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-08-02' - INTERVAL 90 DAYS",
    "work_queue": with_sql("SELECT COMMIT_SHA FROM commits WHERE AUTHOR_ID IS NULL ORDER BY COMMIT_SHA LIMIT 50", "commits"),
    "name_search": with_sql("SELECT ID, DISPLAY_NAME FROM jira_users WHERE DISPLAY_NAME ILIKE '%en%' ORDER BY ORD LIMIT 5", "jira_users"),
    "distinct_on_name": with_sql("SELECT DISTINCT ON (DISPLAY_NAME) DISPLAY_NAME, ID FROM jira_users ORDER BY DISPLAY_NAME, ORD", "jira_users"),
    "upsert_overwrite": f"WITH {_OLD} SELECT o_orderkey, status, role, {_T.format('tags')} FROM (SELECT * FROM o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM n) UNION ALL SELECT * FROM n)",
    "upsert_ignore": f"WITH {_OLD} SELECT o_orderkey, status, role, {_T.format('tags')} FROM (SELECT * FROM o UNION ALL SELECT * FROM n WHERE o_orderkey NOT IN (SELECT o_orderkey FROM o))",
    "upsert_coalesce": _FULL.format("coalesce(n.status, o.status)", "coalesce(n.role, o.role)", _T.format(_NEW.format("tags"))),
    "upsert_keep_old": _FULL.format("coalesce(o.status, n.status)", "CASE WHEN o.role IS NOT NULL THEN o.role ELSE n.role END", _T.format(_NEW.format("tags"))),
    "upsert_array_union": _FULL.format(_NEW.format("status"), _NEW.format("role"), _T.format("list_distinct(list_concat(coalesce(o.tags, []), coalesce(n.tags, [])))")),
    "column_examples": """WITH o AS (SELECT o_orderkey AS ID, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 100)
SELECT 'ID' AS column_name, CAST(min(ID) AS VARCHAR) AS example FROM o UNION ALL SELECT 'STATUS', arg_min(o_orderstatus, ID) FROM o WHERE ID >= 9 UNION ALL SELECT 'LIST', '[1]' UNION ALL SELECT 'DOC', CASE WHEN max(ID) >= 99 THEN '{"a": 1}' END FROM o UNION ALL SELECT 'NEVER', NULL""",
    "text_arrays": with_sql("""WITH a AS (SELECT *, coalesce(ALIAS_EMAIL, []) AS m, coalesce(ALIAS_LOGIN, []) AS l FROM github_users), b AS (SELECT *, list_sort(list_distinct(list_concat(m, l))) AS x FROM a)
SELECT ID, CAST(to_json(x) AS VARCHAR) AS as_json, array_to_string(list_append(m, LOGIN), ',') AS appended, array_to_string(list_sort(list_filter(list_distinct(m), lambda q: q <> EMAIL)), ',') AS others, list_contains(x, 'old' || ID) AS has_old, len(x) AS n FROM b""", "github_users"),
    "parsed_times": "SELECT event_id AS ID, CASE event_id % 5 WHEN 0 THEN '2024-03-0' || (1 + event_id % 9) || 'T08:00:00' WHEN 1 THEN '2024-03-02T04:30:00' WHEN 4 THEN '2024-12-31T23:59:59.250000' END AS utc FROM events",
    "name_scores": "",
    "coerced": "SELECT event_id, CAST(user_id AS VARCHAR) AS id_text, CASE WHEN event_id % 3 <> 0 THEN event_id END AS number FROM events",
    "table_columns": " UNION ALL ".join(f"SELECT '{t}' AS table_name, CAST(row_number() OVER () - 1 AS BIGINT) AS ordinal, column_name, CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END AS column_type FROM (DESCRIBE {t})" for t in ("region", "nation", "labels")),
    "platform_union": with_sql("SELECT 'jira_users' AS platform, count(*) AS n FROM jira_users UNION ALL SELECT 'github_users', count(*) FROM github_users", "jira_users", "github_users"),
}
ORACLES["delete_insert"] = ORACLES["upsert_overwrite"]


def _scores_sql() -> str:
    from . import identity as i

    clean = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g'))"
    ab = "WITH ab AS (SELECT j.ORD, j.DISPLAY_NAME AS a, g.DISPLAY_NAME AS b FROM jira_users j JOIN github_users g ON g.ORD = j.ORD WHERE j.DISPLAY_NAME IS NOT NULL)"
    made = f"x AS (SELECT *, {i._SORTED.format(clean.format('a'))} AS xa, {i._SORTED.format(clean.format('b'))} AS xb FROM sm)"
    return f"{ab}, {i._similarity('ab', 'sm')}, {made} SELECT ORD, round(set_ratio, 6) AS set_ratio, round(200::DOUBLE * {i._lcs('xa', 'xb')} / (length(xa) + length(xb)), 6) AS sort_ratio, round(sim, 6) AS sim FROM x"


ORACLES["name_scores"] = with_sql(_scores_sql(), "jira_users", "github_users")
