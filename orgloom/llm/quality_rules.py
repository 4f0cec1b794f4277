"""Quality rules with host-level verdicts, in DataFrame functions only.

Each document is tested by rules of its own. Failures are then counted by host, the
rate of each host is shrunk towards the corpus rate with a beta prior that is fitted to the
hosts by moments, and the host's verdict is joined back to its documents. The counts per
document are written once, so the texts are read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, fresh, materialize

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
RUN = 8


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def text_counts(docs: DataFrame, text_col: str = "text", run: int = RUN) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (long) to the rows of ``docs``.

    A word repeats if a window of ``run`` words over it occurs twice or more in the text. The windows'
    hashes are compared; a text in which all differ, as in most, is done."""
    bound_batches(docs.sparkSession)
    text, words, heads, hits, lines = fresh(docs, "rule_text", "rule_words", "rule_heads", "rule_hits", "rule_lines")
    n = F.size(F.col(words))
    step = docs.withColumn(text, F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    step = step.withColumns({words: _words(F.col(text)), lines: F.filter(F.split(F.col(text), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))})
    # An array of one hash for each window, none if there are fewer words.
    starts = F.when(n >= run, F.sequence(F.lit(1), n - (run - 1))).otherwise(F.array().cast("array<int>"))
    step = step.withColumn(heads, F.transform(starts, lambda i: F.xxhash64(F.slice(F.col(words), i, F.lit(run)))))
    # Starts of windows that occur again, in order: hashes are sorted with their places, and equal neighbours are kept.
    found = F.array_sort(F.transform(F.col(heads), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = F.filter(
        F.zip_with(F.col(hits), F.concat(F.slice(F.col(hits), 2, F.greatest(F.size(hits), F.lit(1))), F.array(F.lit(None))), lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
        lambda x: x["a"]["h"] == x["b"]["h"],
    )
    both = F.array_sort(F.array_distinct(F.concat(F.transform(twice, lambda x: x["a"]["i"]), F.transform(twice, lambda x: x["b"]["i"]))))
    again = F.size(F.col(heads)) > F.size(F.array_distinct(F.col(heads)))
    step = step.withColumn(hits, F.when(again, found))
    step = step.withColumn(hits, F.when(F.col(hits).isNotNull(), both))
    covered = F.aggregate(
        F.zip_with(F.col(hits), F.concat(F.slice(F.col(hits), 2, F.greatest(F.size(hits), F.lit(1))), F.array(F.lit(1 << 30))), lambda a, b: F.least(b - a, F.lit(run))),
        F.lit(0).cast("long"), lambda s, x: s + x,
    )
    return step.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        n.cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.when(F.col(hits).isNotNull(), covered), F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rule_failed() -> Column:
    """What counts against a host: a failed base rule, a sign in ten characters, or a repeated line in five words."""
    return base_failed() | (10 * F.col("n_symbols") > F.col("word_chars")) | (5 * F.col("n_dup_lines") > F.col("n_words"))


def host_verdicts(failures: DataFrame, host: str = "host", failed: str = "failed", limit: float = 0.6) -> DataFrame:
    """(host, n_docs, n_failed, shrunk_rate, host_ok): a row for each host, null being one of them.

    The prior's mean is the corpus rate; its strength comes from the variance between the hosts' rates
    beyond what chance gives, and is between 10 and 10,000 documents. A host passes at a shrunk
    rate up to ``limit``."""
    hosts = failures.groupBy(F.col(host).alias("host")).agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col(failed).cast("long")).alias("n_failed"))
    p, n = F.col("n_failed") / F.col("n_docs"), F.col("n_docs")
    prior = hosts.agg(
        F.sum("n_docs").alias("all_docs"), (F.sum("n_failed") / F.sum("n_docs")).alias("mean"), F.count(F.lit(1)).alias("n_hosts"),
        F.sum(n * p * p).alias("second"), F.sum(n * n).alias("squares"),
    )
    m, hosts_n = F.col("mean"), F.col("n_hosts")
    between = F.col("second") / F.col("all_docs") - m * m
    chance = hosts_n * m * (1 - m) / F.col("all_docs")
    excess = between - chance
    strength = F.when((excess > 0) & (m > 0) & (m < 1), F.least(F.greatest(m * (1 - m) / excess - 1, F.lit(10.0)), F.lit(10_000.0))).otherwise(10_000.0)
    prior = prior.select((m * strength).alias("alpha"), ((1 - m) * strength).alias("beta"))
    rate = (F.col("n_failed") + F.col("alpha")) / (F.col("n_docs") + F.col("alpha") + F.col("beta"))
    return hosts.join(F.broadcast(prior)).select("host", "n_docs", "n_failed", rate.alias("shrunk_rate"), (rate <= limit).alias("host_ok"))  # the prior is one row


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", limit: float = 0.6) -> DataFrame:
    """(doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, shrunk_rate, kept): one row for each row of ``docs``.

    Null, empty and blank texts have no words, fail the base rules and are not kept. Documents without a
    host are judged as one host. Repeated rows each get their row; an empty table gives an empty result; other
    columns are not looked at."""
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{host_col}`").cast("string").alias("host"), F.col(f"`{text_col}`").alias("text"))
    counts = materialize(text_counts(slim).drop("text"), "rules")
    counts = counts.withColumn("base_failed", base_failed())
    hosts = materialize(host_verdicts(counts.withColumn("failed", rule_failed()), limit=limit).withColumnRenamed("host", "of_host"), "hosts")
    return counts.join(hosts, F.col("host").eqNullSafe(F.col("of_host")), "left").select(*counts.columns, "shrunk_rate", (~F.col("base_failed") & F.col("host_ok")).alias("kept"))


def keep_good(docs: DataFrame, text_col: str = "text", host_col: str = "source", limit: float = 0.6) -> DataFrame:
    """``docs`` without the rows that ``quality_rules`` rejects, whatever its columns are called.

    Texts are read, counted and written once with what the rules say of them (those of failed rows are left out); then only the rejected
    hosts are joined to them."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    counted = text_counts(plain, names[text_col]).withColumns({"bad": base_failed(), "failed": rule_failed()})
    rows = materialize(counted.select(*[F.when(~F.col("bad"), F.col(n)).alias(n) if c == text_col else F.col(n) for c, n in names.items()], "bad", "failed"), "rules")
    hosts = host_verdicts(rows.select(F.col(names[host_col]).cast("string").alias("host"), "failed"), limit=limit)
    rejected = materialize(hosts.filter(~F.col("host_ok")).select(F.col("host").alias("of_host")), "hosts")
    kept = rows.filter(~F.col("bad")).join(rejected, F.col(names[host_col]).cast("string").eqNullSafe(F.col("of_host")), "left_anti")
    return kept.select(*[F.col(n).alias(c) for c, n in names.items()])
