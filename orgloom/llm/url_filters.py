"""URL verdicts: host rules first, and gradient-boosted trees on lexical features for the rest. DataFrame and ML functions only."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Labelled URLs that the trees are fitted on, at most; those of least hash are taken.
TRAIN_ROWS = 20_000
FEATURES = ["f_length", "f_host_length", "f_path_length", "f_depth", "f_labels", "f_digits", "f_entropy", "f_params", "f_hyphens", "f_secure", "f_top_rate", "f_section_rate"]


def host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url)))
    return F.coalesce(F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(rules: list[tuple[str, str]]) -> Column:
    """struct<rule, verdict> of the longest rule (verdict, 'host/path') that fits the columns host and path; null if none does.

    Rules are a list that people write; it is part of the plan."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda x: len(x[1])):
        at = rule.index("/")
        name, prefix = rule[:at], rule[at:]
        fits = ((F.col("host") == name) | F.col("host").endswith("." + name)) & F.col("path").startswith(prefix)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def characters(text: Column) -> Column:
    """The characters of a string."""
    return F.filter(F.split(text, ""), lambda x: x != "")


def entropy(text: Column) -> Column:
    """Bits a character of a string, over the characters it has."""
    chars = characters(text)
    n = F.greatest(F.length(text), F.lit(1))
    share = lambda c: F.size(F.filter(chars, lambda x: x == c)) / n
    return F.when(F.length(text) > 0, F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda s, c: s - share(c) * F.log2(share(c)))).otherwise(0.0)


def _ratio(text: Column, pattern: str) -> Column:
    return F.when(F.length(text) > 0, 1 - F.length(F.regexp_replace(text, pattern, "")) / F.length(text)).otherwise(0.0)


def _count(text: Column, sign: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))).cast("double")


def lexical(urls: DataFrame) -> DataFrame:
    """Adds the lexical features, and ``top`` and ``section`` (the last host label, and that with the first part of the path)."""
    url = F.coalesce(F.col("url"), F.lit(""))
    return urls.withColumns({
        "f_length": F.length(url).cast("double"), "f_host_length": F.length("host").cast("double"), "f_path_length": F.length("path").cast("double"),
        "f_depth": _count(F.col("path"), "/"), "f_labels": _count(F.col("host"), "."), "f_digits": _ratio(url, "[0-9]"), "f_entropy": entropy(url),
        "f_params": F.when(F.locate("?", url) > 0, _count(F.regexp_extract(url, r"\?([^#]*)", 1), "&") + 1).otherwise(0.0),
        "f_hyphens": _count(url, "-"), "f_secure": url.startswith("https:").cast("double"),
        "top": F.substring_index("host", ".", -1), "section": F.concat_ws("/", F.substring_index("host", ".", -1), F.split_part(F.col("path"), F.lit("/"), F.lit(2))),
    })


#: Folds of the training rows: a row's rates come from the other folds, so that none knows its own label.
FOLDS = 5


def _rates(train: DataFrame, key: str, name: str, prior: float, weight: float = 20.0) -> tuple[DataFrame, DataFrame]:
    """Shrunk share of blocked URLs by ``key``: of all rows, and, by fold, of the rows of other folds; no more rows than training rows and folds, which are bounded."""
    rate = lambda n, s: (s + weight * prior) / (n + weight)
    by_fold = train.groupBy(F.col(key).alias(name + "_key"), "fold").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("s"))
    every = by_fold.groupBy(name + "_key").agg(F.sum("n").alias("all_n"), F.sum("s").alias("all_s"))
    others = by_fold.join(every.withColumnRenamed(name + "_key", "of_key"), F.col(name + "_key").eqNullSafe(F.col("of_key")))
    return (
        every.select(name + "_key", rate(F.col("all_n"), F.col("all_s")).alias(name)),
        others.select(name + "_key", F.col("fold").alias(name + "_fold"), rate(F.col("all_n") - F.col("n"), F.col("all_s") - F.col("s")).alias(name)),
    )


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], labelled: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", train_rows: int = TRAIN_ROWS, trees: int = 12, depth: int = 4) -> DataFrame:
    """(page_id, host, path, rule, verdict, p_block): one row for each row of ``pages``.

    A rule's verdict stands; other URLs get that of the trees. labelled: (url, label 1 for block); if None, the
    URLs that rules decide. Null URLs and those without :// have an empty host and path, fit no rule and
    are judged by the trees. If the labels are all alike their verdict is given, and allow without labels. Repeated rows
    each get their row; an empty table gives an empty result; other columns are not looked at."""
    slim = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"))
    slim = slim.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))}).withColumn("found", longest_rule(rules))
    if labelled is None:
        source = slim.filter("found IS NOT NULL").select("url", "host", "path", (F.col("found.verdict") == "block").cast("double").alias("label"))
    else:
        source = labelled.select(F.col("url").cast("string").alias("url"), F.col("label").cast("double").alias("label")).filter("label IS NOT NULL")
        source = source.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    sample = source.orderBy(F.xxhash64("url"), "url", "label").limit(train_rows)
    train = materialize(lexical(sample).withColumn("fold", F.pmod(F.xxhash64("url"), F.lit(FOLDS)).cast("int")), "urls")
    n, blocked = train.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not n or blocked in (0, n):
        constant = F.lit(1.0 if n and blocked else 0.0)
        return slim.select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", F.when(constant > 0.5, "block").otherwise("allow")).alias("verdict"), constant.alias("p_block"))
    prior = blocked / n
    keys = (("top", "f_top_rate"), ("section", "f_section_rate"))
    rates = {name: [materialize(x, name) for x in _rates(train, key, name, prior)] for key, name in keys}

    def whole(rows: DataFrame, fitting: bool = False) -> DataFrame:
        for key, name in keys:
            on = F.col(key) == F.col(name + "_key")
            rows = rows.join(F.broadcast(rates[name][fitting]), on & (F.col("fold") == F.col(name + "_fold")) if fitting else on, "left").withColumn(name, F.coalesce(name, F.lit(prior))).drop(name + "_key", name + "_fold")
        return rows

    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    model = GBTClassifier(featuresCol="features", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=1).fit(assembler.transform(whole(train, True)).select("features", "label"))
    scored = model.transform(assembler.transform(whole(lexical(slim))))
    verdict = F.coalesce("found.verdict", F.when(F.col("prediction") > 0.5, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", F.col("found.rule").alias("rule"), verdict.alias("verdict"), vector_to_array("probability")[1].alias("p_block"))
