"""Secret scanning with a random forest that removes false positives. DataFrame and ML functions only.

Candidates are long runs of key characters, what is assigned to a name like password, and passwords in URLs. A forest fitted on labelled findings
judges each from its length, character transitions, dictionary coverage, path and
neighbouring words. The fitted trees become one expression, so a text is read, judged and redacted
in one pass, without moving rows.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, fresh, materialize
from .url_filters import characters, entropy

_SIGN = r"A-Za-z0-9+/_\-"
_NAMES = "passw(?:or)?d|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credentials?|auth"
#: A run of 16 or more key characters with a digit or an inner capital.
RUN = rf"(?<![{_SIGN}])(?=[{_SIGN}]{{16}})(?=[{_SIGN}]*?(?:[0-9]|[a-z][A-Z]))[{_SIGN}]+={{0,2}}"
_GIVEN = rf"(?i:{_NAMES})[\"'`]?\s{{0,2}}[:=]\s{{0,2}}"
#: Six or more signs between quotes that a name is assigned, blanks and all, up to the closing quote on the line.
QUOTED = "|".join(rf"(?<=[:=]\s{{0,2}}{q})(?=[^{q}\n]{{6}})(?<={_GIVEN}{q})[^{q}\n]++(?={q})" for q in "\"'`")
#: Six or more signs that a name is assigned, up to a space, quote, comma or semicolon.
ASSIGNED = rf"(?<=[:=\s\"'`])(?<=[:=]\s{{0,2}}[\"'`]?)(?=[^\s\"'`,;<>]{{6}})(?<={_GIVEN}[\"'`]?)[^\s\"'`,;<>]+"
#: What stands between user: and @ in a URL; a user of more signs than the pattern looks back is not seen.
IN_URL = r"(?<=[^\s/:@]:)(?=[^\s/:@]{3,}+@)(?<=://[^\s/:@]{1,4096}:)[^\s/:@]++"
CANDIDATE = f"{IN_URL}|{QUOTED}|{ASSIGNED}|{RUN}"
DICTIONARY = (
    "the and for with this that from have word page file data user name account code test example value index list item time date year price number order "
    "product report image photo video music book news blog post home link path lib bin usr share local main config setting service server client request "
    "response get set add delete update create build release version type class function string object array table column row key here your my"
).split()
SECRET_WORDS = "token|secret|api[_-]?key|access[_-]?key|private|passw|pwd|auth|bearer|credential|signature|session"
OTHER_WORDS = "commit|sha1|sha256|md5|checksum|digest|revision|uuid|guid|card|iban|isbn|phone|order|invoice|build|version|file|path|http|see|page"
PLACEHOLDER = r"example|sample|dummy|placeholder|your|xxxx|test|here|changeme|abcdef|123456|0000|\*\*\*|\$\{|environ|\(\)|password"
FEATURES = ["length", "digits", "uppers", "lowers", "signs", "transitions", "distinct", "entropy", "dictionary", "hex", "secret_word", "other_word", "assigned", "quoted", "path", "placeholder", "number", "in_url"]
MASK = "[SECRET]"
#: Labelled findings that the forest is fitted on, at most.
TRAIN_ROWS = 20_000


def _share(text: Column, pattern: str) -> Column:
    return 1 - F.length(F.regexp_replace(text, pattern, "")) / F.length(text)


def features(c: Column, before: Column, after: Column) -> Column:
    """array<double> of FEATURES of a candidate between the texts ``before`` and ``after``."""
    n = F.length(c).cast("double")
    flag = lambda x: F.coalesce(x.cast("double"), F.lit(0.0))
    near = F.lower(F.right(before, F.lit(48)))
    return F.array(
        n, _share(c, "[0-9]"), _share(c, "[A-Z]"), _share(c, "[a-z]"), _share(c, "[^A-Za-z0-9]"),
        (F.size(F.regexp_extract_all(c, F.lit("[A-Z]+|[a-z]+|[0-9]+|[^A-Za-z0-9]+"), F.lit(0))) - 1) / n,
        F.size(F.array_distinct(characters(c))) / n, entropy(c), _share(F.lower(c), "|".join(sorted(DICTIONARY, key=len, reverse=True))),
        flag(c.rlike("^[0-9a-fA-F]+$")), flag(near.rlike(f"(?:{SECRET_WORDS})[^a-z\\n]*$|(?:{SECRET_WORDS})\\W+\\w+\\W+$")), flag(near.rlike(f"(?:{OTHER_WORDS})\\W*(?:\\w+\\W+)?$")),
        flag(near.rlike("[=:]\\s*[\"'`]?$")), flag(near.rlike("[\"'`]$") | F.left(after, F.lit(1)).isin('"', "'", "`")),
        flag(c.contains("/") | near.rlike("[/.]$")), flag(F.lower(c).rlike(PLACEHOLDER)), flag(c.rlike("^[0-9_-]+$")), flag(near.rlike("://[^\\s/:@]+:$")),
    )


#: Parts of which every name of ASSIGNED has one.
_HINTS = ("passw", "passphrase", "pwd", "secret", "token", "key", "credential", "auth")


def candidates(text: Column) -> tuple[Column, Column]:
    """(candidates of a text, the texts around them: one more). A text without any such name or URL is only searched for runs."""
    lower = F.lower(text)
    named = reduce(lambda a, b: a | b, [lower.contains(h) for h in _HINTS]) & (text.contains(":") | text.contains("="))
    both = named | (text.contains("://") & text.contains("@"))
    found = F.when(both, F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))).otherwise(F.regexp_extract_all(text, F.lit(RUN), F.lit(0)))
    return found, F.when(both, F.split(text, CANDIDATE, -1)).otherwise(F.split(text, RUN, -1))


def example_findings(spark: SparkSession, rows: int = 6000) -> DataFrame:
    """(text, label): made-up findings in the usual shapes of keys, and of what is taken for keys."""
    seed = F.sha2(F.col("id").cast("string"), 256)
    coded = F.regexp_replace(F.base64(F.unhex(F.concat(seed, F.sha2(F.concat(seed, F.lit("x")), 256)))), "=", "")
    known = F.split(F.lit(" ".join(DICTIONARY)), " ")
    said = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: F.element_at(known, (F.pmod(F.xxhash64(F.col("id"), k), F.lit(len(DICTIONARY))) + 1).cast("int")))
    rows_of = spark.range(0, rows, numPartitions=1).select("id", seed.alias("h"), coded.alias("base"), said.alias("w"))
    h, base = F.col("h"), F.col("base")
    word = lambda k: F.col("w")[k]
    sub = lambda x, n: F.substring(x, 1, n)
    odd = lambda k: F.translate(F.substring(F.sha2(F.concat(F.lit(f"w{k}"), h), 256), 1, 6), "0123456789", "oiuaerstln")  # noqa: E731  a word of no dictionary
    digits = lambda n: F.substring(F.regexp_replace(F.concat(h, F.sha2(h, 256)), "[a-f]", ""), 1, n)
    say = F.concat(word(1), F.lit(" "), word(2), F.lit(" "))
    yes = [
        F.concat(say, F.lit('token = "'), sub(h, 40), F.lit('" ')), F.concat(say, F.lit('TOKEN = "'), F.upper(sub(h, 40)), F.lit('"!! ')),
        F.concat(say, F.lit("api_key: "), sub(base, 40), F.lit("\n")), F.concat(say, F.lit("AKIA"), F.translate(F.upper(sub(h, 16)), "01", "QZ"), F.lit(" ")),
        F.concat(say, F.lit("ghp_"), sub(F.regexp_replace(base, "[+/]", "x"), 36)), F.concat(F.lit("password="), sub(base, 20)),
        F.concat(F.lit("Authorization: Bearer "), base), F.concat(F.lit("export SECRET_KEY='"), sub(h, 32), F.lit("'")),
        F.concat(F.lit("passwd: '"), F.initcap(sub(F.translate(h, "0123456789", "ghkmprstvz"), 5)), F.lit("&"), digits(3), F.lit("!'")), F.concat(F.lit("postgres://"), word(3), F.lit(":"), sub(F.translate(base, "+/", "xy"), 9), F.lit("@db/"), word(4)),
        F.concat(say, F.lit('api-key = "'), sub(F.translate(h, "0123456789", "ghjkmnpqrs"), 24), F.lit('"')), F.concat(say, F.lit("secret="), sub(F.translate(base, "0123456789+/", "ghjkmnpqrsXY"), 20), F.lit(";")),
        F.concat(say, F.lit("auth_token="), sub(h, 64)), F.concat(say, F.lit('secret: "'), sub(base, 32), F.lit('"')),
        F.concat(say, F.lit("password = '"), odd(8), F.lit(" "), odd(9), F.lit(" "), odd(10), F.lit(" "), odd(11), F.lit(" "), digits(2), F.lit("'")), F.concat(F.lit('passphrase: "'), odd(8), F.lit(" "), odd(9), F.lit(" "), odd(10), F.lit(" "), odd(11), F.lit('"')),
    ]
    no = [
        F.concat(say, digits(16), F.lit(" "), word(3)), F.concat(say, F.lit("commit "), sub(h, 40)), F.concat(F.lit("md5 "), sub(h, 32), F.lit("  file")),
        F.concat(say, F.lit("id "), F.regexp_replace(sub(h, 32), "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-")), F.concat(F.lit("see /usr/share/"), word(3), F.lit("/"), word(4), digits(3), F.lit("/"), word(5)),
        F.concat(say, word(3), F.initcap(word(4)), F.initcap(word(5)), F.initcap(word(6)), digits(2)), F.concat(say, F.lit('api_key = "YOUR_API_KEY_'), digits(5), F.lit('_HERE"')),
        F.concat(F.lit("token = "), F.lit("xxxxxxxxxxxxxxxx"), digits(4)), F.concat(say, word(3), F.lit("-"), word(4), F.lit("-"), word(5), F.lit("-"), word(6), F.lit("-"), digits(4)),
        F.concat(say, F.lit("2024-"), digits(2), F.lit("-"), digits(2), F.lit("T00-00-00-000")), F.concat(say, F.lit("card: "), digits(16), F.lit("### ")), F.concat(say, F.lit("sha256 "), h),
        F.concat(F.lit("password: "), word(3), F.lit("-"), word(4), F.lit(" "), word(5)), F.concat(say, F.lit("token = "), word(3), word(4), F.lit(" "), word(5)), F.concat(say, F.lit("secret: "), F.element_at(F.array(*[F.lit(w) for w in ("required", "optional", "disabled", "undefined", "<hidden>", "******", "changeme", "${SECRET}", "os.environ", "getSecret()")]), (F.pmod(F.xxhash64("id", F.lit(9)), F.lit(10)) + 1).cast("int"))),
        F.concat(F.lit("https://"), word(3), F.lit(":"), F.element_at(F.array(*[F.lit(w) for w in ("password", "example", "your-password", "xxxxxx", "test", "user")]), (F.pmod(F.xxhash64("id", F.lit(8)), F.lit(6)) + 1).cast("int")), F.lit("@"), word(4), F.lit(".org")),
        F.concat(say, F.lit("YOUR_"), F.upper(word(3)), F.lit("_KEY_"), digits(5), F.lit("_HERE")), F.concat(word(3), F.initcap(word(4)), F.initcap(word(5)), F.lit("By"), F.initcap(word(6)), sub(digits(4), 1), F.lit(" "), word(7)),
    ]
    no += [
        F.concat(say, F.lit('password: "'), F.initcap(word(3)), F.lit(" the "), word(4), F.lit(" for your "), word(5), F.lit(" here"), F.lit('"')), F.concat(F.lit("secret = '"), word(3), F.lit(" and "), word(4), F.lit(" of the "), word(5), F.lit(" test'")),
    ]
    pick = lambda made: F.element_at(F.array(*made), (F.pmod(F.floor(F.col("id") / 2), F.lit(len(made))) + 1).cast("int"))
    return rows_of.select(F.when(F.col("id") % 2 == 0, pick(yes)).otherwise(pick(no)).alias("text"), (1 - F.col("id") % 2).cast("double").alias("label"))


def training_rows(findings: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(label, FEATURES): the first candidate of each labelled finding that has one."""
    found, around = candidates(F.col("text"))
    rows = findings.filter("text IS NOT NULL AND label IS NOT NULL").orderBy(F.xxhash64("text"), "text", "label").limit(train_rows)
    rows = rows.withColumns({"c": found, "a": around}).filter(F.size("c") > 0)
    rows = rows.select(F.col("label").cast("double").alias("label"), features(F.col("c")[0], F.col("a")[0], F.col("a")[1]).alias("f"))
    return rows.select("label", *[F.col("f")[i].alias(name) for i, name in enumerate(FEATURES)])


def node_table(roots: list) -> dict[str, list]:
    """All nodes of fitted trees in one table: ``feature`` and ``threshold``, where it goes on to the ``left`` (up to the threshold) and ``right``, and the ``share`` of label 1; ``root`` of each tree.

    A leaf goes on to itself."""
    out: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "share", "root")}

    def add(node) -> int:
        at = len(out["feature"])
        stats = list(node.impurityStats().stats())
        for k, v in (("feature", 0), ("threshold", 1e300), ("left", at), ("right", at), ("share", float(stats[1] / sum(stats)) if len(stats) > 1 and sum(stats) else 0.0)):
            out[k].append(v)
        if node.subtreeDepth():
            split = node.split()
            out["feature"][at], out["threshold"][at] = split.featureIndex(), float(split.threshold())
            out["left"][at] = add(node.leftChild())
            out["right"][at] = add(node.rightChild())
        return at

    out["root"] = [add(r) for r in roots]
    return out


class Forest:
    """A forest fitted on labelled findings; ``score`` gives its expression: a walk over the table of its nodes, whose size does not grow with the trees."""

    def __init__(self, findings: DataFrame, trees: int = 20, depth: int = 6, train_rows: int = TRAIN_ROWS):
        train = materialize(training_rows(findings, train_rows), "findings")
        labels = {r["label"] for r in train.select("label").distinct().limit(3).collect()}
        self.constant, self.depth = None if len(labels) > 1 else (labels.pop() if labels else 0.0), depth
        if self.constant is None:
            model = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=trees, maxDepth=depth, seed=1).fit(VectorAssembler(inputCols=FEATURES, outputCol="x").transform(train))
            self.nodes = node_table([t._call_java("rootNode") for t in model.trees])

    def score(self, x: Column) -> Column:
        if self.constant is not None:
            return F.lit(self.constant)
        table = {k: F.from_json(F.lit(json.dumps(v)), f"array<{'double' if k in ('threshold', 'share') else 'int'}>") for k, v in self.nodes.items()}  # folded to constants
        go = lambda at, _: F.when(F.get(x, F.get(table["feature"], at)) <= F.get(table["threshold"], at), F.get(table["left"], at)).otherwise(F.get(table["right"], at))
        steps = F.sequence(F.lit(1), F.lit(self.depth))
        total = F.aggregate(table["root"], F.lit(0.0), lambda s, root: s + F.get(table["share"], F.aggregate(steps, root, go)))
        return total / len(self.nodes["root"])


_FOUND = "array<struct<start:int,length:int,score:double>>"
#: Candidates that are put in their places together; groups are then moved to theirs, so that the time is not the square of their number.
GROUP = 256


def _places(around: Column, judged: Column) -> Column:
    """_FOUND of the candidates of a text, from the texts around them."""
    pairs = F.arrays_zip(F.slice(around, 1, F.size(judged)).alias("a"), judged.alias("j"))

    def place(s: Column, x: Column) -> Column:
        begin, n = s["at"] + F.length(x["a"]), F.length(x["j"]["c"])
        return F.struct((begin + n).alias("at"), F.concat(s["out"], F.array(F.struct(begin.alias("start"), n.alias("length"), x["j"]["score"].alias("score")))).alias("out"))

    first = F.sequence(F.lit(1), F.size(judged), F.lit(GROUP))
    groups = F.transform(first, lambda i: F.aggregate(F.slice(pairs, i, F.lit(GROUP)), F.struct(F.lit(0).alias("at"), F.array().cast(_FOUND).alias("out")), place))
    moved = F.aggregate(
        groups, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_FOUND}>").alias("out")),
        lambda s, g: F.struct(
            (s["at"] + g["at"]).alias("at"),
            F.concat(s["out"], F.array(F.transform(g["out"], lambda y: F.struct((y["start"] + s["at"]).alias("start"), y["length"].alias("length"), y["score"].alias("score"))))).alias("out"),
        ),
        lambda s: s["out"],
    )
    return F.flatten(moved)


def _scanned(docs: DataFrame, forest: Forest, text_col: str, limit: float, mask: str, names: list[str]) -> DataFrame:
    """``docs`` with findings, the number of secrets and the redacted text under ``names``, which it must not have."""
    bound_batches(docs.sparkSession)
    cand, around, judged = fresh(docs, "secret_candidates", "secret_around", "secret_judged")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    found, rest = candidates(text)
    step = docs.withColumn(cand, found)
    some = F.size(cand) > 0
    step = step.withColumn(around, F.when(some, rest))
    made = F.transform(F.col(cand), lambda c, i: F.struct(c.alias("c"), features(c, F.col(around)[i], F.col(around)[i + 1]).alias("f")))
    step = step.withColumn(judged, F.when(some, made))
    step = step.withColumn(judged, F.transform(judged, lambda x: F.struct(x["c"].alias("c"), forest.score(x["f"]).alias("score"))))
    replaced = F.concat(F.transform(judged, lambda x: F.when(x["score"] >= limit, F.lit(mask)).otherwise(x["c"])), F.array(F.lit("")))
    redacted = F.array_join(F.zip_with(F.col(around), replaced, lambda a, b: F.concat(a, b)), "")
    return step.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.when(some, _places(F.col(around), F.col(judged))).otherwise(F.array().cast(_FOUND)).alias(names[0]),
        F.when(some, F.size(F.filter(judged, lambda x: x["score"] >= limit))).otherwise(0).cast("long").alias(names[1]),
        F.when(some, redacted).otherwise(F.col(f"`{text_col}`").cast("string")).alias(names[2]),
    )


def scan(docs: DataFrame, forest: Forest, text_col: str = "text", limit: float = 0.5, mask: str = MASK) -> DataFrame:
    """``docs`` with secret_findings (array<struct<start,length,score>> of all candidates, start in characters from 0), n_secrets and redacted_text.

    Candidates that score at least ``limit`` are secrets, and are replaced by ``mask``. Null texts stay null and have
    no candidates; repeated rows are judged alike; an empty table gives an empty result; columns of ``docs``
    of the three names are replaced."""
    names = ["secret_findings", "n_secrets", "redacted_text"]
    have = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in names or c == text_col])
    wanted = fresh(have, *names)
    return _scanned(have, forest, text_col, limit, mask, wanted).select(*[F.col(f"`{c}`") for c in have.columns if c.lower() not in names], *[F.col(w).alias(n) for w, n in zip(wanted, names, strict=True)])


def redact(docs: DataFrame, forest: Forest, text_col: str = "text", limit: float = 0.5, mask: str = MASK) -> DataFrame:
    """``docs`` with secrets in its texts masked; the same rows and columns, whatever their names."""
    names = fresh(docs, "found_secrets", "count_secrets", "masked_text")
    done = _scanned(docs, forest, text_col, limit, mask, names)
    return done.select(*[F.col(names[2]).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
