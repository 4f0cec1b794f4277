"""From goals in words to rows: an inverted index over chunks with BM25 impacts, and plans from what it finds."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.adapters import load, with_sql
from ..sources.scratch import written
from .compiler import ColumnSelection, Compare, TargetSchema, compile_target

#: How soon repeats of a term stop to count, and how much long chunks lose.
K1, B = 1.2, 0.75
WORD = "[a-z0-9_]+"


def terms(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, term, tf) of each distinct term of a text; a null or empty text has none."""
    words = F.explode(F.regexp_extract_all(F.lower(text_col), F.lit(WORD), F.lit(0)))
    return df.select(F.col(id_col).alias("id"), words.alias("term")).groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf"))


def build_index(chunks: DataFrame, id_col: str = "id", text_col: str = "document") -> DataFrame:
    """(term, id, impact): what a term adds to the score of a chunk by BM25, once for each chunk and term.

    Ids tell chunks apart: rows of one id count as one chunk with all their words. Chunks without a word have no posting, yet count among all
    chunks; a chunk without an id is left out. An empty table gives an empty index. Of the whole table only two numbers go to the driver."""
    chunks = chunks.filter(F.col(id_col).isNotNull())
    found = terms(chunks, id_col, text_col)
    many = chunks.select(id_col).distinct().count()
    length = found.agg(F.sum("tf")).first()[0] or 0
    mean = length / many if many else 1.0
    sizes = found.groupBy("id").agg(F.sum("tf").alias("size"))
    held = found.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.log(1 + (F.lit(float(many)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("size") / F.lit(mean)))
    return found.join(sizes, "id").join(held, "term").select("term", "id", (weight * part).alias("impact"))


#: Postings of a block of chunks, and terms of a pack of goals, about; a task scores one block for one pack at a time.
BLOCK_POSTINGS, PACK_TERMS = 1 << 18, 1 << 16


def search(index: DataFrame, goals: DataFrame, k: int = 5, goal_col: str = "goal_id", text_col: str = "goal") -> DataFrame:
    """(goal_id, id, score, nth): the k best chunks of each goal, by score and then id; a goal that shares no term with any chunk has no row.

    ``goals`` is a stated query set. A repeated term of a goal counts once. Scores are sums of impacts. A common term makes a pair of each goal and chunk that
    have it, so pairs don't move and are not held: a block of chunks has all postings of them, and gives the k best of it for each goal."""
    asked = written(terms(goals, goal_col, text_col).select(F.col("id").alias("goal_id"), F.col("term").alias("asked")).filter("goal_id IS NOT NULL"), "asked")
    postings = written(index.select("term", "id", "impact"), "postings")
    blocks, packs = (max(1, -(-df.count() // n)) for df, n in ((postings, BLOCK_POSTINGS), (asked, PACK_TERMS)))
    dealt = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left, right = postings.withColumn("block", dealt("id", blocks)).withColumn("pack", each(packs)), asked.withColumn("pack", dealt("goal_id", packs)).withColumn("block", each(blocks))

    def best(held: pa.Table, goals: pa.Table) -> pa.Table:
        ids, words, of = (x.combine_chunks().dictionary_encode() for x in (held["id"], held["term"], goals["goal_id"]))
        rank = np.empty(len(ids.dictionary), np.int64)
        rank[np.asarray(pc.sort_indices(ids.dictionary))] = np.arange(len(rank))
        word = np.asarray(words.indices)
        order = np.argsort(word, kind="stable")
        chunk, impact, ends = np.asarray(ids.indices)[order], np.asarray(held["impact"])[order], np.searchsorted(word[order], np.arange(len(words.dictionary) + 1))
        term = np.asarray(pc.fill_null(pc.index_in(goals["asked"].combine_chunks(), value_set=words.dictionary), -1))
        goal, term = np.asarray(of.indices)[term >= 0], term[term >= 0]
        order = np.argsort(goal, kind="stable")
        goal, term = goal[order], term[order]
        found: list[tuple[np.ndarray, ...]] = []
        for ts in np.split(np.arange(len(goal)), np.flatnonzero(np.diff(goal)) + 1):
            if not len(ts):
                continue
            at = np.concatenate([np.arange(ends[x], ends[x + 1]) for x in term[ts]])
            met, nth = np.unique(chunk[at], return_inverse=True)
            score = np.bincount(nth, weights=impact[at])
            first = np.lexsort((rank[met], -np.round(score, 6)))[:k]
            found.append((np.full(len(first), goal[ts[0]]), met[first], score[first]))
        g, i, s = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pa.table({"goal_id": of.dictionary.take(pa.array(g, pa.int64())), "id": ids.dictionary.take(pa.array(i, pa.int64())), "score": pa.array(s, pa.float64())})

    kinds = f"goal_id {asked.schema['goal_id'].dataType.simpleString()}, id {postings.schema['id'].dataType.simpleString()}, score double"
    met = left.groupBy("block", "pack").cogroup(right.groupBy("block", "pack")).applyInArrow(best, kinds).withColumn("score", F.round("score", 6))
    w = Window.partitionBy("goal_id").orderBy(F.desc("score"), "id")
    return met.withColumn("nth", F.row_number().over(w).cast("bigint")).filter(F.col("nth") <= k)


def value_chunks(tables: dict[str, tuple[str, DataFrame]], columns: dict[str, list[str]]) -> DataFrame:
    """(id, document, platform, table_name, column_name, value): a chunk for each distinct value of the columns that may answer goals; nulls have none."""

    def of(name: str, column: str) -> DataFrame:
        platform, df = tables[name]
        value = F.col(column).cast("string")
        rows = df.filter(value.isNotNull()).select(value.alias("value")).distinct()
        return rows.select(
            F.concat_ws(".", F.lit(name), F.lit(column), "value").alias("id"), F.concat_ws(" ", F.lit(name), F.lit(column.replace("_", " ")), "value").alias("document"),
            F.lit(platform).alias("platform"), F.lit(name).alias("table_name"), F.lit(column).alias("column_name"), "value",
        )

    return reduce(DataFrame.unionByName, [of(n, c) for n, cs in columns.items() for c in cs])


def targets(chunks: DataFrame, found: DataFrame, keys: dict[str, str]) -> list[tuple[object, TargetSchema]]:
    """(goal_id, target) for each chunk found: the keys of those rows of its table that have its value. As many as ``found`` has rows, k for each goal."""
    rows = found.join(chunks, "id").orderBy("goal_id", "nth").collect()
    return [(r["goal_id"], TargetSchema(r["platform"], r["table_name"], [ColumnSelection(keys[r["table_name"]], "key")], Compare(r["column_name"], "=", r["value"]), "distinct")) for r in rows]


def answer_goals(goals: DataFrame, tables: dict[str, tuple[str, DataFrame]], columns: dict[str, list[str]], keys: dict[str, str], k: int = 1) -> DataFrame:
    """(goal_id, platform, table_name, key): the rows that the k best chunks of each goal lead to, through the plan compiler.

    ``goals`` is a list that a person wrote, with a target for each goal and chunk; use ``search`` for many."""
    chunks = value_chunks(tables, columns)
    made = [
        compile_target(tables[t.table][1], t).select(F.lit(goal).alias("goal_id"), F.lit(t.platform).alias("platform"), F.lit(t.table).alias("table_name"), F.col("key").cast("string").alias("key"))
        for goal, t in targets(chunks, search(build_index(chunks), goals, k), keys)
    ]
    return reduce(DataFrame.unionByName, made) if made else goals.sparkSession.createDataFrame([], "goal_id long, platform string, table_name string, key string")


def search_sql(chunks: str, goals: str, k: int) -> str:
    """``search`` over ``build_index`` as SQL, of SELECTs of (id, document) and (goal_id, goal)."""
    return f"""chunks AS ({chunks}), goals AS ({goals}),
words AS (SELECT id, unnest(regexp_extract_all(lower(document), '{WORD}')) AS term FROM chunks), found AS (SELECT id, term, count(*) AS tf FROM words GROUP BY ALL),
sizes AS (SELECT id, sum(tf) AS size FROM found GROUP BY id), held AS (SELECT term, count(*) AS df FROM found GROUP BY term),
whole AS (SELECT count(DISTINCT id)::DOUBLE AS many, (SELECT sum(tf) FROM found)::DOUBLE / count(DISTINCT id) AS mean FROM chunks),
asked AS (SELECT DISTINCT goal_id, unnest(regexp_extract_all(lower(goal), '{WORD}')) AS term FROM goals),
scored AS (SELECT goal_id, id, round(sum(ln(1 + (many - df + 0.5) / (df + 0.5)) * (tf * {K1 + 1} / (tf + {K1} * ({1 - B} + {B} * size / mean)))), 6) AS score
  FROM found JOIN sizes USING (id) JOIN held USING (term) JOIN asked USING (term), whole GROUP BY goal_id, id),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY goal_id ORDER BY score DESC, id) AS nth FROM scored) WHERE nth <= {k})"""


#: Goals that a person might write, the columns whose values may answer them, and the keys of the rows.
GOALS = ["which issues belong to Project 2", "commits in repo_7", "what has login7 committed", "issues of type story", "nothing of the kind"]
COLUMNS = {"issues": ["PROJECT_NAME", "STATUS_NAME", "ISSUE_TYPE"], "commits": ["REPO", "AUTHOR_LOGIN", "AUTHOR_NAME"]}
KEYS, PLATFORMS = {"issues": "ISSUE_KEY", "commits": "COMMIT_SHA"}, {"issues": "jira", "commits": "github"}


def _answered(s: SparkSession, d: str) -> DataFrame:
    goals = s.createDataFrame(list(enumerate(GOALS)), "goal_id long, goal string")
    return answer_goals(goals, {n: (p, load(s, d, n)) for n, p in PLATFORMS.items()}, COLUMNS, KEYS)


def _distinct(rows: DataFrame, columns: list[str], id_col: str, text_col: str) -> DataFrame:
    """Each distinct text of parts under the first of its ids, so that copies meet as one."""
    return rows.groupBy(F.concat_ws(" ", *columns).alias(text_col)).agg(F.min("p_partkey").cast("bigint").alias(id_col))


def _searched(s: SparkSession, d: str) -> DataFrame:
    parts = load(s, d, "part")
    chunks = _distinct(parts, ["p_name", "p_brand", "p_type"], "id", "document")
    return search(build_index(chunks), _distinct(parts.filter("p_partkey % 50 = 0"), ["p_name", "p_brand"], "goal_id", "goal"), 5)


_VALUES = " UNION ALL ".join(f"SELECT DISTINCT '{t}.{c}.' || {c} AS id, '{t} {c.replace('_', ' ')} ' || {c} AS document FROM {t} WHERE {c} IS NOT NULL" for t, cs in COLUMNS.items() for c in cs)
_ROWS = " UNION ALL ".join(f"SELECT '{PLATFORMS[t]}' AS platform, '{t}' AS table_name, '{t}.{c}.' || {c} AS id, {KEYS[t]} AS key FROM {t}" for t, cs in COLUMNS.items() for c in cs)
_GOALS = " UNION ALL ".join(f"SELECT {i}::BIGINT AS goal_id, '{g}' AS goal" for i, g in enumerate(GOALS))
QUERIES = {"goal_answers": _answered, "goal_search": _searched}
ORACLES = {
    "goal_answers": with_sql(f"WITH {search_sql(_VALUES, _GOALS, 1)} SELECT DISTINCT goal_id, platform, table_name, key FROM best JOIN ({_ROWS}) USING (id)", *COLUMNS),
    "goal_search": "WITH "
    + search_sql(
        "SELECT min(p_partkey)::BIGINT AS id, concat_ws(' ', p_name, p_brand, p_type) AS document FROM part GROUP BY 2",
        "SELECT min(p_partkey)::BIGINT AS goal_id, concat_ws(' ', p_name, p_brand) AS goal FROM part WHERE p_partkey % 50 = 0 GROUP BY 2",
        5,
    )
    + " SELECT goal_id, id, score, nth FROM best",
}
