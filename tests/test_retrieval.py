"""The inverted index against scores that are counted plainly."""

import math
import re
from collections import Counter

from orgloom.plans import retrieval

CHUNKS = [
    (1, "Commits by author name and author login"), (2, "issues by project name; Project 2"), (3, "Issues by project name; Project 3"), (4, None), (5, ""), (6, "?!"),
    (7, "commits by repo repo_7"), (8, "commits by repo repo_7"), (9, "author"), (10, "x " * 5000 + "author"), (None, "author without an id"),
]


def brute(chunks, goals, k):
    words = {i: Counter(re.findall("[a-z0-9_]+", (t or "").lower())) for i, t in chunks if i is not None}
    mean = sum(sum(w.values()) for w in words.values()) / len(words)
    df = Counter(t for w in words.values() for t in w)
    out = []
    for g, text in goals:
        scores = {}
        for i, w in words.items():
            for t in set(re.findall("[a-z0-9_]+", (text or "").lower())) & set(w):
                idf = math.log(1 + (len(words) - df[t] + 0.5) / (df[t] + 0.5))
                scores[i] = scores.get(i, 0) + idf * w[t] * 2.2 / (w[t] + 1.2 * (0.25 + 0.75 * sum(w.values()) / mean))
        best = sorted(((-round(s, 6), i) for i, s in scores.items()))[:k]
        out += [(g, i, -s, n + 1) for n, (s, i) in enumerate(best)]
    return sorted(out)


def test_search_equals_plain_scores(spark):
    goals = [(1, "author author login"), (2, "Project 2"), (3, "repo_7"), (4, None), (5, ""), (6, "unheard of"), (7, "issues, commits & x")]
    index = retrieval.build_index(spark.createDataFrame(CHUNKS, "id long, document string").repartition(3))
    got = retrieval.search(index, spark.createDataFrame(goals, "goal_id long, goal string"), 3).collect()
    assert sorted((r["goal_id"], r["id"], r["score"], r["nth"]) for r in got) == brute(CHUNKS, goals, 3)
    assert [r["id"] for r in sorted(got, key=lambda r: r["nth"]) if r["goal_id"] == 3] == [7, 8]  # ties by id


def test_other_columns_and_empty_tables(spark):
    wide = spark.createDataFrame([(1, "a b", "clash", 9)], "key long, text string, term string, tf long")
    index = retrieval.build_index(wide, "key", "text")
    goals = spark.createDataFrame([(5, "b", 1.0)], "goal_id long, goal string, score double")
    assert [tuple(r)[:2] for r in retrieval.search(index, goals).collect()] == [(5, 1)]
    assert retrieval.build_index(wide.limit(0), "key", "text").count() == 0
    assert retrieval.search(index, goals.limit(0)).count() == 0


def test_goals_lead_to_their_tables(spark, sf_dir):
    got = {(r["goal_id"], r["platform"], r["table_name"]) for r in retrieval.QUERIES["goal_answers"](spark, sf_dir).collect()}
    assert got == {(0, "jira", "issues"), (1, "github", "commits"), (2, "github", "commits"), (3, "jira", "issues")}


def test_values_with_quotes_and_types(spark):
    rows = spark.createDataFrame([("k1", "O'Brien", 7), ("k2", None, 8), ("k3", "O'Brien", None)], "key string, name string, size int")
    goals = spark.createDataFrame([(1, "people named brien"), (2, "people size 8")], "goal_id long, goal string")
    got = retrieval.answer_goals(goals, {"people": ("hr", rows)}, {"people": ["name", "size"]}, {"people": "key"})
    assert sorted((r["goal_id"], r["key"]) for r in got.collect()) == [(1, "k1"), (1, "k3"), (2, "k2")]


def test_pairs_of_a_common_term_do_not_move(spark, monkeypatch):
    """60 goals and 400 chunks with one word: 24,000 pairs, of which a block gives the best. However small blocks and packs are, the result is that of plain scores."""
    from test_pairs_at_size import pairs_moved

    chunks = [(i, f"brand w{i % 37} w{i % 11}") for i in range(400)]
    goals = [(i, f"brand w{i % 41}") for i in range(60)]
    index = retrieval.build_index(spark.createDataFrame(chunks, "id long, document string"))
    for block, pack in ((1 << 18, 1 << 16), (300, 50)):
        monkeypatch.setattr(retrieval, "BLOCK_POSTINGS", block)
        monkeypatch.setattr(retrieval, "PACK_TERMS", pack)
        df = retrieval.search(index, spark.createDataFrame(goals, "goal_id long, goal string"), 3)
        assert sorted((r["goal_id"], r["id"], r["score"], r["nth"]) for r in df.collect()) == brute(chunks, goals, 3)
        assert pairs_moved(df) < 8_000
