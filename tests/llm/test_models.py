"""Models against plain Python, and on rows that they were not fitted on."""

import collections
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from orgloom.llm import quality_mil, queries, url_filters

TEXTS = ["", "One two TWO three. " * 40, "a1 ## $$ b c a1 ## $$ b c", "Ünï ça va? " + "x" * 300, "\n\n line one\nline two\nline one\n", "WORD " * 130 + "end"]


def test_features_by_hand():
    raw = [t.encode() for t in TEXTS]
    offs = np.cumsum([0, *map(len, raw)])
    x, at = quality_mil.passage_features(np.frombuffer(b"".join(raw), np.uint8), offs)
    for d, t in enumerate(raw):
        words = t.split()
        groups = [words[i : i + quality_mil.PASSAGE] for i in range(0, len(words), quality_mil.PASSAGE)] or [[]]
        assert at[d + 1] - at[d] == len(groups)
        for g, row in zip(groups, x[at[d] : at[d + 1]], strict=True):
            n, letters = max(len(g), 1), max(sum(map(len, g)), 1)
            low = sum(c in b"abcdefghijklmnopqrstuvwxyz" for w in g for c in w)
            up = sum(c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" for w in g for c in w)
            other = sum(c >= 128 for w in g for c in w)
            assert row[0] == pytest.approx(low / letters) and row[1] == pytest.approx(up / letters) and row[5] == pytest.approx(other / letters)
            assert row[6] == pytest.approx(sum(all(65 <= c < 91 for c in w) for w in g) / n)
            if words:
                assert row[11] == pytest.approx(math.log(n) / math.log(64)) and row[12] == pytest.approx(sum(map(len, g)) / n / 8, rel=1e-5)
        for i, lag in enumerate(quality_mil.LAGS):
            same = [k >= lag and words[k].lower() == words[k - lag].lower() for k in range(len(words))]
            want = [sum(same[s : s + 64]) / max(len(words[s : s + 64]), 1) for s in range(0, max(len(words), 1), 64)]
            assert x[at[d] : at[d + 1], 15 + i].tolist() == pytest.approx(want)


def test_attention_by_hand():
    r = np.random.default_rng(4)
    m = quality_mil.GatedAttention(hidden=5, gate=3)
    m.mean, m.scale = r.normal(size=quality_mil.N_FEATURES), 1 + r.random(quality_mil.N_FEATURES)
    x, at = r.normal(size=(9, quality_mil.N_FEATURES)), np.array([0, 1, 4, 9])
    p, want = m.p, []
    for s, e in zip(at[:-1], at[1:], strict=True):
        hidden, weight = [], []
        for row in x[s:e]:
            h = np.tanh(np.clip((row - m.mean) / m.scale, -8, 8) @ p["E"] + p["e"])
            gate = np.tanh(h @ p["V"]) / (1 + np.exp(-(h @ p["U"])))
            hidden.append(h)
            weight.append(math.exp(float(gate @ p["w"][:, 0])))
        z = sum(w * h for w, h in zip(weight, hidden, strict=True)) / sum(weight)
        want.append(1 / (1 + math.exp(-float(z @ p["c"][:, 0] + p["b"][0]))))
    assert m.score(x, at).tolist() == pytest.approx(want)
    again = quality_mil.GatedAttention.of(m.plain())
    assert again.score(x, at).tolist() == pytest.approx(want)


def test_gradient_by_differences():
    r = np.random.default_rng(6)
    x, at, y = r.normal(size=(8, quality_mil.N_FEATURES)), np.array([0, 2, 5, 8]), np.array([1.0, 0.0, 1.0])

    def loss(m, x):
        s = m._forward(x, at)[-1]
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    m = quality_mil.GatedAttention(hidden=4, gate=2)
    z = np.clip((x - x.mean(axis=0)) / (x.std(axis=0) + 1e-3), -8, 8)
    before = {k: v.copy() for k, v in m.p.items()}
    m.fit(x, at, y, epochs=1, rate=1e-3, decay=0.0)
    for k in before:  # one step of Adam goes down each slope by the rate
        i = tuple(0 for _ in before[k].shape)
        up, down = quality_mil.GatedAttention(hidden=4, gate=2), quality_mil.GatedAttention(hidden=4, gate=2)
        up.p, down.p = ({q: v.copy() for q, v in before.items()} for _ in range(2))
        up.p[k][i] += 1e-5
        down.p[k][i] -= 1e-5
        slope = (loss(up, z) - loss(down, z)) / 2e-5
        if abs(slope) > 1e-4:
            assert (m.p[k][i] - before[k][i]) == pytest.approx(-1e-3 * np.sign(slope), rel=0.05), k


def test_labels_of_held_out_rows_are_not_used(spark, sf_dir):
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (quality_mil.score(docs, quality_mil.fit(docs, x)).orderBy("doc_id").collect() for x in (labels, turned))
    assert one == two and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in one)


URLS = ["http://a.Example.org/x-1/y?a=1&b=2#f", "https://b.com", "", "nothing", "http://ö.fr/%20/ÄÄ1", "https://x.net/" + "p/" * 30, "http://a.b/?"]


def test_lexical_features_by_hand(spark):
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id int, url string").withColumns({"host": url_filters.host(F.col("url")), "path": url_filters.path(F.col("url"))})
    got = {r["page_id"]: r for r in url_filters.lexical(rows).collect()}
    for i, u in enumerate(URLS):
        r, count = got[i], collections.Counter(u)
        assert r["f_length"] == len(u) and r["f_digits"] == pytest.approx(sum(c in "0123456789" for c in u) / max(len(u), 1)) and r["f_hyphens"] == u.count("-")
        assert r["f_entropy"] == pytest.approx(-sum(n / len(u) * math.log2(n / len(u)) for n in count.values()) if u else 0)
        query = re.search(r"\?([^#]*)", u)
        assert r["f_params"] == (query[1].count("&") + 1 if query else 0)
        assert r["f_depth"] == r["path"].count("/") and r["f_labels"] == r["host"].count(".") and r["f_secure"] == u.startswith("https:")


def test_rates_leave_out_the_own_fold(spark):
    rows = [(f"k{i % 3}", i % 5, float(i % 2)) for i in range(60)]
    train = spark.createDataFrame(rows, "key string, fold int, label double")
    every, others = (x.collect() for x in url_filters._rates(train, "key", "r", 0.4, 10.0))
    for r in every:
        own = [y for k, _, y in rows if k == r["r_key"]]
        assert r["r"] == pytest.approx((sum(own) + 4) / (len(own) + 10))
    for r in others:
        rest = [y for k, f, y in rows if k == r["r_key"] and f != r["r_fold"]]
        assert r["r"] == pytest.approx((sum(rest) + 4) / (len(rest) + 10))


def test_url_trees_on_rows_they_have_not_seen(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet".replace("sf0.001", "sf0.1"))
    ruled = url_filters.judge_urls(pages, queries.RULES).filter("rule IS NOT NULL").select("page_id", "verdict").join(pages.select("page_id", "url"), "page_id")
    split = F.pmod(F.xxhash64("url", F.lit(5)), F.lit(4))
    labelled = ruled.filter(split != 0).select("url", (F.col("verdict") == "block").cast("double").alias("label"))
    asked = ruled.filter(split == 0)
    got = url_filters.judge_urls(asked.select("page_id", "url"), [], labelled).join(asked.select("page_id", F.col("verdict").alias("truth")), "page_id").collect()
    right = np.mean([r["verdict"] == r["truth"] for r in got])
    common = max(np.mean([r["truth"] == v for r in got]) for v in ("allow", "block"))
    assert len(got) > 100 and right > 0.9 and right > common


def test_url_trees_learn_other_labels(spark):
    """Labels that no rule gives: long paths of digits and many parameters are spam."""
    r = np.random.default_rng(1)
    bad = [f"http://s{i % 40}.biz/{r.integers(10**9)}/{r.integers(10**9)}?a={r.integers(99)}&b=2&c=3" for i in range(300)]
    good = [f"https://site{i % 40}.net/articles/{'-'.join(r.choice(['on', 'the', 'way', 'home', 'again'], 4))}" for i in range(300)]
    rows = [(u, 1.0) for u in bad] + [(u, 0.0) for u in good]
    train = spark.createDataFrame(rows[::2], "url string, label double")
    asked = spark.createDataFrame([(i, u, y) for i, (u, y) in enumerate(rows[1::2])], "page_id int, url string, y double")
    got = url_filters.judge_urls(asked, [], train).join(asked.select("page_id", "y"), "page_id").collect()
    assert np.mean([(x["verdict"] == "block") == (x["y"] == 1) for x in got]) > 0.95
