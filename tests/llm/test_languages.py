"""The byte network against plain loops and differences, and on texts that it was not fitted on."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orgloom.llm import language_id, queries
from orgloom.llm.language_id import VECTOR, WIDTHS, WINDOW, ByteConvolution

TEXTS = ["", "a", "x" * WINDOW, "y" * (WINDOW + 1), "Straße über alles " * 40, "\x00zero\x00"]


def joined(texts):
    raw = [t.encode() for t in texts]
    return raw, np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def test_windows_cover_whole_texts():
    raw, data, offs = joined(TEXTS)
    x, size, at = language_id.windows_of(data, offs)
    for i, t in enumerate(raw):
        own = slice(at[i], at[i + 1])
        assert b"".join(w[:n].tobytes() for w, n in zip(x[own], size[own], strict=True)) == t
        assert at[i + 1] - at[i] == max(1, -(-len(t) // WINDOW))
        assert not any(w[n:].any() for w, n in zip(x[own], size[own], strict=True))


def test_forward_by_loops():
    net = ByteConvolution(["a", "b", "c"], seed=4)
    r = np.random.default_rng(5)
    net.p["b"] = r.normal(0, 0.3, net.p["b"].shape).astype(np.float32)
    x = r.integers(0, 256, (3, WINDOW)).astype(np.uint8)
    x[1, 50:] = 0
    for w, got in zip(x, net.probabilities(x), strict=True):
        v = np.concatenate([net.p["E"][w], np.zeros((max(WIDTHS), VECTOR))])
        h = []
        for f in range(net.p["W"].shape[1]):
            width = WIDTHS[f // language_id.FILTERS]
            values = [float(v[i : i + width].ravel() @ net.p["W"][: width * VECTOR, f]) for i in range(WINDOW)]
            h.append(max(max(values) + net.p["b"][f], 0))
        logit = np.array(h) @ net.p["O"] + net.p["o"]
        want = np.exp(logit - logit.max())
        assert got.tolist() == pytest.approx((want / want.sum()).tolist(), abs=1e-4)


def test_gradient_by_differences():
    net = ByteConvolution(["a", "b", "c"], seed=7)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    r = np.random.default_rng(9)
    x, y = r.integers(1, 256, (6, WINDOW)).astype(np.uint8), np.array([0, 1, 2, 1, 0, 2])
    wide = lambda self, x: ByteConvolution._unfolded(self, x).astype(np.float64)

    def loss():
        v = np.zeros((len(x), WINDOW + max(WIDTHS) - 1, VECTOR))
        v[:, :WINDOW] = net.p["E"][x]
        u = np.stack([v[:, i : i + WINDOW] for i in range(max(WIDTHS))], axis=2).reshape(len(x), WINDOW, -1)
        h = np.maximum((u @ net.p["W"]).max(axis=1) + net.p["b"], 0)
        logit = h @ net.p["O"] + net.p["o"]
        logit -= logit.max(axis=1, keepdims=True)
        return -np.mean(logit[np.arange(len(x)), y] - np.log(np.exp(logit).sum(axis=1)))

    assert wide(net, x).shape[0] == len(x) * WINDOW
    grad = net.gradient(x, y)
    for k, g in grad.items():
        order = np.argsort(-np.abs(g).ravel())[:4]  # the largest slopes
        for i in order:
            at = np.unravel_index(i, g.shape)
            if net.p[k][at] == 0 and k == "W":
                continue
            before = net.p[k][at]
            net.p[k][at] = before + 1e-5
            up = loss()
            net.p[k][at] = before - 1e-5
            down = loss()
            net.p[k][at] = before
            assert g[at] == pytest.approx((up - down) / 2e-5, rel=2e-2, abs=1e-5), (k, at)


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    found = queries.op12_language_id(spark, d).join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out")
    rows = found.select("lang", "lang_pred").collect()
    assert len(rows) > 200
    for lang in {r["lang"] for r in rows}:
        own = [r["lang_pred"] == lang for r in rows if r["lang"] == lang]
        assert sum(own) >= 0.93 * len(own), lang
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)


def labelled(n):
    words = {"xx": "kala maja tuuli meri", "yy": "brzask chrząszcz źdźbło", "zz": "the quick brown fox"}
    r = np.random.default_rng(1)
    return [(f"{words[k].split()[0]} " + " ".join(r.permutation(words[k].split() * 9)), k, i) for i in range(n) for k in [list(words)[i % 3]]]


SCHEMA = "text string, lang string, doc_id long"


def test_hard_cases(spark):
    docs = spark.createDataFrame([*labelled(240), ("kala maja", None, None), (None, "zz", 1001), ("", "zz", 1002), ("12 ++ 3", "zz", 1003), ("maja kala meri tuuli " * 90_000, None, 1004), ("é", None, 1005)], SCHEMA)
    docs = docs.withColumns({"name": F.lit("n"), "score": F.lit("s"), "held_out": F.lit(1), "letters": F.lit(2), "lang_pred": F.lit(3)})
    model = language_id.fit(docs)
    assert model.names == ["xx", "yy", "zz"]
    out = language_id.predict(docs, model)
    rows = {r["doc_id"]: r for r in out.collect()}
    assert len(rows) == 246 and out.columns == ["doc_id", "held_out", "lang_pred", "score", "n_windows"]
    assert [rows[i]["lang_pred"] for i in (1001, 1002, 1003)] == ["und"] * 3 and rows[1001]["score"] == 0
    assert rows[1004]["lang_pred"] == "xx" and rows[1004]["n_windows"] == -(-21 * 90_000 // WINDOW)
    assert rows[None]["held_out"] is False and rows[None]["lang_pred"] == "xx" and rows[1005]["lang_pred"] in model.names
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    assert sum(rows[i]["lang_pred"] == k for _, k, i in labelled(240)) > 230


def test_held_out_labels_teach_nothing(spark):
    docs = spark.createDataFrame(labelled(90), SCHEMA)
    other = docs.withColumn("lang", F.when(language_id.held_out(F.col("doc_id")), F.lit("qq")).otherwise(F.col("lang")))
    a, b = language_id.fit(docs), language_id.fit(other)
    assert a.names == b.names and all((a.p[k] == b.p[k]).all() for k in a.p)


def test_nothing_or_one_language_to_learn(spark):
    docs = spark.createDataFrame(labelled(30), SCHEMA)
    assert language_id.fit(docs.limit(0)) is None and language_id.fit(docs.withColumn("lang", F.lit(None).cast("string"))) is None
    assert {r["lang_pred"] for r in language_id.predict(docs, None).collect()} == {"und"}
    one = language_id.fit(docs.withColumn("lang", F.lit("xx")))
    assert {(r["lang_pred"], r["score"]) for r in language_id.predict(docs, one).collect()} == {("xx", 1.0)}
    assert language_id.predict(docs.limit(0), one).collect() == []
    many = docs.union(docs).union(docs)
    assert sorted(map(str, language_id.predict(many, one).collect())) == sorted(str(r) for r in language_id.predict(docs, one).collect() for _ in range(3))
