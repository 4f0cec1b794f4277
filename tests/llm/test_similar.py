"""Similar texts against a brute-force join on the Jaccard index."""

import corpus_pipeline
import numpy as np
import pytest

from orgloom.llm import simhash


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def alike(x, y):
    return x == y or 5 * len(x & y) >= 4 * len(x | y)


def brute(texts):
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if root[i] != root[j] and alike(sets[i], sets[j]):
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    return root


@pytest.fixture(scope="module")
def texts(sf_dir):
    import pyarrow.parquet as pq

    r = np.random.default_rng(3)
    out = [None, "", " \n", "one", "ONE ", "two words"]
    for n in (25, 60, 300):
        for _ in range(12):
            base = [f"w{x}" for x in r.integers(0, 5000, n)]
            out.append(" ".join(base))
            for share in (0.005, 0.02, 0.03, 0.05):  # indexes of about 0.6 to 1
                out.append(" ".join("changed" if r.random() < share else w for w in base))
    for cut in (198, 199, 200, 201, 202):  # at the limit: 0.8 is alike, less is not
        out.append(" ".join(f"v{i}" for i in range(cut + 4)))
    out += [" ".join(f"v{i}" for i in range(160 + 4)), " ".join(f"v{i}" for i in range(250 + 4))]
    out += [" ".join(f"s{i}" for i in range(n)) for n in (5, 6, 7, 8, 9, 12, 13, 14)]  # few shingles
    return out + pq.read_table(f"{sf_dir}/documents.parquet")["text"].to_pylist()


def test_groups_equal_brute_force(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar_groups(docs, "doc_id").collect()}
    want = brute(texts)
    assert [got[i] for i in range(len(texts))] == want
    assert len(set(want)) < len(texts)


def test_large_groups_in_chunks(spark, texts, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK_SHINGLES", 150)
    some = [t for t in texts[:60] if len(t or "") > 20]
    docs = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string").repartition(2)
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar_groups(docs, "doc_id").collect()}
    assert [got[i] for i in range(len(some))] == brute(some)


def test_stage_keeps_one_of_each_group(spark, sf_dir, texts, tmp_path):
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    kept = {r["doc_id"] for r in corpus_pipeline.one_of_near_duplicates(spark, docs, sf_dir).collect()}
    assert kept == set(brute(texts))
    clash = spark.createDataFrame([(1, "a b c", "x", "y", "z")] * 2 + [(2, None, "x", "y", "z")], "doc_id long, text string, near_uid string, gone_uid string, node string")
    clash.coalesce(1).write.parquet(str(tmp_path / "clash"))
    left = corpus_pipeline.one_of_near_duplicates(spark, spark.read.parquet(str(tmp_path / "clash")), sf_dir)
    assert left.columns == clash.columns and left.count() == 2
    assert simhash.dedup_similar(docs.limit(0)).count() == 0


def test_spanning_of_a_chain():
    sets = [np.arange(i, i + 100).astype(np.uint64) for i in range(0, 60, 10)]
    found = simhash.jaccard_spanning(np.arange(6), sets, simhash.LEAST)
    assert sorted(map(sorted, found)) == [[i, i + 1] for i in range(5)]


def test_fingerprints_find_most_pairs():
    """The search by fingerprints alone, on pairs of an index of about 0.82; the rest is left to the first shingles."""
    r, met, near = np.random.default_rng(11), 0, 0
    for _ in range(200):
        a = [f"w{x}" for x in r.integers(0, 5000, 200)]
        b = ["changed" if i in (30, 70, 110, 150) else w for i, w in enumerate(a)]
        (p, k), (q, m) = (simhash.wide_fingerprint(simhash.shingle_set(" ".join(x))) for x in (a, b))
        met += bool(set(k.tolist()) & set(m.tolist()))
        near += int(np.bitwise_count(p ^ q).sum()) <= simhash.WIDE_DISTANCE
    assert met >= 180 and near == 200


def test_first_shingles_of_alike_sets_meet():
    r = np.random.default_rng(2)
    heat = r.integers(0, 50, 1 << simhash.HEAT_BITS)
    for n in (1, 2, 4, 5, 9, 10, 40, 333):
        for _ in range(30):
            common = r.integers(0, 1 << 63, n, dtype=np.uint64)
            more = r.integers(0, 1 << 63, n // 4, dtype=np.uint64)  # index 0.8 or more
            a, b = np.unique(common), np.unique(np.concatenate([common, more]))
            x, y = (set(simhash.prefix_keys(s, heat, simhash.LEAST).tolist()) for s in (a, b))
            assert x & y and len(y) == len(b) - -(-4 * len(b) // 5) + 1


def test_owners_of_alike_sets_are_near():
    r = np.random.default_rng(5)
    for n, most in ((5, 4), (40, 1), (400, 0)):
        far = 0
        for _ in range(300):
            a = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64))
            b = np.unique(np.concatenate([a, r.integers(0, 1 << 63, n // 4, dtype=np.uint64)]))  # an index of 0.8
            x, y = (np.uint64(simhash.owner_of(simhash.wide_fingerprint(s)[0], 0) % (1 << 64)) >> np.uint64(simhash.OWN_BITS) for s in (a, b))
            far += int(np.bitwise_count(x ^ y)) > simhash.FIRST_DISTANCE
        assert far <= most, n


def test_sets_of_one_owner_and_keys_of_many(spark, texts, monkeypatch):
    """The groups are those of brute force, however few bits tell owners apart and few owners are looked at."""
    some = [t for t in texts[:120] if len(t or "") > 20]
    docs = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string").repartition(2)
    want = brute(some)
    for few, part in ((2, 1 << 12), (64, 64 << 20)):
        monkeypatch.setattr(simhash, "FEW", few)
        monkeypatch.setattr(simhash, "PART_BYTES", part)
        monkeypatch.setattr(simhash, "OWN_BITS", 0)  # near texts often have one owner
        monkeypatch.setattr(simhash, "FIRST_DISTANCE", 26)
        got = {r["doc_id"]: r["component_id"] for r in simhash.similar_groups(docs, "doc_id").collect()}
        assert [got[i] for i in range(len(some))] == want


def test_many_fingerprints_of_one_segment():
    """As many as share a segment, in seconds, and what they connect is what all pairs connect."""
    import time

    def groups(links, n):
        root = list(range(n))

        def top(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for a, b in links:
            root[max(top(a), top(b))] = min(top(a), top(b))
        return [top(x) for x in range(n)]

    r = np.random.default_rng(4)
    for bits, n in ((32, 3000), (14, 3000)):
        fps = np.unique(r.integers(0, 1 << bits, n, dtype=np.uint64))
        fps = np.unique(np.concatenate([fps, fps[:300] ^ np.uint64(7), fps[300:500] ^ np.uint64(16)]))
        near = [(i, int(j)) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 3)]
        found = simhash.near_spanning(np.arange(len(fps)), fps[:, None], 3)
        assert all(np.bitwise_count(fps[a] ^ fps[b]) <= 3 for a, b in found)
        assert groups(found, len(fps)) == groups(near, len(fps))
    fps = np.unique(r.integers(0, 1 << 32, 100_000, dtype=np.uint64))
    start = time.monotonic()
    simhash.near_spanning(fps.view(np.int64), fps[:, None], 3)
    assert time.monotonic() - start < 20


def test_sets_are_dealt_by_their_first_shingles_alone(spark, texts, monkeypatch):
    """Keys of a set are as many as lose no pair, a fifth of its shingles or so: fingerprints, which meet by chance among many sets, add none."""
    seen, real = {}, simhash.candidates

    def candidates(prints, classes, *more):
        seen.update({r["n"]: len(r["keys"]) // 4 for r in prints.select("n", "keys").collect()})
        return real(prints, classes, *more)

    monkeypatch.setattr(simhash, "candidates", candidates)
    some = texts[:40]
    docs = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar_groups(docs, "doc_id").collect()}
    assert [got[i] for i in range(len(some))] == brute(some)
    assert len(seen) >= 3 and all(k == (n - -(-4 * n // 5) + 1 if n else 0) for n, k in seen.items())
