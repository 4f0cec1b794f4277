"""Cases that break hashes, workers, names and memory."""

import hashlib
import os
import subprocess
import sys
import time
from pathlib import Path

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orgloom.llm import chat_format, common, decontam, quality_rules, secret_scan, simhash, substring_dedup

ROOT = Path(__file__).resolve().parents[2]


def thue_morse(n, a="a", b="b"):
    return "".join((a, b)[i.bit_count() % 2] for i in range(n))


TWO = [thue_morse(1024), thue_morse(1024, "b", "a")]


@pytest.mark.parametrize("seed", [5, 11, 43, 77])
def test_words_of_one_structure_hash_apart(seed):
    words = [thue_morse(n, a, b).encode() for n in (8, 16, 32, 64, 128, 1024, 4096) for a, b in ("ab", "ba", "xy")] + [b"a" * n for n in range(1, 200)] + [b"\0" * n for n in range(1, 40)]
    words = list(dict.fromkeys(words))
    data = np.frombuffer(b"".join(words), np.uint8)
    en = np.cumsum([len(w) for w in words])
    h = common.WordHasher(seed)(data, en - [len(w) for w in words], en)
    assert len(set(h.tolist())) == len(words)
    alone = [common.WordHasher(seed)(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0] for w in words]
    assert h.tolist() == alone  # whatever stands beside them
    upper = common.WordHasher(seed, lower=True)(np.frombuffer(b"ABCdef abcDEF", np.uint8), np.array([0, 7]), np.array([6, 13]))
    assert upper[0] == upper[1]


@pytest.mark.parametrize("k", [1, 2, 3, 9, 18, 35, 64])
def test_windows_hash_by_their_words(k):
    r = np.random.default_rng(k)
    h = r.integers(0, 3, 300, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    got = common.window_hashes(h, k)
    slices = [tuple(h[i : i + k].tolist()) for i in range(len(h) - k + 1)]
    of = dict(zip(slices, got.tolist(), strict=True))
    assert len(got) == len(slices) and [of[s] for s in slices] == got.tolist() and len(set(got.tolist())) == len(set(slices))
    assert len(common.window_hashes(h[: k - 1], k)) == 0


def test_windows_of_one_structure_hash_apart():
    a, b = np.uint64(0x1234567890ABCDEF), np.uint64(0xFEDCBA0987654321)
    for n in (32, 1024, 4096):
        x, y = (np.array([(p, q)[i.bit_count() % 2] for i in range(n)], np.uint64) for p, q in ((a, b), (b, a)))
        assert common.window_hashes(x, n)[0] != common.window_hashes(y, n)[0]


def test_decontamination_of_words_of_one_structure(spark):
    docs = spark.createDataFrame([(0, TWO[0]), (1, TWO[1])], "doc_id long, text string")
    tests = spark.createDataFrame([("x", TWO[1])], "item_id string, text string")
    got = {r["doc_id"]: r["n_hit"] for r in decontam.contamination(docs, tests).collect()}
    assert got == {0: 0, 1: 1}


def test_removal_of_words_of_one_structure(spark):
    plain = [f"w{i}" for i in range(60)]
    rows = [" ".join(plain[:30] + [TWO[i]] + plain[30:]) for i in (0, 1)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert [r["n_removed"] for r in substring_dedup.repeated_passages(docs).collect()] == [0, 0]
    same = spark.createDataFrame([(0, rows[0]), (1, rows[0])], "doc_id long, text string")
    assert [r["n_removed"] for r in substring_dedup.repeated_passages(same).collect()] == [61, 61]


def test_blocks_come_from_bytes(spark):
    texts = [" ".join(f"x{(i * 7 + k) % 400}" for k in range(200)) for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    one, many = ({r["doc_id"]: (r["n_removed"], r["kept_text"]) for r in substring_dedup.repeated_passages(docs, block_bytes=b).collect()} for b in (1 << 24, 1500))
    assert one == many and sum(n for n, _ in one.values())
    slim = common.keep_columns(docs, "doc_id", "text")
    table, blocks = common.stage(slim, "text", "block", 1500)
    assert blocks >= sum(map(len, texts)) // 1500 and table.groupBy("block").agg(F.sum(F.length("text")).alias("n")).agg(F.max("n")).first()[0] < 4 * 1500
    assert not spark.catalog.listTables("default")


def test_index_serves_any_tests(spark, tmp_path):
    docs = spark.createDataFrame([(0, "One two three four"), (1, None), (2, "three four one two"), (3, "")], "doc_id long, text string")
    decontam.build_index(docs, gap=4).write.parquet(str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    sc = spark.sparkContext
    for phrase, want in (("two three", {0}), ("three FOUR", {0, 2}), ("four one", {2}), ("two four", set()), ("zero", set())):
        pack = sc.broadcast(decontam.phrases_of([("i", phrase)], 3))
        got = {r["doc_id"]: r for r in decontam.search(index, [pack]).collect()}
        assert {d for d, r in got.items() if r["n_hit"]} == want and len(got) == 4
        assert all(m["start"] == docs.collect()[0]["text"].lower().split().index(phrase.split()[0].lower()) for m in got[0]["matches"])


SCRIPT = """
import sys
sys.path.insert(0, {root!r})
import corpus_pipeline
from orgloom.llm import queries
from pyspark.sql import SparkSession
s = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").config("spark.sql.warehouse.dir", {tmp!r} + "/w").config("spark.checkpoint.dir", "file://" + {tmp!r} + "/c").getOrCreate()
s.sparkContext.setLogLevel("ERROR")
def lacks(_):
    try:
        import orgloom
        return ["has it"]
    except ImportError:
        return ["lacks it"]
assert s.sparkContext.parallelize([0], 1).mapPartitions(lacks).collect() == ["lacks it"]
for name, f in (queries.QUERIES | {{"pipeline": corpus_pipeline.run}}).items():
    f(s, {sf!r}).write.format("noop").mode("overwrite").save()
print("all ran")
"""


def test_executors_without_the_package(sf_dir, tmp_path):
    tokenizers = str(Path(__import__("public_tokenizers").__file__).resolve().parent.parent)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = f"import sys; sys.path.append({tokenizers!r})\n" + SCRIPT.format(root=str(ROOT), tmp=str(tmp_path), sf=sf_dir)
    done = subprocess.run([sys.executable, "-c", code], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=900)
    assert "all ran" in done.stdout, done.stderr[-3000:]


HELPERS = ["kept_uid", "rule_uid", "rule_text", "near_uid", "gone_uid", "clean_uid", "bad_uid", "redacted_text", "n_secrets", "secret_findings", "masked_text", "secret_around", "secret_judged", "found_secrets",
           "n_words", "host", "fp", "node", "set", "root", "doc", "shrunk_rate", "of_host", "component_id", "first", "label_id", "ids", "block", "contaminated"]


def test_stages_keep_columns_of_any_name(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(120)
    for i, name in enumerate(HELPERS):
        docs = docs.withColumn(name, F.concat(F.lit(f"{i} "), F.col("doc_id").cast("string")))
    docs.write.parquet(str(tmp_path / "in"))
    docs = spark.read.parquet(str(tmp_path / "in"))
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        if i < len(corpus_pipeline.STAGES) - 1:
            for k, c in enumerate(HELPERS):
                assert docs.filter(F.col(c) != F.concat(F.lit(f"{k} "), F.col("doc_id").cast("string"))).count() == 0, (name, c)
    assert docs.count() > 10
    whole = spark.read.parquet(str(tmp_path / "in"))
    assert simhash.dedup(whole).columns == whole.columns and quality_rules.keep_good(whole).columns == whole.columns


@pytest.fixture(scope="module")
def forest(spark):
    return secret_scan.Forest(secret_scan.example_findings(spark))


def test_no_candidates_without_ansi(spark, forest):
    docs = spark.createDataFrame([(1, "nothing here"), (2, None), (3, "")], "doc_id long, text string")
    was = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert [(r["n_secrets"], r["secret_findings"]) for r in secret_scan.scan(docs, forest).collect()] == [(0, [])] * 3
    finally:
        spark.conf.set("spark.sql.ansi.enabled", was)


def test_many_candidates_in_a_text(spark, forest):
    keys = [hashlib.sha256(str(i).encode()).hexdigest()[:40] for i in range(3000)]
    text = "\n".join(f'token = "{k}"' for k in keys)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.time()
    r = secret_scan.scan(docs, forest).first()
    assert time.time() - began < 60
    assert [text[f["start"] : f["start"] + f["length"]] for f in r["secret_findings"]] == keys
    assert r["n_secrets"] > 2900 and len(r["redacted_text"]) < len(text)


def test_long_conversation(spark):
    big = "ab<#\\é " * 1_500_000
    turns = [(1, i, ("user", "assistant")[i % 2], f"turn {i} <") for i in range(5000)] + [(2, 0, "user", big), (2, 1, "assistant", big)]
    made = chat_format.format_conversations(spark.createDataFrame(turns, "conv_id long, turn int, role string, text string"))
    got = {r["conv_id"]: r for r in chat_format.read_back(made).collect()}
    assert got[1]["n_turns"] == 5000 and got[2]["loss_chars"] == len(big)
    assert got[2]["loss_sha256"] == hashlib.sha256(big.encode()).hexdigest()
    assert got[1]["loss_sha256"] == hashlib.sha256("".join(t for _, i, r, t in turns[:5000] if r == "assistant").encode()).hexdigest()


def test_parse_takes_time_in_proportion():
    text = "a\\<b" * 2_000_000
    began = time.process_time()
    assert chat_format.parse(f"### user:\n{text}</turn>\n") == [("user", chat_format.unescape(text))]
    assert time.process_time() - began < 20
    with pytest.raises(ValueError):
        chat_format.parse("### user:\n" + "a" * 100_000)


def test_chunks_and_spans():
    texts = pa.array(["a b", None, "", " c", "d" * 50])
    got = [(at, to, bytes(data), offs.tolist()) for at, to, data, offs in common.chunks_of(texts, 4)]
    assert b"".join(x[2] for x in got) == b"a b c" + b"d" * 50 and got[-1][1] == 5


def test_shared_folder_must_be_named_on_a_cluster(spark):
    class Conf:
        def get(self, *_):
            return None

    class Fake:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})()

    with pytest.raises(ValueError):
        common.shared_dir(Fake())
    Fake.sparkContext.master = "local[8]"
    assert common.shared_dir(Fake()) == common.LOCAL_SHARED
