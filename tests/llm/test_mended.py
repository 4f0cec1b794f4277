"""Quoted secrets, tests without an id, options that are put back, digests of encoded texts."""

import hashlib

import public_tokenizers
import pytest

from orgloom.llm import bpe_trie, common, decontam, secret_scan


@pytest.fixture(scope="module")
def forest(spark):
    return secret_scan.Forest(secret_scan.example_findings(spark))


def test_quoted_secrets_are_masked_whole(spark, forest):
    long = "a!9$" + "Zq7#" * 39
    rows = {
        "password = 'correct horse battery staple 99'": "password = '[SECRET]'",
        'x passphrase: "gravel mutiny oxbow lantern quilt" y': 'x passphrase: "[SECRET]" y',
        f"password = '{long}' end": "password = '[SECRET]' end",
        f"db https://{'u' * 70}:Zx81kqPw77@host/x": f"db https://{'u' * 70}:[SECRET]@host/x",
        f"db https://admin:{long.replace('/', '')}@host/x": "db https://admin:[SECRET]@host/x",
        'password: "the name of your user here"': 'password: "the name of your user here"',
        "secret = 'open\nnext line' it": "secret = 'open\nnext line' it",
        "its password = 'short' and 'more' text": "its password = 'short' and 'more' text",
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string")
    got = {r["text"]: r for r in secret_scan.scan(df, forest).collect()}
    assert {t: got[t]["redacted_text"] for t in rows} == rows
    for t, want in rows.items():
        assert got[t]["n_secrets"] == want.count("[SECRET]")
        found = [t[f["start"] : f["start"] + f["length"]] for f in got[t]["secret_findings"]]
        assert all(x in t for x in found)


def test_tests_without_an_id(spark):
    words = " ".join(f"w{i}" for i in range(13))
    docs = spark.createDataFrame([(1, f"{words} and more"), (2, "nothing of it")], "doc_id long, text string")
    tests = spark.createDataFrame([(None, words), ("None", "and more"), ("x", words), (None, "of it")], "item_id string, text string")
    for pack_bytes in (1 << 20, 1):  # one pack, and one for each test
        got = {r["doc_id"]: r for r in decontam.contamination(docs, tests, pack_bytes=pack_bytes).collect()}
        assert got[1]["items"] == ["None", "x"] and got[1]["n_hit"] == 15
        assert got[2]["items"] == [] and got[2]["n_hit"] == 2


def test_options_are_put_back(spark):
    key = "spark.sql.parquet.columnarReaderBatchSize"
    common.unbound_batches(spark)
    was = spark.conf.get(key)
    common.bound_batches(spark)
    common.bound_batches(spark)
    assert spark.conf.get(key) == "128" != was
    common.unbound_batches(spark)
    assert spark.conf.get(key) == was
    common.bound_batches(spark)
    spark.conf.set(key, "77")  # the user's own, since
    common.unbound_batches(spark)
    assert spark.conf.get(key) == "77"
    spark.conf.unset(key)
    common.collect_garbage(spark)


def test_lists_come_with_digests(spark):
    texts = ["Straße über alles", None, "", "a <b> [UNK] c" * 50, "word " * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = {r["doc_id"]: r for r in bpe_trie.encode_decode(docs, path).collect()}
    for r in bpe_trie.encode_decode(docs, path, lists=True).collect():
        p = plain[r["doc_id"]]
        assert r["ids_sha256"] == hashlib.sha256(p["ids"]).hexdigest() and r["decoded_sha256"] == hashlib.sha256(p["decoded"].encode()).hexdigest()
        assert b"".join(x.to_bytes(4, "little") for x in r["id_list"]) == bytes(p["ids"]) and r["n_tokens"] == len(r["id_list"])
