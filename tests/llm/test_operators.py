"""Operators against brute force, on small fixtures with the hard cases."""

import collections
import hashlib
import itertools
import os
import re
import struct

import numpy as np
import public_tokenizers
import pytest
from conftest import against_sql
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orgloom.llm import bpe_trie, chat_format, common, decontam, pieces, quality_mil, quality_rules, queries, secret_scan, simhash, substring_dedup, token_counts, url_filters

PATH = public_tokenizers.path("word_bpe_49k.json")
CLASH = ["fp", "node", "component_id", "n_words", "text_", "a"]


@pytest.fixture(scope="module")
def texts(sf_dir):
    import pyarrow.parquet as pq

    real = pq.read_table(f"{sf_dir}/documents.parquet")["text"].to_pylist()[:120]
    long = " ".join(f"w{i % 4001}" for i in range(40_000))
    odd = [None, "", " \n\t ", "one", "Two words", long, real[0], real[0], real[1] + "\n" + real[2], "Ünï <|endoftext|> it's\x85x", "a\x0bb\x0cc"]
    return odd + real


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", f"src{i % 3}" if i % 7 else None, *(["x"] * len(CLASH))) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} string" for c in CLASH)).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def groups(n, linked):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(n), 2):
        if linked(a, b):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return [find(i) for i in range(n)]


def test_fingerprint_by_hand():
    import xxhash

    text = "The Quick brown fox"
    h = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in ("the quick brown", "quick brown fox")]
    assert simhash.fingerprint(text) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > 2)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


def test_near_duplicates(docs, texts, empty):
    fps = [simhash.fingerprint(t) for t in texts]
    want = groups(len(texts), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert [got[i] for i in range(len(texts))] == want
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.dedup(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(want))


def test_links_meet_all_pairs(spark):
    r = np.random.default_rng(3)
    base = r.integers(0, 1 << 63, 30, dtype=np.uint64).tolist()
    values = set(base)
    for x in base:
        for k in (1, 2, 3, 4):
            values.add(x ^ sum(1 << int(b) for b in r.choice(64, k, replace=False)))
    signed = sorted(int(np.uint64(v).astype(np.int64)) for v in values)
    got = [(x["a"], x["b"]) for x in simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()]
    apart = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count()
    assert all(a < b and apart(a, b) <= 3 for a, b in got)
    want = groups(len(signed), lambda i, j: apart(signed[i], signed[j]) <= 3)
    have = set(got)
    found = groups(len(signed), lambda i, j: (signed[i], signed[j]) in have)
    assert found == want and len(have) < sum(apart(a, b) <= 3 for a, b in itertools.combinations(signed, 2))


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40) if i != 20] + [(7, 90)], "a long, b long")
    got = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert got == {**dict.fromkeys(range(21), 0), **dict.fromkeys(range(21, 41), 21), 90: 0}


def brute_windows(texts, window):
    rows = [words(t) for t in texts]
    count = collections.Counter(tuple(w[i : i + window]) for w in rows for i in range(len(w) - window + 1))
    out = []
    for w in rows:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("window", [35, 8, 3, 1])
def test_repeated_passages(docs, texts, window):
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in substring_dedup.repeated_passages(docs, window).collect()}
    want = brute_windows(texts, window)
    assert [got[i] for i in range(len(texts))] == want


def test_repeated_passages_of_nothing(empty):
    assert substring_dedup.repeated_passages(empty).count() == 0


def test_levels():
    assert substring_dedup.levels_of(35) == [9, 18, 35]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=30), min_size=1, max_size=5), st.integers(1, 9))
def test_levels_lose_no_window(rows, window):
    import pyarrow as pa

    texts = [" ".join(r) for r in rows]
    answers: dict = {}
    levels = substring_dedup.levels_of(window, 2)
    for level in range(len(levels)):
        sent = substring_dedup._walk(pa.array(texts), window, levels, answers, 2)[1]
        if sent:
            a, _, marks, cuts = sent
            answers[level] = {i: np.packbits(marks[cuts[i] : cuts[i + 1]]).tobytes() for i in range(2)}
        else:
            answers[level] = {}
    live = np.concatenate([p.live for p in substring_dedup._walk(pa.array(texts), window, levels, answers, 2)[0]]) if texts else []
    count = collections.Counter(tuple(r[i : i + window]) for r in rows for i in range(len(r) - window + 1))
    assert int(np.sum(live)) == sum(n for n in count.values() if n > 1)


def test_decontamination(spark, docs, texts, empty):
    tests = [("b", " ".join(words(texts[20])[5:30])), ("a", "w7 w8 w9"), ("c", None), ("d", "..."), ("a", "never seen here")]
    table = spark.createDataFrame([(*x, 1) for x in tests], "item_id string, text string, doc_id int")
    got = {r["doc_id"]: r for r in decontam.verdicts(decontam.contamination(docs, table)).collect()}
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower().decode())
    windows = collections.defaultdict(set)
    for i, t in tests:
        w = split(t)
        for k in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[k : k + 13])].add(i)
    for d, t in enumerate(texts):
        w, hit, items = split(t), set(), set()
        for g, who in windows.items():
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k : k + len(g)]) == g:
                    hit |= set(range(k, k + len(g)))
                    items |= who
        want = (len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
        assert tuple(got[d])[1:] == want, d
    assert decontam.contamination(empty, table).count() == 0
    assert decontam.contamination(docs, table.limit(0)).agg(F.sum("n_hit")).first()[0] == 0


def test_decontamination_in_packs_and_nearby(spark, docs):
    table = spark.createDataFrame([("a", "w7 w8 w9"), ("b", "w10 w12"), ("c", "w3000 w3001")], "item_id string, text string")
    one, many = (decontam.contamination(docs, table, pack_bytes=p).filter("n_hit > 0").select("doc_id", "n_hit", F.size("items").alias("n")).collect() for p in (1 << 20, 1))
    assert one == many and one[0]["n"] == 2
    near = decontam.contamination(docs, table, slop=1).filter("n_hit > 0").collect()
    assert near[0]["items"] == ["a", "b", "c"]


def test_quality_rules(docs, texts, empty):
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(docs).collect()}
    for d, t in enumerate(texts):
        w = words(t)
        count = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        again = {p for i in range(len(w) - 7) if count[tuple(w[i : i + 8])] > 1 for p in range(i, i + 8)}
        lines = [x for x in (t or "").split("\n") if words(x)]
        r = got[d]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(again))
        assert r["base_failed"] == (len(w) < 20 or 100 * len(again) > 30 * len(w))
        assert not (r["kept"] and r["base_failed"])
    assert quality_rules.quality_rules(empty).count() == 0
    assert quality_rules.keep_good(docs).columns == docs.columns


def test_bad_hosts_are_rejected(spark):
    rows = spark.createDataFrame([("good", False)] * 90 + [("bad", True)] * 60 + [("new", True)], "host string, failed boolean")
    got = {r["host"]: r["host_ok"] for r in quality_rules.host_verdicts(rows).collect()}
    assert got == {"good": True, "bad": False, "new": True}


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_token_counts(docs, texts, empty, library):
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in token_counts.token_counts(docs, PATH).collect()}
    for d, t in enumerate(texts):
        assert got[d] == (len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)), d
    assert token_counts.token_counts(empty, PATH).count() == 0


def test_token_counts_of_sentencepiece(docs, texts):
    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path("piece_bpe_32k.model")
    p = SentencePieceProcessor(model_file=path)
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(docs.filter("doc_id < 40"), path).collect()}
    assert all(got[d] == len(p.encode(t or "", num_threads=1)) for d, t in enumerate(texts[:40]))


def test_token_counts_of_byte_level(docs, texts):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(docs.filter("doc_id < 60"), path, cut_bytes=500).collect()}
    assert all(got[d] == len(t.encode(x or "", add_special_tokens=False).ids) for d, x in enumerate(texts[:60]))
    with pytest.raises(ValueError):
        with open(path, encoding="utf-8") as f:
            bpe_trie.Pieces(f.read())


def test_encode_decode(docs, texts, empty, library):
    got = {r["doc_id"]: r for r in bpe_trie.encode_decode(docs, PATH).collect()}
    for d, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert (got[d]["n_tokens"], bytes(got[d]["ids"]), got[d]["decoded"]) == (len(ids), struct.pack(f"<{len(ids)}I", *ids), library.decode(ids, skip_special_tokens=False)), d
    assert bpe_trie.encode_decode(empty, PATH).count() == 0
    lists = {r["doc_id"]: r["id_list"] for r in bpe_trie.encode_decode(docs, PATH, lists=True).collect()}
    assert all(struct.pack(f"<{len(x)}I", *x) == bytes(got[d]["ids"]) for d, x in lists.items())


def test_decode_needs_ids_only(spark, docs, library):
    ids = [[], [5, 49406, 320, 49407], [60_000, 7], None, list(range(0, 49_408, 7))]
    table = spark.createDataFrame([(i, None if x is None else bytearray(struct.pack(f"<{len(x)}I", *x)), "x") for i, x in enumerate(ids)], "doc_id long, ids binary, decoded string")
    got = {r["doc_id"]: r["decoded"] for r in bpe_trie.decode(table, PATH).collect()}
    assert got == {i: library.decode(x or [], skip_special_tokens=False) for i, x in enumerate(ids)}
    coded = bpe_trie.encode(docs, PATH)
    both = {r["doc_id"]: r["decoded"] for r in bpe_trie.encode_decode(docs, PATH).collect()}
    assert {r["doc_id"]: r["decoded"] for r in bpe_trie.decode(coded, PATH).collect()} == both
    assert bpe_trie.decode(table.limit(0), PATH).count() == 0


@pytest.mark.parametrize("word", ["letters", "a" * 50_000, "ab" * 30_000, "日本" * 20_000, "don't" * 5000, "-" * 3000 + "x" * 3000])
def test_long_words(library, word):
    import time

    if word == "letters":
        word = "".join(np.random.default_rng(0).choice(list("abcdefghijklmnopqrstuvwxyz"), 1_000_000))
    tool, _, _ = _tools()
    began = time.process_time()
    coded = tool.encode([word.encode()])[word.encode()]
    assert time.process_time() - began < 12
    ids = library.encode(word, add_special_tokens=False).ids
    assert coded == struct.pack(f"<{len(ids)}I", *ids)


def test_shared_lengths():
    words = sorted({"a", "ab", "b", "x" * 70, "x" * 71, "x" * 71 + "y", "x" * 23, "x" * 24, "x" * 24 + "é", "日本", "日本語"})
    want = [0, *(len(os.path.commonprefix(p)) for p in itertools.pairwise(words))]
    assert bpe_trie.shared_lengths(words) == want and bpe_trie.shared_lengths([]) == []


def test_memory_of_words_is_bounded():
    memory = pieces.Recent(1 << 14)
    for i in range(60):
        keys = [b"%d" % (i * 50 + k) for k in range(60)] + [b"long" * 200 + b"%d" % i]
        new = memory.missing(keys)
        memory.learn(dict.fromkeys(new, 1))
        assert all(k in memory.new for k in keys)
    assert len(memory.new) + len(memory.old) < 400 and not any(len(k) > 700 for k in memory.old)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abcEz019 '\n\t.,!?<|>/#-_éÉßİıſŉñ×÷“”̸́̈ \u0085 \x1c\x00日本кКΣςfiﬁ😀‍"), max_size=16))
def test_pieces_keep_encodings(text):
    tool, library, count = _tools()
    cut = [p for w in text.encode().split() for p in pieces.split_word(w)]
    coded = tool.encode(list(set(cut)))
    ids = library.encode(text, add_special_tokens=False).ids
    assert b"".join(coded[p] for p in cut) == struct.pack(f"<{len(ids)}I", *ids)
    assert sum(count(cut)) == len(ids) if cut else not ids


def _tools(cache={}):  # noqa: B006
    if not cache:
        from tokenizers import Tokenizer

        with open(PATH, encoding="utf-8") as f:
            c = f.read()
        cache["t"] = bpe_trie.Pieces(c), Tokenizer.from_str(c), token_counts._piece_counter(c.encode())
    return cache["t"]


def test_url_parts(spark):
    rows = [("http://A.Example.ORG/es/x?y#z", "a.example.org", "/es/x", "example.org/es/", "block"), ("https://x.org", "x.org", "", None, None), ("http://b.org/q", "b.org", "/q", "org/", "allow"),
            ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"), ("nothing", "", "", None, None), (None, "", "", None, None), ("", "", "", None, None), ("ftp://c.com/de/1#/fr/", "c.com", "/de/1", "com/de/", "block"),
            ("http://d.com?x=/fr/", "d.com", "", None, None), ("http://example.org/en/19", "example.org", "/en/19", "example.org/en/1", "block")]
    pages = spark.createDataFrame([(i, r[0], "x") for i, r in enumerate(rows)], "page_id long, url string, host string")
    got = {r["page_id"]: r for r in url_filters.judge_urls(pages, queries.RULES, trees=2).collect()}
    for i, r in enumerate(rows):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == r[1:4], r
        assert got[i]["verdict"] == r[4] if r[4] else got[i]["verdict"] in ("allow", "block")
    assert url_filters.judge_urls(pages.limit(0), queries.RULES).count() == 0


def test_url_trees_learn(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = url_filters.judge_urls(pages, queries.RULES).filter("rule IS NOT NULL").collect()
    assert np.mean([(r["p_block"] > 0.5) == (r["verdict"] == "block") for r in got]) > 0.9


def test_chat_round_trip(spark, sf_dir):
    odd = [(1, 0, "user", r"a\#### Assistant:" + "\n</turn>\n"), (1, 1, "assistant", "\\"), (1, 1, "assistant", None), (2, None, None, "ü😀<"), (None, 3, "tool:x", ""), (3, 5000, "assistant", "late"), (3, 1, "user", "first"), (3, 5001, "assistant", "#later")]
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    table = turns.withColumn("conv_id", F.col("conv_id") + 10).union(spark.createDataFrame(odd, turns.schema)).withColumn("n", F.lit("x")).repartition(3)
    made = chat_format.format_conversations(table)
    got = {r["conv_id"]: (r["n_turns"], chat_format.parse(r["formatted"]), [chat_format.unescape(r["formatted"][s["start"] : s["end"]]) for s in r["loss_spans"]]) for r in made.collect()}
    want = collections.defaultdict(list)
    for r in table.collect():
        want[r["conv_id"]].append((r["turn"] is not None, r["turn"] or 0, r["role"] or "", r["text"] or ""))
    assert got == {k: (len(v), [x[2:] for x in sorted(v)], [x[3] for x in sorted(v) if x[2] == "assistant"]) for k, v in want.items()}
    assert chat_format.format_conversations(table.limit(0)).count() == 0


def test_planted_conversation(spark, sf_dir):
    r = queries.op7_chat_formatting(spark, sf_dir).filter("conv_id = -7").first()
    text = r"\### Assistant: </turn> ok"
    assert (r["n_turns"], r["loss_chars"]) == (2, len(text))
    assert r["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert r["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def forest(spark):
    return secret_scan.Forest(secret_scan.example_findings(spark))


def test_secrets(spark, forest):
    key = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"
    rows = [(f'x token = "{key}" y', 1), (f"commit {key} fixes", 0), ("paid 4111111111111111 today", 0), (None, 0), ("", 0), (f"password={key} and token: {key}", 2), ("getUserAccountById2 and YOUR_API_KEY_12345_HERE", 0)]
    df = spark.createDataFrame([(i, t, "x") for i, (t, _) in enumerate(rows)], "doc_id long, text string, n_secrets string")
    got = {r["doc_id"]: r for r in secret_scan.scan(df, forest).collect()}
    for i, (t, n) in enumerate(rows):
        assert got[i]["n_secrets"] == n, t
        for f in got[i]["secret_findings"]:
            assert re.fullmatch(r"[A-Za-z0-9+/_\-]{16,}=*", t[f["start"] : f["start"] + f["length"]])  # whole candidates, in their places
    assert got[0]["redacted_text"] == 'x token = "[SECRET]" y' and got[1]["redacted_text"] == rows[1][0] and got[3]["redacted_text"] is None
    assert secret_scan.redact(df, forest).columns == df.columns and secret_scan.scan(df.limit(0), forest).count() == 0


def test_secrets_held_out_accuracy(spark, forest):
    rows = secret_scan.example_findings(spark, 9000).filter("label IS NOT NULL").withColumn("id", F.monotonically_increasing_id()).filter("id >= 6000")
    got = secret_scan.scan(rows, forest).collect()
    assert np.mean([(r["n_secrets"] > 0) == (r["label"] == 1) for r in got]) > 0.97


#: Written by hand, in other shapes than those that the forest is fitted on.
REAL = [
    "curl -H 'X-Api-Key: 7Fq2LmZp0RtYw9Xc3VbN8sKd' https://api.host/v1", "AWS_SECRET_ACCESS_KEY=wJalrXUtnFEMIK7MDENGbPxRfiCYzzQkLmTqRa1b", 'password = "Tr0ub4dor&3"', "DATABASE_URL=postgres://admin:hunter2pass@db.internal:5432/main",
    "private_key: 'MIIEvQIBADANBgkqhkiG9w0BAQEFAASCBKcwggSjAgEAAoIBAQC7'", 'slack token = "xoxb2048109876kLmNoPqRsTuVwXyZaBcDeF"', "client_secret=8hJx-2kLq9_Zw7TtVbN4mPcR", "auth: 3b1f7c9e5a2d4860b7f1c3e9d5a28460", '"apiKey": "qwlkzmxncbvhgfjdksatyrue"',
    "mongodb://svc:Zx81kqPw@cluster0/x", "pwd='S3cr&tV4lue!'", "bearer token: 0a9s8d7f6g5h4j3k2l1qpwoeiruty",
]
HARMLESS = [
    "commit 9fceb02d0ae598e95dc970b74767f19372d61af8 fixes it", "sha256 digest e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855", "order 4929123456781234 was paid", "uuid 123e4567-e89b-12d3-a456-426614174000", "password: required field",
    "see /usr/local/share/data/report/2024/index", "the token = nextToken() call", "getResponseContentTypeFromServer2 is slow", "api_key = YOUR_API_KEY_GOES_HERE_123", "https://user:password@example.org", "secret: optional", "build-2024-01-31-release-candidate-7",
]


def test_secrets_of_other_shapes(spark, forest):
    rows = [(i, t, 1) for i, t in enumerate(REAL)] + [(100 + i, t, 0) for i, t in enumerate(HARMLESS)]
    got = {r["doc_id"]: r for r in secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string, y int"), forest).collect()}
    hits = [got[i]["n_secrets"] > 0 for i in range(len(REAL))]
    alarms = [got[100 + i]["n_secrets"] > 0 for i in range(len(HARMLESS))]
    assert sum(hits) >= 0.9 * len(REAL), [t for t, h in zip(REAL, hits, strict=True) if not h]
    assert sum(alarms) <= 0.1 * len(HARMLESS), [t for t, a in zip(HARMLESS, alarms, strict=True) if a]


def test_planted_secrets_are_found(spark, sf_dir, forest):
    """Precision and recall on the documents: the planted keys, and nothing else that is masked in clean text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet".replace("sf0.001", "sf0.01"))
    key = re.compile(r'token = "([0-9a-f]{40})"')
    true = found = hit = 0
    for r in secret_scan.scan(docs, forest).collect():
        spans = {m.span(1) for m in key.finditer(r["text"] or "")}
        said = {(f["start"], f["start"] + f["length"]) for f in r["secret_findings"] if f["score"] >= 0.5}
        true, found, hit = true + len(spans), found + len(said), hit + len(spans & said)
        assert (r["redacted_text"] or "").count(secret_scan.MASK) == len(said) == r["n_secrets"]
    assert true > 5 and hit == true and hit >= 0.9 * found


def test_forest_expression_equals_the_model(spark):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    train = secret_scan.training_rows(secret_scan.example_findings(spark, 1500)).cache()
    whole = VectorAssembler(inputCols=secret_scan.FEATURES, outputCol="x").transform(train)
    model = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=5, maxDepth=4, seed=1).fit(whole)
    mine = secret_scan.Forest.__new__(secret_scan.Forest)
    mine.constant, mine.depth, mine.nodes = None, 4, secret_scan.node_table([t._call_java("rootNode") for t in model.trees])
    rows = model.transform(whole).select(vector_to_array("probability")[1].alias("p"), mine.score(F.array(*secret_scan.FEATURES)).alias("q")).collect()
    assert max(abs(r["p"] - r["q"]) for r in rows) < 1e-9


def test_quality_held_out(spark, sf_dir):
    d = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    scored = quality_mil.score(docs, quality_mil.fit(docs, labels)).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in scored]) > 0.95


def test_quality_hard_cases(spark, docs, texts, empty):
    labels = spark.createDataFrame([(i, i % 2) for i in range(20, 60)] + [(None, 1), (5, None)], "doc_id long, quality int")
    model = quality_mil.fit(docs, labels)
    got = quality_mil.score(docs, model).collect()
    assert len(got) == len(texts) and all(0 <= r["score"] <= 1 for r in got)
    assert quality_mil.score(empty, model).count() == 0
    assert quality_mil.fit(docs, labels.limit(0)) == 0.5
    assert quality_mil.fit(docs, labels.filter("quality = 1")) == 1.0


def test_attention_gradient():
    r = np.random.default_rng(0)
    m = quality_mil.GatedAttention(hidden=3, gate=2)
    x, at, y = r.normal(size=(7, quality_mil.N_FEATURES)), np.array([0, 2, 3, 7]), np.array([1.0, 0.0, 1.0])
    loss = lambda: -np.mean(y * np.log(m._forward(x, at)[-1]) + (1 - y) * np.log(1 - m._forward(x, at)[-1]))
    before = loss()
    m.fit(x, at, y, epochs=60)
    assert -np.mean(y * np.log(m.score(x, at)) + (1 - y) * np.log(1 - m.score(x, at))) < before / 2


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    got, want = against_sql(spark, sf_dir, queries.QUERIES[name], queries.ORACLES[name])
    assert got == want


def test_release(spark):
    common.release(spark)
