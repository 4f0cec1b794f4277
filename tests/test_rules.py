"""Hand-computed rows for rules whose order or exactness matters."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orgloom.functions import similarity, text
from orgloom.operators import joins, upserts
from orgloom.plans import graph, identity, inference, knowledge, links, lookups, staging
from orgloom.sources import catalog
from orgloom.streaming import ingest

USER = "ID string, ORD long, DISPLAY_NAME string, EMAIL string"


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v")).alias("r")).first()["r"]


def test_issue_key(spark):
    for value, want in (("fix DNS-12 and AB-3", "DNS-12"), ("PROJ_9", "PROJ-9"), ("proj-9", None), ("Story/dns 15178", "DNS-15178"), ("  ", None), (None, None)):
        assert one(spark, text.issue_key, value) == want


def test_skill_key(spark):
    assert one(spark, text.skill_key, " C++/CLI ") == "c_cli"


def test_paths(spark):
    for value, want in (("a/b/.env", ("a/b", ".env", "")), ("x.tar.gz", ("", "x.tar.gz", ".gz")), ("a/f", ("a", "f", "")), ("..x", ("", "..x", ""))):
        r = spark.createDataFrame([(value,)], "v string").select(*[c.alias(f"c{i}") for i, c in enumerate(text.path_parts(F.col("v")))]).first()
        assert tuple(r) == want


def test_block_keys_and_tokens(spark):
    r = spark.createDataFrame([("Stone, Robert",), ("123",), (None,)], "v string").select(F.array(*text.block_keys(F.col("v"))).alias("b")).collect()
    assert [x["b"] for x in r] == [["sto", "rob"], ["", ""], ["", ""]]
    assert one(spark, text.tokens, "janeSmith_x") == ["janesmithx", "jane", "smith"]


def test_times(spark):
    r = spark.sql("SELECT timestamp_ntz'2024-01-02 03:04:05.5' AS a, timestamp_ntz'2024-01-02 03:04:05' AS b, '2024-01-02T03:04:05+02:00' AS c, 'x' AS d")
    r = r.select(text.iso(F.col("a")), text.iso(F.col("b")), text.parse_iso(F.col("c")).cast("string"), text.parse_iso(F.col("d"))).first()
    assert tuple(r) == ("2024-01-02T03:04:05.500000", "2024-01-02T03:04:05", "2024-01-02 01:04:05", None)


def test_lenient_json(spark):
    assert one(spark, lambda c: text.lenient_json(c, "a int")["a"], '```json\n{"a": 3}\n```') == 3
    assert one(spark, lambda c: text.lenient_json(c, "a int")["a"], "nonsense") is None


def match(spark, jira, github):
    g = spark.createDataFrame(github, USER + ", LOGIN string")
    return {r["JIRA_ID"]: r for r in identity.match(spark.createDataFrame(jira, USER), g).collect()}


def test_match_tiers(spark):
    got = match(
        spark,
        [("j1", 1, "Zed", " A@X.com "), ("j2", 2, "Ann Lee", None), ("j3", 3, "Bob Stone Smith", None), ("j4", 4, "123", None), ("j5", 5, "Other Zed", "a@x.com")],
        [("g1", 1, "Q", "a@x.com", "q"), ("g2", 2, "Ann Lee Smith", None, "al"), ("g3", 3, "Bob Stone", None, "bs"), ("g4", 4, "123", None, "n")],
    )
    assert (got["j1"]["GITHUB_ID"], got["j1"]["MATCHING_METHOD"], got["j1"]["MATCH_CONFIDENCE"]) == ("g1", "METHOD_1_EMAIL", 1.0)
    assert got["j5"]["GITHUB_ID"] == "g1"  # not one to one
    assert (got["j2"]["GITHUB_ID"], got["j2"]["MATCH_CONFIDENCE"]) == ("g2", 0.95)
    assert (got["j3"]["GITHUB_ID"], got["j3"]["MATCH_CONFIDENCE"]) == ("g3", 0.85)
    assert (got["j4"]["GITHUB_ID"], got["j4"]["MATCHING_METHOD"]) == ("g4", "METHOD_SUBSTRING")


def test_pr_user_token(spark):
    jira = spark.createDataFrame([("j1", 1, "Jane Smith", None)], USER)
    r = identity.pr_user_match(spark.createDataFrame([("jsmith42",)], "LOGIN string"), jira).first()
    assert r["JIRA_ID"] == "j1" and r["METHOD"] == "METHOD_TOKEN_SUBSTRING" and r["SCORE"] >= 0.9


def test_account_without_id_gives_way_to_one_with_an_id(spark):
    jira = spark.createDataFrame([("j1", 1, "Jane Smith", None)], USER)
    logins = [("jsmith42", None), ("jsmith42", "7"), ("jsmith42", "10"), ("janesmith", None)]
    got = identity.pr_user_match(spark.createDataFrame(logins, "LOGIN string, GITHUB_ID string"), jira).collect()
    assert sorted((r["GITHUB_LOGIN"], r["GITHUB_ID"]) for r in got) == [("janesmith", None), ("jsmith42", "10")]


def test_collapse_with_missing(spark):
    rows = spark.createDataFrame([("1", None, "e", "l"), ("1", "Ann", "e", "l"), ("2", "Bob", "f", "l")], "ID string, NAME string, EMAIL string, LOGIN string")
    live = {r["ID"]: r for r in identity.collapse(rows, keep_missing=True).collect()}
    assert live["1"]["NAME"] == "" and live["1"]["ALIAS_NAME"] == ["Ann"] and live["1"]["ALIAS_ID"] == ["2"]
    assert {r["ID"]: r["NAME"] for r in identity.collapse(rows).collect()} == {"1": "Ann", "2": "Bob"}


def test_patch(spark):
    kind = ", ".join(f"{c} {'array<string>' if c.endswith('ALIAS') else 'double' if c == 'MATCH_CONFIDENCE' else 'string'}" for c in identity.MATCHED)
    row = lambda i, g, login, ids, logins: (i, g, ids, f"Name {i}", f"{i}@j", f"G {g}", None, login, ["old"], [], logins, "M", 0.9)
    old = spark.createDataFrame([row("a", "1", "l1", [], []), row("b", None, None, [], []), row("c", "3", "l3", ["4"], ["l4"])], kind)
    steps = [(1, "a", "1", "l1"), (2, "a", "9", "l9"), (3, "b", "2", "l2"), (4, "c", "4", "l4"), (5, "d", "5", "l5"), (6, "d", "6", "l6"), (7, None, "7", "l7")]
    new = spark.createDataFrame([(o, i, f"P{o}", f"p{o}@j", g, login) for o, i, g, login in steps], "ORD long, JIRA_ID string, JIRA_DISPLAY_NAME string, JIRA_EMAIL string, GITHUB_ID string, GITHUB_LOGIN string")
    done = {r["JIRA_ID"]: r for r in identity.patch(old, new).collect()}
    got = {i: (r["GITHUB_ID"], r["GITHUB_ID_ALIAS"], r["GITHUB_LOGIN_ALIAS"], r["MATCHING_METHOD"]) for i, r in done.items()}
    assert got == {"a": ("1", ["9"], ["l9"], "M"), "b": ("2", [], [], "M"), "c": ("3", ["4"], ["l4"], "M"), "d": ("5", ["6"], ["l6"], "PATCH_PR")}
    assert tuple(done["d"])[3:7] == ("P5", "p5@j", None, None) and done["d"]["MATCH_CONFIDENCE"] is None and done["d"]["GITHUB_DISPLAY_NAME_ALIAS"] == [] and tuple(done["a"])[3:6] == ("Name a", "a@j", "G 1")


def test_budgets(spark):
    d = lambda *n: spark.createDataFrame([("u", 100 - i, x) for i, x in enumerate(n)], "COMMITTER_ID string, ORD long, N long")
    assert links.budget(d(6, 6, 6), 10, True).count() == 2
    assert links.budget(d(6, 6, 6), 10, False).count() == 1
    assert links.budget(d(20, 1), 10, False).count() == 1


def test_modal_role_ties(spark):
    rows = spark.createDataFrame([("p", "B"), ("p", "A"), ("p", "A"), ("p", "B")], "person string, role string")
    assert links.modal_role(rows, "person", "role").first()["role"] == "A"


def test_assignee_before_reporter(spark):
    i = spark.createDataFrame([("K-1", "a", "a", "P")], "ISSUE_KEY string, ASSIGNEE_ACCOUNT_ID string, REPORTER_ACCOUNT_ID string, PROJECT_KEY string")
    m = spark.createDataFrame([("a", "u")], "JIRA_ID string, UUID string")
    assert [r["role"] for r in graph.story_memberships(i, m).collect()] == ["Assignee"]


def test_not_in(spark):
    left = spark.createDataFrame([("a",), (None,)], "k string")
    right = lambda *v: spark.createDataFrame([(x,) for x in v], "r string")
    count = lambda r: joins.not_in(left, "k", r, "r").count()
    assert (count(right("b", None)), count(right("b")), count(right("a")), count(right())) == (0, 1, 0, 2)


def test_upserts_are_idempotent(spark):
    old = spark.createDataFrame([(1, "a", ["x"]), (2, None, None)], "k int, v string, t array<string>")
    new = spark.createDataFrame([(2, "b", ["y"]), (3, None, ["z"])], "k int, v string, t array<string>")
    rules = {"v": "fill_new", "t": "union"}
    once = upserts.merge(old, new, ["k"], rules)
    twice = upserts.merge(once, new, ["k"], rules)
    rows = lambda df: sorted((r["k"], r["v"], tuple(r["t"] or ())) for r in df.collect())
    assert rows(once) == rows(twice) == [(1, "a", ("x",)), (2, "b", ("y",)), (3, None, ("z",))]
    assert rows(upserts.overwrite(upserts.overwrite(old, new, ["k"]), new, ["k"])) == rows(upserts.overwrite(old, new, ["k"]))
    assert upserts.insert_ignore(old, new, ["k"], [F.asc("v")]).count() == 3


def test_any_of_equals_or_join(spark):
    a = spark.createDataFrame([(1, "x", "x"), (2, "x", "y"), (3, None, "y"), (4, None, None)], "i int, p string, q string")
    b = spark.createDataFrame([("x", 1), ("y", 2), ("y", 3)], "k string, n int")
    want = sorted((r["i"], r["n"]) for r in a.join(b, (a.p == b.k) | (a.q == b.k)).collect())
    assert sorted((r["i"], r["n"]) for r in joins.any_of(a, ["p", "q"], b, "k").collect()) == want


def test_participants(spark):
    p = "struct<id:string,login:string>"
    df = spark.createDataFrame([(1, ("1", "a"), [("2", "b"), ("2", "b"), (None, "c")], None, [("1", "a")])], f"PR_ID long, AUTHOR {p}, ASSIGNEES array<{p}>, REQUESTED array<{p}>, REVIEWERS array<{p}>")
    assert sorted((r["role"], r["id"]) for r in staging.participants(df).collect()) == [("ACTUAL_REVIEWER", "1"), ("ASSIGNEE", "2"), ("AUTHOR", "1")]


def test_kernel():
    assert similarity.lcs("abcde", "ace") == 3
    assert similarity.token_set_ratio("ann lee", "lee ann smith") == 100
    assert similarity.token_set_ratio("", "a") == 0
    assert similarity.token_sort_ratio("b a", "a b") == 100
    assert similarity.partial_ratio("abc", "xxabcxx") == 100
    assert round(similarity.ratio("abcd", "abxd"), 4) == 75


def test_kernel_golden_pairs():
    """Values that the documentation of the usual library of these ratios gives."""
    assert round(similarity.ratio("this is a test", "this is a test!"), 4) == 96.5517
    assert similarity.partial_ratio("this is a test", "this is a test!") == 100
    assert round(similarity.ratio("fuzzy wuzzy was a bear", "wuzzy fuzzy was a bear"), 4) == 90.9091
    assert similarity.token_sort_ratio("fuzzy wuzzy was a bear", "wuzzy fuzzy was a bear") == 100
    assert round(similarity.token_sort_ratio("fuzzy was a bear", "fuzzy fuzzy was a bear"), 4) == 84.2105
    assert similarity.token_set_ratio("fuzzy was a bear", "fuzzy fuzzy was a bear") == 100


def test_tokens_are_measured_before_they_are_squashed():
    assert similarity.token_set("a! b") == {"ab", "a"} and similarity.token_set("x") == set() and similarity.token_set("JohnDoe") == {"johndoe", "john", "doe"}


def test_last_update_of_a_key_counts(spark):
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string")
    new = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, None, 3), (2, "z", 4), (2, "w", 5)], "k int, v string, at int")
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(lookups.update_column(old, new, "k", "v", "at")) == [(1, "y"), (2, "w"), (3, "c")]
    assert rows(lookups.update_column(old, new, "k", "v", "at", True)) == [(1, "a"), (2, "z"), (3, "c")]
    assert rows(upserts.overwrite(old, new.withColumnRenamed("at", "o").select("k", "v", "o").drop("o"), ["k"], [F.desc_nulls_last("v")])) == [(1, "y"), (2, "z"), (3, "c")]


@settings(max_examples=60, deadline=None)
@given(st.text("abc ", max_size=12), st.text("abc ", max_size=12))
def test_kernel_against_table(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    assert similarity.lcs(a, b) == t[-1][-1]
    assert 0 <= similarity.token_set_ratio(a, b) <= 100


def test_validation(spark):
    rows = spark.createDataFrame([('{"role": "QA"}',), ('{"role": "Cook"}',), ("broken",)], "j string")
    ok, bad = inference.validated(rows, "j", "role string", {"role": ["QA", "Backend"]})
    assert (ok.count(), bad.count()) == (1, 2)


def test_knowledge_chunks(spark):
    doc = json.dumps({"schema": {"tables": [{"name": "t", "description": "d", "columns": [{"name": "c", "description": "e", "type_details": "int"}]}]}})
    got = {(r["id"], r["kind"]) for r in knowledge.chunks(spark.createDataFrame([(doc,)], "j string"), "j", "src").collect()}
    assert got == {("src.t", "table"), ("src.t.c", "column")}


def test_sources(spark, tmp_path):
    (tmp_path / "u.csv").write_text("User id,User name,email\n1,Ann,a@x\n2,Bob,\n")
    df = catalog.open_source(spark, "csv", path=str(tmp_path / "u.csv"), columns={"User id": "ID", "User name": "NAME", "email": "EMAIL"})
    assert df.columns == ["ID", "NAME", "EMAIL"] and df.count() == 2
    assert catalog.counted_write(df, str(tmp_path / "out")) == (0, 2)
    assert catalog.counted_write(df, str(tmp_path / "out")) == (2, 4)
    catalog.export_csv(df, str(tmp_path / "csv"), first=1, order=["ID"])
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first()["NAME"] == "Ann"
    catalog.export_json(df, str(tmp_path / "json"))
    assert catalog.open_source(spark, "json", path=str(tmp_path / "json")).count() == 2
    assert {r["name"] for r in catalog.open_source(spark, "files", path=str(tmp_path), pattern="*.csv").collect()} >= {"u.csv"}


def test_streaming(spark, tmp_path):
    schema = "k long, v string"
    spark.createDataFrame([(1, "a"), (2, "b")], schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    versions = []

    def run():
        ingest.upsert_into(
            ingest.file_stream(spark, str(tmp_path / "in"), schema), lambda: spark.read.parquet(versions[-1]) if versions else None,
            lambda df, n: (df.write.mode("overwrite").parquet(f"{tmp_path}/v{n}"), versions.append(f"{tmp_path}/v{n}")),
            lambda old, new: upserts.overwrite(old, new, ["k"]), str(tmp_path / "cp"),
        ).awaitTermination(120)

    run()
    spark.createDataFrame([(2, "c"), (3, "d")], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    assert sorted(tuple(r) for r in spark.read.parquet(versions[-1]).collect()) == [(1, "a"), (2, "c"), (3, "d")]


def test_patterns_are_tried_only_where_their_word_is(spark):
    """The text is put in lower case once for all patterns, whose results stay as they were; lines are counted without a pattern."""
    rows = [("import Django\nfrom torch import x; kubectl", 2), ("djangos mydjango import_torch dockers", 1), ("no words\n\n", 3), ("", 1), (None, None), ("DOCKER server servers api-api", 1)]
    df = spark.createDataFrame([(f"s{i}", i, "m", "f.py", t) for i, (t, _) in enumerate(rows)], "COMMIT_SHA string, ORD int, COMMIT_MESSAGE string, FILE_PATH string, DIFF string")
    made = inference.commit_summaries(df)
    got = {r["COMMIT_SHA"]: (r["frameworks"], r["key_changes"]) for r in made.collect()}
    found = [["Django", "Kubernetes", "PyTorch"], [], [], [], [], ["Docker"]]
    assert got == {f"s{i}": (found[i], [f"f.py: {n} lines"] if n else []) for i, (_, n) in enumerate(rows)}
    counts = df.select(inference.role_counts(F.col("DIFF")).alias("c")).collect()
    assert [(r["c"][inference.BACK], r["c"]["DevOps Engineer"]) for r in counts] == [(1, 1), (0, 0), (0, 0), (0, 0), (0, 0), (3, 1)]
    plan = df.select(inference.frameworks_of(F.col("DIFF")).alias("f"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(") == 1
