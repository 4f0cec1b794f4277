"""Keys of many rows on both sides: results by brute force, and no plan that moves their pairs."""

import math
import re

from pyspark.sql import functions as F

from orgloom.operators import joins
from orgloom.operators.upserts import first_by
from orgloom.plans import graph, identity, knowledge, links, lookups, staging


def pairs_moved(df) -> int:
    """The largest number of rows that one shuffle of the plan wrote, after a run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    seen, stack = [], [plan.finalPhysicalPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan]
    while stack:
        node = stack.pop()
        if node.getClass().getSimpleName() == "ShuffleQueryStageExec":
            node = node.plan()
        metric = node.metrics().get("shuffleRecordsWritten")
        if metric.isDefined():
            seen.append(metric.get().value())
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return max(seen, default=0)


def test_pairs_in_parts_equal_a_join(spark):
    left = spark.createDataFrame([(i % 3, f"a{i}") for i in range(60)] + [(None, "x"), (9, "y")], "k int, a string")
    right = spark.createDataFrame([(i % 4, f"b{i}") for i in range(40)] + [(None, "z")], "k int, b string")
    got = joins.in_parts(left, right, "k", 16)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, left.join(right, "k").collect())) and got.count() == 600


def test_interactions_of_shared_accounts_are_not_moved(spark):
    """300 people of one account are 90,000 rows; and roles of one name in three forms, which may give the same row."""
    issues = spark.createDataFrame([("p1", "p2"), ("p3", None), ("lost", "x1")], "ASSIGNEE_ACCOUNT_ID string, REPORTER_ACCOUNT_ID string")
    commits = spark.createDataFrame([("g", "h"), (None, "gone")], "AUTHOR_ID string, COMMITTER_ID string")
    prs = spark.createDataFrame([("ASSIGNEE", "g"), ("MATCHED", "g"), ("MATCHED", "h"), ("REPORTER", "h")], "ROLE_IN_PR string, USER_ID string")
    people = [(f"p{i}", "g", f"u{i}") for i in range(300)] + [("x1", "h", "v1"), ("x1", None, "v2"), ("x1", "g", None), ("x2", "h", "v1"), (None, "h", "v3"), ("p2", "g", "u2")]
    matched = spark.createDataFrame(people, "JIRA_ID string, GITHUB_ID string, UUID string")
    roles = {("AUTHOR", None, "g"), ("COMMITTER", None, "h"), ("COMMITTER", None, "gone"), ("ASSIGNEE", "p1", None), ("ASSIGNEE", "p3", None), ("ASSIGNEE", "lost", None), ("REPORTER", "p2", None), ("REPORTER", "x1", None)}
    roles |= {("ASSIGNEE", None, "g"), ("MATCHED", None, "g"), ("MATCHED", None, "h"), ("REPORTER", None, "h")} | {("MATCHED", j, g) for j, g, _ in people}
    want = set()
    for role, j, g in roles:
        met = [m for m in people if (j and m[0] == j) or (g and m[1] == g)]
        want |= {(role, j or m[0], g or m[1], m[2], "RESOLVED") for m in met} or {(role, j, g, None, "UNRESOLVED")}
    df = links.all_interactions(issues, commits, prs, matched)
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 90_000
    assert pairs_moved(df) < 10_000


def test_wide_links_make_no_pairs(spark):
    """200 commits and 200 pull requests of one story: as many rows as they are, and the sets of all pairs."""
    issues = spark.createDataFrame([("ORD-1", "Story", "P", "Project", None, None, "c1", "r1", "a1"), ("ORD-2", "Story", "P", "Project", None, None, "c1", "r2", None), ("ORD-3", "Story", "P", "Project", None, None, "c3", "r3", "a3")], "ISSUE_KEY string, ISSUE_TYPE string, PROJECT_KEY string, PROJECT_NAME string, PARENT_ISSUE_TYPE string, PARENT_ID string, CREATOR_ACCOUNT_ID string, REPORTER_ACCOUNT_ID string, ASSIGNEE_ACCOUNT_ID string")
    commits = spark.createDataFrame([(f"s{i}", f"repo{i % 7}", f"u{i}", f"l{i}", None, f"ORD-{1 + i % 2}") for i in range(400)], "COMMIT_SHA string, REPO string, AUTHOR_ID string, AUTHOR_LOGIN string, AUTHOR_EMAIL string, COMMIT_MESSAGE string")
    prs = spark.createDataFrame([(f"p{i}", "AUTHOR", f"w{i}", f"m{i}", "ORD-1", None) for i in range(200)], "INTERNAL_ID string, ROLE_IN_PR string, USER_ID string, USER_LOGIN string, TITLE string, BODY string")
    wide = links.wide_links(issues, commits, prs)
    assert wide.count() < 700
    (row,) = links.linked_identities(wide).collect()
    assert row["JIRA_CREATOR_ID"] == "c1" and row["story_keys"] == "ORD-1" and row["gh_author_ids"] == ",".join(sorted(f"u{i}" for i in range(0, 400, 2))) and row["pr_user_ids"] == ",".join(sorted(f"w{i}" for i in range(200)))
    names = {(r["name"], r["role"]): r for r in links.lists_by_name(wide).collect()}
    assert names["Name c1", "creator"]["story_keys"] == "ORD-1,ORD-2" and len(re.split(",", names["Name r2", "reporter"]["repos"])) == 7 and ("Name c3", "creator") not in names


def rows_met(df) -> int:
    """The largest number of rows that one join of the plan gave, after a run."""
    df.collect()
    seen, stack = [], [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            stack.append(node.finalPhysicalPlan())
        elif kind.endswith("QueryStageExec"):
            stack.append(node.plan())
        metric = node.metrics().get("numOutputRows")
        if "Join" in kind and metric.isDefined():
            seen.append(metric.get().value())
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return max(seen, default=0)


def test_ids_of_one_login_are_not_met_in_pairs(spark, monkeypatch):
    monkeypatch.setattr(identity, "KIN", 100)
    rows = [(f"{i:03}", f"n{i}", None, "shared") for i in range(300)] + [("x", "n", "a@x", "own"), ("x", "m", "b@x", "zz"), ("y", "n", "b@x", None), ("y", "n", "a@x", None), ("z", None, "", "zz"), (None, "n", "a@x", "shared")]
    df = spark.createDataFrame(rows, "ID string, NAME string, EMAIL string, LOGIN string")
    for keep in (False, True):
        sets = {}
        for i, _, mail, login in rows:
            if i is not None:
                for k, v in (("mail", mail), ("login", login)):
                    sets.setdefault(i, {"mail": set(), "login": set()})[k] |= {v or "" if keep else v} - {None}
        want = {}
        for i, s in sets.items():
            first = {k: min(v) for k, v in s.items() if v and (keep or min(v) != "")}
            want[i] = sorted(o for o, other in sets.items() if o != i and any(v in other[k] for k, v in first.items()))
        done = identity.collapse(df, keep_missing=keep)
        assert {r["ID"]: r["ALIAS_ID"] for r in done.collect()} == want and len(want["000"]) >= 299
        assert rows_met(done) < 2000


def _people(spark):
    jira = spark.createDataFrame([(str(i), i, ["Anna Abbott", "Boris Castro", None][i % 3], f"u{i}@x" if i < 4 else None) for i in range(300)], "ID string, ORD long, DISPLAY_NAME string, EMAIL string")
    github = spark.createDataFrame([(str(i), i, ["anna abbott", "Abbott_Anna", "Boris"][i % 3], f"u{i}@x", f"l{i}") for i in range(300)], "ID string, ORD long, DISPLAY_NAME string, EMAIL string, LOGIN string")
    return jira, github


def test_pairs_of_names_are_not_moved(spark):
    """19,000 pairs and more of a few names: made last, and as many as each two rows give."""
    jira, github = _people(spark)
    signals = github.selectExpr("ID AS SIG", "EMAIL AS MAIL", "DISPLAY_NAME AS NAME")
    for df in (identity.candidates(jira, github), lookups.signal_matches(signals, jira), staging.jaccard_pairs(jira, github)):
        assert df.count() > 19_000 and df.count() == df.distinct().count()
        assert pairs_moved(df) < 2000


def test_people_of_one_name_share_their_candidates(spark):
    """Matches, picks and what is left come from groups of people; a person of two rows has the candidates of both, by the order of the rows."""
    jira, github = _people(spark)
    two = spark.createDataFrame([("two", 900, "Boris Castro", None), ("two", 800, "Anna Abbott", None), ("mail", 901, "Anna Abbott", "u7@x"), ("mail", 902, "Boris Castro", None), ("lone", 903, "Zoe Zed", None)], jira.schema)
    jira = jira.unionByName(two)
    found = identity.scored(jira, github)
    best = first_by(found, ["JIRA_ID"], identity._best())
    taken = {r["GITHUB_ID"] for r in best.collect()}
    want = {(r["JIRA_ID"], r["GITHUB_ID"]) for r in best.collect()} | {(r["JIRA_ID"], r["GITHUB_ID"]) for r in first_by(found, ["GITHUB_ID"], identity._best()).collect() if r["GITHUB_ID"] not in taken}
    picks = identity.greedy(jira, github)
    assert {(r["JIRA_ID"], r["GITHUB_ID"]) for r in picks.collect()} == want and rows_met(picks) < 2000 < found.count()
    assert {r["JIRA_ID"]: r["METHOD"] for r in found.collect()}["mail"] == "METHOD_1_EMAIL"
    matches = {r["JIRA_ID"]: r for r in identity.match(jira, github).collect()}
    by_person = {}
    for r in found.collect():
        by_person.setdefault(r["JIRA_ID"], set()).add(r["GITHUB_ID"])
    first = {r["JIRA_ID"]: r["GITHUB_ID"] for r in best.collect()}
    assert {j: (m["GITHUB_ID"], set(m["GITHUB_ID_ALIAS"])) for j, m in matches.items()} == {j: (first[j], g - {first[j]}) for j, g in by_person.items()}
    left = identity.unmatched_people(jira, github)
    assert {r["ID"] for r in left.collect()} == {r["ID"] for r in jira.collect()} - set(matches) and rows_met(left) < 2000
    assert rows_met(identity.unmatched(github, identity.matched_groups(jira, github)[1], "GITHUB_ID")) < 2000


def test_a_person_of_many_matches_has_each_account_once(spark):
    """2,000 matches of one person to 5 accounts: the steps of the plan hold each account once, and the fold one by one gives the same."""
    schema = "JIRA_ID string, GITHUB_ID string, GITHUB_ID_ALIAS array<string>, JIRA_DISPLAY_NAME string, JIRA_EMAIL string, GITHUB_DISPLAY_NAME string, GITHUB_EMAIL string, GITHUB_LOGIN string, GITHUB_DISPLAY_NAME_ALIAS array<string>, GITHUB_EMAIL_ALIAS array<string>, GITHUB_LOGIN_ALIAS array<string>, MATCHING_METHOD string, MATCH_CONFIDENCE double"
    start = {"a": ("g0", "l0", ["g1"]), "b": (None, "own", ["g3"]), "c": (None, "own", []), "d": ("g9", "l9", [])}
    matched = spark.createDataFrame([(j, i, ids, j, j, None, None, login, [], [], ["x"] * len(ids), "M", 1.0) for j, (i, login, ids) in start.items()], schema)
    found = [(k, "abn"[k % 3], f"P{k}", None, None if k % 11 == 0 else f"g{(k * 7) % 5}", f"l{k}") for k in range(2000)] + [(5000, "c", "P", None, None, "late"), (4000, "c", "P", None, None, "early")]
    want = {}
    for k, j, _, _, g, login in sorted(found, key=lambda f: f[0]):
        i, own, ids, logins = want.setdefault(j, (*start.get(j, (None, None, []))[:2], list(start.get(j, (0, 0, []))[2]), ["x"] * len(start.get(j, (0, 0, []))[2])))
        if i is None:
            want[j] = (g, login, ids, logins)
        elif g is not None and g != i and g not in ids:
            want[j] = (i, own, [*ids, g], [*logins, login])
    want["d"] = ("g9", "l9", [], [])
    steps = spark.createDataFrame(found, "ORD long, JIRA_ID string, JIRA_DISPLAY_NAME string, JIRA_EMAIL string, GITHUB_ID string, GITHUB_LOGIN string")
    done = identity.patch(matched, steps)
    assert {r["JIRA_ID"]: (r["GITHUB_ID"], r["GITHUB_LOGIN"], r["GITHUB_ID_ALIAS"], r["GITHUB_LOGIN_ALIAS"]) for r in done.collect()} == want
    assert "transform" in (plan := done._jdf.queryExecution().optimizedPlan().toString()) and " aggregate(" not in plan


def test_contributions_are_summed_up_before_people_meet(spark):
    """500 commits of an account of 100 people, one of them twice."""
    commits = spark.createDataFrame([("g", "o", f"r{i % 2}", i) for i in range(500)] + [(None, "o", "r", 1)], "AUTHOR_ID string, ORG string, REPO string, COMMIT_TIMESTAMP long")
    matched = spark.createDataFrame([("g", f"u{i % 99}") for i in range(100)] + [("g", None), (None, "u1")], "GITHUB_ID string, UUID string")
    df = graph.repo_contribution(commits, matched)
    assert {tuple(r) for r in df.collect()} == {(f"u{i}", "o", f"r{k}", k, 500 if i == 0 else 250) for i in range(99) for k in range(2)}
    assert rows_met(df) <= 200


def test_vectors_are_scored_some_pairs_at_once(spark, monkeypatch):
    """Slices of a batch give the nearest of the whole, equal scores by id."""
    monkeypatch.setattr(knowledge, "PAIRS_AT_ONCE", 8, raising=True)
    rows = [(i, [float(i % 5 + 1), float(i * 7 % 4), 1.0]) for i in range(60)]
    base = spark.createDataFrame(rows, "ID long, EMBEDDING array<double>").coalesce(1)
    got = {(r["QUERY_ID"], r["nth"]): (r["ID"], r["score"]) for r in knowledge.nearest_each(base, base.filter("ID % 20 = 0"), 4).collect()}
    cos = lambda a, b: round(sum(x * y for x, y in zip(a, b, strict=True)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b)), 6)
    for q in (0, 20, 40):
        want = sorted((-cos(rows[q][1], v), i) for i, v in rows)[:4]
        assert [got[q, n] for n in range(1, 5)] == [(i, -s) for s, i in want]


def test_missing_diffs_move_no_pairs(spark):
    """A login that 100 accounts share, for 200 commits: pairs stay where they are made. Commits of several rows, logins or accounts have each pair once."""
    rows = [(f"s{i}", f"g{i % 7}" if i % 3 else None, "l") for i in range(400)] + [("x", "g1", "l"), ("x", "g1", "m"), ("x", "h", None), ("y", "none", "none"), (None, "g2", "m"), (None, "g3", "l")]
    people = [(f"g{i}", "l") for i in range(100)] + [("g1", "m"), (None, "m"), (None, "l"), ("h", None)]
    commits = spark.createDataFrame(rows, "COMMIT_SHA string, AUTHOR_ID string, AUTHOR_LOGIN string")
    diffs = spark.createDataFrame([(f"s{i}",) for i in range(0, 400, 2)] * 2 + [(None,)], "COMMIT_SHA string")
    done = {f"s{i}" for i in range(0, 400, 2)}
    want = {(s, g) for s, i, n in rows if s not in done for g, login in people if (i and i == g) or (n and n == login)}
    df = links.commits_missing_diffs(commits, spark.createDataFrame(people, "GITHUB_ID string, GITHUB_LOGIN string"), diffs)
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 20_000
    assert pairs_moved(df) < 2_000


def test_stories_of_a_person_meet_no_links(spark):
    """500 links of each of 40 keys, and three people of each story: links are counted, not met; repeated and null ids, and links of an id and a key, count as they should."""
    stories = [(i, f"k{i % 40}", f"p{i % 3}", f"p{i % 5}", None if i % 4 else "p9") for i in range(60)] + [(60, "alone", "p7", "p7", None), (61, None, "p8", None, None)]
    rows = [(i, i % 90 if i % 2 else None, f"k{i % 50}") for i in range(20_000)] + [(5, 3, "k1"), (5, 4, None), (None, 61, None), (7, None, "alone"), (20_001, 61, "k1"), (20_001, 61, "k2")]
    people = [(f"p{i}",) for i in (0, 1, 2, 3, 7, 8, 9, 9)] + [("nobody",), (None,)]
    want = []
    for p in sorted({p for (p,) in people if p}):
        mine = [s for s in stories if p in s[2:]]
        met = [{r[0] for r in rows if r[1] == s[0] or (s[1] and r[2] == s[1])} for s in mine]
        if mine:
            want.append((p, len(mine), len(set().union(*met) - {None}), any(not m or None in m for m in met)))
    df = lookups.story_person(spark.createDataFrame(people, "JIRA_ID string"), spark.createDataFrame(stories, "STORY_ID long, STORY_KEY string, REPORTER string, ASSIGNEE string, OWNER string"), spark.createDataFrame(rows, "LINK_ID long, LINK_STORY_ID long, LINK_KEY string"))
    assert sorted(map(tuple, df.select("JIRA_ID", "n_stories", "n_links", "has_unlinked").collect())) == want
    assert pairs_moved(df) < 21_000


def test_shared_lists_are_one_text_and_many_tasks(spark, monkeypatch):
    """500 ids of one login: lists as texts equal lists, also of ids at the ends of blocks, with commas, empty, or alone; and rows of long lists are not one task's work."""
    monkeypatch.setattr(identity, "KIN", 20)
    monkeypatch.setattr(identity, "TEXT_IDS", 16, raising=False)
    rows = [(f"{i:03}", f"n{i % 3}", f"m{i % 5}" if i % 2 else None, "shared") for i in range(500)] + [("a,b", "n", None, "shared"), ("a", "n", None, "shared"), ("", "n", "e@x", "own"), ("b", "n", "e@x", "own"), ("z", "n", "z@x", "zz"), ("none", None, None, None)]
    df = spark.createDataFrame(rows, "ID string, NAME string, EMAIL string, LOGIN string")
    for keep in (False, True):
        lists = identity.collapse(df, keep_missing=keep)
        texts = identity.collapse_shown(df, keep_missing=keep)
        assert sorted(map(str, texts.collect())) == sorted(map(str, identity._shown(lists).collect())) and texts.count() == 506
        for d in (lists, texts):
            assert d.select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_rows_of_a_key_are_copied_few_times(spark):
    """Parts of a key are a grid, so 300 rows and 300 are moved 16 times each, and not each of one side to 300 parts; no part is empty of pairs that a plain join has."""
    left = spark.createDataFrame([("k", f"a{i}") for i in range(300)] + [("one", f"a{i}") for i in range(300)], "k string, a string")
    right = spark.createDataFrame([("k", f"b{i}") for i in range(300)] + [("one", "b"), ("none", "b")], "k string, b string")
    got = joins.in_parts(left, right, "k", 16)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, left.join(right, "k").collect()))
    assert pairs_moved(got) < 6000
    swapped = joins.in_parts(right, left, "k", 16)
    assert swapped.distinct().count() == swapped.count() == 90_300 and pairs_moved(swapped) < 6000
    assert got.select(F.spark_partition_id().alias("p")).distinct().count() > 1
