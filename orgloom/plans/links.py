"""Links between issues, commits and pull requests, and what is gathered of them by person."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..operators import joins, upserts
from ..operators.running import running
from ..operators.upserts import first_by
from ..sources.adapters import load, with_sql

_NEVER = "timestamp_ntz'1900-01-01'"


def modal_role(rows: DataFrame, person: str, role: str) -> DataFrame:
    """The most frequent role of each person; of equals the first by name."""
    counted = rows.groupBy(F.col(person).alias("person"), F.col(role).alias("role")).agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy("person").agg(F.min(F.struct((-F.col("n")).alias("n"), "role")).alias("b"))
    return best.select("person", F.col("b.role").alias("role"), (-F.col("b.n")).alias("n"))


def latest_by_login(prs: DataFrame, known: DataFrame) -> DataFrame:
    """The last row of each login that is not among the known ones."""
    last = first_by(prs, ["USER_LOGIN"], [F.desc_nulls_last("UPDATED_AT"), F.asc("ORD")])
    return joins.not_in(last, "USER_LOGIN", known, "GITHUB_LOGIN").select("USER_LOGIN", "USER_ID", "UPDATED_AT", "ORD")


def representative_user(commits: DataFrame, prs: DataFrame) -> DataFrame:
    """For each id the row of the first name and email, nulls last."""
    both = commits.select(F.col("AUTHOR_ID").alias("ID"), F.col("AUTHOR_NAME").alias("NAME"), F.col("AUTHOR_EMAIL").alias("EMAIL")).union(
        prs.select("USER_ID", "USER_LOGIN", F.lit(None).cast("string")))
    return first_by(both.filter("ID IS NOT NULL"), ["ID"], [F.asc_nulls_last("NAME"), F.asc_nulls_last("EMAIL")])


def consolidated_users(commits: DataFrame, prs: DataFrame) -> DataFrame:
    """By login: the largest id, and some name and email (the least)."""
    both = commits.select(F.col("AUTHOR_LOGIN").alias("LOGIN"), F.col("AUTHOR_ID").alias("ID"), F.col("AUTHOR_NAME").alias("NAME"), F.col("AUTHOR_EMAIL").alias("EMAIL")).unionByName(
        prs.select(F.col("USER_LOGIN").alias("LOGIN"), F.col("USER_ID").alias("ID"), F.lit(None).cast("string").alias("NAME"), F.lit(None).cast("string").alias("EMAIL")))
    return both.groupBy("LOGIN").agg(F.max("ID").alias("ID"), F.min("NAME").alias("NAME"), F.min("EMAIL").alias("EMAIL"), F.count(F.lit(1)).alias("n_rows"))


def keyed(df: DataFrame, message: Column) -> DataFrame:
    return df.withColumn("EXTRACTED_KEY", text.issue_key(message))


def set_text(c: str) -> Column:
    """Distinct non-null values in order, as one text."""
    return F.array_join(F.sort_array(F.collect_set(c)), ",")


def with_null(c: str) -> Column:
    """Distinct values in order, with a null if there was one."""
    return F.concat(F.sort_array(F.collect_set(c)), F.when(F.count_if(F.col(c).isNull()) > 0, F.array(F.lit(None).cast("string"))).otherwise(F.array().cast("array<string>")))


ROLES_OF_ISSUES = ("CREATOR", "REPORTER", "ASSIGNEE")


def wide_links(issues: DataFrame, commits: DataFrame, prs: DataFrame) -> DataFrame:
    """What stories, their commits and their pull requests say, for sets of values by who created, reported or was assigned the story.

    Those are columns of every row; of the others, a row has the story's, or those of one commit or of one pull request that names it, and nulls elsewhere. So
    the distinct values of a column are those of ``story_links`` with all columns, whose pairs of a commit and a pull request are never made."""
    named = lambda r: [F.col(f"{r}_ACCOUNT_ID").alias(f"JIRA_{r}_ID"), F.concat(F.lit("Name "), f"{r}_ACCOUNT_ID").alias(f"JIRA_{r}_NAME"), F.concat(F.lit("p"), f"{r}_ACCOUNT_ID", F.lit("@j.com")).alias(f"JIRA_{r}_EMAIL")]
    stories, c, p = named_by(issues, commits, prs)
    known = stories.select("ISSUE_KEY").join(named_keys(c, p), F.col("ISSUE_KEY") == F.col("KEY"), "left_semi").distinct()
    who = issues.join(known, "ISSUE_KEY", "left_semi").select(F.col("ISSUE_KEY").alias("STORY_KEY"), F.expr("substr(ISSUE_KEY, 5)").alias("STORY_ID"), "PROJECT_KEY", "PROJECT_NAME", *[x for r in ROLES_OF_ISSUES for x in named(r)])
    of_commit = commits.select("COMMIT_SHA", "REPO", *[F.col(f"{r}_{x}").alias(f"GH_{r}_{x}") for r in ("AUTHOR", "COMMITTER") for x in ("ID", "LOGIN", "EMAIL") if f"{r}_{x}" in commits.columns])
    of_pull = prs.select(F.col("INTERNAL_ID").alias("PR_ID"), "ROLE_IN_PR", F.col("USER_ID").alias("PR_USER_ID"), F.col("USER_LOGIN").alias("PR_USER_LOGIN")).distinct()
    said = lambda named, key, rows, by: named.join(known, F.col(key) == F.col("ISSUE_KEY"), "left_semi").distinct().join(rows, by).drop(*by).withColumnRenamed(key, "STORY_KEY").distinct()
    by_commit, by_pull = said(c, "ck", of_commit, ["COMMIT_SHA"]), said(p, "pk", of_pull, ["PR_ID", "ROLE_IN_PR"])
    people = who.select("STORY_KEY", *[f"JIRA_{r}_{x}" for r in ROLES_OF_ISSUES for x in ("ID", "NAME", "EMAIL")])
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [who, people.join(by_commit, "STORY_KEY"), people.join(by_pull, "STORY_KEY")])


LINKED = ["JIRA_CREATOR_NAME", "JIRA_CREATOR_EMAIL", "JIRA_REPORTER_ID", "JIRA_REPORTER_NAME", "JIRA_REPORTER_EMAIL", "JIRA_ASSIGNEE_ID", "JIRA_ASSIGNEE_NAME", "JIRA_ASSIGNEE_EMAIL", "STORY_ID", "STORY_KEY", "REPO", "GH_AUTHOR_ID", "GH_AUTHOR_LOGIN", "GH_AUTHOR_EMAIL", "GH_COMMITTER_ID", "GH_COMMITTER_LOGIN", "GH_COMMITTER_EMAIL", "PR_USER_ID", "PR_USER_LOGIN"]


def linked_identities(links: DataFrame) -> DataFrame:
    """By creator, of links that have a creator, a reporter and an assignee: the distinct values of everything else, in order."""
    known = [c for c in LINKED if c in links.columns]
    return links.dropna(subset=[f"JIRA_{r}_ID" for r in ROLES_OF_ISSUES]).groupBy("JIRA_CREATOR_ID").agg(*[set_text(c).alias(c.lower() + "s") for c in known])


def lists_by_name(links: DataFrame) -> DataFrame:
    """Stories and repositories by the name of the creator, of the reporter and of the assignee."""
    branch = lambda r: links.filter(F.col(f"JIRA_{r}_NAME").isNotNull()).groupBy(F.col(f"JIRA_{r}_NAME").alias("name")).agg(F.lit(r.lower()).alias("role"), *[set_text(c).alias(c.lower() + "s") for c in ("STORY_ID", "STORY_KEY", "REPO")])
    return reduce(DataFrame.unionByName, [branch(r) for r in ROLES_OF_ISSUES])


ARTEFACTS = ["STORY_KEY", "STORY_ID", "EPIC_KEY", "EPIC_ID", "PROJECT_KEY", "PROJECT_NAME", "REPO"]


def person_arrays(people: DataFrame, interactions: DataFrame) -> DataFrame:
    """Each of ``people`` (GITHUB_ID, NAME) with the largest name, login and id of their interactions, and seven arrays of what they touched: distinct values in order, a null at the end if there was one, and empty for people without interactions."""
    per = interactions.filter("GITHUB_ID IS NOT NULL").groupBy(F.col("GITHUB_ID").alias("gid")).agg(*[F.max(c).alias(f"any_{c}") for c in ("GITHUB_LOGIN", "JIRA_ID")], *[with_null(c).alias(f"{c}S") for c in ARTEFACTS])
    none = F.array().cast("array<string>")
    out = people.join(per, F.col("GITHUB_ID") == F.col("gid"), "left")
    return out.select("GITHUB_ID", "NAME", F.col("any_GITHUB_LOGIN").alias("GITHUB_LOGIN"), F.col("any_JIRA_ID").alias("JIRA_ID"), *[F.coalesce(f"{c}S", none).alias(f"{c}S") for c in ARTEFACTS])


#: Pairs of a commit and a pull request that one part of a key gives, about.
PAIRS_OF_PART = 1 << 20


def named_by(issues: DataFrame, commits: DataFrame, prs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The link table in factors: stories (ISSUE_KEY, EPIC_ID), commits (ck, COMMIT_SHA) and pull requests (pk, PR_ID, ROLE_IN_PR) by the key that they name."""
    stories = issues.filter("ISSUE_TYPE = 'Story'").select("ISSUE_KEY", F.when(F.col("PARENT_ISSUE_TYPE") == "Epic", F.col("PARENT_ID")).alias("EPIC_ID"))
    c = keyed(commits, F.col("COMMIT_MESSAGE")).filter("EXTRACTED_KEY IS NOT NULL").select(F.col("EXTRACTED_KEY").alias("ck"), "COMMIT_SHA")
    p = keyed(prs, text.join_text(F.col("TITLE"), F.col("BODY"))).filter("EXTRACTED_KEY IS NOT NULL").select(F.col("EXTRACTED_KEY").alias("pk"), F.col("INTERNAL_ID").alias("PR_ID"), "ROLE_IN_PR")
    return stories, c, p


def named_keys(c: DataFrame, p: DataFrame) -> DataFrame:
    """(KEY, commits, pulls) of each key that a commit or a pull request names."""
    seen = c.select(F.col("ck").alias("KEY"), F.lit(1).alias("c"), F.lit(0).alias("p")).unionByName(p.select(F.col("pk").alias("KEY"), F.lit(0).alias("c"), F.lit(1).alias("p")))
    return seen.groupBy("KEY").agg(F.sum("c").alias("commits"), F.sum("p").alias("pulls"))


def story_link_counts(issues: DataFrame, commits: DataFrame, prs: DataFrame) -> DataFrame:
    """(ISSUE_KEY, EPIC_ID, commits, pulls, links) of each story that is named: how many rows ``story_links`` has for it, without one of them."""
    stories, c, p = named_by(issues, commits, prs)
    links = F.greatest("commits", F.lit(1)) * F.greatest("pulls", F.lit(1))
    return stories.join(named_keys(c, p), F.col("ISSUE_KEY") == F.col("KEY")).select("ISSUE_KEY", "EPIC_ID", "commits", "pulls", links.alias("links"))


def story_links(issues: DataFrame, commits: DataFrame, prs: DataFrame) -> DataFrame:
    """Stories with the commits and pull requests that name them, all pairs of both; stories that none names are left out.

    Pairs are made in parts of keys (``joins.in_parts``), and nothing moves them afterwards. A story without commits, or without pull requests, has one row of nulls in their place."""
    stories, c, p = named_by(issues, commits, prs)
    named = stories.join(named_keys(c, p), F.col("ISSUE_KEY") == F.col("KEY")).select("ISSUE_KEY", "EPIC_ID", "commits", "pulls")
    none = F.lit(None).cast("string")
    met = named.join(c, F.col("ISSUE_KEY") == F.col("ck")).select("ISSUE_KEY", "EPIC_ID", "COMMIT_SHA")
    met = met.unionByName(named.filter("commits = 0").select("ISSUE_KEY", "EPIC_ID", none.alias("COMMIT_SHA")))
    pulls = p.withColumnRenamed("pk", "ISSUE_KEY").unionByName(named.filter("pulls = 0").select("ISSUE_KEY", none.alias("PR_ID"), none.alias("ROLE_IN_PR")).distinct())
    return joins.in_parts(met, pulls, "ISSUE_KEY", PAIRS_OF_PART).select("ISSUE_KEY", "EPIC_ID", "COMMIT_SHA", "PR_ID", "ROLE_IN_PR")


def all_interactions(issues: DataFrame, commits: DataFrame, prs: DataFrame, matched: DataFrame) -> DataFrame:
    """Everyone's roles, with the matched person by either id, and whether there is one.

    Roles of a person, of an account and of both are met one by one, so that no two give the same row: accounts that many people share make more pairs than
    there are rows, and pairs aren't moved to be told apart."""
    null = F.lit(None).cast("string")
    branch = lambda df, role, jira, github: df.select(F.lit(role).alias("ROLE"), jira.alias("J"), github.alias("G")).distinct()
    parts = [
        branch(commits, "AUTHOR", null, F.col("AUTHOR_ID")), branch(commits, "COMMITTER", null, F.col("COMMITTER_ID")), branch(issues, "ASSIGNEE", F.col("ASSIGNEE_ACCOUNT_ID"), null),
        branch(issues, "REPORTER", F.col("REPORTER_ACCOUNT_ID"), null), prs.select(F.col("ROLE_IN_PR").alias("ROLE"), null.alias("J"), F.col("USER_ID").alias("G")).distinct(),
        branch(matched, "MATCHED", F.col("JIRA_ID"), F.col("GITHUB_ID")),
    ]
    roles = reduce(DataFrame.unionByName, parts).filter("J IS NOT NULL OR G IS NOT NULL").distinct()
    known = matched.select("JIRA_ID", "GITHUB_ID", "UUID").distinct()
    by_j, by_g, both = roles.filter("G IS NULL").select("ROLE", "J"), roles.filter("J IS NULL").select("ROLE", "G"), roles.filter("J IS NOT NULL AND G IS NOT NULL")
    of_j = known.filter("JIRA_ID IS NOT NULL").withColumnRenamed("JIRA_ID", "J")
    of_g = known.filter("GITHUB_ID IS NOT NULL").withColumnRenamed("GITHUB_ID", "G")
    # what a role of both ids says already, or one of an account, is left out before pairs are made
    mine = joins.in_parts(by_j, of_j, "J").withColumnRenamed("GITHUB_ID", "G").join(by_g, ["ROLE", "G"], "left_anti").join(both, ["ROLE", "J", "G"], "left_anti")
    theirs = joins.in_parts(by_g, of_g, "G").withColumnRenamed("JIRA_ID", "J").join(both, ["ROLE", "J", "G"], "left_anti")
    ends = of_g.select("G", "UUID").distinct()
    by_account = joins.in_parts(both, ends, "G")
    by_person = both.join(of_j.select("J", "UUID").distinct(), "J").join(ends.select(F.col("G").alias("end_g"), F.col("UUID").alias("end_uuid")), (F.col("G") == F.col("end_g")) & F.col("UUID").eqNullSafe(F.col("end_uuid")), "left_anti")
    alone = roles.join(of_j.select("J").distinct(), "J", "left_anti").join(of_g.select("G").distinct(), "G", "left_anti")
    out = lambda df, status: df.select("ROLE", F.col("J").alias("JIRA"), F.col("G").alias("GITHUB"), "UUID" if "UUID" in df.columns else null.alias("UUID"), F.lit(status).alias("STATUS"))
    return reduce(DataFrame.unionByName, [*[out(df, "RESOLVED") for df in (mine, theirs, by_account, by_person)], out(alone, "UNRESOLVED")])


def commits_missing_diffs(commits: DataFrame, users: DataFrame, diffs: DataFrame) -> DataFrame:
    """(COMMIT_SHA, GITHUB_ID) of commits of known users (by id or by login) that have no diffs, once each.

    Commits with diffs go first, and those left are one row each with their authors' ids and logins. A login that many accounts share
    makes more pairs than there are commits, so pairs are told apart by what their commit's row says, and only those of a commit of several logins are moved."""
    left = commits.select("COMMIT_SHA", "AUTHOR_ID", "AUTHOR_LOGIN").join(diffs.select("COMMIT_SHA"), "COMMIT_SHA", "left_anti")
    one = left.groupBy("COMMIT_SHA").agg(F.collect_set("AUTHOR_ID").alias("ids"), F.collect_set("AUTHOR_LOGIN").alias("logins"))
    by_id = one.select("COMMIT_SHA", F.explode("ids").alias("GITHUB_ID")).join(users.select("GITHUB_ID"), "GITHUB_ID", "left_semi").select("COMMIT_SHA", "GITHUB_ID")
    of_login = users.filter("GITHUB_LOGIN IS NOT NULL").select("GITHUB_LOGIN", "GITHUB_ID").distinct()
    asked = one.select("COMMIT_SHA", "ids", (F.size("logins") > 1).alias("several"), F.explode("logins").alias("GITHUB_LOGIN"))
    pairs = lambda df: df.join(of_login, "GITHUB_LOGIN").filter(~F.coalesce(F.array_contains("ids", F.col("GITHUB_ID")), F.lit(False))).select("COMMIT_SHA", "GITHUB_ID")
    return by_id.unionByName(pairs(asked.filter("NOT several"))).unionByName(pairs(asked.filter("several")).distinct())


def person_attributes(commits: DataFrame, issues: DataFrame) -> DataFrame:
    """Sets of projects and repositories of each assignee (null if there are none) and the first status."""
    a = issues.filter("ASSIGNEE_ACCOUNT_ID IS NOT NULL").groupBy(F.col("ASSIGNEE_ACCOUNT_ID").alias("person")).agg(F.collect_set(text.blank_to_null(F.col("PROJECT_NAME"))).alias("p"), F.min("STATUS_NAME").alias("status"))
    b = commits.groupBy(F.col("AUTHOR_ID").alias("gid")).agg(F.collect_set("REPO").alias("r"))
    some = lambda c: F.when(F.size(c) > 0, F.array_join(F.sort_array(c), ","))
    return a.join(b, F.col("person") == F.col("gid"), "left").select("person", some("p").alias("projects"), some("r").alias("repos"), "status")


def identity_signals(commits: DataFrame, prs: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """Distinct traces of a person (fingerprint of id, login, email, name and the profile's email and name) and where they were seen, in order.

    ``users`` (ID, LOGIN, NAME, EMAIL, ORD) fill in: by id, or else by login; of repeated keys the last counts."""
    row = lambda df, i, login, email, name, source: df.select(F.col(i).alias("id"), F.col(login).alias("login"), (text.blank_to_null(F.lower(email)) if email else F.lit(None).cast("string")).alias("email"), (F.col(name) if name else F.lit(None).cast("string")).alias("name"), source.alias("source"))
    rows = row(commits, "AUTHOR_ID", "AUTHOR_LOGIN", "AUTHOR_EMAIL", "AUTHOR_NAME", F.concat(F.lit("COMMITS_AUTHOR:"), "COMMIT_SHA"))
    if "COMMITTER_LOGIN" in commits.columns:
        rows = rows.unionByName(row(commits, "COMMITTER_ID", "COMMITTER_LOGIN", "COMMITTER_EMAIL", "COMMITTER_NAME", F.concat(F.lit("COMMITS_COMMITTER:"), "COMMIT_SHA")))
    rows = rows.filter(F.coalesce(*[F.nullif(c, F.lit("")) for c in ("id", "login", "name", "email")]).isNotNull())
    pulls = row(prs, "USER_ID", "USER_LOGIN", None, None, F.concat(F.lit("PRS_"), "ROLE_IN_PR", F.lit(":"), "INTERNAL_ID")).filter(F.coalesce(F.nullif("id", F.lit("")), F.nullif("login", F.lit(""))).isNotNull())
    rows = rows.unionByName(pulls)
    if users is None:
        rows = rows.withColumns({"profile_name": F.lit(None).cast("string"), "profile_email": F.lit(None).cast("string")})
    else:
        last = lambda key, tag: first_by(users.filter(F.col(key).isNotNull()), [key], [F.desc("ORD")]).select(F.col("ID").alias(f"{tag}_id"), F.col("LOGIN").alias(f"{tag}_login"), F.col("NAME").alias(f"{tag}_name"), text.blank_to_null(F.lower("EMAIL")).alias(f"{tag}_email"), F.lit(True).alias(f"{tag}_there"))
        met = rows.join(last("ID", "a"), F.col("id") == F.col("a_id"), "left").join(last("LOGIN", "b"), F.col("login") == F.col("b_login"), "left")
        pick = lambda c: F.when(F.col("a_there"), F.col(f"a_{c}")).otherwise(F.col(f"b_{c}"))
        rows = met.select(text.first_filled(F.col("id"), pick("id")).alias("id"), text.first_filled(F.col("login"), pick("login")).alias("login"), "email", "name", "source", pick("name").alias("profile_name"), pick("email").alias("profile_email"))
    parts = ("id", "login", "email", "name", "profile_email", "profile_name")
    return rows.withColumn("fp", text.fingerprint(*[F.col(c) for c in parts])).groupBy("fp").agg(*[F.max(c).alias(c) for c in parts], F.sort_array(F.collect_list("source")).alias("sources"))


def merged_signals(old: DataFrame, new: DataFrame) -> DataFrame:
    """New signals over old ones, by fingerprint: the new values, and both lists of sources without repeats."""
    return upserts.merge(old, new, ["fp"], {c: "union" if c == "sources" else "new" for c in new.columns if c != "fp"})


def pending_links(prs: DataFrame, issues: DataFrame) -> DataFrame:
    """Pull requests with the issue that they name, of which the hash is not among those done (those of every fourth ORD are)."""
    links = keyed(prs, text.join_text(F.col("TITLE"), F.col("BODY"))).join(issues.select("ISSUE_KEY", "ASSIGNEE_ACCOUNT_ID", "SUMMARY", "DESCRIPTION"), F.col("EXTRACTED_KEY") == F.col("ISSUE_KEY"))
    links = links.select("ORD", text.link_hash(F.col("INTERNAL_ID"), F.col("USER_LOGIN"), F.col("ROLE_IN_PR"), F.col("ISSUE_KEY")).alias("link_hash"), "ASSIGNEE_ACCOUNT_ID", "SUMMARY", "DESCRIPTION")
    return links.join(links.filter("ORD % 4 = 0").select("link_hash").distinct(), "link_hash", "left_anti")


def unknown_logins(prs: DataFrame, matched: DataFrame) -> DataFrame:
    """The last row of each login that is neither a matched login nor among the aliases; NOT IN, with its rule for nulls."""
    known = matched.select("GITHUB_LOGIN").union(matched.select(F.explode("GITHUB_LOGIN_ALIAS"))).distinct()
    last = first_by(prs, ["USER_LOGIN"], [F.desc_nulls_last("UPDATED_AT"), F.asc("ORD")])
    return joins.not_in(last, "USER_LOGIN", known, "GITHUB_LOGIN").select(F.col("USER_ID").alias("GITHUB_ID"), F.col("USER_LOGIN").alias("GITHUB_LOGIN"))


def full_rows(matches: DataFrame, accounts: DataFrame) -> DataFrame:
    """Matches with the whole row of their account; an id that several rows have gives several."""
    return matches.join(accounts.withColumnRenamed("ID", "ACCOUNT_ID"), F.col("GITHUB_ID") == F.col("ACCOUNT_ID"), "left").drop("ACCOUNT_ID")


def first_diff(diffs: DataFrame) -> DataFrame:
    """The earliest diff of each committer, of equals the first path."""
    return diffs.groupBy("COMMITTER_ID").agg(F.min(F.struct("ORD", "FILE_PATH", "COMMIT_SHA")).alias("d")).select("COMMITTER_ID", "d.ORD", "d.FILE_PATH", "d.COMMIT_SHA")


def budget(diffs: DataFrame, limit: int, crossing: bool) -> DataFrame:
    """The newest diffs of each committer up to ``limit`` characters: with the one that crosses it, or without (but always the first), a line break between.

    Only ids and lengths are summed up, over all tasks; then each committer has an oldest diff that stays, and whole rows meet it. Diffs of one
    ORD stay or go together, as the first of them does; those without an ORD are the oldest."""
    n = F.coalesce(F.col("N"), F.lit(0)).cast("long")
    sizes = diffs.select(F.col("COMMITTER_ID").alias("of"), F.col("ORD").alias("at"), n.alias("size"))
    summed = running(sizes, ["of"], [F.col("at").desc_nulls_last()], {"upto": F.col("size") + (0 if crossing else 1), "nth": F.lit(1)})
    kept = summed.filter(F.col("upto") - F.col("size") <= limit) if crossing else summed.filter((F.col("nth") == 1) | (F.col("upto") - 1 <= limit))
    cut = kept.groupBy("of").agg(F.min("at").alias("oldest"), F.max(F.col("at").isNull()).alias("undated"))
    met = diffs.join(cut, F.col("COMMITTER_ID").eqNullSafe(F.col("of")))
    return met.filter((F.col("ORD") >= F.col("oldest")) | (F.col("ORD").isNull() & F.col("undated"))).select(*diffs.columns)


def budget_blocks(diffs: DataFrame, limit: int = 100_000) -> DataFrame:
    """(COMMITTER_ID, COMMITTER_NAME, DIFF_COUNTS, AGGREGATED_DIFFS, AGGREGATED_DIFF_LENGTH, FIRST_DIFF) of each committer: blocks of their diffs, newest first, up to the one that crosses ``limit``.

    Diffs that are null or empty, or of nobody, are left out. The name is that of the last block; the first diff is the oldest of all, of equals that of the first path."""
    rows = diffs.filter("COMMITTER_ID IS NOT NULL AND DIFF IS NOT NULL AND DIFF != ''")
    line = lambda name, c: F.concat(F.lit(f"--- {name}: "), F.col(c).cast("string"), F.lit(" ---\n"))
    block = F.concat(line("START OF COMMIT", "COMMIT_SHA"), line("TIMESTAMP", "ORD"), line("REPO", "REPO"), line("FILE_PATH", "FILE_PATH"), F.lit("\n"), "DIFF", F.lit("\n\n"), line("END OF COMMIT", "COMMIT_SHA"))
    kept = budget(rows.withColumn("N", F.length(block)), limit, crossing=True).withColumn("block", block)
    parts = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("ORD")).alias("o"), "FILE_PATH", "block"))), lambda x: x["block"])
    made = kept.groupBy("COMMITTER_ID").agg(F.min_by("COMMITTER_NAME", "ORD").alias("COMMITTER_NAME"), F.count(F.lit(1)).alias("DIFF_COUNTS"), F.array_join(parts, "\n\n### NEXT CODE CHANGE ###\n\n").alias("AGGREGATED_DIFFS"))
    first = rows.groupBy(F.col("COMMITTER_ID").alias("of")).agg(F.min(F.struct("ORD", "FILE_PATH", "DIFF")).alias("f"))
    return made.join(first, F.col("COMMITTER_ID") == F.col("of")).select("COMMITTER_ID", "COMMITTER_NAME", "DIFF_COUNTS", "AGGREGATED_DIFFS", F.length("AGGREGATED_DIFFS").cast("bigint").alias("AGGREGATED_DIFF_LENGTH"), F.col("f.DIFF").alias("FIRST_DIFF"))


def capped(diffs: DataFrame, inner: int, outer: int) -> DataFrame:
    """The first ``inner`` rows of each committer and file type, then the first ``outer`` of the committer."""
    a = Window.partitionBy("COMMITTER_ID", "EXT").orderBy("ORD")
    b = Window.partitionBy("COMMITTER_ID").orderBy(F.asc("EXT"), F.desc("ORD"))
    named = diffs.withColumn("EXT", text.path_parts(F.col("FILE_PATH"))[2])
    return named.withColumn("i", F.row_number().over(a)).filter(F.col("i") <= inner).withColumn("o", F.row_number().over(b)).filter(F.col("o") <= outer).select("COMMITTER_ID", "EXT", "ORD", "FILE_PATH")


def commit_rollup(diffs: DataFrame) -> DataFrame:
    """By commit: sets of repositories and paths, the list of diffs in order, sums of lines, the first message and time."""
    return diffs.groupBy("COMMIT_SHA").agg(
        set_text("REPO").alias("repos"), set_text("FILE_PATH").alias("paths"), F.transform(F.array_sort(F.collect_list(F.struct("ORD", "DIFF"))), lambda x: x["DIFF"]).alias("diffs"),
        F.sum("ADDED").alias("added"), F.sum("REMOVED").alias("removed"), F.min_by("COMMIT_MESSAGE", "ORD").alias("message"), F.min("ORD").alias("first_at"),
    )


_KEY = r"CASE WHEN regexp_matches({0}, '\b[A-Z]{{2,5}}[-_][0-9]+\b') THEN regexp_extract({0}, '\b([A-Z]{{2,5}})[-_]([0-9]+)\b', 1) || '-' || regexp_extract({0}, '\b([A-Z]{{2,5}})[-_]([0-9]+)\b', 2) WHEN regexp_matches({0}, '(?i)story/[a-z]{{2,5}}[ _-][0-9]+') THEN upper(regexp_extract({0}, '(?i)story/([a-z]{{2,5}})[ _-]([0-9]+)', 1)) || '-' || regexp_extract({0}, '(?i)story/([a-z]{{2,5}})[ _-]([0-9]+)', 2) END"
_CKEY = _KEY.format("COMMIT_MESSAGE")
_PTEXT = "trim(concat_ws(chr(10) || chr(10), nullif(trim(TITLE), ''), nullif(trim(BODY), '')))"
_PKEY = _KEY.format("PTEXT")


def _set(c: str) -> str:
    return f"coalesce(string_agg(DISTINCT {c}, ',' ORDER BY {c}), '')"


def _q(f, *names):
    return lambda spark, d: f(*[load(spark, d, n) for n in names])


def _users(matched: DataFrame) -> DataFrame:
    return matched.select("GITHUB_ID", "GITHUB_LOGIN").distinct()


def _committers(s, d) -> DataFrame:
    """Commits with the committer's account too."""
    return load(s, d, "commits").withColumns({"COMMITTER_LOGIN": F.concat(F.lit("login"), "COMMITTER_ID"), "COMMITTER_EMAIL": F.concat(F.lit("c"), "COMMITTER_ID", F.lit("@x.com"))})


def _linked(s, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    return load(s, d, "issues"), _committers(s, d), load(s, d, "prs")


def _touched(s, d) -> tuple[DataFrame, DataFrame]:
    """People, and what they touched: the issues of their people, and the repositories of their commits."""
    people = load(s, d, "diffs").filter("COMMITTER_ID IS NOT NULL").groupBy(F.col("COMMITTER_ID").alias("GITHUB_ID")).agg(F.min("COMMITTER_NAME").alias("NAME"))
    m = load(s, d, "matched").select("JIRA_ID", "GITHUB_ID", "GITHUB_LOGIN")
    null = F.lit(None).cast("string")
    i = load(s, d, "issues").join(m, F.col("ASSIGNEE_ACCOUNT_ID") == F.col("JIRA_ID")).select("GITHUB_ID", "GITHUB_LOGIN", "JIRA_ID", F.col("ISSUE_KEY").alias("STORY_KEY"), F.expr("substr(ISSUE_KEY, 5)").alias("STORY_ID"), F.concat(F.lit("K"), "PARENT_ID").alias("EPIC_KEY"), F.col("PARENT_ID").alias("EPIC_ID"), "PROJECT_KEY", "PROJECT_NAME", null.alias("REPO"))
    c = load(s, d, "commits").select(F.col("AUTHOR_ID").alias("GITHUB_ID"), F.col("AUTHOR_LOGIN").alias("GITHUB_LOGIN"), null.alias("JIRA_ID"), *[null.alias(x) for x in ARTEFACTS if x != "REPO"], "REPO")
    return people, i.unionByName(c)


def _joined(df: DataFrame) -> DataFrame:
    """Arrays as text, a null in them as 'null'; long ones by their digest."""
    return df.select(*[F.md5(F.array_join(c, ",", "null")).alias(c) if df.schema[c].dataType.typeName() == "array" else F.col(c) for c in df.columns])


def _aliased(s, d) -> DataFrame:
    """Matched people with other logins of theirs."""
    return load(s, d, "matched").select("GITHUB_LOGIN", F.expr("CASE WHEN CAST(JIRA_ID AS INT) % 3 = 0 THEN array('login' || CAST(30 + CAST(JIRA_ID AS INT) % 6 AS STRING), 'other' || JIRA_ID) END").alias("GITHUB_LOGIN_ALIAS"))


def _profiles(s, d) -> DataFrame:
    return load(s, d, "github_users").select("ID", F.expr("'login' || CAST(ORD % 45 AS STRING)").alias("LOGIN"), F.col("DISPLAY_NAME").alias("NAME"), F.upper("EMAIL").alias("EMAIL"), "ORD")


def _signals(s, d, half: int | None = None) -> DataFrame:
    c = _committers(s, d)
    return identity_signals(c.filter(f"ascii(COMMIT_SHA) % 2 = {half}") if half is not None else c, load(s, d, "prs"), _profiles(s, d))


def _sources(df: DataFrame) -> DataFrame:
    return df.withColumns({"n_sources": F.size("sources").cast("bigint"), "sources": F.md5(F.array_join(F.sort_array("sources"), ","))})


QUERIES = {
    "modal_role": lambda s, d: modal_role(load(s, d, "commits"), "AUTHOR_ID", "REPO"),
    "latest_pr_row_per_login": _q(latest_by_login, "prs", "matched"),
    "unmatched_logins": lambda s, d: joins.not_in(load(s, d, "prs").select("USER_LOGIN").distinct(), "USER_LOGIN", load(s, d, "matched"), "GITHUB_LOGIN"),
    "null_aware_not_in": lambda s, d: joins.not_in(load(s, d, "prs").select("USER_ID").distinct(), "USER_ID", load(s, d, "matched"), "GITHUB_ID"),
    "representative_user": _q(representative_user, "commits", "prs"),
    "consolidated_users": _q(consolidated_users, "commits", "prs"),
    "issue_key_extract": lambda s, d: keyed(load(s, d, "commits"), F.col("COMMIT_MESSAGE")).select("COMMIT_SHA", "EXTRACTED_KEY"),
    "pr_issue_key": lambda s, d: keyed(load(s, d, "prs"), text.join_text(F.col("TITLE"), F.col("BODY"))).select("ORD", "EXTRACTED_KEY"),
    "linked_identities": lambda s, d: linked_identities(wide_links(*_linked(s, d))),
    "by_name_lists": lambda s, d: lists_by_name(wide_links(*_linked(s, d))),
    "person_arrays": lambda s, d: _joined(person_arrays(*_touched(s, d))),
    "unknown_logins": lambda s, d: unknown_logins(load(s, d, "prs"), _aliased(s, d)),
    "full_rows": lambda s, d: full_rows(load(s, d, "matched").select("JIRA_ID", "GITHUB_ID"), load(s, d, "github_users").select("ID", "LOGIN", "EMAIL").unionByName(load(s, d, "github_users").filter("ORD % 10 = 1").select("ID", F.concat("LOGIN", F.lit("b")).alias("LOGIN"), "EMAIL"))),
    "story_links": _q(story_links, "issues", "commits", "prs"),
    "story_link_counts": _q(story_link_counts, "issues", "commits", "prs"),
    "all_interactions": _q(all_interactions, "issues", "commits", "prs", "matched"),
    "commits_missing_diffs": lambda s, d: commits_missing_diffs(load(s, d, "commits"), _users(load(s, d, "matched")), load(s, d, "commit_files").filter("STATUS != 'removed'")),
    "person_attributes": _q(person_attributes, "commits", "issues"),
    "identity_signals": lambda s, d: _sources(_signals(s, d)),
    "merged_signals": lambda s, d: _sources(merged_signals(_signals(s, d, 0), _signals(s, d, 1))).select("fp", "name", "sources", "n_sources"),
    "link_hash_pending": lambda s, d: pending_links(load(s, d, "prs"), load(s, d, "issues")).select("ORD", "link_hash"),
    "first_diff": _q(first_diff, "diffs"),
    "diff_budget_inclusive": lambda s, d: budget(load(s, d, "diffs"), 30_000, True).select("COMMITTER_ID", "ORD"),
    "diff_budget_exclusive": lambda s, d: budget(load(s, d, "diffs"), 30_000, False).select("COMMITTER_ID", "ORD"),
    "diff_budget_text": lambda s, d: budget_blocks(load(s, d, "diffs"), 30_000).withColumns({c: F.md5(c) for c in ("AGGREGATED_DIFFS", "FIRST_DIFF")}),
    "diff_caps": lambda s, d: capped(load(s, d, "diffs"), 10, 20),
    "commit_rollup": lambda s, d: commit_rollup(load(s, d, "diffs")).withColumn("diffs", F.md5(F.array_join("diffs", "|"))),
}
_STORY = f"""c AS (SELECT * FROM (SELECT {_CKEY} AS ck, COMMIT_SHA, REPO, AUTHOR_LOGIN FROM commits) WHERE ck IS NOT NULL),
pt AS (SELECT *, {_PTEXT} AS PTEXT FROM prs), p AS (SELECT * FROM (SELECT {_PKEY} AS pk, * FROM pt) WHERE pk IS NOT NULL)"""
_WIDE = f"""{_STORY}, sl AS (SELECT ISSUE_KEY AS STORY_KEY, COMMIT_SHA, INTERNAL_ID AS PR_ID, ROLE_IN_PR FROM (SELECT * FROM issues WHERE ISSUE_TYPE = 'Story') i LEFT JOIN c ON ISSUE_KEY = ck LEFT JOIN p ON ISSUE_KEY = pk WHERE ISSUE_KEY IN (SELECT ck FROM c UNION SELECT pk FROM p)),
w AS (SELECT STORY_KEY, substr(STORY_KEY, 5) AS STORY_ID, {", ".join(f"i.{r}_ACCOUNT_ID AS JIRA_{r}_ID, 'Name ' || i.{r}_ACCOUNT_ID AS JIRA_{r}_NAME, 'p' || i.{r}_ACCOUNT_ID || '@j.com' AS JIRA_{r}_EMAIL" for r in ROLES_OF_ISSUES)},
m.REPO, m.AUTHOR_ID AS GH_AUTHOR_ID, m.AUTHOR_LOGIN AS GH_AUTHOR_LOGIN, m.AUTHOR_EMAIL AS GH_AUTHOR_EMAIL, m.COMMITTER_ID AS GH_COMMITTER_ID, 'login' || m.COMMITTER_ID AS GH_COMMITTER_LOGIN, 'c' || m.COMMITTER_ID || '@x.com' AS GH_COMMITTER_EMAIL, u.USER_ID AS PR_USER_ID, u.USER_LOGIN AS PR_USER_LOGIN
FROM sl JOIN issues i ON i.ISSUE_KEY = STORY_KEY LEFT JOIN commits m ON m.COMMIT_SHA = sl.COMMIT_SHA LEFT JOIN (SELECT DISTINCT INTERNAL_ID, ROLE_IN_PR, USER_ID, USER_LOGIN FROM prs) u ON u.INTERNAL_ID = PR_ID AND u.ROLE_IN_PR = sl.ROLE_IN_PR)"""
_SIGNALS = """pf AS (SELECT ID, 'login' || (ORD % 45) AS LOGIN, DISPLAY_NAME AS NAME, nullif(trim(lower(upper(EMAIL))), '') AS EMAIL, ORD FROM github_users), pl AS (SELECT * FROM pf QUALIFY row_number() OVER (PARTITION BY LOGIN ORDER BY ORD DESC) = 1),
s0 AS (SELECT AUTHOR_ID AS id, AUTHOR_LOGIN AS login, nullif(trim(lower(AUTHOR_EMAIL)), '') AS email, AUTHOR_NAME AS name, 'COMMITS_AUTHOR:' || COMMIT_SHA AS source FROM commits UNION ALL SELECT COMMITTER_ID, 'login' || COMMITTER_ID, 'c' || COMMITTER_ID || '@x.com', COMMITTER_NAME, 'COMMITS_COMMITTER:' || COMMIT_SHA FROM commits
UNION ALL SELECT USER_ID, USER_LOGIN, NULL, NULL, 'PRS_' || ROLE_IN_PR || ':' || INTERNAL_ID FROM prs),
s AS (SELECT coalesce(s0.id, CASE WHEN a.ID IS NOT NULL THEN a.ID ELSE b.ID END) AS id, coalesce(s0.login, CASE WHEN a.ID IS NOT NULL THEN a.LOGIN ELSE b.LOGIN END) AS login, s0.email AS email, s0.name AS name, source, CASE WHEN a.ID IS NOT NULL THEN a.NAME ELSE b.NAME END AS profile_name, CASE WHEN a.ID IS NOT NULL THEN a.EMAIL ELSE b.EMAIL END AS profile_email
FROM s0 LEFT JOIN pf a ON a.ID = s0.id LEFT JOIN pl b ON b.LOGIN = s0.login)"""
_FP = " || '|' || ".join(f"coalesce({c}, 'none')" for c in ("id", "login", "email", "name", "profile_email", "profile_name"))
_MAXES = ", ".join(f"max({c}) AS {c}" for c in ("id", "login", "email", "name", "profile_email", "profile_name"))
ORACLES = {
    "modal_role": with_sql("WITH n AS (SELECT AUTHOR_ID AS person, REPO AS role, count(*) AS n FROM commits GROUP BY ALL) SELECT person, role, n FROM (SELECT *, row_number() OVER (PARTITION BY person ORDER BY n DESC, role) AS r FROM n) WHERE r = 1", "commits"),
    "latest_pr_row_per_login": with_sql("SELECT USER_LOGIN, USER_ID, UPDATED_AT, ORD FROM (SELECT *, row_number() OVER (PARTITION BY USER_LOGIN ORDER BY UPDATED_AT DESC NULLS LAST, ORD) AS r FROM prs) WHERE r = 1 AND USER_LOGIN NOT IN (SELECT GITHUB_LOGIN FROM matched)", "prs", "matched"),
    "unmatched_logins": with_sql("SELECT DISTINCT USER_LOGIN FROM prs WHERE USER_LOGIN NOT IN (SELECT GITHUB_LOGIN FROM matched)", "prs", "matched"),
    "null_aware_not_in": with_sql("SELECT DISTINCT USER_ID FROM prs WHERE USER_ID NOT IN (SELECT GITHUB_ID FROM matched)", "prs", "matched"),
    "representative_user": with_sql("WITH b AS (SELECT AUTHOR_ID AS ID, AUTHOR_NAME AS NAME, AUTHOR_EMAIL AS EMAIL FROM commits UNION ALL SELECT USER_ID, USER_LOGIN, NULL FROM prs) SELECT ID, NAME, EMAIL FROM (SELECT *, row_number() OVER (PARTITION BY ID ORDER BY NAME NULLS LAST, EMAIL NULLS LAST) AS r FROM b WHERE ID IS NOT NULL) WHERE r = 1", "commits", "prs"),
    "consolidated_users": with_sql("WITH b AS (SELECT AUTHOR_LOGIN AS LOGIN, AUTHOR_ID AS ID, AUTHOR_NAME AS NAME, AUTHOR_EMAIL AS EMAIL FROM commits UNION ALL SELECT USER_LOGIN, USER_ID, NULL, NULL FROM prs) SELECT LOGIN, max(ID) AS ID, min(NAME) AS NAME, min(EMAIL) AS EMAIL, count(*) AS n_rows FROM b GROUP BY LOGIN", "commits", "prs"),
    "issue_key_extract": with_sql(f"SELECT COMMIT_SHA, {_CKEY} AS EXTRACTED_KEY FROM commits", "commits"),
    "pr_issue_key": with_sql(f"WITH pt AS (SELECT ORD, {_PTEXT} AS PTEXT FROM prs) SELECT ORD, {_PKEY} AS EXTRACTED_KEY FROM pt", "prs"),
    "linked_identities": with_sql(f"WITH {_WIDE} SELECT JIRA_CREATOR_ID, {', '.join(f'{_set(c)} AS {c.lower()}s' for c in LINKED)} FROM w WHERE JIRA_CREATOR_ID IS NOT NULL AND JIRA_REPORTER_ID IS NOT NULL AND JIRA_ASSIGNEE_ID IS NOT NULL GROUP BY 1", "issues", "commits", "prs"),
    "by_name_lists": with_sql(f"WITH {_WIDE} " + " UNION ALL ".join(f"SELECT JIRA_{r}_NAME AS name, '{r.lower()}' AS role, {_set('STORY_ID')} AS story_ids, {_set('STORY_KEY')} AS story_keys, {_set('REPO')} AS repos FROM w WHERE JIRA_{r}_NAME IS NOT NULL GROUP BY 1" for r in ROLES_OF_ISSUES), "issues", "commits", "prs"),
    "person_arrays": with_sql(f"""WITH pp AS (SELECT COMMITTER_ID AS GITHUB_ID, min(COMMITTER_NAME) AS NAME FROM diffs WHERE COMMITTER_ID IS NOT NULL GROUP BY 1),
t AS (SELECT GITHUB_ID, GITHUB_LOGIN, JIRA_ID, ISSUE_KEY AS STORY_KEY, substr(ISSUE_KEY, 5) AS STORY_ID, 'K' || PARENT_ID AS EPIC_KEY, PARENT_ID AS EPIC_ID, PROJECT_KEY, PROJECT_NAME, NULL AS REPO FROM issues JOIN matched ON ASSIGNEE_ACCOUNT_ID = JIRA_ID UNION ALL SELECT AUTHOR_ID, AUTHOR_LOGIN, NULL, NULL, NULL, NULL, NULL, NULL, NULL, REPO FROM commits),
g AS (SELECT GITHUB_ID, max(GITHUB_LOGIN) AS GITHUB_LOGIN, max(JIRA_ID) AS JIRA_ID, {', '.join(f"md5(array_to_string(list_concat(list_sort(list_distinct(list({c}) FILTER ({c} IS NOT NULL))), CASE WHEN bool_or({c} IS NULL) THEN ['null'] ELSE [] END), ',')) AS {c}S" for c in ARTEFACTS)} FROM t WHERE GITHUB_ID IS NOT NULL GROUP BY 1)
SELECT pp.GITHUB_ID, NAME, GITHUB_LOGIN, JIRA_ID, {', '.join(f"coalesce({c}S, md5('')) AS {c}S" for c in ARTEFACTS)} FROM pp LEFT JOIN g ON g.GITHUB_ID = pp.GITHUB_ID""", "diffs", "issues", "matched", "commits"),
    "unknown_logins": with_sql("""WITH a AS (SELECT GITHUB_LOGIN FROM matched UNION SELECT unnest(['login' || (30 + CAST(JIRA_ID AS INT) % 6), 'other' || JIRA_ID]) FROM matched WHERE CAST(JIRA_ID AS INT) % 3 = 0)
SELECT USER_ID AS GITHUB_ID, USER_LOGIN AS GITHUB_LOGIN FROM prs WHERE USER_LOGIN NOT IN (SELECT GITHUB_LOGIN FROM a) QUALIFY row_number() OVER (PARTITION BY USER_LOGIN ORDER BY UPDATED_AT DESC NULLS LAST, ORD) = 1""", "prs", "matched"),
    "full_rows": with_sql("WITH a AS (SELECT ID, LOGIN, EMAIL FROM github_users UNION ALL SELECT ID, LOGIN || 'b', EMAIL FROM github_users WHERE ORD % 10 = 1) SELECT JIRA_ID, GITHUB_ID, LOGIN, EMAIL FROM matched LEFT JOIN a ON GITHUB_ID = ID", "matched", "github_users"),
    "story_link_counts": with_sql(f"""WITH {_STORY}, n AS (SELECT key, sum(c)::BIGINT AS commits, sum(p)::BIGINT AS pulls FROM (SELECT ck AS key, 1 AS c, 0 AS p FROM c UNION ALL SELECT pk, 0, 1 FROM p) GROUP BY key)
SELECT ISSUE_KEY, CASE WHEN PARENT_ISSUE_TYPE = 'Epic' THEN PARENT_ID END AS EPIC_ID, commits, pulls, greatest(commits, 1) * greatest(pulls, 1) AS links FROM issues JOIN n ON ISSUE_KEY = key WHERE ISSUE_TYPE = 'Story'""", "issues", "commits", "prs"),
    "story_links": with_sql(f"WITH {_STORY}, s AS (SELECT ISSUE_KEY, CASE WHEN PARENT_ISSUE_TYPE = 'Epic' THEN PARENT_ID END AS EPIC_ID FROM issues WHERE ISSUE_TYPE = 'Story') SELECT ISSUE_KEY, EPIC_ID, COMMIT_SHA, INTERNAL_ID AS PR_ID, ROLE_IN_PR FROM s LEFT JOIN c ON ISSUE_KEY = ck LEFT JOIN p ON ISSUE_KEY = pk WHERE ISSUE_KEY IN (SELECT ck FROM c UNION SELECT pk FROM p)", "issues", "commits", "prs"),
    "all_interactions": with_sql("""WITH r AS (SELECT 'AUTHOR' AS ROLE, NULL AS J, AUTHOR_ID AS G FROM commits UNION SELECT 'COMMITTER', NULL, COMMITTER_ID FROM commits UNION SELECT 'ASSIGNEE', ASSIGNEE_ACCOUNT_ID, NULL FROM issues UNION SELECT 'REPORTER', REPORTER_ACCOUNT_ID, NULL FROM issues UNION SELECT ROLE_IN_PR, NULL, USER_ID FROM prs UNION SELECT 'MATCHED', JIRA_ID, GITHUB_ID FROM matched)
SELECT DISTINCT ROLE, coalesce(J, JIRA_ID) AS JIRA, coalesce(G, GITHUB_ID) AS GITHUB, UUID, CASE WHEN JIRA_ID IS NULL AND GITHUB_ID IS NULL THEN 'UNRESOLVED' ELSE 'RESOLVED' END AS STATUS FROM r LEFT JOIN matched ON J = JIRA_ID OR G = GITHUB_ID WHERE J IS NOT NULL OR G IS NOT NULL""", "issues", "commits", "prs", "matched"),
    "commits_missing_diffs": with_sql("WITH u AS (SELECT DISTINCT GITHUB_ID, GITHUB_LOGIN FROM matched) SELECT DISTINCT COMMIT_SHA, GITHUB_ID FROM commits JOIN u ON AUTHOR_ID = GITHUB_ID OR AUTHOR_LOGIN = GITHUB_LOGIN WHERE NOT EXISTS (SELECT 1 FROM commit_files d WHERE STATUS <> 'removed' AND d.COMMIT_SHA = commits.COMMIT_SHA)", "commits", "matched", "commit_files"),
    "person_attributes": with_sql("WITH a AS (SELECT ASSIGNEE_ACCOUNT_ID AS person, string_agg(DISTINCT PROJECT_NAME, ',' ORDER BY PROJECT_NAME) AS projects, min(STATUS_NAME) AS status FROM issues WHERE ASSIGNEE_ACCOUNT_ID IS NOT NULL GROUP BY 1), b AS (SELECT AUTHOR_ID AS gid, string_agg(DISTINCT REPO, ',' ORDER BY REPO) AS repos FROM commits GROUP BY 1) SELECT person, projects, repos, status FROM a LEFT JOIN b ON person = gid", "commits", "issues"),
    "identity_signals": with_sql(f"WITH {_SIGNALS} SELECT {_FP} AS fp, {_MAXES}, md5(string_agg(source, ',' ORDER BY source)) AS sources, count(*) AS n_sources FROM s GROUP BY 1", "commits", "prs", "github_users"),
    "merged_signals": with_sql(f"""WITH {_SIGNALS}, f AS (SELECT *, {_FP} AS fp, CASE WHEN source LIKE 'PRS%' THEN -1 ELSE ascii(substr(source, position(':' IN source) + 1)) % 2 END AS half FROM s)
SELECT fp, max(name) AS name, md5(string_agg(DISTINCT source, ',' ORDER BY source)) AS sources, count(DISTINCT source) AS n_sources FROM f GROUP BY 1""", "commits", "prs", "github_users"),
    "link_hash_pending": with_sql(f"WITH pt AS (SELECT *, {_PTEXT} AS PTEXT FROM prs), p AS (SELECT *, {_PKEY} AS pk FROM pt), l AS (SELECT ORD, md5(INTERNAL_ID || '|' || USER_LOGIN || '|' || ROLE_IN_PR || '|' || ISSUE_KEY) AS link_hash FROM p JOIN issues ON pk = ISSUE_KEY) SELECT l.* FROM l LEFT JOIN (SELECT DISTINCT link_hash FROM l WHERE ORD % 4 = 0) x USING (link_hash) WHERE x.link_hash IS NULL", "prs", "issues"),
    "first_diff": with_sql("SELECT COMMITTER_ID, ORD, min(FILE_PATH) AS FILE_PATH, min(COMMIT_SHA) AS COMMIT_SHA FROM diffs WHERE (COMMITTER_ID, ORD) IN (SELECT COMMITTER_ID, min(ORD) FROM diffs GROUP BY 1) GROUP BY ALL", "diffs"),
    "diff_budget_inclusive": with_sql("SELECT COMMITTER_ID, ORD FROM (SELECT *, sum(N) OVER (PARTITION BY COMMITTER_ID ORDER BY ORD DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM diffs) WHERE coalesce(b, 0) <= 30000", "diffs"),
    "diff_budget_exclusive": with_sql("SELECT COMMITTER_ID, ORD FROM (SELECT *, sum(N + 1) OVER w - 1 AS b, row_number() OVER w AS r FROM diffs WINDOW w AS (PARTITION BY COMMITTER_ID ORDER BY ORD DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) WHERE r = 1 OR b <= 30000", "diffs"),
    "diff_budget_text": with_sql("""WITH b AS (SELECT *, '--- START OF COMMIT: ' || COMMIT_SHA || ' ---' || chr(10) || '--- TIMESTAMP: ' || ORD || ' ---' || chr(10) || '--- REPO: ' || REPO || ' ---' || chr(10) || '--- FILE_PATH: ' || FILE_PATH || ' ---' || chr(10) || chr(10) || DIFF || chr(10) || chr(10) || '--- END OF COMMIT: ' || COMMIT_SHA || ' ---' || chr(10) AS block
  FROM diffs WHERE COMMITTER_ID IS NOT NULL AND DIFF IS NOT NULL AND DIFF <> ''),
k AS (SELECT *, sum(length(block)) OVER (PARTITION BY COMMITTER_ID ORDER BY ORD DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM b),
t AS (SELECT COMMITTER_ID, arg_min(COMMITTER_NAME, ORD) AS COMMITTER_NAME, count(*) AS DIFF_COUNTS, string_agg(block, chr(10) || chr(10) || '### NEXT CODE CHANGE ###' || chr(10) || chr(10) ORDER BY ORD DESC) AS txt FROM k WHERE coalesce(before, 0) <= 30000 GROUP BY 1),
f AS (SELECT COMMITTER_ID, arg_min(DIFF, ORD) AS FIRST_DIFF FROM b GROUP BY 1)
SELECT t.COMMITTER_ID, COMMITTER_NAME, DIFF_COUNTS, md5(txt) AS AGGREGATED_DIFFS, length(txt)::BIGINT AS AGGREGATED_DIFF_LENGTH, md5(FIRST_DIFF) AS FIRST_DIFF FROM t JOIN f ON f.COMMITTER_ID = t.COMMITTER_ID""", "diffs"),
    "diff_caps": with_sql(r"WITH e AS (SELECT *, regexp_extract(FILE_PATH, '[^./][^/]*?(\.[^./]*)$', 1) AS EXT FROM diffs), i AS (SELECT *, row_number() OVER (PARTITION BY COMMITTER_ID, EXT ORDER BY ORD) AS r FROM e), o AS (SELECT *, row_number() OVER (PARTITION BY COMMITTER_ID ORDER BY EXT, ORD DESC) AS q FROM i WHERE r <= 10) SELECT COMMITTER_ID, EXT, ORD, FILE_PATH FROM o WHERE q <= 20", "diffs"),
    "commit_rollup": with_sql(f"SELECT COMMIT_SHA, {_set('REPO')} AS repos, {_set('FILE_PATH')} AS paths, md5(string_agg(DIFF, '|' ORDER BY ORD)) AS diffs, sum(ADDED)::BIGINT AS added, sum(REMOVED)::BIGINT AS removed, arg_min(COMMIT_MESSAGE, ORD) AS message, min(ORD) AS first_at FROM diffs GROUP BY 1", "diffs"),
}
