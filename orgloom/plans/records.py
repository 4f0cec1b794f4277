"""Landed API records in the full width of their tables: commits, pull requests, issues, files, users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..operators.running import running
from ..sources import catalog, paged
from ..sources.adapters import load, with_sql

_PERSON = "struct<name:string,email:string,date:string>"
COMMIT_JSON = f"author {_PERSON}, committer {_PERSON}, message string"
ACCOUNT_JSON = "id string, login string"
_NAMED = "struct<name:string>"
_USER = "struct<accountId:string,displayName:string,emailAddress:string>"
FIELDS_JSON = f"assignee {_USER}, reporter {_USER}, summary string, description string, status {_NAMED}, issuetype {_NAMED}, project struct<key:string,name:string>, created string, updated string, resolution {_NAMED}, priority {_NAMED}, labels string"


def some_id(c: Column) -> Column:
    """An id as text; 0 and empty are none."""
    return F.when(c.isin("0", ""), None).otherwise(c)


def flat_commits(raw: DataFrame) -> DataFrame:
    """The 14 columns of a commit from its JSON parts; what is missing or broken is null, and so is an id of 0."""
    c, a, m = F.from_json("COMMIT", COMMIT_JSON), F.from_json("AUTHOR", ACCOUNT_JSON), F.from_json("COMMITTER", ACCOUNT_JSON)
    return raw.select(
        "ORG", "REPO", "COMMIT_SHA", "COMMIT_TIMESTAMP", some_id(a["id"]).alias("AUTHOR_ID"), c["author"]["name"].alias("AUTHOR_NAME"), c["author"]["email"].alias("AUTHOR_EMAIL"), a["login"].alias("AUTHOR_LOGIN"),
        some_id(m["id"]).alias("COMMITTER_ID"), c["committer"]["name"].alias("COMMITTER_NAME"), c["committer"]["email"].alias("COMMITTER_EMAIL"), m["login"].alias("COMMITTER_LOGIN"),
        c["message"].alias("COMMIT_MESSAGE"), F.lit(None).cast("string").alias("EXTRACTED_JIRA_KEY"),
    )


def live_commits(raw: DataFrame, repos: DataFrame, cutoff: str) -> DataFrame:
    """``flat_commits`` since the cutoff of repositories that are no forks."""
    kept = repos.filter("NOT FORK").select(F.col("NAME").alias("REPO"))
    return flat_commits(catalog.landed(raw, "COMMIT_TIMESTAMP", cutoff).join(kept, "REPO", "left_semi"))


def live_pulls(pulls: DataFrame, repos: DataFrame, cutoff: str) -> DataFrame:
    """Pull requests updated since the cutoff, of repositories that are neither forks nor archived, with their place (NTH) in the repository, newest first.

    Of pages that descend by time, those behind the first old one are never opened."""
    kept = repos.filter("NOT FORK AND NOT ARCHIVED").select(F.col("NAME").alias("REPO"))
    return running(catalog.landed(pulls, "UPDATED_AT", cutoff).join(kept, "REPO", "left_semi"), ["REPO"], [F.desc("UPDATED_AT"), F.asc("ORD")], {"NTH": F.lit(1)})


def flat_issues(raw: DataFrame, profiles: DataFrame | None = None) -> DataFrame:
    """The 19 columns of an issue from its FIELDS; names are the profiles' (ID, DISPLAY_NAME, EMAIL) if they have some, emails theirs alone.

    Without ``profiles``, names and emails are those of FIELDS, as in live records."""
    rows = raw.select("KEY", "ID", F.from_json("FIELDS", FIELDS_JSON).alias("f"))
    named = {}
    for role in ("assignee", "reporter"):
        if profiles is None:
            named[role] = F.col(f"f.{role}.displayName"), F.col(f"f.{role}.emailAddress")
        else:
            p = profiles.select(F.col("ID").alias(f"{role}_pid"), F.col("DISPLAY_NAME").alias(f"{role}_pname"), F.col("EMAIL").alias(f"{role}_pemail"))
            rows = rows.join(p, F.col(f"f.{role}.accountId") == F.col(f"{role}_pid"), "left")
            named[role] = F.coalesce(F.nullif(f"{role}_pname", F.lit("")), F.col(f"f.{role}.displayName")), F.col(f"{role}_pemail")
    return rows.select(
        F.col("KEY").alias("ISSUE_KEY"), named["assignee"][0].alias("ASSIGNEE_DISPLAY_NAME"), named["reporter"][0].alias("REPORTER_DISPLAY_NAME"), F.col("f.assignee.accountId").alias("ASSIGNEE_ACCOUNT_ID"), F.col("f.reporter.accountId").alias("REPORTER_ACCOUNT_ID"),
        named["assignee"][1].alias("ASSIGNEE_EMAIL"), named["reporter"][1].alias("REPORTER_EMAIL"), F.expr("try_cast(ID AS BIGINT)").alias("INTERNAL_ID"), F.col("f.summary").alias("SUMMARY"), F.col("f.description").alias("DESCRIPTION"),
        F.col("f.status.name").alias("STATUS_NAME"), F.col("f.issuetype.name").alias("ISSUE_TYPE_NAME"), F.col("f.project.key").alias("PROJECT_KEY"), F.col("f.project.name").alias("PROJECT_NAME"), F.col("f.created").alias("CREATED"), F.col("f.updated").alias("UPDATED"),
        F.col("f.resolution.name").alias("RESOLUTION_NAME"), F.col("f.priority.name").alias("PRIORITY_NAME"), F.from_json("f.labels", "array<string>").alias("LABELS"),
    )


def issues_since(raw: DataFrame, cutoff: str) -> DataFrame:
    """Landed issues updated at or after the cutoff, oldest first."""
    return catalog.landed(raw, "UPDATED", cutoff, order=True)


def usable_files(files: DataFrame, empty_too: bool = False) -> DataFrame:
    """Files of commits that have a patch: not removed, not null; empty ones only if wanted."""
    kept = files.filter("STATUS != 'removed' AND PATCH IS NOT NULL")
    return kept if empty_too else kept.filter("PATCH != ''")


def staged_diffs(files: DataFrame, repos: DataFrame, per_repo: int = 200, per_user: int = 200) -> DataFrame:
    """The first ``per_repo`` commits of each user and repository as the API gives them (ORD), and of their usable files the first ``per_user`` of the user: newest-pushed repository first, then newest commit.

    Repositories without a push, and commits without a date, come last."""
    commits = files.groupBy("USER_LOGIN", "REPO", "COMMIT_SHA").agg(F.min("ORD").alias("first_ord"))
    taken = commits.withColumn("i", F.row_number().over(Window.partitionBy("USER_LOGIN", "REPO").orderBy("first_ord", "COMMIT_SHA"))).filter(F.col("i") <= per_repo)
    rows = usable_files(files).join(taken.select("USER_LOGIN", "REPO", "COMMIT_SHA"), ["USER_LOGIN", "REPO", "COMMIT_SHA"], "left_semi").join(repos.select(F.col("NAME").alias("REPO"), "PUSHED_AT"), "REPO", "left")
    order = [F.desc_nulls_last("PUSHED_AT"), F.asc("REPO"), F.desc_nulls_last("COMMITTED_AT"), F.asc("ORD")]
    return rows.withColumn("NTH", F.row_number().over(Window.partitionBy("USER_LOGIN").orderBy(*order))).filter(F.col("NTH") <= per_user)


def commits_without_diffs(commits: DataFrame, users: DataFrame, diffs: DataFrame) -> DataFrame:
    """Commits (ORG, REPO, COMMIT_SHA) of known users, by id or login, that have no diff of the same three; a commit of several repositories counts in each."""
    from ..operators import joins

    known = joins.or_left(commits.select("ORG", "REPO", "COMMIT_SHA", "AUTHOR_ID", "AUTHOR_LOGIN"), users, [("AUTHOR_ID", "GITHUB_ID"), ("AUTHOR_LOGIN", "GITHUB_LOGIN")], ["ORG", "REPO", "COMMIT_SHA"], ["GITHUB_ID", "GITHUB_LOGIN"])
    rows = known.filter("GITHUB_ID IS NOT NULL OR GITHUB_LOGIN IS NOT NULL").select("ORG", "REPO", "COMMIT_SHA").distinct()
    return rows.join(diffs.select("ORG", "REPO", "COMMIT_SHA").distinct(), ["ORG", "REPO", "COMMIT_SHA"], "left_anti")


def batches(rows: DataFrame) -> DataFrame:
    """(ORG, REPO, shas) of rows to fetch, one for each repository."""
    return rows.groupBy("ORG", "REPO").agg(F.sort_array(F.collect_set("COMMIT_SHA")).alias("shas"))


def file_tree(entries: DataFrame, repos: DataFrame, as_of: str, days: int = 90, max_repos: int = 500) -> DataFrame:
    """Files (blobs) of the trees of the first ``max_repos`` repositories, by name, pushed within ``days``, with folder, name and extension."""
    since = F.expr(f"timestamp'{as_of}' - INTERVAL {days} DAYS")
    active = repos.filter(F.col("PUSHED_AT") >= since).orderBy("NAME").limit(max_repos).select(F.col("NAME").alias("REPO"), "DEFAULT_BRANCH")
    folder, name, extension = text.path_parts(F.col("PATH"))
    return entries.filter("TYPE = 'blob'").join(active, "REPO").select("REPO", F.col("DEFAULT_BRANCH").alias("BRANCH"), "PATH", folder.alias("DIR_PATH"), name.alias("FILE_NAME"), extension.alias("EXTENSION"), "SIZE")


def account_users(users: DataFrame) -> DataFrame:
    return users.filter("ACCOUNT_ID IS NOT NULL").select("ACCOUNT_ID", "DISPLAY_NAME", F.coalesce("ACTIVE", F.lit(False)).alias("ACTIVE"))


def complete(df: DataFrame, *columns: str) -> DataFrame:
    """Rows that have all of ``columns``."""
    return df.dropna(subset=list(columns))


def _pages(rows: DataFrame, source: str, newest_first: str | None, last: str) -> DataFrame:
    """``rows`` landed in pages, as an API gives them, and read again."""
    order = [*([F.desc(newest_first)] if newest_first else []), F.asc(last)]
    path, schema = paged.land_pages(rows, source, order, 500)
    return paged.paged(rows.sparkSession, path, schema, source, newest_first)


def _texts(df: DataFrame) -> DataFrame:
    """Arrays as text and times as ISO text, so that every engine shows them alike."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema}
    return df.select(*[F.array_join(c, ",").alias(c) if k == "array" else text.iso(F.col(c)).alias(c) if k.startswith("timestamp") else F.col(c) for c, k in kinds.items()])


SINCE = "2024-01-10 00:00:00"
QUERIES = {
    "commit_record": lambda s, d: _texts(flat_commits(load(s, d, "raw_commits"))),
    "live_commits": lambda s, d: _texts(live_commits(load(s, d, "raw_commits"), load(s, d, "repos"), SINCE)),
    "live_pulls": lambda s, d: live_pulls(_pages(load(s, d, "prs"), "REPO", "UPDATED_AT", "ORD"), load(s, d, "repos"), SINCE).select("REPO", "ORD", "NTH"),
    "issue_record": lambda s, d: _texts(flat_issues(load(s, d, "raw_issues"), load(s, d, "jira_users"))),
    "live_issue_record": lambda s, d: _texts(flat_issues(load(s, d, "raw_issues"))),
    "issues_since": lambda s, d: issues_since(_pages(load(s, d, "raw_issues").select(F.split_part("KEY", F.lit("-"), F.lit(1)).alias("PROJECT"), "KEY", "UPDATED"), "PROJECT", "UPDATED", "KEY"), "1998-07-01 00:00:00").select("KEY"),
    "staged_diffs": lambda s, d: staged_diffs(load(s, d, "commit_files"), load(s, d, "repos"), 5, 20).select("USER_LOGIN", "REPO", "ORD", F.col("NTH").cast("bigint").alias("NTH")),
    "commits_without_diffs": lambda s, d: commits_without_diffs(load(s, d, "commits"), load(s, d, "matched").select("GITHUB_ID", "GITHUB_LOGIN").distinct(), usable_files(load(s, d, "commit_files"))),
    "commit_batches": lambda s, d: _texts(batches(load(s, d, "commits"))).select("ORG", "REPO", F.md5("shas").alias("shas")),
    "file_tree": lambda s, d: file_tree(load(s, d, "tree_entries"), load(s, d, "repos"), "2024-04-05 00:00:00", 90, 10),
    "account_users": lambda s, d: account_users(_pages(load(s, d, "accounts").withColumn("SITE", F.lit("all")), "SITE", None, "ACCOUNT_ID")),
    "project_keys": lambda s, d: load(s, d, "raw_issues").select(F.get_json_object("FIELDS", "$.project.key").alias("key")).filter("key IS NOT NULL").distinct().orderBy("key"),
    "active_repos": lambda s, d: catalog.landed(load(s, d, "repos"), "PUSHED_AT", "2024-01-10 00:00:00", strict=True).select("NAME"),
    "complete_rows": lambda s, d: complete(load(s, d, "commits"), "AUTHOR_ID", "AUTHOR_EMAIL").select("COMMIT_SHA"),
    "newest_first": lambda s, d: load(s, d, "commits").select("COMMIT_SHA", "AUTHOR_ID", "COMMIT_TIMESTAMP").orderBy(F.asc_nulls_last("AUTHOR_ID"), F.desc_nulls_last("COMMIT_TIMESTAMP"), "COMMIT_SHA").select("AUTHOR_ID", "COMMIT_SHA"),
}


def _js(column: str, path: str) -> str:
    return f"CASE WHEN json_valid({column}) THEN json_extract_string({column}, '{path}') END"


def _iso(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN strftime({c}, '%f') = '000000' THEN '' ELSE '.' || strftime({c}, '%f') END"


_ID = "CASE WHEN {0} IN ('0', '') THEN NULL ELSE {0} END"
_COMMIT_SQL = f"""SELECT ORG, REPO, COMMIT_SHA, {_iso("COMMIT_TIMESTAMP")} AS COMMIT_TIMESTAMP, {_ID.format(_js("AUTHOR", "$.id"))} AS AUTHOR_ID, {_js("COMMIT", "$.author.name")} AS AUTHOR_NAME, {_js("COMMIT", "$.author.email")} AS AUTHOR_EMAIL, {_js("AUTHOR", "$.login")} AS AUTHOR_LOGIN,
{_ID.format(_js("COMMITTER", "$.id"))} AS COMMITTER_ID, {_js("COMMIT", "$.committer.name")} AS COMMITTER_NAME, {_js("COMMIT", "$.committer.email")} AS COMMITTER_EMAIL, {_js("COMMITTER", "$.login")} AS COMMITTER_LOGIN, {_js("COMMIT", "$.message")} AS COMMIT_MESSAGE, NULL::VARCHAR AS EXTRACTED_JIRA_KEY FROM raw_commits"""


def _issue_sql(profiles: bool) -> str:
    name = "coalesce(nullif({0}.DISPLAY_NAME, ''), {1})" if profiles else "{1}"
    who = lambda r: (name.format(r[0], _js("FIELDS", f"$.{r}.displayName")), f"{r[0]}.EMAIL" if profiles else _js("FIELDS", f"$.{r}.emailAddress"))
    (an, ae), (rn, re_) = who("assignee"), who("reporter")
    joined = f"LEFT JOIN jira_users a ON a.ID = {_js('FIELDS', '$.assignee.accountId')} LEFT JOIN jira_users r ON r.ID = {_js('FIELDS', '$.reporter.accountId')}" if profiles else ""
    plain = {"SUMMARY": "summary", "DESCRIPTION": "description", "STATUS_NAME": "status.name", "ISSUE_TYPE_NAME": "issuetype.name", "PROJECT_KEY": "project.key", "PROJECT_NAME": "project.name", "CREATED": "created", "UPDATED": "updated", "RESOLUTION_NAME": "resolution.name", "PRIORITY_NAME": "priority.name", "ASSIGNEE_ACCOUNT_ID": "assignee.accountId", "REPORTER_ACCOUNT_ID": "reporter.accountId"}
    return f"""SELECT KEY AS ISSUE_KEY, {an} AS ASSIGNEE_DISPLAY_NAME, {rn} AS REPORTER_DISPLAY_NAME, {ae} AS ASSIGNEE_EMAIL, {re_} AS REPORTER_EMAIL, try_cast(raw_issues.ID AS BIGINT) AS INTERNAL_ID,
{", ".join(f"{_js('FIELDS', '$.' + p)} AS {c}" for c, p in plain.items())}, CASE WHEN json_valid(FIELDS) AND json_type(FIELDS, '$.labels') = 'ARRAY' THEN array_to_string(json_extract_string(FIELDS, '$.labels[*]'), ',') END AS LABELS FROM raw_issues {joined}"""


_USABLE = "STATUS <> 'removed' AND PATCH IS NOT NULL AND PATCH <> ''"
ORACLES = {
    "commit_record": with_sql(_COMMIT_SQL, "raw_commits"),
    "live_commits": with_sql(f"{_COMMIT_SQL} WHERE COMMIT_TIMESTAMP >= TIMESTAMP '{SINCE}' AND REPO IN (SELECT NAME FROM repos WHERE NOT FORK)", "raw_commits", "repos"),
    "live_pulls": with_sql(f"SELECT REPO, ORD, row_number() OVER (PARTITION BY REPO ORDER BY UPDATED_AT DESC, ORD) AS NTH FROM prs WHERE UPDATED_AT >= TIMESTAMP '{SINCE}' AND REPO IN (SELECT NAME FROM repos WHERE NOT FORK AND NOT ARCHIVED)", "prs", "repos"),
    "issue_record": with_sql(_issue_sql(True), "raw_issues", "jira_users"),
    "live_issue_record": with_sql(_issue_sql(False), "raw_issues"),
    "issues_since": with_sql("SELECT KEY FROM raw_issues WHERE UPDATED >= TIMESTAMP '1998-07-01' ORDER BY UPDATED", "raw_issues"),
    "staged_diffs": with_sql(f"""WITH g AS (SELECT USER_LOGIN, REPO, COMMIT_SHA, min(ORD) AS o FROM commit_files GROUP BY ALL), c AS (SELECT *, row_number() OVER (PARTITION BY USER_LOGIN, REPO ORDER BY o, COMMIT_SHA) AS i FROM g),
k AS (SELECT f.*, r.PUSHED_AT FROM commit_files f JOIN c ON c.USER_LOGIN = f.USER_LOGIN AND c.REPO = f.REPO AND c.COMMIT_SHA = f.COMMIT_SHA AND i <= 5 LEFT JOIN repos r ON r.NAME = f.REPO WHERE {_USABLE})
SELECT USER_LOGIN, REPO, ORD, NTH FROM (SELECT *, row_number() OVER (PARTITION BY USER_LOGIN ORDER BY PUSHED_AT DESC NULLS LAST, REPO, COMMITTED_AT DESC NULLS LAST, ORD) AS NTH FROM k) WHERE NTH <= 20""", "commit_files", "repos"),
    "commits_without_diffs": with_sql(f"""SELECT DISTINCT ORG, REPO, COMMIT_SHA FROM commits c WHERE (AUTHOR_ID IN (SELECT GITHUB_ID FROM matched WHERE GITHUB_ID IS NOT NULL) OR AUTHOR_LOGIN IN (SELECT GITHUB_LOGIN FROM matched))
AND NOT EXISTS (SELECT 1 FROM commit_files d WHERE {_USABLE} AND d.ORG = c.ORG AND d.REPO = c.REPO AND d.COMMIT_SHA = c.COMMIT_SHA)""", "commits", "matched", "commit_files"),
    "commit_batches": with_sql("SELECT ORG, REPO, md5(string_agg(DISTINCT COMMIT_SHA, ',' ORDER BY COMMIT_SHA)) AS shas FROM commits GROUP BY ALL", "commits"),
    "file_tree": with_sql(r"""WITH a AS (SELECT NAME, DEFAULT_BRANCH FROM repos WHERE PUSHED_AT >= TIMESTAMP '2024-04-05' - INTERVAL 90 DAYS ORDER BY NAME LIMIT 10)
SELECT REPO, DEFAULT_BRANCH AS BRANCH, PATH, regexp_extract(PATH, '^(.*)/', 1) AS DIR_PATH, regexp_extract(PATH, '[^/]*$') AS FILE_NAME, CASE WHEN PATH LIKE '%/.%' THEN '' ELSE regexp_extract(PATH, '(\.[^./]*)$', 1) END AS EXTENSION, SIZE FROM tree_entries JOIN a ON REPO = NAME WHERE TYPE = 'blob'""", "tree_entries", "repos"),
    "account_users": with_sql("SELECT ACCOUNT_ID, DISPLAY_NAME, coalesce(ACTIVE, false) AS ACTIVE FROM accounts WHERE ACCOUNT_ID IS NOT NULL", "accounts"),
    "project_keys": with_sql(f"SELECT DISTINCT {_js('FIELDS', '$.project.key')} AS key FROM raw_issues WHERE {_js('FIELDS', '$.project.key')} IS NOT NULL ORDER BY 1", "raw_issues"),
    "active_repos": with_sql("SELECT NAME FROM repos WHERE PUSHED_AT > TIMESTAMP '2024-01-10'", "repos"),
    "complete_rows": with_sql("SELECT COMMIT_SHA FROM commits WHERE AUTHOR_ID IS NOT NULL AND AUTHOR_EMAIL IS NOT NULL", "commits"),
    "newest_first": with_sql("SELECT AUTHOR_ID, COMMIT_SHA FROM commits ORDER BY AUTHOR_ID NULLS LAST, COMMIT_TIMESTAMP DESC NULLS LAST, COMMIT_SHA", "commits"),
}
