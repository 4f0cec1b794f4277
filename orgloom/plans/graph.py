"""Vertices and edges of the organization graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import joins
from ..operators.upserts import first_by
from ..sources.adapters import load, with_sql


def _by_person(rows: DataFrame, account: str, at: str, matched: DataFrame, first: str, n: str) -> DataFrame:
    """First time and number of rows of each person (UUID) in each repository. Rows are summed up by account before they meet its people, who may be many."""
    summed = rows.filter(F.col(account).isNotNull()).groupBy(F.col(account).alias("GITHUB_ID"), "ORG", "REPO").agg(F.min(at).alias("at"), F.count(F.lit(1)).alias("n"))
    people = matched.filter("UUID IS NOT NULL").groupBy("GITHUB_ID", "UUID").agg(F.count(F.lit(1)).alias("times"))
    return summed.join(people, "GITHUB_ID").groupBy("UUID", "ORG", "REPO").agg(F.min("at").alias(first), F.sum(F.col("n") * F.col("times")).alias(n))


def repo_contribution(commits: DataFrame, matched: DataFrame) -> DataFrame:
    """First commit and number of commits of each person in each repository."""
    return _by_person(commits, "AUTHOR_ID", "COMMIT_TIMESTAMP", matched, "first_commit", "commit_count")


def pr_contribution(prs: DataFrame, matched: DataFrame) -> DataFrame:
    """First pull request and number of participations (a person counts once for each role)."""
    return _by_person(prs, "USER_ID", "CREATED_AT", matched, "first_pr", "pr_count")


def user_repo_edges(commits: DataFrame, prs: DataFrame, matched: DataFrame) -> DataFrame:
    """Commit edges, and pull request edges where there is no commit edge."""
    by_commit, by_pr = repo_contribution(commits, matched), pr_contribution(prs, matched)
    alone = by_pr.join(by_commit, ["UUID", "ORG", "REPO"], "left_anti")
    edge = lambda df, first, n, via: df.select("UUID", text.safe_key(text.repo_path(F.col("ORG"), F.col("REPO"))).alias("repo_key"), F.col(first).alias("first_at"), F.col(n).alias("n"), F.lit(via).alias("via"))
    return edge(by_commit, "first_commit", "commit_count", "commit").unionByName(edge(alone, "first_pr", "pr_count", "pr"))


def memberships(issues: DataFrame, matched: DataFrame) -> DataFrame:
    """(issue, person, project) for assignees and reporters, once for each pair of rows."""
    return joins.any_of(issues.select("ISSUE_KEY", "PROJECT_KEY", "ASSIGNEE_ACCOUNT_ID", "REPORTER_ACCOUNT_ID"), ["ASSIGNEE_ACCOUNT_ID", "REPORTER_ACCOUNT_ID"], matched.select("JIRA_ID", "UUID"), "JIRA_ID")


def user_epic_story_count(issues: DataFrame, matched: DataFrame) -> DataFrame:
    met = memberships(issues, matched).filter("UUID IS NOT NULL AND PROJECT_KEY IS NOT NULL")
    return met.groupBy("UUID", "PROJECT_KEY").agg(F.countDistinct("ISSUE_KEY").alias("story_count"))


def epic_collaboration(issues: DataFrame, matched: DataFrame) -> DataFrame:
    """Pairs of projects and how many people they share."""
    people = memberships(issues, matched).filter("UUID IS NOT NULL AND PROJECT_KEY IS NOT NULL").select("UUID", "PROJECT_KEY").distinct()
    a, b = people.withColumnRenamed("PROJECT_KEY", "epic1"), people.withColumnRenamed("PROJECT_KEY", "epic2")
    return a.join(b, "UUID").filter("epic1 < epic2").groupBy("epic1", "epic2").agg(F.count(F.lit(1)).alias("shared_count"))


def dept_repos(commits: DataFrame, prs: DataFrame, issues: DataFrame, matched: DataFrame) -> DataFrame:
    """Repositories touched by people who have any issue."""
    active = issues.select(F.explode(F.array("ASSIGNEE_ACCOUNT_ID", "REPORTER_ACCOUNT_ID")).alias("JIRA_ID")).filter("JIRA_ID IS NOT NULL").distinct()
    people = matched.join(active, "JIRA_ID", "left_semi").filter("GITHUB_ID IS NOT NULL").select("GITHUB_ID").distinct()
    path = text.repo_path(F.col("ORG"), F.col("REPO")).alias("repo")
    a = commits.join(people, F.col("AUTHOR_ID") == F.col("GITHUB_ID"), "left_semi").select(path)
    b = prs.join(people, F.col("USER_ID") == F.col("GITHUB_ID"), "left_semi").select(path)
    return a.union(b).distinct().select("repo", text.safe_key(F.col("repo")).alias("repo_key"))


def story_memberships(issues: DataFrame, matched: DataFrame) -> DataFrame:
    """One edge for each issue and person; the assignee's comes before the reporter's."""
    branch = lambda c, role, rank: issues.join(matched, F.col(c) == F.col("JIRA_ID")).filter("UUID IS NOT NULL").select("ISSUE_KEY", "UUID", F.struct(F.lit(rank).alias("rank"), F.lit(role).alias("role")).alias("r"))
    both = branch("ASSIGNEE_ACCOUNT_ID", "Assignee", 0).unionByName(branch("REPORTER_ACCOUNT_ID", "Reporter", 1))
    return both.groupBy("ISSUE_KEY", "UUID").agg(F.min("r").alias("r")).select("ISSUE_KEY", "UUID", F.col("r.role").alias("role"), F.concat_ws("-", "ISSUE_KEY", "UUID").alias("edge_key"))


def vertices(commits: DataFrame, prs: DataFrame, issues: DataFrame, matched: DataFrame, skills: DataFrame) -> DataFrame:
    """(kind, key, title) of departments, epics, teams, users, repositories and skills."""
    v = lambda df, kind, key, title: df.select(F.lit(kind).alias("kind"), key.alias("key"), title.alias("title"))
    spark = commits.sparkSession
    epics = first_by(issues.filter("PROJECT_KEY IS NOT NULL").select("PROJECT_KEY", "PROJECT_NAME").distinct(), ["PROJECT_KEY"], [F.asc_nulls_last("PROJECT_NAME")])
    repos = commits.select("ORG", "REPO").union(prs.select("ORG", "REPO")).distinct()
    path = text.repo_path(F.col("ORG"), F.col("REPO"))
    out = [
        v(spark.range(1), "Departments", F.lit("engineering"), F.lit("Engineering")), v(epics, "Epics", F.col("PROJECT_KEY"), F.col("PROJECT_NAME")),
        v(issues, "Teams", F.col("ISSUE_KEY"), F.concat_ws(" | ", "SUMMARY", "STATUS_NAME", text.iso(F.col("CREATED_TIMESTAMP")))),
        v(matched.filter("UUID IS NOT NULL"), "Users", F.col("UUID"), F.col("JIRA_DISPLAY_NAME")), v(repos, "Repos", text.safe_key(path), path),
        v(skill_vertices(skills), "Skills", F.col("skill_key"), F.col("skill_name")),
    ]
    whole = out[0]
    for x in out[1:]:
        whole = whole.unionByName(x)
    return whole


def spread_skills(skills: DataFrame) -> DataFrame:
    named = skills.select("UUID", F.posexplode(text.list_of(F.col("SKILLS"))).alias("ord", "skill_name")).withColumn("skill_key", text.skill_key(F.col("skill_name")))
    return named.filter("skill_key != ''")


def skill_vertices(skills: DataFrame) -> DataFrame:
    """One vertex for each key; the least spelling is its name."""
    return spread_skills(skills).groupBy("skill_key").agg(F.min("skill_name").alias("skill_name"))


def skill_edges(skills: DataFrame) -> DataFrame:
    return spread_skills(skills).select("skill_key", "UUID").distinct()


def user_vertices(matched: DataFrame, profiles: DataFrame) -> DataFrame:
    """A vertex for each person with a UUID: the match's columns, and role, level and skills (a list, empty without a profile) of the profile of that UUID."""
    p = profiles.select(F.col("UUID").alias("of_uuid"), F.col("ROLE").alias("role"), F.col("EXPERIENCE_LEVEL").alias("experience_level"), text.list_of(F.col("SKILLS")).alias("skills"))
    met = matched.filter("UUID IS NOT NULL").join(p, F.col("UUID") == F.col("of_uuid"), "left").drop("of_uuid")
    return met.withColumn("skills", F.coalesce("skills", F.array().cast("array<string>"))).withColumnRenamed("UUID", "_key")


def epic_edges(issues: DataFrame) -> DataFrame:
    """Department to each epic, and epic to each of its stories whose epic is a vertex."""
    epics = issues.filter("PROJECT_KEY IS NOT NULL").select(F.col("PROJECT_KEY").alias("key")).distinct()
    stories = issues.select(F.col("ISSUE_KEY").alias("key")).distinct()
    down = epics.select(F.lit("dept_to_epic").alias("kind"), F.lit("engineering").alias("src"), F.col("key").alias("dst"))
    across = joins.guarded(issues.select(F.col("PROJECT_KEY").alias("src"), F.col("ISSUE_KEY").alias("dst")), epics, stories).select(F.lit("epic_to_team").alias("kind"), "src", "dst")
    return down.unionByName(across)


_MEMBERS = """SELECT DISTINCT m.UUID, i.PROJECT_KEY, i.ISSUE_KEY FROM issues i JOIN matched m ON i.ASSIGNEE_ACCOUNT_ID = m.JIRA_ID OR i.REPORTER_ACCOUNT_ID = m.JIRA_ID
WHERE m.UUID IS NOT NULL AND i.PROJECT_KEY IS NOT NULL"""
_BY_COMMIT = "SELECT UUID, ORG, REPO, min(COMMIT_TIMESTAMP) AS first_commit, count(*) AS commit_count FROM commits JOIN matched ON AUTHOR_ID = GITHUB_ID WHERE UUID IS NOT NULL GROUP BY ALL"
_BY_PR = "SELECT UUID, ORG, REPO, min(CREATED_AT) AS first_pr, count(*) AS pr_count FROM prs JOIN matched ON USER_ID = GITHUB_ID WHERE UUID IS NOT NULL GROUP BY ALL"
_SKILLS = "SELECT UUID, trim(s) AS skill_name, trim(regexp_replace(lower(trim(s)), '[^a-z0-9]+', '_', 'g'), '_') AS skill_key FROM skills, unnest(string_split(SKILLS, ',')) t(s) WHERE trim(s) <> ''"


def _profiles(s, d) -> DataFrame:
    """Profiles of two people in three."""
    return load(s, d, "matched").filter("CAST(JIRA_ID AS INT) % 3 != 0").selectExpr("UUID", "CASE WHEN CAST(JIRA_ID AS INT) % 2 = 0 THEN 'Back End Developer' ELSE 'Inconclusive' END AS ROLE", "'Senior' AS EXPERIENCE_LEVEL", "CASE WHEN CAST(JIRA_ID AS INT) % 5 = 0 THEN NULL ELSE ' Python, ,' || SEGMENT || ' ' END AS SKILLS")


def _q(f, *names):
    return lambda spark, d: f(*[load(spark, d, n) for n in names])


QUERIES = {
    "repo_contribution": _q(repo_contribution, "commits", "matched"),
    "pr_contribution": _q(pr_contribution, "prs", "matched"),
    "user_repo_edges": _q(user_repo_edges, "commits", "prs", "matched"),
    "user_epic_story_count": _q(user_epic_story_count, "issues", "matched"),
    "epic_collaboration": _q(epic_collaboration, "issues", "matched"),
    "dept_repos": _q(dept_repos, "commits", "prs", "issues", "matched"),
    "story_memberships": _q(story_memberships, "issues", "matched"),
    "graph_vertices": _q(vertices, "commits", "prs", "issues", "matched", "skills"),
    "skills_split_sanitize": _q(skill_vertices, "skills"),
    "skill_to_user": _q(skill_edges, "skills"),
    "epic_edges": _q(epic_edges, "issues"),
    "user_vertices": lambda s, d: user_vertices(load(s, d, "matched").select("UUID", "JIRA_ID", "GITHUB_ID", "GITHUB_LOGIN", "JIRA_DISPLAY_NAME"), _profiles(s, d)).withColumn("skills", F.array_join("skills", "|")),
    "guarded_edges": lambda s, d: joins.guarded(load(s, d, "events").select(F.concat(F.lit("u"), "user_id").alias("src"), F.concat(F.lit("p"), (F.col("event_id") % 700).cast("string")).alias("dst")).distinct(), load(s, d, "supplier").select(F.concat(F.lit("u"), "s_suppkey").alias("key")), load(s, d, "part").filter("p_size > 10").select(F.concat(F.lit("p"), "p_partkey").alias("key"))),
    "first_titles": lambda s, d: first_by(load(s, d, "issues").filter("PROJECT_KEY IS NOT NULL").select("PROJECT_KEY", "PROJECT_NAME", "CREATED_TIMESTAMP", "ISSUE_KEY"), ["PROJECT_KEY"], [F.asc("CREATED_TIMESTAMP"), F.asc("ISSUE_KEY")]).select("PROJECT_KEY", "PROJECT_NAME"),
}
ORACLES = {
    "repo_contribution": with_sql(_BY_COMMIT, "commits", "matched"),
    "pr_contribution": with_sql(_BY_PR, "prs", "matched"),
    "user_repo_edges": with_sql(f"""WITH c AS ({_BY_COMMIT}), p AS ({_BY_PR})
SELECT UUID, replace(ORG || '/' || REPO, '/', '__') AS repo_key, first_commit AS first_at, commit_count AS n, 'commit' AS via FROM c
UNION ALL SELECT UUID, replace(ORG || '/' || REPO, '/', '__'), first_pr, pr_count, 'pr' FROM p ANTI JOIN c USING (UUID, ORG, REPO)""", "commits", "prs", "matched"),
    "user_epic_story_count": with_sql(f"WITH m AS ({_MEMBERS}) SELECT UUID, PROJECT_KEY, count(DISTINCT ISSUE_KEY) AS story_count FROM m GROUP BY ALL", "issues", "matched"),
    "epic_collaboration": with_sql(f"WITH m AS (SELECT DISTINCT UUID, PROJECT_KEY FROM ({_MEMBERS})) SELECT a.PROJECT_KEY AS epic1, b.PROJECT_KEY AS epic2, count(*) AS shared_count FROM m a JOIN m b ON a.UUID = b.UUID AND a.PROJECT_KEY < b.PROJECT_KEY GROUP BY ALL", "issues", "matched"),
    "dept_repos": with_sql("""WITH act AS (SELECT DISTINCT GITHUB_ID FROM matched m WHERE GITHUB_ID IS NOT NULL AND EXISTS (SELECT 1 FROM issues i WHERE i.ASSIGNEE_ACCOUNT_ID = m.JIRA_ID OR i.REPORTER_ACCOUNT_ID = m.JIRA_ID)),
r AS (SELECT ORG || '/' || REPO AS repo FROM commits WHERE AUTHOR_ID IN (SELECT GITHUB_ID FROM act) UNION SELECT ORG || '/' || REPO FROM prs WHERE USER_ID IN (SELECT GITHUB_ID FROM act))
SELECT repo, replace(repo, '/', '__') AS repo_key FROM r""", "commits", "prs", "issues", "matched"),
    "story_memberships": with_sql("""WITH u AS (SELECT ISSUE_KEY, UUID, 'Assignee' AS role FROM issues JOIN matched ON ASSIGNEE_ACCOUNT_ID = JIRA_ID UNION ALL SELECT ISSUE_KEY, UUID, 'Reporter' FROM issues JOIN matched ON REPORTER_ACCOUNT_ID = JIRA_ID)
SELECT ISSUE_KEY, UUID, min(role) AS role, ISSUE_KEY || '-' || UUID AS edge_key FROM u WHERE UUID IS NOT NULL GROUP BY ISSUE_KEY, UUID""", "issues", "matched"),
    "graph_vertices": with_sql(f"""WITH s AS ({_SKILLS})
SELECT 'Departments' AS kind, 'engineering' AS key, 'Engineering' AS title
UNION ALL SELECT 'Epics', PROJECT_KEY, min(PROJECT_NAME) FROM issues WHERE PROJECT_KEY IS NOT NULL GROUP BY PROJECT_KEY
UNION ALL SELECT 'Teams', ISSUE_KEY, SUMMARY || ' | ' || STATUS_NAME || ' | ' || strftime(CREATED_TIMESTAMP, '%Y-%m-%dT%H:%M:%S') || CASE WHEN strftime(CREATED_TIMESTAMP, '%f') = '000000' THEN '' ELSE '.' || strftime(CREATED_TIMESTAMP, '%f') END FROM issues
UNION ALL SELECT 'Users', UUID, JIRA_DISPLAY_NAME FROM matched WHERE UUID IS NOT NULL
UNION ALL SELECT 'Repos', replace(r, '/', '__'), r FROM (SELECT ORG || '/' || REPO AS r FROM commits UNION SELECT ORG || '/' || REPO FROM prs)
UNION ALL SELECT 'Skills', skill_key, min(skill_name) FROM s WHERE skill_key <> '' GROUP BY skill_key""", "commits", "prs", "issues", "matched", "skills"),
    "skills_split_sanitize": with_sql(f"WITH s AS ({_SKILLS}) SELECT skill_key, min(skill_name) AS skill_name FROM s WHERE skill_key <> '' GROUP BY skill_key", "skills"),
    "skill_to_user": with_sql(f"WITH s AS ({_SKILLS}) SELECT DISTINCT skill_key, UUID FROM s WHERE skill_key <> ''", "skills"),
    "epic_edges": with_sql("""SELECT DISTINCT 'dept_to_epic' AS kind, 'engineering' AS src, PROJECT_KEY AS dst FROM issues WHERE PROJECT_KEY IS NOT NULL
UNION ALL SELECT 'epic_to_team', PROJECT_KEY, ISSUE_KEY FROM issues WHERE PROJECT_KEY IS NOT NULL""", "issues"),
    "user_vertices": with_sql("SELECT UUID AS _key, JIRA_ID, GITHUB_ID, GITHUB_LOGIN, JIRA_DISPLAY_NAME, CASE WHEN CAST(JIRA_ID AS INT) % 3 = 0 THEN NULL WHEN CAST(JIRA_ID AS INT) % 2 = 0 THEN 'Back End Developer' ELSE 'Inconclusive' END AS role, CASE WHEN CAST(JIRA_ID AS INT) % 3 <> 0 THEN 'Senior' END AS experience_level, CASE WHEN CAST(JIRA_ID AS INT) % 3 = 0 OR CAST(JIRA_ID AS INT) % 5 = 0 THEN '' ELSE 'Python|' || SEGMENT END AS skills FROM matched WHERE UUID IS NOT NULL", "matched"),
    "guarded_edges": "SELECT DISTINCT 'u' || user_id AS src, 'p' || (event_id % 700) AS dst FROM events WHERE user_id IN (SELECT s_suppkey FROM supplier) AND event_id % 700 IN (SELECT p_partkey FROM part WHERE p_size > 10)",
    "first_titles": with_sql("SELECT PROJECT_KEY, arg_min(PROJECT_NAME, (CREATED_TIMESTAMP, ISSUE_KEY)) AS PROJECT_NAME FROM issues WHERE PROJECT_KEY IS NOT NULL GROUP BY 1", "issues"),
}
