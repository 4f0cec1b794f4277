"""Engineering records in the shape of the star-schema tables: one definition for Spark and for SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Made-up people.
FIRST = "Anna,Boris,Carla,Dmitri,Elena,Farid,Greta,Hugo,Ines,Jonas,Klara,Liam,Mona"
LAST = "Abbott,Bergmann,Castro,Dubois,Eriksen,Fischer,Garcia,Hansen,Ivanov,Jensen,Keller,Lopez,Moreau,Novak,Olsen,Petrov,Quint"


def part(names: str, number: str) -> str:
    """SQL of the name of that number, counted round and round."""
    return f"split_part('{names}', ',', CAST(({number}) % {names.count(',') + 1} + 1 AS INT))"


def person(first: str, last: str) -> str:
    return f"{part(FIRST, first)} || ' ' || {part(LAST, last)}"


_CODE = "CASE doc_id % 7 WHEN 0 THEN 'from django.db import models; api = database' WHEN 1 THEN 'import React from \"react\"; a component with css' WHEN 2 THEN 'import torch; a neural network' WHEN 3 THEN 'docker build; kubectl apply; terraform plan' WHEN 4 THEN 'import pandas as pd; import numpy' WHEN 5 THEN 'microservices architecture' ELSE 'plain' END || chr(10)"

#: name -> (table, column expressions that Spark and DuckDB both take, condition)
ADAPTERS: dict[str, tuple[str, list[str], str | None]] = {
    "commits": ("events", [
        "'org' AS ORG", "'repo_' || CAST(event_id % 12 AS STRING) AS REPO", "md5('c' || CAST(event_id AS STRING)) AS COMMIT_SHA", "ts AS COMMIT_TIMESTAMP",
        "CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(user_id AS STRING) END AS AUTHOR_ID", "'User ' || CAST(user_id AS STRING) AS AUTHOR_NAME",
        "CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'u' || CAST(user_id AS STRING) || '@x.com' END AS AUTHOR_EMAIL", "'login' || CAST(user_id % 40 AS STRING) AS AUTHOR_LOGIN",
        "CAST((user_id * 7 + 3) % 150 AS STRING) AS COMMITTER_ID", "'User ' || CAST((user_id * 7 + 3) % 150 AS STRING) AS COMMITTER_NAME",
        "CASE event_id % 4 WHEN 0 THEN 'fix ORD-' || CAST(event_id % 500 AS STRING) || ' now' WHEN 1 THEN 'ORD_' || CAST(event_id % 500 AS STRING) || ' and ABC-1' WHEN 2 THEN 'no key here' ELSE 'story/ord ' || CAST(event_id % 90 AS STRING) END AS COMMIT_MESSAGE",
    ], None),
    "prs": ("events", [
        "CAST(event_id % 3000 AS STRING) AS INTERNAL_ID", "CAST(event_id AS BIGINT) AS ORD", "'org' AS ORG", "'repo_' || CAST(event_id % 15 AS STRING) AS REPO", "CAST(user_id AS STRING) AS USER_ID",
        "'login' || CAST(user_id % 40 AS STRING) AS USER_LOGIN", "upper(event_type) AS ROLE_IN_PR", "ts AS CREATED_AT", "ts AS UPDATED_AT",
        "'Work on ' || event_type AS TITLE", "CASE event_id % 3 WHEN 0 THEN 'closes ORD-' || CAST(event_id % 400 AS STRING) WHEN 1 THEN '' ELSE NULL END AS BODY",
    ], "event_id % 2 = 0"),
    "issues": ("orders", [
        "'ORD-' || CAST(o_orderkey AS STRING) AS ISSUE_KEY", "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS ASSIGNEE_ACCOUNT_ID",
        "CAST((o_custkey * 3 + 1) % 400 AS STRING) AS REPORTER_ACCOUNT_ID", "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE 'P' || substr(o_orderpriority, 1, 1) || CAST(o_orderkey % 9 AS STRING) END AS PROJECT_KEY",
        "'Project ' || CAST(o_orderkey % 4 AS STRING) AS PROJECT_NAME", "o_orderstatus AS STATUS_NAME", "CASE WHEN o_orderkey % 3 = 0 THEN 'Story' ELSE 'Task' END AS ISSUE_TYPE", "'Order ' || CAST(o_orderkey AS STRING) AS SUMMARY", "CASE o_orderkey % 5 WHEN 0 THEN 'Fix the react component' WHEN 1 THEN 'database query of the api' WHEN 2 THEN NULL WHEN 3 THEN '' ELSE 'terraform and docker' END AS DESCRIPTION", "o_orderdate AS CREATED_TIMESTAMP",
        "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST((o_custkey * 5 + 2) % 300 AS STRING) END AS CREATOR_ACCOUNT_ID", "CASE WHEN o_orderkey % 2 = 0 THEN 'Epic' ELSE 'Story' END AS PARENT_ISSUE_TYPE", "'E' || CAST(o_orderkey % 50 AS STRING) AS PARENT_ID",
    ], None),
    "matched": ("customer", [
        "CAST(c_custkey AS STRING) AS JIRA_ID", "CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE CAST(c_custkey % 150 AS STRING) END AS GITHUB_ID",
        "substr(sha1(CAST(c_custkey AS STRING) || '|' || CAST(c_custkey % 150 AS STRING)), 1, 20) AS UUID", "'login' || CAST(c_custkey % 30 AS STRING) AS GITHUB_LOGIN", "c_name AS JIRA_DISPLAY_NAME", "c_mktsegment AS SEGMENT",
    ], None),
    "diffs": ("documents", [
        "CAST(doc_id % 40 AS STRING) AS COMMITTER_ID", "'Name ' || CAST(doc_id % 40 AS STRING) AS COMMITTER_NAME", "doc_id AS ORD", "md5(CAST(doc_id - doc_id % 80 + doc_id % 40 AS STRING)) AS COMMIT_SHA", "'repo_' || CAST(doc_id % 12 AS STRING) AS REPO",
        "'Change ' || CAST(doc_id - doc_id % 80 + doc_id % 40 AS STRING) || ' of the code. More follows.' AS COMMIT_MESSAGE",
        "'src/' || lang || '/f' || CAST(doc_id % 7 AS STRING) || CASE doc_id % 3 WHEN 0 THEN '.py' WHEN 1 THEN '.tar.gz' ELSE '' END AS FILE_PATH", f"{_CODE} || text AS DIFF", f"CAST(length({_CODE} || text) AS BIGINT) AS N",
        "CAST(doc_id % 97 * 9 AS BIGINT) AS ADDED", "CAST(doc_id % 13 AS BIGINT) AS REMOVED",
    ], None),
    "summaries": ("events", [
        "'u' || CAST(event_id AS STRING) AS UUID",
        """'{"last_90d_commits": ' || CAST(event_id % 50 AS STRING) || ', "pr_review_comments": ' || CAST(event_id % 7 AS STRING) || ', "associated_issues": {' || CASE WHEN event_id % 3 = 0 THEN '' ELSE '"ORD-' || CAST(event_id AS STRING) || '": {"issue_type": "Bug", "project_key": "P' || CAST(event_id % 4 AS STRING) || '", "project_name": "Proj", "description": ' || CASE WHEN event_id % 2 = 0 THEN '"About ' || CAST(event_id AS STRING) || '"' ELSE 'null' END || '}' END || '}, "commits": [' || CASE WHEN event_id % 5 = 0 THEN '' ELSE '{"repos": ["a", "b"], "commit_message": "m' || CAST(event_id AS STRING) || '", "summary": ' || CASE WHEN event_id % 4 = 0 THEN '""' ELSE '"did it"' END || ', "key_changes": ["x", "y"], "langs": ["Python"], "frameworks": [], "loc_added": 3, "loc_removed": ' || CAST(event_id % 9 AS STRING) || ', "file_count": 1, "file_path": ["p/' || CAST(event_id AS STRING) || '.py"]}' || CASE WHEN event_id % 7 = 0 THEN ', {"repos": [], "commit_message": "", "summary": "", "key_changes": [], "langs": [], "frameworks": ["React"], "loc_added": 1, "loc_removed": 0, "file_count": 0, "file_path": []}' ELSE '' END END || ']}' AS SUMMARIES""",
    ], None),
    "agent_outputs": ("events", [
        "event_id AS ID",
        """CASE event_id % 6 WHEN 0 THEN '```json {"role": "DevOps Engineer", "experience_level": "Senior", "skills": ["AWS"]} ```' WHEN 1 THEN '{"role": "Wizard", "experience_level": "Senior"}' WHEN 2 THEN 'sorry' WHEN 3 THEN NULL WHEN 4 THEN '{"role": "Inconclusive"}' ELSE '{"role": "Data Scientist", "experience_level": "Junior", "skills": []}' END AS OUTPUT""",
    ], None),
    "raw": ("events", ["event_id AS ID", "props AS PROPS", "'{\"author\": {\"name\": \"User ' || CAST(user_id AS STRING) || '\", \"date\": \"2024-01-0' || CAST(1 + event_id % 9 AS STRING) || '\"}, \"message\": \"m' || CAST(event_id AS STRING) || '\"}' AS COMMIT", "CASE WHEN event_id % 6 = 0 THEN NULL ELSE '{\"id\": ' || CAST(user_id AS STRING) || ', \"login\": \"l' || CAST(user_id AS STRING) || '\"}' END AS AUTHOR"], None),
    "repos": ("nation", [
        "'repo_' || CAST(n_nationkey AS STRING) AS NAME", "n_nationkey % 5 = 4 AS FORK", "n_nationkey % 7 = 3 AS ARCHIVED", "'main' || CAST(n_nationkey % 2 AS STRING) AS DEFAULT_BRANCH",
        "CASE WHEN n_nationkey % 6 = 5 THEN NULL ELSE CAST('2024-01-' || lpad(CAST(1 + n_nationkey AS STRING), 2, '0') || ' 00:00:00' AS TIMESTAMP) END AS PUSHED_AT",
    ], None),
    "raw_commits": ("events", [
        "'org' AS ORG", "'repo_' || CAST(event_id % 12 AS STRING) AS REPO", "md5('c' || CAST(event_id AS STRING)) AS COMMIT_SHA", "ts AS COMMIT_TIMESTAMP",
        """CASE WHEN event_id % 23 = 0 THEN '{broken' WHEN event_id % 19 = 0 THEN NULL ELSE '{"author": {"name": "User ' || CAST(user_id AS STRING) || '", "email": "u' || CAST(user_id AS STRING) || '@x.com", "date": "2024-01-02"}, ' || CASE WHEN event_id % 4 = 0 THEN '' ELSE '"committer": {"name": "Committer ' || CAST(user_id % 9 AS STRING) || '", "email": null}, ' END || '"message": "m' || CAST(event_id AS STRING) || '"}' END AS COMMIT""",
        """CASE WHEN event_id % 6 = 0 THEN NULL WHEN event_id % 11 = 0 THEN '{"id": 0, "login": "ghost"}' ELSE '{"id": ' || CAST(user_id AS STRING) || ', "login": "l' || CAST(user_id AS STRING) || '"}' END AS AUTHOR""",
        """CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 13 = 0 THEN '{}' ELSE '{"id": "' || CAST(user_id % 9 AS STRING) || '", "login": "c' || CAST(user_id % 9 AS STRING) || '"}' END AS COMMITTER""",
    ], None),
    "raw_issues": ("orders", [
        "'ORD-' || CAST(o_orderkey AS STRING) AS KEY", "CAST(o_orderkey AS STRING) AS ID", "o_orderdate AS UPDATED",
        """CASE WHEN o_orderkey % 29 = 0 THEN 'no json' ELSE '{' || CASE WHEN o_orderkey % 11 = 0 THEN '"assignee": null, ' ELSE '"assignee": {"accountId": "' || CAST(o_custkey AS STRING) || '", "displayName": "Blob ' || CAST(o_custkey AS STRING) || '", "emailAddress": "b' || CAST(o_custkey AS STRING) || '@j.com"}, ' END || '"reporter": {"accountId": "' || CAST((o_custkey * 3 + 1) % 400 AS STRING) || '", "displayName": "Rep"}, "summary": "Order ' || CAST(o_orderkey AS STRING) || '", ' || CASE WHEN o_orderkey % 3 = 0 THEN '"description": "About it", ' ELSE '"description": null, ' END || '"status": {"name": "' || o_orderstatus || '"}, "issuetype": {"name": "Task"}, ' || CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE '"project": {"key": "P' || substr(o_orderpriority, 1, 1) || '", "name": "Project ' || substr(o_orderpriority, 1, 1) || '"}, ' END || '"created": "2024-01-01T00:00:00.000+0000", "updated": "2024-02-01", ' || CASE WHEN o_orderkey % 2 = 0 THEN '"resolution": {"name": "Done"}, ' ELSE '"resolution": null, ' END || '"priority": {"name": "' || o_orderpriority || '"}, "labels": ' || CASE o_orderkey % 3 WHEN 0 THEN '["a", "b"]' WHEN 1 THEN '[]' ELSE '"text"' END || '}' END AS FIELDS""",
    ], None),
    "commit_files": ("events", [
        "event_id AS ORD", "'org' AS ORG", "'repo_' || CAST(event_id % 12 AS STRING) AS REPO", "md5('c' || CAST(event_id - event_id % 24 + event_id % 12 AS STRING)) AS COMMIT_SHA", "'login' || CAST(user_id % 40 AS STRING) AS USER_LOGIN",
        "CASE WHEN event_id % 31 = 0 THEN NULL ELSE ts END AS COMMITTED_AT", "CASE event_id % 8 WHEN 3 THEN 'removed' WHEN 5 THEN 'added' ELSE 'modified' END AS STATUS",
        "CASE event_id % 9 WHEN 4 THEN NULL WHEN 7 THEN '' ELSE '+ line ' || CAST(event_id AS STRING) END AS PATCH",
    ], None),
    "tree_entries": ("part", [
        "'repo_' || CAST(p_partkey % 25 AS STRING) AS REPO", "CASE WHEN p_partkey % 9 = 0 THEN 'tree' ELSE 'blob' END AS TYPE", "CAST(p_size AS BIGINT) AS SIZE",
        "CASE p_partkey % 4 WHEN 0 THEN 'src/main/' || CAST(p_partkey AS STRING) || '.tar.gz' WHEN 1 THEN 'README' || CAST(p_partkey AS STRING) WHEN 2 THEN 'conf/.hidden' || CAST(p_partkey AS STRING) ELSE 'a/b/c' || CAST(p_partkey AS STRING) || '.py' END AS PATH",
    ], None),
    "accounts": ("customer", ["CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE 'acc' || CAST(c_custkey AS STRING) END AS ACCOUNT_ID", "c_name AS DISPLAY_NAME", "CASE c_custkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS ACTIVE"], None),
    "jira_users": ("customer", [
        "CAST(c_custkey AS STRING) AS ID", "c_custkey AS ORD", f"CASE c_custkey % 5 WHEN 0 THEN NULL ELSE {person('c_custkey', 'c_custkey * 7')} END AS DISPLAY_NAME",
        "CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN ' U' || CAST(c_custkey AS STRING) || '@X.com ' ELSE 'u' || CAST(c_custkey AS STRING) || '@y.com' END AS EMAIL",
    ], None),
    "github_users": ("supplier", [
        "CAST(s_suppkey AS STRING) AS ID", "s_suppkey AS ORD",
        f"CASE s_suppkey % 4 WHEN 0 THEN lower({person('s_suppkey', 's_suppkey * 7')}) WHEN 1 THEN {part(LAST, 's_suppkey * 7')} || '_' || {part(FIRST, 's_suppkey')} WHEN 2 THEN {part(FIRST, 's_suppkey')} ELSE {person('s_suppkey', 's_suppkey * 5')} || ' PhD' END AS DISPLAY_NAME",
        "'u' || CAST(s_suppkey AS STRING) || '@x.com' AS EMAIL", "'plogin' || CAST(s_suppkey AS STRING) AS LOGIN",
        "CASE WHEN s_suppkey % 8 = 1 THEN split('9' || CAST(s_suppkey AS STRING), ',') END AS ALIAS_ID",
        "CASE WHEN s_suppkey % 6 = 1 THEN split('Old Name ' || CAST(s_suppkey AS STRING), ',') END AS ALIAS_DISPLAY_NAME",
        "CASE WHEN s_suppkey % 3 = 1 THEN split('u' || CAST(s_suppkey * 4 + 2 AS STRING) || '@y.com,Old' || CAST(s_suppkey AS STRING) || '@Z.com', ',') END AS ALIAS_EMAIL",
        "CASE WHEN s_suppkey % 6 = 1 THEN split('old' || CAST(s_suppkey AS STRING), ',') END AS ALIAS_LOGIN",
    ], None),
    "pr_logins": ("supplier", [
        "CAST(s_suppkey AS STRING) AS ID",
        f"lower({part(FIRST, 's_suppkey')}) || CASE s_suppkey % 3 WHEN 0 THEN lower({part(LAST, 's_suppkey * 7')}) WHEN 1 THEN '.' || lower({part(LAST, 's_suppkey * 5')}) ELSE CAST(s_suppkey AS STRING) END AS LOGIN",
        f"{part(FIRST, 's_suppkey')} || substr({part(LAST, 's_suppkey * 7')}, 1, CAST(2 + s_suppkey % 4 AS INT)) AS CAMEL",
    ], None),
    "skills": ("part", ["p_partkey AS UUID", "p_name || ', ' || p_brand || ', ,C++/CLI , ' || p_type AS SKILLS"], None),
    "rollup": ("lineitem", ["CAST(l_orderkey AS STRING) AS COMMIT_SHA", "'repo_' || l_returnflag AS REPO", "'f' || CAST(l_partkey % 50 AS STRING) AS FILE_PATH", "CAST(l_quantity AS BIGINT) AS ADDED", "CAST(l_linenumber AS BIGINT) AS REMOVED", "l_shipdate AS TS"], None),
    "kb": ("embeddings", ["vec_id AS ID", "embedding AS EMBEDDING", "label AS LABEL", "'table_' || CAST(label AS STRING) AS TABLE_NAME"], None),
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, or an adapter over one."""
    if name not in ADAPTERS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    table, columns, where = ADAPTERS[name]
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return (df.where(where) if where else df).selectExpr(*columns)


def with_sql(sql: str, *names: str) -> str:
    """``sql`` with the adapters before it as common table expressions."""
    parts = []
    for n in names:
        table, columns, where = ADAPTERS[n]
        parts.append(f"{n} AS (SELECT {', '.join(columns)} FROM {table}{f' WHERE {where}' if where else ''})")
    body = sql.strip()
    return f"WITH {', '.join(parts)}{', ' + body[5:] if body.startswith('WITH ') else ' ' + body}"
