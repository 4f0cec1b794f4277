"""What a language model would say of code and profiles, by rules; any callable of the same form can take a rule's place."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators.running import running
from ..operators.upserts import first_by
from ..sources.adapters import load, with_sql
from .links import _PKEY, _PTEXT, budget_blocks, pending_links

#: Languages by extension.
LANGUAGES = {".py": "Python", ".java": "Java", ".js": "JavaScript", ".ts": "TypeScript", ".go": "Go", ".rs": "Rust", ".rb": "Ruby", ".sql": "SQL", ".cpp": "C++", ".sh": "Shell", ".gz": "Archive"}
#: The roles that a profile can have, and words that speak for them.
FRONT, BACK, FULL = "Front End Developer", "Back End Developer", "Full Stack Developer"
ROLES = {
    FRONT: ["react", "css", "component", "angular", "vue"], BACK: ["api", "server", "database", "django", "query"], "AI Engineer": ["torch", "tensorflow", "neural", "inference", "model"],
    "DevOps Engineer": ["docker", "kubernetes", "kubectl", "terraform", "jenkins"], "Data Scientist": ["pandas", "numpy", "statistics", "dataset", "notebook"], "Technical Architect": ["architecture", "microservices", "integration", "blueprint", "scalability"],
}
DEFAULT_ROLE, DEFAULT_LEVEL = "Inconclusive", "Mid-level"
LEVELS = ["Junior", DEFAULT_LEVEL, "Senior"]
#: Frameworks and tools by the word that an import, or a use, names.
FRAMEWORKS = {"Django": "django", "FastAPI": "fastapi", "NumPy": "numpy", "PyTorch": "torch", "React": "react", "TensorFlow": "tensorflow", "pandas": "pandas"}
TOOLS = {"Docker": "docker", "Kubernetes": "kubectl", "Terraform": "terraform"}
#: Labels of repositories by the role of their code.
LABELS = {FRONT: "frontend", BACK: "backend", FULL: "fullstack", "AI Engineer": "ai", "DevOps Engineer": "infrastructure", "Data Scientist": "data", "Technical Architect": "architecture"}
#: Characters of code that a model is asked about.
CODE_CHARS = 40_000


def _word(w: str) -> str:
    return rf"(?<![a-z0-9_]){w}(?![a-z0-9_])"


def _lowered(c: Column, of: Callable[[Column], Column]) -> Column:
    """``of`` the text in lower case, which is made once for a row, whatever ``of`` asks of it."""
    return F.transform(F.array(F.lower(F.coalesce(c, F.lit("")))), of)[0]


def role_counts(c: Column) -> Column:
    """struct of how often the words of each role, by name, occur in the whole text. Patterns are tried only where their word is somewhere in the text, which is told much sooner."""
    many = lambda t, w: F.when(F.contains(t, F.lit(w)), F.regexp_count(t, F.lit(_word(w)))).otherwise(0)
    return _lowered(c, lambda t: F.struct(*[reduce(lambda a, b: a + b, [many(t, w) for w in ROLES[r]]).cast("bigint").alias(r) for r in sorted(ROLES)]))


def role_by(counts: Column) -> Column:
    """The role of most words, of equals the first by name; full stack if front and back end have three words each or more, and neither has twice the other's; 'Inconclusive' without any."""
    best = F.array_min(F.array(*[F.struct((-counts[r]).alias("n"), F.lit(r).alias("role")) for r in sorted(ROLES)]))
    front, back = counts[FRONT], counts[BACK]
    full = (F.least(front, back) >= 3) & (2 * F.least(front, back) >= F.greatest(front, back)) & best["role"].isin(FRONT, BACK)
    return F.when(full, FULL).when(best["n"] < 0, best["role"]).otherwise(DEFAULT_ROLE)


def role_of(c: Column) -> Column:
    return role_by(role_counts(c))


def level_of(lines: Column) -> Column:
    return F.when(lines.isNull(), DEFAULT_LEVEL).when(lines < 100, "Junior").when(lines <= 500, DEFAULT_LEVEL).otherwise("Senior")


def language_of(path: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in LANGUAGES.items() for x in kv])[text.path_parts(path)[2]]


def frameworks_of(c: Column) -> Column:
    """Frameworks that are imported and tools that are named, in order. Patterns are tried only where their word is somewhere in the text, as in ``role_counts``."""
    words = FRAMEWORKS | TOOLS
    pattern = {n: rf"(?:^|[^a-z0-9_])(?:import|from|require)[ (\"']+{w}(?:[^a-z0-9_]|$)" for n, w in FRAMEWORKS.items()} | {n: _word(w) for n, w in TOOLS.items()}
    return _lowered(c, lambda t: F.filter(F.array(*[F.when(F.contains(t, F.lit(words[n])), F.when(t.rlike(pattern[n]), n)) for n in sorted(words)]), lambda x: x.isNotNull()))


def commit_summaries(diffs: DataFrame) -> DataFrame:
    """(COMMIT_SHA, summary, key_changes, langs, frameworks) of each commit: the message's first sentence, the files and their lines, and what they are written in."""
    lines = (F.length("DIFF") - F.length(F.replace("DIFF", F.lit("\n"), F.lit(""))) + 1).cast("int")
    rows = diffs.select("COMMIT_SHA", "ORD", "COMMIT_MESSAGE", "FILE_PATH", lines.alias("lines"), language_of(F.col("FILE_PATH")).alias("lang"), frameworks_of(F.col("DIFF")).alias("fw"))
    files = rows.groupBy("COMMIT_SHA", "FILE_PATH").agg(F.sum("lines").alias("lines"))
    changes = files.groupBy("COMMIT_SHA").agg(F.sort_array(F.collect_list(F.concat("FILE_PATH", F.lit(": "), "lines", F.lit(" lines")))).alias("key_changes"))
    made = rows.groupBy("COMMIT_SHA").agg(
        F.min_by("COMMIT_MESSAGE", "ORD").alias("message"), F.sort_array(F.collect_set("lang")).alias("langs"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("fw")))).alias("frameworks"),
    )
    return made.join(changes, "COMMIT_SHA").select("COMMIT_SHA", F.regexp_extract("message", r"^[^.\n]*\.?", 0).alias("summary"), "key_changes", "langs", "frameworks")


def kept_commits(diffs: DataFrame, limit: int = 150_000) -> DataFrame:
    """Commits of each committer, newest first (NTH), within ``limit`` characters of diffs: always the first, and none from the one on that crosses it. TOTAL: all commits there are."""
    commits = diffs.groupBy("COMMITTER_ID", "COMMIT_SHA").agg(
        F.max("ORD").alias("at"), F.min_by("COMMIT_MESSAGE", "ORD").alias("message"), F.sort_array(F.collect_set("REPO")).alias("repos"), F.sort_array(F.collect_set("FILE_PATH")).alias("paths"),
        F.sum("ADDED").alias("added"), F.sum("REMOVED").alias("removed"), (F.sum("N") + F.count(F.lit(1)) - 1).alias("size"),
    )
    places = running(commits.select(F.col("COMMITTER_ID").alias("of"), F.col("COMMIT_SHA").alias("sha"), "at", "size"), ["of"], [F.desc("at"), F.asc("sha")], {"NTH": F.lit(1), "upto": F.col("size")})
    total = places.groupBy(F.col("of").alias("all_of")).agg(F.max("NTH").alias("TOTAL"))
    kept = places.filter((F.col("NTH") == 1) | (F.col("upto") <= limit)).select("of", "sha", "NTH")
    same = F.col("COMMITTER_ID").eqNullSafe(F.col("of")) & F.col("COMMIT_SHA").eqNullSafe(F.col("sha"))
    return commits.join(kept, same).join(total, F.col("COMMITTER_ID").eqNullSafe(F.col("all_of"))).select(*commits.columns, "NTH", "TOTAL")


def inference_input(diffs: DataFrame, comments: DataFrame, matched: DataFrame, issues: DataFrame, limit: int = 150_000) -> DataFrame:
    """(COMMITTER_ID, JIRA_ID, UUID, record) of each committer: what a profile is made from.

    record: last_90d_commits (all commits), pr_review_comments (of ``comments``.AUTHOR), commits (the kept ones with their summaries, newest
    first) and associated_issues by key. A person is the first of those matched to the account."""
    commits = kept_commits(diffs, limit).join(commit_summaries(diffs), "COMMIT_SHA")
    one = F.struct(
        "NTH", "repos", F.col("message").alias("commit_message"), "summary", "key_changes", "langs", "frameworks", F.col("added").alias("loc_added"), F.col("removed").alias("loc_removed"),
        F.size("paths").cast("bigint").alias("file_count"), F.col("paths").alias("file_path"), "COMMIT_SHA",
    )
    per = commits.groupBy("COMMITTER_ID").agg(F.max("TOTAL").alias("last_90d_commits"), F.sort_array(F.collect_list(one)).alias("commits"))
    said = comments.groupBy(F.get_json_object("AUTHOR", "$.id").alias("said_by")).agg(F.count(F.lit(1)).alias("pr_review_comments")).filter("said_by IS NOT NULL")
    person = first_by(matched.filter("GITHUB_ID IS NOT NULL").select("GITHUB_ID", "JIRA_ID", "UUID"), ["GITHUB_ID"], [F.asc("JIRA_ID")])
    info = F.struct(F.col("ISSUE_TYPE").alias("issue_type"), F.col("SUMMARY").alias("summary"), F.col("DESCRIPTION").alias("description"), F.col("PROJECT_KEY").alias("project_key"), F.col("PROJECT_NAME").alias("project_name"))
    theirs = issues.filter("ASSIGNEE_ACCOUNT_ID IS NOT NULL").groupBy(F.col("ASSIGNEE_ACCOUNT_ID").alias("assignee")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("ISSUE_KEY", info)))).alias("associated_issues"))
    whole = per.join(said, F.col("COMMITTER_ID") == F.col("said_by"), "left").join(person, F.col("COMMITTER_ID") == F.col("GITHUB_ID"), "left").join(theirs, F.col("JIRA_ID") == F.col("assignee"), "left")
    record = F.struct("last_90d_commits", F.coalesce("pr_review_comments", F.lit(0).cast("bigint")).alias("pr_review_comments"), "commits", "associated_issues")
    return whole.select("COMMITTER_ID", "JIRA_ID", "UUID", record.alias("record"))


def profiles(diffs: DataFrame, limit: int = 150_000) -> DataFrame:
    """(COMMITTER_ID, analysis, role, experience_level, skills, justification) of each committer, from the kept commits: whole diffs are counted, and levels go by the lines of a commit."""
    kept = kept_commits(diffs, limit)
    parts = diffs.join(kept.select("COMMITTER_ID", "COMMIT_SHA"), ["COMMITTER_ID", "COMMIT_SHA"], "left_semi").select("COMMITTER_ID", role_counts(F.col("DIFF")).alias("c"), language_of(F.col("FILE_PATH")).alias("lang"), frameworks_of(F.col("DIFF")).alias("fw"))
    counted = parts.groupBy("COMMITTER_ID").agg(F.struct(*[F.sum(F.col("c")[r]).alias(r) for r in sorted(ROLES)]).alias("c"), F.collect_set("lang").alias("langs"), F.flatten(F.collect_list("fw")).alias("fws"))
    sizes = kept.groupBy("COMMITTER_ID").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("added") + F.col("removed")).alias("lines"), F.sum(F.size("paths")).alias("files"))
    skills = F.sort_array(F.array_distinct(F.concat("langs", "fws")))
    analysis = F.concat("n", F.lit(" commits, "), "files", F.lit(" files, "), "lines", F.lit(" lines"))
    why = F.concat_ws(", ", *[F.when(F.col("c")[r] > 0, F.concat(F.lit(f"{r}: "), F.col("c")[r].cast("string"))) for r in sorted(ROLES)])
    return counted.join(sizes, "COMMITTER_ID").select("COMMITTER_ID", analysis.alias("analysis"), role_by(F.col("c")).alias("role"), level_of(F.col("lines") / F.col("n")).alias("experience_level"), skills.alias("skills"), why.alias("justification"))


def committer_info(code: DataFrame, chars: int = CODE_CHARS) -> DataFrame:
    """(COMMITTER_ID, role, skills) from the first ``chars`` characters of a committer's CODE, as a model is asked; both null for blank code, and skills if there are none."""
    asked = F.substring("CODE", 1, chars)
    some = F.coalesce(text.blank_to_null(F.col("CODE")).isNotNull(), F.lit(False))
    return code.select("COMMITTER_ID", F.when(some, role_of(asked)).alias("role"), F.when(some, F.nullif(F.array_join(frameworks_of(asked), ", "), F.lit(""))).alias("skills"))


def repo_labels(code: DataFrame, chars: int = CODE_CHARS) -> DataFrame:
    """(REPO, label) from the first ``chars`` characters of a repository's CODE; null for blank code, or none that says anything."""
    some = F.coalesce(text.blank_to_null(F.col("CODE")).isNotNull(), F.lit(False))
    return code.select("REPO", F.when(some, F.create_map(*[F.lit(x) for kv in LABELS.items() for x in kv])[role_of(F.substring("CODE", 1, chars))]).alias("label"))


def link_roles(links: DataFrame) -> DataFrame:
    """(link_hash, assignee, role) of links with an ASSIGNEE, from SUMMARY and DESCRIPTION; null if both are blank."""
    asked = text.join_text(F.col("SUMMARY"), F.col("DESCRIPTION"))
    return links.filter("ASSIGNEE IS NOT NULL").select("link_hash", F.col("ASSIGNEE").alias("assignee"), F.when(asked != "", role_of(asked)).alias("role"))


def validated(rows: DataFrame, column: str, schema: str, needed: dict[str, list[str]]) -> tuple[DataFrame, DataFrame]:
    """(rows whose JSON fits, rejects): ``needed`` fields are there, and of the values given, if any are."""
    parsed = rows.withColumn("parsed", text.lenient_json(F.col(column), schema))
    fits = reduce(lambda a, b: a & b, [F.col(f"parsed.{k}").isNotNull() & (F.col(f"parsed.{k}").isin(v) if v else F.lit(True)) for k, v in needed.items()])
    ok = F.coalesce(fits, F.lit(False))
    return parsed.filter(ok), parsed.filter(~ok).drop("parsed")


PROFILE = "role string, experience_level string, skills array<string>"


def with_stubs(rows: DataFrame, column: str = "OUTPUT") -> DataFrame:
    """All rows with (role, experience_level, skills, valid): what does not fit the profile's fields and values gets a stub of defaults."""
    ok, bad = validated(rows, column, PROFILE, {"role": [*ROLES, FULL, DEFAULT_ROLE], "experience_level": LEVELS})
    none = F.array().cast("array<string>")
    good = ok.select(*rows.columns, "parsed.role", "parsed.experience_level", F.coalesce("parsed.skills", none).alias("skills"), F.lit(True).alias("valid"))
    return good.unionByName(bad.select(*rows.columns, F.lit(DEFAULT_ROLE).alias("role"), F.lit(DEFAULT_LEVEL).alias("experience_level"), none.alias("skills"), F.lit(False).alias("valid")))


_COMMIT = "struct<repos:array<string>,commit_message:string,summary:string,key_changes:array<string>,langs:array<string>,frameworks:array<string>,loc_added:bigint,loc_removed:bigint,file_count:bigint,file_path:array<string>>"
_ISSUE = "struct<issue_type:string,project_key:string,project_name:string,description:string>"
RECORD = f"last_90d_commits bigint, pr_review_comments bigint, associated_issues map<string,{_ISSUE}>, commits array<{_COMMIT}>"


def rendered(record: Column) -> Column:
    """The record as lines that people read; what is empty has no line. Empty without a record."""
    r = F.from_json(record, RECORD)
    line = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    only = lambda condition, *lines: F.when(F.coalesce(condition, F.lit(False)), F.array(*lines)).otherwise(F.array().cast("array<string>"))
    filled = lambda c: c.isNotNull() & (c != "")

    def listed(name: str, items: Column) -> Column:
        return F.when(F.coalesce(F.size(items) > 0, F.lit(False)), F.concat(F.array(F.lit(f"    {name}:")), F.transform(items, lambda x: F.concat(F.lit("      - "), x)))).otherwise(F.array().cast("array<string>"))

    def issue(e: Column) -> Column:
        i = e["value"]
        head = line("  • ", e["key"], " [", F.coalesce(i["issue_type"], F.lit("Unknown")), "] (Project: ", i["project_key"], " - ", i["project_name"], ")")
        return F.concat(F.array(head), only(filled(i["description"]), line("      Description: ", i["description"])))

    def commit(c: Column, n: Column) -> Column:
        joined = lambda name, items: only(F.size(items) > 0, line(f"    {name}: ", F.array_join(items, ", ")))
        return F.concat(
            F.array(line("  Commit ", n + 1, ":")), joined("Repos", c["repos"]), only(filled(c["commit_message"]), line("    Message: ", c["commit_message"])), only(filled(c["summary"]), line("    Summary: ", c["summary"])),
            listed("Key Changes", c["key_changes"]), joined("Languages", c["langs"]), joined("Frameworks", c["frameworks"]), F.array(line("    LOC Added: ", F.coalesce(c["loc_added"], F.lit(0))), line("    LOC Removed: ", F.coalesce(c["loc_removed"], F.lit(0))), line("    File Count: ", F.coalesce(c["file_count"], F.lit(0)))),
            listed("File Paths", c["file_path"]), F.array(F.lit("")),
        )

    issues, commits = F.map_entries(r["associated_issues"]), r["commits"]
    some = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    none = F.array().cast("array<string>")
    lines = F.concat(
        F.array(line("Last 90-day Commits: ", F.coalesce(r["last_90d_commits"], F.lit(0))), line("PR Review Comments: ", F.coalesce(r["pr_review_comments"], F.lit(0))), F.lit("")),
        F.when(some(issues), F.concat(F.array(F.lit("Associated Issues:")), F.flatten(F.transform(issues, issue)), F.array(F.lit("")))).otherwise(none),
        F.when(some(commits), F.concat(F.array(F.lit("Commits:")), F.flatten(F.transform(commits, commit)))).otherwise(none),
    )
    whole = F.regexp_replace(F.array_join(lines, "\n"), r"\s+$", "")
    return F.when(text.blank_to_null(record).isNull(), "").otherwise(whole)


def inference_sheet(people: DataFrame, summaries: DataFrame) -> DataFrame:
    """``people`` in order of UUID with INFERENCE_INPUT: the rendered record of the same UUID, or nothing."""
    shown = summaries.select(F.col("UUID").alias("of_uuid"), rendered(F.col("SUMMARIES")).alias("shown"))
    return people.join(shown, F.col("UUID") == F.col("of_uuid"), "left").select(*people.columns, F.coalesce("shown", F.lit("")).alias("INFERENCE_INPUT")).orderBy("UUID")


def _texts(df: DataFrame) -> DataFrame:
    return df.select(*[F.array_join(c, "|").alias(c) if df.schema[c].dataType.typeName() == "array" else F.col(c) for c in df.columns])


def _developer_input(s, d) -> DataFrame:
    made = inference_input(load(s, d, "diffs"), load(s, d, "raw"), load(s, d, "matched"), load(s, d, "issues"), 60_000)
    commits = F.col("record.commits")
    return made.select(
        "COMMITTER_ID", "JIRA_ID", "UUID", "record.last_90d_commits", "record.pr_review_comments", F.array_join(F.transform(commits, lambda c: c["COMMIT_SHA"]), ",").alias("shas"),
        F.aggregate(commits, F.lit(0).cast("bigint"), lambda a, c: a + c["loc_added"] - c["loc_removed"]).alias("net_lines"), F.array_join(F.transform(commits, lambda c: F.array_join(F.concat(c["repos"], c["langs"], c["file_path"]), ",")), ";").alias("listed"),
        F.array_join(F.transform(F.map_entries("record.associated_issues"), lambda e: F.concat_ws("/", e["key"], e["value"]["summary"], e["value"]["description"], e["value"]["project_key"])), ",").alias("issues"),
    )


def _code(s, d) -> DataFrame:
    return budget_blocks(load(s, d, "diffs"), 100_000).select("COMMITTER_ID", F.col("AGGREGATED_DIFFS").alias("CODE"))


def _repo_code(s, d) -> DataFrame:
    """Of each repository the code of its first file; of one in six, blanks."""
    first = first_by(load(s, d, "diffs").filter("DIFF IS NOT NULL"), ["REPO"], [F.asc("ORD")])
    return first.select("REPO", F.expr("CASE WHEN REPO IN ('repo_5', 'repo_11') THEN ' ' ELSE DIFF END").alias("CODE"))


def _links(s, d) -> DataFrame:
    return pending_links(load(s, d, "prs"), load(s, d, "issues")).select("link_hash", F.col("ASSIGNEE_ACCOUNT_ID").alias("ASSIGNEE"), "SUMMARY", "DESCRIPTION").distinct()


def _title(titles: str = "CASE ORD % 4 WHEN 0 THEN 'query the api server' WHEN 1 THEN 'Docker' WHEN 2 THEN 'react css vue: api server database' END") -> str:
    return titles


QUERIES = {
    "commit_summaries": lambda s, d: _texts(commit_summaries(load(s, d, "diffs"))),
    "developer_profiles": lambda s, d: _texts(profiles(load(s, d, "diffs"), 60_000)),
    "developer_input": _developer_input,
    "committer_info": lambda s, d: committer_info(_code(s, d)),
    "repo_labels": lambda s, d: repo_labels(_repo_code(s, d)),
    "link_roles": lambda s, d: link_roles(_links(s, d)),
    "experience_level": lambda s, d: load(s, d, "rollup").groupBy("COMMIT_SHA").agg(F.sum("ADDED").alias("n")).select("COMMIT_SHA", level_of(F.col("n")).alias("level")),
    "title_roles": lambda s, d: load(s, d, "prs").select("ORD", role_of(F.concat_ws(" ", F.col("TITLE"), F.expr(_title()))).alias("role")),
    "validated_outputs": lambda s, d: with_stubs(load(s, d, "agent_outputs")).select("ID", "role", "experience_level", F.array_join("skills", ",").alias("skills"), "valid"),
    "inference_sheet": lambda s, d: inference_sheet(load(s, d, "events").select(F.expr("'u' || CAST(event_id * 2 AS STRING)").alias("UUID"), "event_type"), load(s, d, "summaries")),
}


def _count_sql(t: str, role: str) -> str:
    return "(" + " + ".join(rf"len(regexp_extract_all({t}, '\b{w}\b'))" for w in ROLES[role]) + ")"


def _pick_sql(count: dict[str, str]) -> str:
    """SQL of the role from the SQL of each role's count."""
    most = f"greatest({', '.join(count[r] for r in sorted(ROLES))})"
    first = "CASE " + " ".join(f"WHEN {count[r]} = {most} THEN '{r}'" for r in sorted(ROLES)) + " END"
    low, high = f"least({count[FRONT]}, {count[BACK]})", f"greatest({count[FRONT]}, {count[BACK]})"
    return f"CASE WHEN {most} = 0 THEN '{DEFAULT_ROLE}' WHEN {low} >= 3 AND 2 * {low} >= {high} AND {first} IN ('{FRONT}', '{BACK}') THEN '{FULL}' ELSE {first} END"


_COUNTS = ", ".join(f"{_count_sql('t', r)} AS c{i}" for i, r in enumerate(sorted(ROLES)))
_PICK = _pick_sql({r: f"c{i}" for i, r in enumerate(sorted(ROLES))})
_LANG = f"CASE {' '.join(f'WHEN e = {chr(39)}{k}{chr(39)} THEN {chr(39)}{v}{chr(39)}' for k, v in LANGUAGES.items())} END"
_EXT = "CASE WHEN FILE_PATH LIKE '%/.%' THEN '' ELSE regexp_extract(FILE_PATH, '[^/.][^/]*(\\.[^./]*)$', 1) END"
_FW_SQL = "list_filter([" + ", ".join(
    [f"CASE WHEN regexp_matches(t, '(?:^|[^a-z0-9_])(?:import|from|require)[ (\"'']+{FRAMEWORKS[n]}(?:[^a-z0-9_]|$)') THEN '{n}' END" if n in FRAMEWORKS else rf"CASE WHEN regexp_matches(t, '\b{TOOLS[n]}\b') THEN '{n}' END" for n in sorted(FRAMEWORKS | TOOLS)]
) + "], lambda q: q IS NOT NULL)"
_PARTS = f"p AS (SELECT *, lower(coalesce(DIFF, '')) AS t, {_EXT} AS e FROM diffs), q AS (SELECT *, {_LANG} AS lang, {_FW_SQL} AS fw, len(regexp_extract_all(DIFF, '\\n')) + 1 AS lines FROM p)"
_KEPT = """c AS (SELECT COMMITTER_ID, COMMIT_SHA, max(ORD) AS at_ord, list_sort(list_distinct(list(REPO))) AS repos, list_sort(list_distinct(list(FILE_PATH))) AS paths, sum(ADDED)::BIGINT AS added, sum(REMOVED)::BIGINT AS removed, sum(N) + count(*) - 1 AS size FROM diffs GROUP BY ALL),
r AS (SELECT *, row_number() OVER w AS nth, sum(size) OVER w AS upto, count(*) OVER (PARTITION BY COMMITTER_ID) AS total FROM c WINDOW w AS (PARTITION BY COMMITTER_ID ORDER BY at_ord DESC, COMMIT_SHA ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
k AS (SELECT * FROM r WHERE nth = 1 OR upto <= 60000)"""
ORACLES = {
    "commit_summaries": with_sql(f"""WITH {_PARTS}, f AS (SELECT COMMIT_SHA, FILE_PATH, sum(lines) AS n FROM q GROUP BY ALL), x AS (SELECT COMMIT_SHA, string_agg(FILE_PATH || ': ' || n || ' lines', '|' ORDER BY FILE_PATH || ': ' || n || ' lines') AS key_changes FROM f GROUP BY 1)
SELECT q.COMMIT_SHA, regexp_extract(arg_min(COMMIT_MESSAGE, ORD), '^[^.]*\\.?') AS summary, any_value(key_changes) AS key_changes, coalesce(string_agg(DISTINCT lang, '|' ORDER BY lang), '') AS langs, array_to_string(list_sort(list_distinct(flatten(list(fw)))), '|') AS frameworks
FROM q JOIN x ON x.COMMIT_SHA = q.COMMIT_SHA GROUP BY q.COMMIT_SHA""", "diffs"),
    "developer_profiles": with_sql(f"""WITH {_KEPT}, {_PARTS}, n AS (SELECT q.*, {_COUNTS} FROM q JOIN k ON k.COMMITTER_ID = q.COMMITTER_ID AND k.COMMIT_SHA = q.COMMIT_SHA),
g AS (SELECT COMMITTER_ID, {", ".join(f"sum(c{i})::BIGINT AS c{i}" for i in range(len(ROLES)))}, array_to_string(list_sort(list_distinct(list_filter(list_concat(list(lang), flatten(list(fw))), lambda z: z IS NOT NULL))), '|') AS skills FROM n GROUP BY 1),
s AS (SELECT COMMITTER_ID, count(*) AS n, sum(added + removed)::BIGINT AS lines, sum(len(paths))::BIGINT AS files FROM k GROUP BY 1)
SELECT g.COMMITTER_ID, n || ' commits, ' || files || ' files, ' || lines || ' lines' AS analysis, {_PICK} AS role, CASE WHEN lines / n < 100 THEN 'Junior' WHEN lines / n <= 500 THEN 'Mid-level' ELSE 'Senior' END AS experience_level, skills,
concat_ws(', ', {", ".join(f"CASE WHEN c{i} > 0 THEN '{r}: ' || c{i} END" for i, r in enumerate(sorted(ROLES)))}) AS justification FROM g JOIN s ON s.COMMITTER_ID = g.COMMITTER_ID""", "diffs"),
    "developer_input": with_sql(f"""WITH {_KEPT}, {_PARTS}, l AS (SELECT COMMIT_SHA, list_sort(list_distinct(list_filter(list(lang), lambda z: z IS NOT NULL))) AS langs FROM q GROUP BY 1),
a AS (SELECT k.COMMITTER_ID, max(total) AS last_90d_commits, string_agg(k.COMMIT_SHA, ',' ORDER BY nth) AS shas, sum(added - removed)::BIGINT AS net_lines, string_agg(array_to_string(list_concat(repos, langs, paths), ','), ';' ORDER BY nth) AS listed FROM k JOIN l ON l.COMMIT_SHA = k.COMMIT_SHA GROUP BY 1),
s AS (SELECT json_extract_string(AUTHOR, '$.id') AS who, count(*) AS n FROM raw WHERE AUTHOR IS NOT NULL GROUP BY 1), m AS (SELECT GITHUB_ID, min(JIRA_ID) AS JIRA_ID, arg_min(UUID, JIRA_ID) AS UUID FROM matched WHERE GITHUB_ID IS NOT NULL GROUP BY 1),
i AS (SELECT ASSIGNEE_ACCOUNT_ID AS who, string_agg(concat_ws('/', ISSUE_KEY, SUMMARY, DESCRIPTION, PROJECT_KEY), ',' ORDER BY ISSUE_KEY) AS issues FROM issues WHERE ASSIGNEE_ACCOUNT_ID IS NOT NULL GROUP BY 1)
SELECT a.COMMITTER_ID, JIRA_ID, UUID, last_90d_commits, coalesce(s.n, 0) AS pr_review_comments, shas, net_lines, listed, issues FROM a LEFT JOIN s ON s.who = a.COMMITTER_ID LEFT JOIN m ON m.GITHUB_ID = a.COMMITTER_ID LEFT JOIN i ON i.who = m.JIRA_ID""", "diffs", "raw", "matched", "issues"),
    "experience_level": with_sql("SELECT COMMIT_SHA, CASE WHEN sum(ADDED) < 100 THEN 'Junior' WHEN sum(ADDED) <= 500 THEN 'Mid-level' ELSE 'Senior' END AS level FROM rollup GROUP BY 1", "rollup"),
    "title_roles": with_sql(f"WITH p AS (SELECT ORD, lower(concat_ws(' ', TITLE, {_title()})) AS t FROM prs), n AS (SELECT ORD, {_COUNTS} FROM p) SELECT ORD, {_PICK} AS role FROM n", "prs"),
    "repo_labels": with_sql(f"""WITH f AS (SELECT REPO, CASE WHEN REPO IN ('repo_5', 'repo_11') THEN ' ' ELSE DIFF END AS CODE FROM diffs WHERE DIFF IS NOT NULL QUALIFY row_number() OVER (PARTITION BY REPO ORDER BY ORD) = 1), p AS (SELECT *, lower(substr(CODE, 1, 40000)) AS t FROM f), n AS (SELECT REPO, CODE, {_COUNTS} FROM p)
SELECT REPO, CASE WHEN trim(CODE) <> '' THEN CASE {_PICK} {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in LABELS.items())} END END AS label FROM n""", "diffs"),
    "committer_info": with_sql(f"""WITH b AS (SELECT *, '--- START OF COMMIT: ' || COMMIT_SHA || ' ---' || chr(10) || '--- TIMESTAMP: ' || ORD || ' ---' || chr(10) || '--- REPO: ' || REPO || ' ---' || chr(10) || '--- FILE_PATH: ' || FILE_PATH || ' ---' || chr(10) || chr(10) || DIFF || chr(10) || chr(10) || '--- END OF COMMIT: ' || COMMIT_SHA || ' ---' || chr(10) AS block
  FROM diffs WHERE COMMITTER_ID IS NOT NULL AND DIFF IS NOT NULL AND DIFF <> ''), o AS (SELECT *, sum(length(block)) OVER (PARTITION BY COMMITTER_ID ORDER BY ORD DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM b),
a AS (SELECT COMMITTER_ID, string_agg(block, chr(10) || chr(10) || '### NEXT CODE CHANGE ###' || chr(10) || chr(10) ORDER BY ORD DESC) AS txt FROM o WHERE coalesce(before, 0) <= 100000 GROUP BY 1), p AS (SELECT COMMITTER_ID, lower(substr(txt, 1, 40000)) AS t FROM a), n AS (SELECT COMMITTER_ID, {_FW_SQL} AS fw, {_COUNTS} FROM p)
SELECT COMMITTER_ID, {_PICK} AS role, nullif(array_to_string(fw, ', '), '') AS skills FROM n""", "diffs"),
    "link_roles": with_sql(f"""WITH pt AS (SELECT *, {_PTEXT} AS PTEXT FROM prs), pk AS (SELECT *, {_PKEY} AS k FROM pt), l AS (SELECT ORD, md5(INTERNAL_ID || '|' || USER_LOGIN || '|' || ROLE_IN_PR || '|' || ISSUE_KEY) AS link_hash, ASSIGNEE_ACCOUNT_ID AS assignee, trim(concat_ws(chr(10) || chr(10), nullif(trim(SUMMARY), ''), nullif(trim(DESCRIPTION), ''))) AS asked FROM pk JOIN issues ON k = ISSUE_KEY),
d AS (SELECT DISTINCT link_hash, assignee, asked FROM l WHERE assignee IS NOT NULL AND link_hash NOT IN (SELECT link_hash FROM l WHERE ORD % 4 = 0)), p AS (SELECT *, lower(asked) AS t FROM d), n AS (SELECT *, {_COUNTS} FROM p)
SELECT link_hash, assignee, CASE WHEN asked <> '' THEN {_PICK} END AS role FROM n""", "prs", "issues"),
    "validated_outputs": with_sql("SELECT ID, CASE ID % 6 WHEN 0 THEN 'DevOps Engineer' WHEN 5 THEN 'Data Scientist' ELSE 'Inconclusive' END AS role, CASE ID % 6 WHEN 0 THEN 'Senior' WHEN 5 THEN 'Junior' ELSE 'Mid-level' END AS experience_level, CASE ID % 6 WHEN 0 THEN 'AWS' ELSE '' END AS skills, ID % 6 IN (0, 5) AS valid FROM agent_outputs", "agent_outputs"),
    "inference_sheet": """SELECT 'u' || (event_id * 2) AS UUID, event_type, CASE WHEN event_id * 2 > (SELECT max(event_id) FROM events) THEN '' ELSE regexp_replace(
'Last 90-day Commits: ' || (event_id * 2 % 50) || chr(10) || 'PR Review Comments: ' || (event_id * 2 % 7) || chr(10) || chr(10)
|| CASE WHEN event_id * 2 % 3 = 0 THEN '' ELSE 'Associated Issues:' || chr(10) || '  • ORD-' || (event_id * 2) || ' [Bug] (Project: P' || (event_id * 2 % 4) || ' - Proj)' || chr(10) || '      Description: About ' || (event_id * 2) || chr(10) || chr(10) END
|| CASE WHEN event_id * 2 % 5 = 0 THEN '' ELSE 'Commits:' || chr(10) || '  Commit 1:' || chr(10) || '    Repos: a, b' || chr(10) || '    Message: m' || (event_id * 2) || chr(10) || CASE WHEN event_id * 2 % 4 = 0 THEN '' ELSE '    Summary: did it' || chr(10) END
  || '    Key Changes:' || chr(10) || '      - x' || chr(10) || '      - y' || chr(10) || '    Languages: Python' || chr(10) || '    LOC Added: 3' || chr(10) || '    LOC Removed: ' || (event_id * 2 % 9) || chr(10) || '    File Count: 1' || chr(10) || '    File Paths:' || chr(10) || '      - p/' || (event_id * 2) || '.py' || chr(10) || chr(10)
  || CASE WHEN event_id * 2 % 7 = 0 THEN '  Commit 2:' || chr(10) || '    Frameworks: React' || chr(10) || '    LOC Added: 1' || chr(10) || '    LOC Removed: 0' || chr(10) || '    File Count: 0' || chr(10) ELSE '' END END, '\\s+$', '') END AS INFERENCE_INPUT FROM events ORDER BY 1""",
}
