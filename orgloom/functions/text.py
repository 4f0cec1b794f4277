"""Scalar rules for names, keys, paths and times, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITE = " \t\n\r\x0b\x0c"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def first_filled(*cs: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cs])


def email(c: Column) -> Column:
    return F.lower(strip(c))


def squash(c: Column) -> Column:
    """Lower-cased letters and digits only."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]", "")


def clean(c: Column) -> Column:
    """Lower case, anything else than letters and digits a single space."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", " "))


def without_digits_at_end(c: Column) -> Column:
    return F.regexp_replace(c, r"\d+$", "")


def name(c: Column) -> Column:
    """Camel case split, letters only, single spaces, lower case."""
    split = F.regexp_replace(F.coalesce(c, F.lit("")), "([a-z])([A-Z])", "$1 $2")
    return F.lower(F.trim(F.regexp_replace(split, "[^A-Za-z]+", " ")))


def tokens(c: Column) -> Column:
    """Distinct tokens: the squashed whole, and the parts between camel humps, dots, spaces, _ and -, of what is longer than one character before it is squashed."""
    text = F.coalesce(c, F.lit(""))
    parts = F.split(F.lower(F.regexp_replace(text, "([a-z])([A-Z])", "$1 $2")), r"[.\s_\-]+")
    more = lambda t: F.length(t) > 1
    return F.array_distinct(F.concat(F.filter(F.array(squash(text)), more), F.transform(F.filter(parts, more), squash)))


def block_keys(c: Column) -> tuple[Column, Column]:
    """First three letters of the first and of the last alphabetic token; '' without one."""
    words = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit("[a-z]+"), F.lit(0))
    part = lambda i: F.coalesce(F.substring(F.try_element_at(words, F.lit(i)), 1, 3), F.lit(""))
    return part(1), part(-1)


def jaccard(a: Column, b: Column) -> Column:
    """Of two token arrays; 0 if either is empty."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))).otherwise(0.0)


def contains_any_case(c: Column, part: str) -> Column:
    """Whether ``part`` occurs, whatever its case; % and _ in it stand for themselves."""
    return c.ilike("%" + "".join("\\" + x if x in "\\%_" else x for x in part) + "%")


def issue_key(c: Column) -> Column:
    """The first KEY-123 (or KEY_123, or 'story/key 123') of a text, written KEY-123; null without one."""
    exact, loose = r"\b([A-Z]{2,5})[-_](\d+)\b", r"(?i)story/([a-z]{2,5})[ _-](\d+)"
    pick = lambda p: F.when(c.rlike(p), F.concat(F.upper(F.regexp_extract(c, p, 1)), F.lit("-"), F.regexp_extract(c, p, 2)))
    return F.coalesce(pick(exact), pick(loose))


def join_text(title: Column, body: Column) -> Column:
    return strip(F.concat_ws("\n\n", blank_to_null(title), blank_to_null(body)))


def skill_key(c: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), F.lit("_"))


def list_of(c: Column) -> Column:
    """Parts of a comma-separated list, trimmed, blanks left out."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), strip), lambda x: x != "")


def path_parts(c: Column) -> tuple[Column, Column, Column]:
    """(folder, file name, extension): a leading dot begins no extension."""
    file = F.substring_index(c, "/", -1)
    folder = F.when(F.locate("/", c) > 0, F.substring(c, 1, F.length(c) - F.length(file) - 1)).otherwise("")
    return folder, file, F.regexp_extract(file, r"[^.].*(\.[^.]*)$", 1)


def repo_path(org: Column, repo: Column) -> Column:
    """org/repo; null if either is."""
    return F.concat(org, F.lit("/"), repo)


def safe_key(c: Column) -> Column:
    return F.replace(c, F.lit("/"), F.lit("__"))


def iso(c: Column) -> Column:
    """ISO 8601, with microseconds only if there are any."""
    micros = F.date_format(c, "SSSSSS")
    return F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros)))


def parse_iso(c: Column) -> Column:
    """The instant of a text with an offset, in UTC without zone; null if it can't be read."""
    return F.to_utc_timestamp(F.try_to_timestamp(c), F.current_timezone()).cast("timestamp_ntz")


def person_uuid(jira: Column, github: Column) -> Column:
    return F.substring(F.sha1(F.concat(F.coalesce(jira, F.lit("")), F.lit("|"), F.coalesce(github, F.lit("")))), 1, 20)


def link_hash(*cs: Column) -> Column:
    """md5 of the parts between pipes; null if one is."""
    return F.md5(F.concat(*[x for i, c in enumerate(cs) for x in ([F.lit("|")] if i else []) + [c]]))


def fingerprint(*cs: Column) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.nullif(c.cast("string"), F.lit("")), F.lit("none")) for c in cs])


def lenient_json(c: Column, schema: str) -> Column:
    """JSON between optional backticks with a leading 'json'."""
    return F.from_json(F.regexp_replace(strip(c), r"^`+(?:json)?\s*|`+$", ""), schema)


def org_repo(url: Column) -> tuple[Column, Column]:
    path = F.split(F.try_parse_url(url, F.lit("PATH")), "/")
    return F.try_element_at(path, F.lit(2)), F.try_element_at(path, F.lit(3))
