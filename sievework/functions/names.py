"""File names, globs and brands."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

STEM = r"(?s)^(.+)\.[^.]+$"
STRICT = r"^([^_]+)_(.+)_([0-9]+(?:\.[0-9]+)?)$"


def basename(key: Column) -> Column:
    return F.element_at(F.split(key, "/"), -1)


def stem(key: Column) -> Column:
    """The base name without its last suffix; a name without suffix stays (so 'a_b_0.95' is 'a_b_0')."""
    return F.regexp_replace(basename(key), STEM, "$1")


def strict_parts(key: Column) -> Column:
    """struct(brand, label, confidence) of '<brand>_<label>_<number>'; an error for any other name. The label keeps inner underscores.

    Use it after filters: the error is raised when the value is computed."""
    s = stem(key)
    bad = F.raise_error(F.concat(F.lit("name is not <brand>_<label>_<confidence>: "), key))
    part = lambda i: F.when(s.rlike(STRICT), F.regexp_extract(s, STRICT, i)).otherwise(bad.cast("string"))
    return F.struct(part(1).alias("brand"), part(2).alias("label"), part(3).cast("double").alias("confidence"))


def lenient_parts(key: Column) -> Column:
    """struct(brand, label, confidence string): first, inner parts run together, last; null with fewer than three parts."""
    p = F.split(stem(key), "_")
    inner = F.array_join(F.slice(p, F.lit(2), F.greatest(F.size(p) - 2, F.lit(0))), "")
    return F.when(F.size(p) >= 3, F.struct(p[0].alias("brand"), inner.alias("label"), F.element_at(p, -1).alias("confidence")))


def second_part(key: Column) -> Column:
    """The label as the second part alone."""
    return F.split(stem(key), "_")[1]


def glob_regex(pattern: str) -> str:
    """A Java regular expression for a shell glob (* ? [..] [!..]) over the whole name."""
    out, i = "", 0
    while i < len(pattern):
        c = pattern[i]
        i += 1
        if c == "*":
            out += ".*"
        elif c == "?":
            out += "."
        elif c == "[" and (end := pattern.find("]", i + (1 if pattern[i : i + 1] != "!" else 2))) > 0:
            body, i = pattern[i:end], end + 1
            negate = body.startswith("!")
            body = "".join("\\" + x if x in "\\[]^&" else x for x in (body[1:] if negate else body))
            out += f"[{'^' if negate else ''}{body}]"
        else:
            out += re.escape(c)
    return f"(?s)^{out}\\z"


def matches_glob(name: Column, pattern: str) -> Column:
    """Case-sensitive glob match; a plain prefix becomes ``startswith``, which the Parquet scan can use."""
    head = pattern[:-1]
    if pattern.endswith("*") and not re.search(r"[*?\[]", head):
        return name.startswith(head)
    return name.rlike(glob_regex(pattern))


def literal_ends(pattern: str) -> tuple[str, str]:
    """What every name that a glob matches starts and ends with: the literal text before its first and after its last wildcard. A pattern
    without wildcards has all of it as head."""
    wild = [m.start() for m in re.finditer(r"[*?\[]", pattern)]
    if not wild:
        return pattern, ""
    tail = re.split(r"[*?\]]", pattern)[-1] if "[" not in pattern.rpartition("]")[2] else ""
    return pattern[: wild[0]], tail


def brand_token(pattern: str) -> str:
    """The literal brand that a naming pattern starts with; patterns that don't start with '<brand>_' are refused."""
    found = re.match(r"([^_*?\[\]]+)_", pattern)
    if not found:
        raise ValueError(f"pattern {pattern!r} does not start with a literal brand and an underscore")
    return found[1]


def safe_brand(brand: Column) -> Column:
    return F.substring(F.regexp_replace(brand, r"[^\p{L}\p{N}-]", "-"), 1, 40)


def decoded_key(key: Column) -> Column:
    """URL-decoded; a key with malformed escapes stays as it is."""
    return F.coalesce(F.try_url_decode(key), key)


def first_match(name: Column, patterns: list[tuple[str, str]]) -> Column:
    """The id of the first (id, glob) that matches, else null: a CASE chain, no join. For some hundred patterns; ``operators.brands`` has a
    join for more."""
    out = F.lit(None).cast("string")
    for brand, pattern in reversed(patterns):
        out = F.when(matches_glob(name, pattern), F.lit(brand)).otherwise(out)
    return out


def with_fallback(*columns: Column) -> Column:
    return F.coalesce(*columns)


def split_claims(value: Column) -> Column:
    """A JSON array of strings, or parts between commas, semicolons and spaces; trimmed, without empty ones."""
    parts = F.coalesce(F.from_json(value, "array<string>"), F.split(value, "[,; ]"))
    return F.filter(F.transform(parts, lambda s: F.trim(s)), lambda s: s != "")  # trim itself would take the index as what to trim
