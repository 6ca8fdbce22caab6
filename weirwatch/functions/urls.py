"""URL parts, scrubbing and key summaries, all as Column expressions.

Attack probes carry characters that URL parsers reject, so the parts are cut
with regular expressions that accept any text.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirwatch.fixed_values import (
    PATH_SCRUBBERS,
    SENSITIVE_PAYLOAD_KEYS,
    SENSITIVE_QUERY_KEYS,
    USER_AGENT_MARKERS,
)
from weirwatch.functions.casts import none_if_empty

_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?"
_PATH = _AUTHORITY + r"([^?#]*)"
_QUERY = r"^[^?#]*\?([^#]*)"


# Leading characters a URL parser drops: controls and blanks.
_LEADING = "".join(chr(c) for c in range(0x21))


def _trimmed(resource: Column) -> Column:
    """Drop leading controls and blanks, and tabs or line ends anywhere."""
    return F.translate(F.ltrim(resource, F.lit(_LEADING)), "\t\r\n", "")


def url_path(resource: Column) -> Column:
    path = F.regexp_extract(_trimmed(resource), _PATH, 1)
    return F.regexp_replace(path, r"^$", "/")


def url_query(resource: Column) -> Column:
    return F.regexp_extract(_trimmed(resource), _QUERY, 1)


def _scrub(path: Column, placeholder: str, pattern: str) -> Column:
    return F.regexp_replace(path, "(?U)" + pattern, placeholder)


def _may_hold(path: Column, placeholder: str) -> Column:
    """A cheap test that must hold for a pattern to match at all."""
    return {
        "{email}": F.contains(path, F.lit("@")),
        "{uuid}": (F.length(path) >= 36) & F.contains(path, F.lit("-")),
        "{hex}": F.length(path) >= 16,
        "{num}": F.length(path) >= 4,
    }[placeholder]


def clean_path(resource: Column) -> Column:
    """Path of a URL with e-mails, UUIDs, long hex and long numbers replaced."""
    path = url_path(none_if_empty(resource))
    for placeholder, pattern in PATH_SCRUBBERS:
        path = _scrub(path, placeholder, pattern)
    return path


def with_clean_path(df: DataFrame, resource: str, out: str) -> DataFrame:
    """:func:`clean_path` as a column, one step at a time.

    Each pattern runs on the rows that may hold it only. As steps of their own
    the tests do not repeat the work before them.
    """
    df = df.withColumn(out, url_path(none_if_empty(F.col(resource))))
    for placeholder, pattern in PATH_SCRUBBERS:
        path = F.col(out)
        scrubbed = _scrub(path, placeholder, pattern)
        df = df.withColumn(out, F.when(_may_hold(path, placeholder), scrubbed).otherwise(path))
    return df


def query_keys(resource: Column) -> Column:
    """Lower-cased keys of the non-empty query parts, with repeats."""
    parts = F.filter(F.split(url_query(resource), "&"), lambda part: part != "")
    keys = F.transform(parts, lambda part: F.lower(F.split_part(part, F.lit("="), F.lit(1))))
    # Most requests have no query; they are told by one character.
    return F.when(F.contains(resource, F.lit("?")), keys)


def _any_of(keys: Column, words: list[str]) -> Column:
    listed = F.array(*[F.lit(w) for w in words])
    return F.coalesce(F.arrays_overlap(keys, listed), F.lit(False))


def key_count(keys: Column) -> Column:
    return F.when(keys.isNull(), F.lit(0)).otherwise(F.size(keys))


def query_key_count(resource: Column) -> Column:
    return key_count(query_keys(resource))


def has_sensitive_key(keys: Column) -> Column:
    """Whether query keys hold a sensitive one."""
    return _any_of(keys, SENSITIVE_QUERY_KEYS)


def has_sensitive_query_key(resource: Column) -> Column:
    return has_sensitive_key(query_keys(resource))


def payload_keys(payload: Column) -> Column:
    """Distinct lower-cased keys of a map column; null where it is no object."""
    return F.array_distinct(F.transform(F.map_keys(payload), lambda key: F.lower(key)))


def payload_key_count(payload: Column) -> Column:
    return F.when(payload.isNull(), F.lit(0)).otherwise(F.size(payload_keys(payload)))


def has_sensitive_payload_key(payload: Column) -> Column:
    return _any_of(payload_keys(payload), SENSITIVE_PAYLOAD_KEYS)


def user_agent_category(agent: Column) -> Column:
    """Coarse client family from marker words; the first family wins."""
    return agent_family(F.lower(none_if_empty(agent)))


def agent_family(text: Column) -> Column:
    """Client family of a lower-cased agent text; null stays null."""
    category = F.when(text.isNull(), F.lit(None).cast("string"))
    for family, markers in USER_AGENT_MARKERS:
        listed = reduce(or_, [F.contains(text, F.lit(marker)) for marker in markers])
        category = category.when(listed, F.lit(family))
    return category.otherwise(F.lit("other"))
