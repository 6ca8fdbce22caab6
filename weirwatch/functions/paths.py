"""Generalised endpoint features of an already scrubbed path.

These run once per raw row, so word lists are tested with plain substring and
suffix checks, and a pattern is tried only where a cheap check allows it.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirwatch.fixed_values import (
    SEGMENT_DIGITS,
    SEGMENT_HEX,
    SEGMENT_HEX_MIN,
    SEGMENT_LONG,
    SEGMENT_PLACEHOLDERS,
    SEGMENT_SLUG,
    STATIC_EXTENSIONS,
    SUSPICIOUS_PATH_PATTERNS,
    TEMPLATE_DEPTH,
    VERSION_SEGMENTS,
)


def _whole(pattern: str) -> str:
    return rf"(?U)^(?:{pattern})\z"


def _contains_any(text: Column, words: list[str]) -> Column:
    return reduce(or_, [F.contains(text, F.lit(word)) for word in words])


def _ends_with_any(text: Column, suffixes: list[str]) -> Column:
    return reduce(or_, [F.endswith(text, F.lit(suffix)) for suffix in suffixes])


def path_segments(path: Column) -> Column:
    """Non-empty parts between slashes; empty for null."""
    return F.array_remove(F.split(F.coalesce(path, F.lit("")), "/"), "")


def is_static_segment(lower: Column) -> Column:
    """Whether a lower-cased segment ends in a static file extension."""
    return F.contains(lower, F.lit(".")) & _ends_with_any(lower, STATIC_EXTENSIONS)


def is_suspicious_path(path: Column) -> Column:
    return F.coalesce(_contains_any(F.lower(path), SUSPICIOUS_PATH_PATTERNS), F.lit(False))


def _group(first: Column, static: Column, suspicious: Column) -> Column:
    """Route family; API and static routes win over suspicious ones."""
    return (
        F.when(first.isNull(), F.lit("root"))
        .when(first == "api", F.lit("api"))
        .when(static, F.lit("static_asset"))
        .when(suspicious, F.lit("suspicious_probe"))
        .when(first.isin(VERSION_SEGMENTS), F.lit("versioned_api"))
        .otherwise(F.lit("application_route"))
    )


def _generalize(lower: Column, index: Column, size: Column) -> Column:
    """A token naming the kind of a variable-looking segment, else the segment.

    ``lower`` is the lower-cased segment, ``size`` the length as written.
    """
    return (
        F.when(lower.isin(SEGMENT_PLACEHOLDERS), lower)
        .when(lower.rlike(_whole(SEGMENT_DIGITS)), F.lit("{num}"))
        .when((size >= SEGMENT_HEX_MIN) & lower.rlike(_whole(SEGMENT_HEX)), F.lit("{hex}"))
        .when(is_static_segment(lower), F.lit("{static_file}"))
        .when(
            (index > 0) & F.contains(lower, F.lit("-")) & lower.rlike(_whole(SEGMENT_SLUG)),
            F.lit("{slug}"),
        )
        .when(size > SEGMENT_LONG, F.lit("{long_segment}"))
        .otherwise(lower)
    )


def _template(segments: Column, lowered: Column) -> Column:
    """First segments generalised; ``/`` where there is none."""
    kept = F.transform(
        F.slice(lowered, 1, TEMPLATE_DEPTH),
        lambda lower, index: _generalize(lower, index, F.length(F.get(segments, index))),
    )
    return F.concat(F.lit("/"), F.array_join(kept, "/"))


def generalize_paths(df: DataFrame, path: str = "endpoint_path") -> DataFrame:
    """Add the six endpoint features to rows with a scrubbed path."""
    column, segments, lowered = F.col(path), F.col("_segments"), F.col("_lowered")
    first, last = F.col("_first"), F.col("_last")
    split = df.withColumns(
        {"_segments": path_segments(column), "_lowered": path_segments(F.lower(column))}
    ).withColumns(
        {
            "_first": F.try_element_at(lowered, F.lit(1)),
            "_last": F.try_element_at(lowered, F.lit(-1)),
        }
    )
    flags = split.withColumns(
        {
            "is_static_asset": F.coalesce(is_static_segment(last), F.lit(False)),
            "has_suspicious_path_pattern": is_suspicious_path(column),
        }
    )
    features = flags.withColumns(
        {
            "endpoint_group": _group(
                first, F.col("is_static_asset"), F.col("has_suspicious_path_pattern")
            ),
            "endpoint_template": _template(segments, lowered),
            "path_depth": F.size(segments),
            "path_length": F.length(F.coalesce(column, F.lit(""))),
        }
    )
    ordered = [
        "endpoint_group",
        "endpoint_template",
        "path_depth",
        "path_length",
        "is_static_asset",
        "has_suspicious_path_pattern",
    ]
    return features.select(*[c for c in df.columns if c not in ordered], *ordered)
