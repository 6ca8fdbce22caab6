"""Rule-based threat score with reasons, as Column expressions.

Each rule block is a list of (condition, points, reason); the first condition
that holds counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirwatch.fixed_values import (
    ANOMALY_WEIGHT,
    MAX_THREAT_SCORE,
    NO_REASON,
    RELEVANT_LEVELS,
    THREAT_LEVELS,
)


def _blocks() -> list[list[tuple[Column, float, str]]]:
    anomaly, suspicious = F.col("anomaly_score"), F.col("suspicious_path_count")
    rate, errors = F.col("error_rate"), F.col("error_count")
    requests, endpoints = F.col("request_count"), F.col("unique_endpoint_count")
    off = F.col("off_hours")
    static_share = F.coalesce(
        F.coalesce(F.col("static_asset_count"), F.lit(0)).cast("double")
        / F.nullif(requests.cast("double"), F.lit(0.0)),
        F.lit(0.0),
    )
    # Thresholds, points and reason texts of the rules.
    return [
        [
            (anomaly >= 0.8, 0.0, "very high anomaly score"),
            (anomaly >= 0.6, 0.0, "high anomaly score"),
        ],
        [
            (suspicious >= 100, 30.0, "large number of suspicious path probes"),
            (suspicious >= 20, 22.0, "repeated suspicious path probes"),
            (suspicious > 0, 12.0, "suspicious path pattern present"),
        ],
        [
            ((rate >= 0.5) & (errors >= 10), 18.0, "high error rate with repeated failures"),
            ((rate >= 0.2) & (errors >= 10), 12.0, "elevated error rate"),
            (errors >= 50, 10.0, "large number of error responses"),
        ],
        [
            (requests >= 500, 12.0, "high request burst"),
            (requests >= 150, 8.0, "elevated request volume"),
        ],
        [
            (endpoints >= 100, 12.0, "very broad endpoint access pattern"),
            (endpoints >= 30, 8.0, "broad endpoint access pattern"),
        ],
        [
            (
                off & ((requests >= 100) | (suspicious > 0) | (errors >= 10)),
                6.0,
                "activity occurred during off-hours",
            ),
        ],
        [
            (
                (static_share >= 0.8) & (suspicious == 0) & (rate < 0.05),
                -18.0,
                "mostly static asset traffic",
            ),
        ],
    ]


def _first_match(block: list[tuple[Column, float, str]], pick, default) -> Column:
    chain = None
    for rule in block:
        value = F.lit(pick(rule))
        chain = F.when(rule[0], value) if chain is None else chain.when(rule[0], value)
    return chain.otherwise(default)


def threat_level(score: Column) -> Column:
    chain = None
    for level, bound in THREAT_LEVELS:
        if bound is None:
            return chain.otherwise(F.lit(level))
        chain = F.when(score >= bound, level) if chain is None else chain.when(score >= bound, level)
    raise ValueError("the lowest level must have no bound")


def threat_score(df: DataFrame) -> DataFrame:
    """Add ``threat_score``, ``threat_level``, ``is_security_relevant``, ``reasons``."""
    blocks = _blocks()
    total = F.col("anomaly_score") * F.lit(ANOMALY_WEIGHT)
    for block in blocks:
        total = total + _first_match(block, lambda rule: rule[1], F.lit(0.0))
    score = F.greatest(F.least(F.bround(total, 4), F.lit(MAX_THREAT_SCORE)), F.lit(0.0))
    none = F.lit(None).cast("string")
    reasons = F.array_compact(
        F.array(*[_first_match(block, lambda rule: rule[2], none) for block in blocks])
    )
    scored = df.withColumns({"threat_score": score, "_found": reasons})
    level, found = threat_level(F.col("threat_score")), F.col("_found")
    return scored.withColumns(
        {
            "threat_level": level,
            "is_security_relevant": level.isin(RELEVANT_LEVELS) & (F.size(found) > 0),
            "reasons": F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(NO_REASON))),
        }
    ).drop("_found")


CONTEXT_COLUMNS = [
    "window_start",
    "ip_hash",
    "model_version",
    "anomaly_score",
    "anomaly_rank",
    "request_count",
    "suspicious_path_count",
    "error_count",
    "error_rate",
    "unique_endpoint_count",
    "static_asset_count",
    "off_hours",
]


def score_threats(scores: DataFrame, features: DataFrame) -> DataFrame:
    """Threat rows of scored windows joined with their features.

    One row of each side per window and client, so the join cannot multiply
    rows and no key of it is hot.
    """
    used = [c for c in CONTEXT_COLUMNS if c in features.columns]
    context = scores.select(
        "window_start", "ip_hash", "model_version", "anomaly_score", "anomaly_rank"
    ).join(features.select(*used), ["window_start", "ip_hash"])
    return threat_score(context.select(*CONTEXT_COLUMNS))


def threat_level_counts(threats: DataFrame) -> DataFrame:
    """Rows per level, all four levels listed, highest first."""
    counts = [F.count_if(F.col("threat_level") == level).alias(level) for level, _ in THREAT_LEVELS]
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("level_order"), F.lit(level).alias("threat_level"), F.col(level).alias("windows")
            )
            for i, (level, _) in enumerate(THREAT_LEVELS, start=1)
        ]
    )
    return threats.agg(*counts).select(F.inline(rows)).orderBy("level_order").drop("level_order")
