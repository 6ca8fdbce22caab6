"""Synthetic scenarios: labelled feature rows for the evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weirwatch.fixed_values import FOREST_SEED, REQUEST_FEATURES, SCENARIO_COLUMNS, SCENARIOS


def _order_key(seed: int):
    """A seeded, engine-independent shuffle order of feature rows."""
    key = F.concat_ws("|", F.unix_seconds("window_start").cast("string"), "ip_hash", F.lit(str(seed)))
    return F.sha2(key, 256)


def candidates(features: DataFrame) -> DataFrame:
    """Quiet windows: nothing suspicious, few errors, at least two requests."""
    return features.where(
        (F.col("suspicious_path_count") == 0)
        & (F.col("error_rate") <= 0.05)
        & (F.col("request_count") >= 2)
    )


def base_rows(features: DataFrame, rows_per_scenario: int, seed: int = FOREST_SEED) -> DataFrame:
    """A seeded sample of feature windows, numbered 1..n in ``row_index``.

    Quiet windows are taken if there are enough of them, else all windows;
    if those are too few as well they repeat.
    """
    n = rows_per_scenario
    if n < 1:
        raise ValueError("rows_per_scenario must be positive")
    pool = candidates(features)
    if pool.limit(n).count() < n:
        pool = features
    keys = ["window_start", "ip_hash"]
    order = [_order_key(seed), F.col("window_start"), F.col("ip_hash")]
    sample = pool.orderBy(*order).limit(n)
    # At most n rows are left here, the requested sample size.
    numbered = sample.select(
        *keys, (F.row_number().over(W.orderBy(*order)) - 1).alias("_i")
    )
    have = sample.count()
    if have == 0:
        raise ValueError("no feature rows to take scenarios from")
    repeats = F.sequence((F.col("_i") + 1).cast("int"), F.lit(n), F.lit(have))
    return numbered.select(
        F.explode(repeats).alias("row_index"),
        F.col("window_start").alias("base_window_start"),
        F.col("ip_hash").alias("base_ip_hash"),
    )


def scenarios(features: DataFrame, rows_per_scenario: int = 100, seed: int = FOREST_SEED) -> DataFrame:
    """One row per scenario and base row, with all model features.

    A scenario fixes every feature, so its rows differ in their ids and in the
    window they were derived from only.
    """
    table = F.array(
        *[
            F.struct(
                F.lit(i).alias("scenario_index"),
                *[F.lit(v).alias(c) for c, v in zip(SCENARIO_COLUMNS, values, strict=True)],
            )
            for i, values in enumerate(SCENARIOS, start=1)
        ]
    )
    rows = base_rows(features, rows_per_scenario, seed).select("*", F.inline(table))
    requests = F.col("request_count")

    def bounded(count: str):
        return F.greatest(F.lit(0), F.least(F.col(count), requests))

    rows = rows.withColumns(
        {
            "error_count": bounded("error_count"),
            "suspicious_path_count": bounded("suspicious_path_count"),
        }
    )
    share = F.col("error_count").cast("double") / F.nullif(requests.cast("double"), F.lit(0.0))
    rows = rows.withColumns(
        {
            "error_rate": F.coalesce(share, F.lit(0.0)),
            "synthetic_id": F.format_string(
                "%02d_%04d_%s", "scenario_index", "row_index", "scenario_name"
            ),
            "ip_hash": F.format_string("synthetic_%02d_%04d", "scenario_index", "row_index"),
        }
    )
    return rows.select(
        "synthetic_id",
        "scenario_name",
        "is_attack_like",
        "ip_hash",
        *REQUEST_FEATURES,
        "scenario_index",
        "row_index",
        "base_window_start",
        "base_ip_hash",
    )
