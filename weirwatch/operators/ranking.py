"""Global ranks, min-max scores and top rows without a one-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weirwatch.session import materialize

_ROW_BITS = (1 << 33) - 1


def global_rank(df: DataFrame, order: list[Column], out: str | list[str], partitions: int | None = None) -> DataFrame:
    """Number all rows 1..n along ``order``, which must be a total order.

    Rows are range-partitioned by the order, so equal scores spread over
    partitions by their tie-breakers, and sorted within each partition. The
    sorted rows are written once to the shared scratch folder: range bounds
    come from a sample, and both the counting and the numbering must see the
    same ones. A rank is the place within the partition plus the rows of the
    partitions before, a table with one row per partition.
    """
    ranged = (
        df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    )
    placed = ranged.sortWithinPartitions(*order).withColumn(
        "_place", F.monotonically_increasing_id()
    )
    placed = materialize(placed, "ranked").withColumns(
        {
            "_part": F.shiftright("_place", 33),
            "_row": F.col("_place").bitwiseAND(F.lit(_ROW_BITS)) + 1,
        }
    )
    sizes = placed.groupBy("_part").agg(F.max("_row").alias("_size"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    # One row per partition of the range shuffle, so small by construction.
    ranked = placed.join(F.broadcast(offsets), "_part")
    return ranked.withColumn(out, F.col("_row") + F.col("_before")).drop(
        "_place", "_part", "_row", "_before"
    )


def min_max(df: DataFrame, value: Column, out: str) -> DataFrame:
    """Scale a value to [0, 1] by its bounds over the table; 0 if all are equal.

    The bounds are a scalar subquery: one row computed once, no join.
    """
    bounds = df.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high")).alias("b")).scalar()
    low, high = bounds["low"], bounds["high"]
    scaled = (value - low) / F.nullif(high - low, F.lit(0.0))
    return df.withColumn(out, F.when(value.isNotNull(), F.coalesce(scaled, F.lit(0.0))))


def normalize_and_rank(df: DataFrame, raw: str = "raw_decision_score", keys: tuple[str, ...] = ("window_start", "ip_hash")) -> DataFrame:
    """Anomaly score and rank from a raw score that is low for outliers.

    Equal scores keep the order of the keys.
    """
    scored = min_max(df, -F.col(raw), "anomaly_score")
    order = [F.col("anomaly_score").desc(), *[F.col(k).asc() for k in keys]]
    return global_rank(scored, order, "anomaly_rank")


def top_rows(df: DataFrame, order: list[Column], limit: int) -> DataFrame:
    """First rows along an order; partitions pre-select before they merge."""
    return df.orderBy(*order).limit(limit)
