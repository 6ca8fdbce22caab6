"""Exact quantiles that never gather a group in one place.

The built-in exact percentile keeps every distinct value of a group in one
task's memory. Here a group is first counted by value bucket, which partial
aggregation shrinks before the shuffle, however hot the group is. The bucket
that holds the wanted rank is found from the counts. Mostly the rank falls on
the smallest or largest value of its bucket and is known at once; only for the
others are the rows of that single bucket looked at again.

There is one way for inputs of all sizes.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weirwatch.operators.whole_quantiles import whole_quantiles

# Buckets per e-fold of the value: about 60 for values up to ten thousand. More
# would open fewer rows later but count into more groups first.
_PER_EFOLD = 8
_TOP_BUCKET = 1_000_000
# Parts a bucket is split into at each further level.
_PARTS = 4096

def _log_bucket(value: Column) -> Column:
    """A bucket number that never falls as the value grows."""
    size = F.least(F.floor(F.log1p(F.abs(value)) * F.lit(_PER_EFOLD)), F.lit(_TOP_BUCKET))
    signed = F.when(value < 0, -size).otherwise(size)
    return F.when(F.isnan(value), F.lit(_TOP_BUCKET + 1)).otherwise(signed)


def _linear_bucket(value: Column, low: Column, high: Column) -> Column:
    """Split [low, high] evenly; also never falls as the value grows."""
    share = (value - low) / F.nullif(high - low, F.lit(0.0))
    part = F.floor(share * F.lit(_PARTS))
    return F.coalesce(F.least(part, F.lit(_PARTS - 1)), F.lit(0)).cast("bigint")


def _running(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows of the group up to and before each bucket, and in all."""
    along = W.partitionBy(*keys).orderBy(order)
    upto = along.rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = along.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return df.withColumns(
        {"_upto": F.sum("_n").over(upto), "_all": F.sum("_n").over(whole)}
    ).withColumn("_before", F.col("_upto") - F.col("_n"))


def _pick(rank: Column) -> tuple[Column, Column]:
    """Whether a bucket holds a rank, and the value if its ends tell it."""
    holds = (F.col("_before") <= rank) & (rank < F.col("_upto"))
    known = (
        F.when(rank == F.col("_before"), F.col("_low"))
        .when(rank == F.col("_upto") - 1, F.col("_high"))
        .when(F.col("_low") == F.col("_high"), F.col("_low"))
    )
    return holds, known


def _locate(
    hist: DataFrame, keys: list[str], low_rank: Column, high_rank: Column, kept: list[str]
) -> DataFrame:
    """Per group: the two rank values where known, else the bucket to open.

    ``kept`` are columns that are the same in all rows of a group.

    The two ranks are equal or neighbours, so unless they share a bucket both
    lie on a bucket end. At most one bucket per group has to be opened.
    """
    holds_low, low = _pick(low_rank)
    holds_high, high = _pick(high_rank)
    open_here = (holds_low & low.isNull()) | (holds_high & high.isNull())
    return hist.groupBy(*keys).agg(
        F.max(F.when(holds_low, low)).alias("_qlow"),
        F.max(F.when(holds_high, high)).alias("_qhigh"),
        *[F.max(c).alias(c) for c in kept],
        F.max(F.when(open_here, F.col("_bucket"))).alias("_bucket"),
        F.max(F.when(open_here, F.col("_before"))).alias("_before"),
        F.max(F.when(open_here, F.col("_low"))).alias("_low"),
        F.max(F.when(open_here, F.col("_high"))).alias("_high"),
    )


def exact_quantile(
    df: DataFrame,
    keys: list[str],
    value: str,
    p: float,
    out: str,
    method: str = "interpolated",
    levels: int = 1,
) -> DataFrame:
    """One exact quantile of ``value`` per group, nulls ignored.

    ``interpolated`` is the SQL ``percentile_cont``; ``nearest`` takes the value
    whose 0-based rank is ``p * (n - 1)`` rounded half to even. Rows with a null
    key are left out. ``levels`` is how often a bucket is split before its values
    are ranked: 1 does for measurements of limited precision within a group.
    Groups without a value are absent. Without ``keys`` the quantile of the
    whole table is found at once, by ``whole_quantiles``.
    """
    if not keys:
        found = whole_quantiles(df, {out: (value, p, method)})[out]
        return df.sparkSession.createDataFrame([] if found is None else [(found,)], f"{out} DOUBLE")
    if method not in ("interpolated", "nearest"):
        raise ValueError(f"unknown method: {method}")
    if not 0.0 <= p <= 1.0:
        raise ValueError("p must lie in [0, 1]")
    group = list(keys)
    # The joins below would filter null keys on one side only; filtering them
    # here keeps both uses of the counted rows one and the same shuffle.
    present = reduce(and_, [F.col(c).isNotNull() for c in [*keys, value]])
    rows = df.where(present).select(*keys, F.col(value).cast("double").alias("_v"))

    position = F.lit(p) * (F.col("_all") - 1)
    if method == "nearest":
        low_rank = high_rank = F.least(F.rint(position).cast("bigint"), F.col("_all") - 1)
    else:
        low_rank, high_rank = F.floor(position), F.ceil(position)

    rows = rows.withColumn("_bucket", _log_bucket(F.col("_v")))
    counted = rows.groupBy(*group, "_bucket").agg(
        F.count("*").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high")
    )
    found = _locate(_running(counted, group, "_bucket"), group, low_rank, high_rank, ["_all"])
    found = found.withColumns({"_rlow": low_rank, "_rhigh": high_rank})
    result = found.select(*group, "_all", "_qlow", "_qhigh")

    opened = found.where(F.col("_bucket").isNotNull()).select(
        *group, "_bucket", F.col("_before").alias("_base"), "_low", "_high", "_rlow", "_rhigh"
    )
    carried = ["_base", "_rlow", "_rhigh"]
    inside = _open(rows, opened, group)
    for _ in range(levels - 1):
        inside, settled = _narrow(inside, group, carried)
        result = _fill(result, settled, group)
    result = _fill(result, _rank_values(inside, group, carried), group)

    fraction = F.lit(0.0) if method == "nearest" else position - F.floor(position)
    quantile = F.col("_qlow") + (F.col("_qhigh") - F.col("_qlow")) * fraction
    # Equal ends need no arithmetic, which would turn infinity into NaN.
    quantile = F.when(F.col("_qlow") == F.col("_qhigh"), F.col("_qlow")).otherwise(quantile)
    return result.select(*keys, quantile.alias(out))


def _open(rows: DataFrame, opened: DataFrame, group: list[str]) -> DataFrame:
    """Rows of the opened buckets.

    There is at most one opened bucket per group, so a partition of them fits
    a hash table and the rows need no sort. A hot bucket is split by the
    adaptive skew join.
    """
    return rows.join(opened.hint("shuffle_hash"), [*group, "_bucket"]).drop("_bucket")


def _narrow(inside: DataFrame, group: list[str], carried: list[str]) -> tuple[DataFrame, DataFrame]:
    """Split the open bucket of each group evenly and keep the part in question."""
    rows = inside.withColumn("_bucket", _linear_bucket(F.col("_v"), F.col("_low"), F.col("_high")))
    counted = rows.groupBy(*group, "_bucket").agg(
        F.count("*").alias("_n"),
        F.min("_v").alias("_low"),
        F.max("_v").alias("_high"),
        *[F.max(c).alias(c) for c in carried],
    )
    local = _running(counted, group, "_bucket").withColumns(
        {"_before": F.col("_before") + F.col("_base"), "_upto": F.col("_upto") + F.col("_base")}
    )
    found = _locate(local, group, F.col("_rlow"), F.col("_rhigh"), ["_rlow", "_rhigh"])
    opened = found.where(F.col("_bucket").isNotNull()).select(
        *group, "_bucket", F.col("_before").alias("_base"), "_low", "_high", "_rlow", "_rhigh"
    )
    kept = _open(rows.select(*group, "_bucket", "_v"), opened, group)
    return kept, found.select(*group, "_qlow", "_qhigh")


def _rank_values(inside: DataFrame, group: list[str], carried: list[str]) -> DataFrame:
    """Rank the distinct values that are left; equal ones count together."""
    counted = inside.groupBy(*group, "_v").agg(
        F.count("*").alias("_n"), *[F.max(c).alias(c) for c in carried]
    )
    local = _running(counted, group, "_v")
    before, upto = F.col("_before") + F.col("_base"), F.col("_upto") + F.col("_base")
    at = {}
    for name, rank in (("_qlow", F.col("_rlow")), ("_qhigh", F.col("_rhigh"))):
        at[name] = F.max(F.when((before <= rank) & (rank < upto), F.col("_v"))).alias(name)
    return local.groupBy(*group).agg(*at.values())


def _fill(result: DataFrame, more: DataFrame, group: list[str]) -> DataFrame:
    """Take values found later where none was known before."""
    later = more.select(*group, F.col("_qlow").alias("_mlow"), F.col("_qhigh").alias("_mhigh"))
    return result.join(later, group, "left").select(
        *group,
        "_all",
        F.coalesce("_qlow", "_mlow").alias("_qlow"),
        F.coalesce("_qhigh", "_mhigh").alias("_qhigh"),
    )
