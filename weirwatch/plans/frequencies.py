"""Endpoint frequencies and window rarity, kept up to date without reading the log again.

The rarity of an endpoint is the negative logarithm of its share of all rows,
so each new row changes it for every window. It is kept in parts that change
less. Over the rows of a window with an endpoint,

    mean rarity = ln(rows of the whole log) - mean(ln(rows of the endpoint)).

The first term is one number, applied when the table is read. The second one
changes only in windows that have an endpoint whose count changed.

Three tables are kept beside the log, all partitioned by day: rows per day and
endpoint, rows per window, client and endpoint, and each window's mean of
logarithms. A refresh learns from the log's manifests which days changed since
the last one, counts these days anew, and takes the difference of the endpoint
counts from the small table; the log's other days are never opened.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirwatch.functions.windows import window_start
from weirwatch.session import materialize
from weirwatch.sources.tables import DAY, changed_since, read_table, replace_parts, table_exists, upsert, with_day

WINDOW_KEYS = ["window_start", "ip_hash"]


@dataclass(frozen=True)
class FrequencyTables:
    """Where the tables lie, below one folder."""

    root: str
    window: str = "5 minutes"

    @property
    def endpoints(self) -> str:
        return f"{self.root}/endpoint_counts"

    @property
    def windows(self) -> str:
        return f"{self.root}/window_endpoints"

    @property
    def means(self) -> str:
        return f"{self.root}/window_log_means"

    @property
    def state(self) -> str:
        return f"{self.root}/refreshed"


def endpoint_counts(spark: SparkSession, at: FrequencyTables) -> DataFrame:
    """Rows per endpoint over the whole log, null included: the daily counts added up."""
    return read_table(spark, at.endpoints).groupBy("endpoint_template").agg(F.sum("n").alias("endpoint_count"))


def _changed(old: DataFrame, new: DataFrame) -> DataFrame:
    """Endpoints whose count differs; their number is that of distinct endpoints at most."""
    a, b = old.withColumnRenamed("endpoint_count", "was").alias("a"), new.withColumnRenamed("endpoint_count", "is").alias("b")
    met = a.join(b, F.expr("a.endpoint_template <=> b.endpoint_template"), "full")
    differ = met.where(~F.col("was").eqNullSafe(F.col("is")))
    return differ.select(F.coalesce("b.endpoint_template", "a.endpoint_template").alias("endpoint_template"))


def _last_refresh(spark: SparkSession, at: FrequencyTables) -> int | None:
    if not table_exists(spark, at.state):
        return None
    return read_table(spark, at.state).first().commit


def refresh(spark: SparkSession, log_path: str, at: FrequencyTables) -> set:
    """Bring the tables up to the log's present snapshot; returns the days that were counted anew.

    Safe to repeat: a refresh that was cut off is done again from the same snapshot on.
    """
    commit, days = changed_since(spark, log_path, _last_refresh(spark, at))
    if not days and table_exists(spark, at.endpoints):
        return days
    logs = read_table(spark, log_path, parts=list(days))
    daily = logs.groupBy(DAY, "endpoint_template").agg(F.count(F.lit(1)).alias("n"))
    daily = materialize(daily, "endpoint-counts")
    keyed = logs.where(F.col("ip_hash").isNotNull() & F.col("timestamp").isNotNull())
    start = window_start(F.col("timestamp"), at.window)
    detail = keyed.groupBy(DAY, start.alias("window_start"), "ip_hash", "endpoint_template").agg(F.count(F.lit(1)).alias("n"))

    known = table_exists(spark, at.endpoints)
    old = materialize(endpoint_counts(spark, at), "old-counts") if known else None
    # Windows that a touched day loses are no longer in its detail, but in the old one.
    gone = read_table(spark, at.windows, parts=list(days)).select(*WINDOW_KEYS).distinct() if known else None
    gone = None if gone is None else materialize(gone, "old-windows")
    replace_parts(spark, at.windows, detail, DAY, days)
    stored = read_table(spark, at.windows)
    touched = stored.where(F.col(DAY).cast("string").isin(list(days))).select(*WINDOW_KEYS)
    new = daily.groupBy("endpoint_template").agg(F.sum("n").alias("endpoint_count"))
    if known:
        rest = read_table(spark, at.endpoints).where(~F.col(DAY).cast("string").isin(list(days)))
        new = rest.select("endpoint_template", F.col("n").alias("endpoint_count")).unionByName(new).groupBy("endpoint_template").agg(F.sum("endpoint_count").alias("endpoint_count"))
        new = materialize(new, "new-counts")
        other = stored.join(_changed(old, new), "endpoint_template", "left_semi").select(*WINDOW_KEYS)
        touched = touched.unionByName(other).unionByName(gone)
    windows = materialize(touched.distinct(), "touched-windows")
    _store_means(spark, at, stored.join(windows, WINDOW_KEYS, "left_semi"), new, windows)
    replace_parts(spark, at.endpoints, daily, DAY, days)
    state = spark.createDataFrame([(log_path, commit)], "log STRING, commit LONG")
    upsert(spark, at.state, state, ["log"])
    return days


def _store_means(spark: SparkSession, at: FrequencyTables, detail: DataFrame, counts: DataFrame, windows: DataFrame) -> None:
    """Means of the given windows; one that has no row any more keeps its key with no rows."""
    logs = detail.join(counts, "endpoint_template").withColumn("part", F.log("endpoint_count") * F.col("n"))
    means = logs.groupBy(*WINDOW_KEYS).agg((F.sum("part") / F.sum("n")).alias("mean_log_count"))
    rows = detail.groupBy(*WINDOW_KEYS).agg(F.sum("n").alias("request_count"))
    whole = windows.join(rows, WINDOW_KEYS, "left").join(means, WINDOW_KEYS, "left")
    whole = whole.withColumn("request_count", F.coalesce("request_count", F.lit(0).cast("long")))
    upsert(spark, at.means, with_day(whole, "window_start"), WINDOW_KEYS, partition_by=DAY, part_of_key=True)


def window_rarity(spark: SparkSession, at: FrequencyTables) -> DataFrame:
    """``window_start``, ``ip_hash``, ``request_count``, ``avg_endpoint_rarity`` of every window, as a full rebuild gives them."""
    total = read_table(spark, at.endpoints).agg(F.sum("n").cast("double").alias("n")).scalar()
    means = read_table(spark, at.means).where("request_count > 0")
    return means.select(*WINDOW_KEYS, "request_count", (F.log(total) - F.col("mean_log_count")).alias("avg_endpoint_rarity"))


def rarity(spark: SparkSession, at: FrequencyTables) -> DataFrame:
    """``endpoint_template``, ``endpoint_count``, ``endpoint_rarity`` from the daily counts; takes the place of a pass over the log."""
    total = read_table(spark, at.endpoints).agg(F.sum("n").cast("double").alias("n")).scalar()
    return endpoint_counts(spark, at).withColumn("endpoint_rarity", -F.log(F.col("endpoint_count") / F.nullif(total, F.lit(0.0))))
