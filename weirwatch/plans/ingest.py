"""Incremental pull of raw entries by a stored high-water mark."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirwatch.fixed_values import FRESHNESS_MINUTES, OVERLAP_MINUTES
from weirwatch.functions.casts import first_present, lenient_timestamp
from weirwatch.functions.identity import hash_entity
from weirwatch.session import materialize
from weirwatch.sources.raw import request_rows
from weirwatch.sources.tables import load_request_logs, read_table, table_exists, upsert

STATE_KEYS = ["source_name"]
MOMENT = "_moment"
LINE_HASH = "_line_hash"


def entry_timestamp() -> Column:
    """Time of a raw request entry in ``value``; unparsable is null."""
    return lenient_timestamp(
        first_present(
            F.get_json_object("value", "$.timestamp"),
            F.get_json_object("value", "$.protoPayload.startTime"),
        )
    )


def high_water_mark(spark: SparkSession, state_path: str, log_path: str, source: str) -> datetime | None:
    """Stored mark of a source, else the newest loaded log time, else None."""
    if table_exists(spark, state_path):
        state = read_table(spark, state_path).where(F.col("source_name") == source)
        row = state.agg(F.max("last_log_timestamp").alias("t")).first()
        if row.t is not None:
            return row.t
    if table_exists(spark, log_path):
        return read_table(spark, log_path).agg(F.max("timestamp").alias("t")).first().t
    return None


def pull_since(
    entries: DataFrame,
    mark: datetime | None,
    overlap_minutes: int = OVERLAP_MINUTES,
    freshness_minutes: int = FRESHNESS_MINUTES,
    now: Column | None = None,
) -> DataFrame:
    """Entries from the mark minus an overlap on; recent ones without a mark.

    No row limit: one that fell inside the overlap would stop the mark from
    ever moving on.
    """
    return entries.where(entry_timestamp() >= pulled_from(mark, overlap_minutes, freshness_minutes, now))


def pulled_from(mark: datetime | None, overlap_minutes: int, freshness_minutes: int, now: Column | None) -> Column:
    """The least time of a pull: the mark minus the overlap, without a mark the freshness before ``now``."""
    if mark is not None:
        return F.lit(mark) - F.make_dt_interval(mins=F.lit(overlap_minutes))
    return (F.current_timestamp() if now is None else now) - F.make_dt_interval(mins=F.lit(freshness_minutes))


def advance_mark(old: Column, new: Column) -> Column:
    """The mark never moves back, and an empty batch leaves it as it is."""
    return F.greatest(old, new)


def save_state(
    spark: SparkSession, state_path: str, source: str, newest: datetime | None, rows: int, run_id: str, raw_path: str
) -> None:
    """Store the mark after a successful load."""
    if newest is None:
        return
    old = None
    if table_exists(spark, state_path):
        row = read_table(spark, state_path).where(F.col("source_name") == source).first()
        old = row.last_log_timestamp if row else None
    state = spark.range(1).select(
        F.lit(source).alias("source_name"),
        advance_mark(F.lit(old).cast("timestamp"), F.lit(newest)).alias("last_log_timestamp"),
        F.lit(run_id).alias("last_successful_run_id"),
        F.current_timestamp().alias("last_successful_run_at"),
        F.lit(rows).cast("bigint").alias("last_rows_retrieved"),
        F.lit(raw_path).alias("last_raw_path"),
        F.current_timestamp().alias("updated_at"),
    )
    upsert(spark, state_path, state, STATE_KEYS)


def ingest_requests(
    spark: SparkSession,
    entries: DataFrame,
    log_path: str,
    state_path: str,
    salt: str,
    source: str = "requests",
    run_id: str = "",
    raw_path: str = "",
    overlap_minutes: int = OVERLAP_MINUTES,
    freshness_minutes: int | None = FRESHNESS_MINUTES,
    now: Column | None = None,
    refused_path: str | None = None,
) -> int:
    """Pull, anonymise, generalise, upsert; then move the mark. Safe to repeat.

    ``entries`` has ``value`` and ``load_order``. Late entries inside the
    overlap are pulled again and replace themselves by key. Where neither a
    mark nor a log is stored, entries of the last ``freshness_minutes`` before
    ``now`` are taken; None takes all, to fill a new table from the past.

    An entry without a time that can be read is in no pull's range: such
    entries go to the table ``refused_path``, each once; without that path they
    fail the pull.
    """
    mark = high_water_mark(spark, state_path, log_path, source)
    # An exploded list of one: the time is read once, and no filter on it reads the entry again.
    timed = entries.select("*", F.explode(F.array(entry_timestamp())).alias(MOMENT))
    moment = F.col(MOMENT)
    if mark is not None or freshness_minutes is not None:
        timed = timed.where(moment.isNull() | (moment >= pulled_from(mark, overlap_minutes, freshness_minutes, now)))
    # A pull takes one stretch of a file in order of time: without a new dealing, few tasks would have all its rows.
    timed = timed.hint("rebalance").withColumn(LINE_HASH, F.when(moment.isNull(), hash_entity(F.col("value"), salt)))
    # One pass from entries to rows; only what was made of an entry is stored.
    pulled = materialize(request_rows(timed, salt, keep=("load_order", MOMENT, LINE_HASH)), "pulled")
    fresh = pulled.where(moment.isNotNull()).drop(LINE_HASH)
    untimed = pulled.where(moment.isNull()).select(F.col(LINE_HASH).alias("line_hash"))
    if refused_path:
        refused = untimed.groupBy("line_hash").agg(F.count(F.lit(1)).alias("n_lines"))
        named = refused.select(F.lit(source).alias("source_name"), F.lit("no timestamp").alias("reason"), "line_hash", "n_lines")
        upsert(spark, refused_path, named, ["source_name", "reason", "line_hash"])
    elif not untimed.isEmpty():
        raise ValueError("an entry has no timestamp; pull refused")
    loaded = load_request_logs(spark, fresh.drop(MOMENT), log_path)
    newest = fresh.agg(F.max(MOMENT).alias("t")).first().t
    save_state(spark, state_path, source, newest, loaded, run_id, raw_path)
    return loaded
