"""Structured Streaming jobs over landed log files.

Ingestion keeps late rows: duplicates are resolved by key in the table, not by
a watermark. The checkpoint takes the place of a stored high-water mark.
Window features are refreshed from the table for the windows a batch touches,
with the same code as the batch job, so a hot client grows no state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weirwatch.functions.windows import window_start
from weirwatch.operators.window_features import (
    FIVE_MINUTES,
    endpoint_rarity,
    ip_window_features,
)
from weirwatch.session import materialize
from weirwatch.functions.identity import hash_entity
from weirwatch.sources.jsonl import is_blank, is_json_object
from weirwatch.sources.raw import request_rows
from weirwatch.sources.tables import DAY, REQUEST_KEYS, load_request_logs, loaded_files, read_table, stored_matches, table_exists, upsert, with_day


def stream_lines(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """All lines of files as they land.

    There is no row limit, only an optional number of files per batch.
    """
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder).select(
        "value",
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def stream_entries(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Raw entries of JSON-lines files as they land; other lines are left out."""
    return stream_lines(spark, folder, files_per_batch).where(is_json_object(F.col("value")))


REFUSED_KEYS = ["file_path", "modified", "reason", "line_hash"]


def _batch_requests(lines: DataFrame, salt: str) -> tuple[DataFrame, DataFrame]:
    """Request rows of a batch's lines, and lines that give none: (rows, refused).

    Rows have a time and a ``load_order``. Refused are, per file, reason and
    salted hash of the line, how often it was there: lines that are no JSON
    object, and requests without a time that can be read.
    """
    # One pass: a line is parsed once, and only what was made of it is stored.
    lines = lines.where(~is_blank(F.col("value"))).withColumn("scan_id", F.monotonically_increasing_id())
    order = F.struct("modified", "file_path", "block_start", "scan_id").alias("load_order")
    lines = lines.select(order, F.col("value").alias("line"), is_json_object(F.col("value")).alias("is_object"))
    entries = lines.withColumn("value", F.when(F.col("is_object"), F.col("line")))
    rows = request_rows(entries, salt, keep=("load_order", "line", "is_object"))
    reason = F.when(~F.col("is_object"), F.lit("not one JSON object")).when(F.col("timestamp").isNull(), F.lit("no timestamp"))
    rows = rows.withColumn("reason", reason)
    rows = rows.withColumn("line_hash", F.when(F.col("reason").isNotNull(), hash_entity(F.col("line"), salt)))
    rows = materialize(rows.drop("line", "is_object"), "stream-batch")
    refused = rows.where(F.col("reason").isNotNull())
    counted = refused.groupBy(F.col("load_order.file_path").alias("file_path"), F.col("load_order.modified").alias("modified"), "reason", "line_hash")
    return rows.where(F.col("reason").isNull()).drop("reason", "line_hash"), counted.agg(F.count(F.lit(1)).alias("n_lines"))


def _first_seen(rows: DataFrame, log_path: str, number: int) -> tuple[DataFrame, DataFrame]:
    """Rows that a load may add, and ledger rows of the files that bring them.

    A file lands whole in one batch, and its rows and its ledger row are
    published in one step. So rows without a key, which no upsert can tell
    apart, are left out where the table has their file: a batch that is run
    again, or files that are read again by another run, count them once.
    """
    spark = rows.sparkSession
    files = rows.select(F.col("load_order.file_path").alias("file_path"), F.col("load_order.modified").alias("modified")).distinct()
    files = materialize(files.withColumn("batch", F.lit(number).cast("long")), "stream-files")
    done = loaded_files(spark, log_path).select("file_path", "modified").join(files.select("file_path", "modified"), ["file_path", "modified"], "left_semi")
    done = materialize(done.distinct(), "stream-known-files")
    of = done.select(F.col("file_path").alias("of"), F.col("modified").alias("at"))
    known = F.col("request_hash").isNull() & (F.col("load_order.file_path") == F.col("of")) & (F.col("load_order.modified") == F.col("at"))
    return rows.join(of, known, "left_anti"), files.join(done, ["file_path", "modified"], "left_anti")


def _store_refused(refused: DataFrame, path: str) -> None:
    """Add refused lines; those of a file that was refused before are there already."""
    upsert(refused.sparkSession, path, with_day(refused, "modified"), REFUSED_KEYS, keep="first", partition_by=DAY, part_of_key=True)


def read_refused(spark: SparkSession, path: str) -> DataFrame:
    """Refused lines: ``file_path``, ``modified``, ``reason``, ``line_hash``, ``n_lines``."""
    return read_table(spark, path).drop(DAY)


def affected_windows(rows: DataFrame, window: str = FIVE_MINUTES) -> DataFrame:
    """Distinct windows that hold rows, one row per window."""
    start = window_start(F.col("timestamp"), window)
    return rows.where(F.col("timestamp").isNotNull()).select(start.alias("window_start")).distinct()


def refresh_windows(
    spark: SparkSession,
    log_path: str,
    feature_path: str,
    windows: DataFrame,
    rarity: DataFrame | None = None,
    window: str = FIVE_MINUTES,
) -> int:
    """Recompute the given windows from the log table and upsert them.

    Endpoint rarity depends on the whole log, so without a fixed ``rarity``
    table windows refreshed at different times have seen different totals; a
    full rebuild is exact.
    """
    # One value per day of a batch: a short list that prunes the partitions.
    # A window may run into later days.
    last = F.to_date(F.col("window_start") + F.expr(f"interval {window}") - F.expr("interval 1 microsecond"))
    of_windows = windows.select(F.explode(F.sequence(F.to_date("window_start"), last)).alias("d"))
    days = [r.d for r in of_windows.distinct().collect()]
    if not days:
        return 0
    inside = (
        read_table(spark, log_path, parts=days)
        .withColumn("window_start", window_start(F.col("timestamp"), window))
        .join(windows, "window_start", "left_semi")
        .drop("window_start")
    )
    if rarity is None:
        rarity = endpoint_rarity(read_table(spark, log_path))
    features = with_day(ip_window_features(inside, window, rarity=rarity), "window_start")
    return upsert(
        spark, feature_path, features, ["window_start", "ip_hash"], partition_by=DAY, part_of_key=True
    )


def start_ingest(
    entries: DataFrame,
    log_path: str,
    salt: str,
    checkpoint: str,
    feature_path: str | None = None,
    rarity: DataFrame | None = None,
    window: str = FIVE_MINUTES,
    refused_path: str | None = None,
) -> StreamingQuery:
    """Upsert each batch into the log table and refresh the windows it touches.

    A batch that is run again after a failure replaces the same keys with the
    same rows, and adds no row without a key twice. With ``refused_path``, and
    ``entries`` from ``stream_lines``, lines that are no JSON object and requests
    without a time land in a table of their own; without it such a request
    fails the load.
    """

    def load(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows, refused = _batch_requests(batch, salt)
        if refused_path:
            _store_refused(refused, refused_path)
        elif not (untimed := refused.where("reason = 'no timestamp'")).isEmpty():
            raise ValueError(f"a log row has no timestamp; load refused: {untimed.first().file_path}")
        if rows.isEmpty():
            return
        windows = materialize(affected_windows(rows, window), "stream-windows")
        rows, ledger = _first_seen(rows, log_path, number)
        load_request_logs(spark, rows, log_path, ledger)
        if feature_path:
            refresh_windows(spark, log_path, feature_path, windows, rarity, window)

    return (
        entries.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def live_requests(entries: DataFrame, salt: str, delay: str = "5 minutes") -> DataFrame:
    """Request rows of a stream, repeats within the delay dropped.

    Rows later than the watermark are dropped too. Rows without a hash never
    count as repeats: they get a key of their own.
    """
    rows = request_rows(entries.select("value"), salt)
    rows = rows.where(F.col("timestamp").isNotNull()).withWatermark("timestamp", delay)
    key = F.coalesce("request_hash", F.concat(F.lit("none:"), F.uuid()))
    return rows.withColumn("_key", key).dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def live_counters(rows: DataFrame, window: str = FIVE_MINUTES) -> DataFrame:
    """Counts per window and client as windows close, in append mode.

    Rows of one batch count in any order. Over several batches a row later than
    the watermark is lost here, as in every append stream; ``start_live_counters``
    keeps such rows and refreshes their windows.

    The first aggregation is keyed by template too, so the state of a hot
    client is spread out; the second one only adds those rows up, and its row
    count is the number of distinct templates.
    """

    def count(condition: Column, name: str) -> Column:
        return F.count_if(condition).alias(name)

    errors = F.col("status_family").isin("4xx", "5xx")
    per_template = (
        rows.where(F.col("ip_hash").isNotNull())
        .groupBy(F.window("timestamp", window).alias("w"), "ip_hash", "endpoint_template")
        .agg(
            F.count("*").alias("n"),
            count(F.col("has_suspicious_path_pattern"), "suspicious"),
            count(errors, "errors"),
            F.max("latency_ms").alias("slowest"),
        )
    )
    per_client = per_template.groupBy(
        F.window(F.window_time("w"), window).alias("w"), "ip_hash"
    ).agg(
        F.sum("n").alias("request_count"),
        F.count("endpoint_template").alias("unique_endpoint_count"),
        F.sum("suspicious").alias("suspicious_path_count"),
        F.sum("errors").alias("error_count"),
        F.max("slowest").alias("max_latency_ms"),
    )
    return per_client.select(F.col("w.start").alias("window_start"), *per_client.columns[1:])


COUNTERS = ("request_count", "unique_endpoint_count", "suspicious_path_count", "error_count")


def window_counters(rows: DataFrame, window: str = FIVE_MINUTES) -> DataFrame:
    """The counts of ``live_counters`` from a table that holds a request once."""
    per_template = (
        rows.where(F.col("ip_hash").isNotNull())
        .groupBy(window_start(F.col("timestamp"), window).alias("window_start"), "ip_hash", "endpoint_template")
        .agg(
            F.count("*").alias("n"),
            F.count_if("has_suspicious_path_pattern").alias("suspicious"),
            F.count_if(F.col("status_family").isin("4xx", "5xx")).alias("errors"),
            F.max("latency_ms").alias("slowest"),
        )
    )
    return per_template.groupBy("window_start", "ip_hash").agg(
        F.sum("n").alias("request_count"),
        F.count("endpoint_template").alias("unique_endpoint_count"),
        F.sum("suspicious").alias("suspicious_path_count"),
        F.sum("errors").alias("error_count"),
        F.max("slowest").alias("max_latency_ms"),
    )


def refresh_counters(spark: SparkSession, log_path: str, counter_path: str, windows: DataFrame, window: str = FIVE_MINUTES) -> None:
    """Count the given windows anew from the log table; a client that left a window gets counts of 0."""
    last = F.to_date(F.col("window_start") + F.expr(f"interval {window}") - F.expr("interval 1 microsecond"))
    days = [r.d for r in windows.select(F.explode(F.sequence(F.to_date("window_start"), last)).alias("d")).distinct().collect()]
    if not days:
        return
    logs = read_table(spark, log_path, parts=days).withColumn("window_start", window_start(F.col("timestamp"), window))
    fresh = window_counters(logs.join(windows, "window_start", "left_semi").drop("window_start"), window)
    if table_exists(spark, counter_path):
        keys = ["window_start", "ip_hash"]
        gone = read_table(spark, counter_path, parts=days).join(windows, "window_start", "left_semi").join(fresh.select(*keys), keys, "left_anti")
        zero = [F.lit(0).cast("long").alias(c) for c in COUNTERS]
        fresh = fresh.unionByName(gone.select(*keys, *zero, F.lit(None).cast(dict(fresh.dtypes)["max_latency_ms"]).alias("max_latency_ms")))
    upsert(spark, counter_path, with_day(fresh, "window_start"), ["window_start", "ip_hash"], partition_by=DAY, part_of_key=True)


def start_live_counters(lines: DataFrame, log_path: str, counter_path: str, refused_path: str, salt: str, checkpoint: str, window: str = FIVE_MINUTES) -> StreamingQuery:
    """Counts per window and client after every batch, whatever the order of rows and batches.

    Rows go to the log table by key, and the windows that they touch, or that a
    replaced row leaves, are counted anew from it: no row is too late, and none
    counts twice when a batch or a file is read again. Refused lines go to
    ``refused_path`` (``read_refused``). ``lines`` comes from ``stream_lines``.
    """

    def load(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows, refused = _batch_requests(batch, salt)
        _store_refused(refused, refused_path)
        if rows.isEmpty():
            return
        windows = affected_windows(rows, window)
        if table_exists(spark, log_path):
            replaced = stored_matches(spark, log_path, rows.select(*REQUEST_KEYS), REQUEST_KEYS)
            windows = windows.unionByName(affected_windows(replaced, window)).distinct()
        windows = materialize(windows, "stream-windows")
        rows, ledger = _first_seen(rows, log_path, number)
        load_request_logs(spark, rows, log_path, ledger)
        refresh_counters(spark, log_path, counter_path, windows, window)

    return (
        lines.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_counters(spark: SparkSession, counter_path: str) -> DataFrame:
    """The counts as they are now."""
    return read_table(spark, counter_path).where("request_count > 0").drop(DAY)
