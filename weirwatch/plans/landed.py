"""Pulls from a folder of landed JSON-lines files that open only files with entries in range.

A table beside the log names every landed file with its least and greatest
entry time. It is kept up by reading files that are new or have changed, once;
a pull from a mark then opens the files whose entries reach it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirwatch.fixed_values import FRESHNESS_MINUTES, OVERLAP_MINUTES
from weirwatch.plans import ingest
from weirwatch.sources.jsonl import is_blank, read_entries
from weirwatch.sources.tables import read_table, table_exists, upsert

FILE_KEYS = ["file_path"]
# What tells one state of a file from another.
_STATE = ["file_path", "modified", "n_bytes"]


def landed_files(spark: SparkSession, folder: str | list[str]) -> DataFrame:
    """``file_path, modified, n_bytes`` of the files in a folder; no content is read."""
    meta = F.col("_metadata")
    return spark.read.format("binaryFile").load(folder).select(
        meta["file_path"].alias("file_path"), meta["file_modification_time"].alias("modified"), meta["file_size"].alias("n_bytes")
    )


def refresh_file_times(spark: SparkSession, folder: str | list[str], index_path: str) -> int:
    """Index the files that are new or have changed; returns how many. Files that are gone stay listed, which harms no pull.

    The driver gets the names of these files alone, as any read of a folder lists them.
    """
    files = landed_files(spark, folder)
    if table_exists(spark, index_path):
        files = files.join(read_table(spark, index_path).select(*_STATE), _STATE, "left_anti")
    new = [tuple(r) for r in files.collect()]
    if not new:
        return 0
    lines = spark.read.text([path for path, _, _ in new]).where(~is_blank(F.col("value")))
    moment = ingest.entry_timestamp()
    times = lines.select(F.col("_metadata.file_path").alias("file_path"), moment.alias("moment")).groupBy("file_path").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(F.col("moment").isNull()).alias("n_untimed"),
        F.min("moment").alias("low"),
        F.max("moment").alias("high"),
    )
    listed = spark.createDataFrame(new, "file_path STRING, modified TIMESTAMP, n_bytes BIGINT")
    rows = listed.join(times, "file_path", "left").fillna(0, ["n_lines", "n_untimed"])
    upsert(spark, index_path, rows, FILE_KEYS)
    return len(new)


def files_since(spark: SparkSession, folder: str | list[str], index_path: str, since: Column | None) -> list[str]:
    """Landed files that can have an entry from ``since`` on; all without it.

    A file that the index does not know in its present state is among them,
    and one with lines that have no readable time, as a pull must tell of these.
    """
    files = landed_files(spark, folder)
    if since is not None and table_exists(spark, index_path):
        known = read_table(spark, index_path)
        early = known.where((F.col("n_untimed") == 0) & ((F.col("n_lines") == 0) | (F.col("high") < since)))
        files = files.join(early.select(*_STATE), _STATE, "left_anti")
    return sorted(r.file_path for r in files.select("file_path").collect())


def pull_landed(
    spark: SparkSession,
    folder: str | list[str],
    index_path: str,
    log_path: str,
    state_path: str,
    salt: str,
    source: str = "requests",
    mode: str = "failfast",
    overlap_minutes: int = OVERLAP_MINUTES,
    freshness_minutes: int | None = FRESHNESS_MINUTES,
    now: Column | None = None,
    **options,
) -> int:
    """:func:`weirwatch.plans.ingest.ingest_requests` from a folder; the rows loaded are those of a pull that reads all files.

    ``mode`` is that of :func:`weirwatch.sources.jsonl.read_entries`, for the
    files that are opened.
    """
    refresh_file_times(spark, folder, index_path)
    mark = ingest.high_water_mark(spark, state_path, log_path, source)
    since = None
    if mark is not None or freshness_minutes is not None:
        since = ingest.pulled_from(mark, overlap_minutes, freshness_minutes, now)
    files = files_since(spark, folder, index_path, since)
    if not files:
        return 0
    entries = read_entries(spark, files, mode)
    return ingest.ingest_requests(
        spark, entries, log_path, state_path, salt, source, overlap_minutes=overlap_minutes, freshness_minutes=freshness_minutes, now=now, **options
    )
