"""JSON-lines and JSON-array scans, and the JSON-lines sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weirwatch.functions.casts import lenient_double, lenient_int, lenient_long, lenient_timestamp
from weirwatch.schemas import APP_LOG, REQUEST_LOG, column_types


def is_json_object(line: Column) -> Column:
    """Whether a line is exactly one JSON object.

    Wrapping the line in another object makes the parser read to its end, so
    text after the object, or a second object, is seen too.
    """
    wrapped = F.json_object_keys(F.concat(F.lit('{"r":'), line, F.lit("}")))
    return F.coalesce(
        F.json_object_keys(line).isNotNull() & (wrapped == F.array(F.lit("r"))),
        F.lit(False),
    )


def scan_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Non-blank lines with the place they come from.

    ``load_order`` sorts lines as files and lines follow each other, which is
    what last-write-wins and first-write-wins loads go by.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("scan_id"),
    )
    return lines.withColumn(
        "load_order", F.struct("modified", "file_path", "block_start", "scan_id")
    )


def is_blank(line: Column) -> Column:
    return F.trim(F.translate(line, "\t\r\n\f", "    ")) == ""


def read_entries(spark: SparkSession, path: str | list[str], mode: str = "failfast") -> DataFrame:
    """Lines that hold one JSON object each, as ``value`` and ``load_order``.

    ``failfast`` makes the reading job fail on a bad line and name its file;
    :func:`bad_lines` then lists file and line numbers. ``quarantine`` leaves
    bad lines out, to be kept aside with :func:`bad_lines`.
    """
    if mode not in ("failfast", "quarantine"):
        raise ValueError(f"unknown mode: {mode}")
    lines = scan_lines(spark, path).where(~is_blank(F.col("value")))
    good = is_json_object(F.col("value"))
    if mode == "failfast":
        where = F.concat(
            F.lit("not one JSON object: a line of "), F.col("file_path"),
            F.lit(", split at byte "), F.col("block_start"),
        )
        good = F.when(good, F.lit(True)).otherwise(F.raise_error(where).cast("boolean"))
    return lines.where(good).select("value", "load_order")


def bad_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines that are not one JSON object, with file name and line number.

    A big file is read in splits by many tasks. Lines are counted per split,
    the counts are summed along the file, and only bad lines join the sums.
    """
    lines = scan_lines(spark, path)
    splits = lines.groupBy("file_path", "block_start").agg(
        F.min("scan_id").alias("first_id"), F.count("*").alias("n")
    )
    along = W.partitionBy("file_path").orderBy("block_start")
    splits = splits.withColumn(
        "before", F.sum("n").over(along.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("n")
    )
    value = F.col("value")
    bad = lines.where(~is_blank(value) & ~is_json_object(value))
    return bad.join(splits, ["file_path", "block_start"]).select(
        "file_path",
        (F.col("before") + F.col("scan_id") - F.col("first_id") + 1).alias("line_number"),
        F.when(_is_whole_json(value), F.lit("Expected JSON object"))
        .otherwise(F.lit("Invalid JSON"))
        .alias("problem"),
        "value",
    )


def _is_whole_json(line: Column) -> Column:
    wrapped = F.json_object_keys(F.concat(F.lit('{"r":'), line, F.lit("}")))
    return F.coalesce(wrapped == F.array(F.lit("r")), F.lit(False))


def read_array_file(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Entries of files that hold one JSON array each.

    A JSON array cannot be split, so each file is one task; exports meant for
    scale should be JSON lines. A file that is no JSON array is an error that
    names it.
    """
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    parsed = F.from_json("value", "ARRAY<VARIANT>")
    broken = F.raise_error(F.concat(F.lit("not a JSON array: "), F.col("file")))
    entries = F.when(parsed.isNull(), broken.cast("ARRAY<VARIANT>")).otherwise(parsed)
    return files.select(F.explode(entries).alias("entry")).select(
        F.to_json("entry").alias("value"), F.monotonically_increasing_id().alias("load_order")
    )


_CASTS = {
    "TIMESTAMP": lenient_timestamp,
    "INT": lenient_int,
    "BIGINT": lenient_long,
    "DOUBLE": lenient_double,
    "BOOLEAN": lambda c: c.try_cast("boolean"),
    "STRING": lambda c: c,
}


def _typed(entries: DataFrame, schema: str) -> DataFrame:
    types = column_types(schema)
    text_schema = ", ".join(f"{name} STRING" for name in types)
    row = entries.withColumn("row", F.from_json("value", text_schema))
    return row.select(
        *[_CASTS[kind](F.col("row")[name]).alias(name) for name, kind in types.items()],
        "load_order",
        F.col("value").alias("raw_record"),
    )


def read_request_log(spark: SparkSession, path: str | list[str], mode: str = "failfast") -> DataFrame:
    """Generalised request log lines, typed; bad values become null."""
    return _typed(read_entries(spark, path, mode), REQUEST_LOG)


def read_app_log(spark: SparkSession, path: str | list[str], mode: str = "failfast") -> DataFrame:
    """Generalised application log lines, typed; bad values become null."""
    return _typed(read_entries(spark, path, mode), APP_LOG)


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per line; null keys and fractions of seconds are kept."""
    options = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    df.write.mode(mode).options(**options).json(path)
