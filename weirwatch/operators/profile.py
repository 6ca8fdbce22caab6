"""Data-quality profile of a log: scalar metrics and top values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weirwatch.fixed_values import TOP_VALUES
from weirwatch.functions.casts import lenient_double, none_if_empty
from weirwatch.operators.whole_quantiles import whole_quantiles

# What each kind of log reports: (metric, column).
PROFILES = {
    "request": {
        "missing": [
            ("missing_timestamp", "timestamp"),
            ("missing_ip_hash", "ip_hash"),
            ("missing_endpoint_template", "endpoint_template"),
        ],
        "unique": [
            ("unique_ip_hashes", "ip_hash"),
            ("unique_endpoint_templates", "endpoint_template"),
        ],
        "flags": [
            ("suspicious_path_rows", "has_suspicious_path_pattern"),
            ("sensitive_query_rows", "has_sensitive_query_key"),
        ],
        "duration": ("latency", "latency_ms"),
        "sizes": [("response_size_avg", "response_size")],
        "top": ["status_family", "method", "module_id", "endpoint_group", "user_agent_category"],
    },
    "app": {
        "missing": [
            ("missing_timestamp", "timestamp"),
            ("missing_user_id_hash", "user_id_hash"),
            ("missing_tenant_hash", "tenant_hash"),
            ("missing_endpoint_template", "endpoint_template"),
        ],
        "unique": [
            ("unique_user_hashes", "user_id_hash"),
            ("unique_tenant_hashes", "tenant_hash"),
            ("unique_endpoint_templates", "endpoint_template"),
        ],
        "flags": [
            ("error_rows", "has_error"),
            ("suspicious_path_rows", "has_suspicious_path_pattern"),
            ("request_sensitive_key_rows", "request_data_has_sensitive_key"),
        ],
        "duration": ("response_time", "response_time_ms"),
        "sizes": [],
        "top": ["level", "method", "status_family", "endpoint_group"],
    },
}


def _text(value: Column) -> Column:
    return none_if_empty(value.cast("string"))


def _number(df: DataFrame, column: str) -> Column:
    """A numeric column as it is; text is parsed and bad text left out."""
    if dict(df.dtypes)[column] == "string":
        return lenient_double(F.col(column))
    return F.col(column).cast("double")


def nearest_rank_p95(df: DataFrame, column: str, out: str = "p95") -> DataFrame:
    """Value at 0-based rank ``0.95 * (n - 1)``, rounded half to even."""
    found = whole_quantiles(df, {out: (_number(df, column), 0.95, "nearest")})[out]
    return df.sparkSession.createDataFrame([] if found is None else [(found,)], f"{out} DOUBLE")


def profile(df: DataFrame, kind: str, dataset: str) -> DataFrame:
    """One row with all scalar metrics of a log, in report order."""
    spec = PROFILES[kind]
    name, duration = spec["duration"]
    stamp = F.col("timestamp")
    if dict(df.dtypes)["timestamp"] == "string":
        stamp = F.try_to_timestamp(none_if_empty(stamp))
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    tail = F.lit(whole_quantiles(df, {"v": (_number(df, duration), 0.95, "nearest")})["v"]).cast("double")
    metrics = [
        F.count("*").alias("row_count"),
        F.date_format(F.min(stamp), iso).alias("start_time"),
        F.date_format(F.max(stamp), iso).alias("end_time"),
    ]
    metrics += [F.count_if(_text(F.col(c)).isNull()).alias(m) for m, c in spec["missing"]]
    metrics += [F.count_distinct(_text(F.col(c))).alias(m) for m, c in spec["unique"]]
    metrics += [F.count_if(F.col(c)).alias(m) for m, c in spec["flags"]]
    value = _number(df, duration)
    unit = f"{name}_{{}}_ms"
    metrics += [
        F.bround(F.avg(value), 3).alias(unit.format("avg")),
        F.max(value).alias(unit.format("max")),
    ]
    metrics += [F.bround(F.avg(_number(df, c)), 3).alias(m) for m, c in spec["sizes"]]
    row = df.agg(*metrics).withColumns(
        {
            "dataset": F.lit(dataset),
            "column_count": F.lit(len(df.columns)),
            unit.format("p95"): tail,
        }
    )
    order = ["dataset", "row_count", "column_count", "start_time", "end_time"]
    order += [m for part in ("missing", "unique", "flags") for m, _ in spec[part]]
    order += [unit.format(k) for k in ("avg", "p95", "max")] + [m for m, _ in spec["sizes"]]
    return row.select(*order)


def metric_rows(summary: DataFrame) -> DataFrame:
    """A profile row as ``dataset, metric, value`` text rows; null stays null."""
    names = [c for c in summary.columns if c != "dataset"]
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("metric"), F.col(c).cast("string").alias("value"))
            for c in names
        ]
    )
    return summary.select("dataset", F.inline(pairs))


def top_values(df: DataFrame, columns: list[str], limit: int = TOP_VALUES) -> DataFrame:
    """Most frequent values per column; null and empty count as ``missing``.

    All columns are counted in one shuffle on (column, value). The ranking
    window is limited per partition first, so no task gets all values of a
    column. Equal counts are listed by value.
    """
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.coalesce(_text(F.col(c)), F.lit("missing")).alias("value"),
            )
            for c in columns
        ]
    )
    counted = df.select(F.inline(pairs)).groupBy("column_name", "value").agg(F.count("*").alias("rows"))
    order = W.partitionBy("column_name").orderBy(F.col("rows").desc(), F.col("value").asc())
    ranked = counted.withColumn("value_rank", F.row_number().over(order))
    return ranked.where(F.col("value_rank") <= limit)


def profile_top_values(df: DataFrame, kind: str) -> DataFrame:
    return top_values(df, PROFILES[kind]["top"])
