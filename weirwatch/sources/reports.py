"""Report sinks: metric CSV and short Markdown tables.

Reports are small by definition: scalar metrics, top-n rows and counts per
level. Only those reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirwatch.operators.profile import metric_rows, profile, profile_top_values
from weirwatch.operators.threat import threat_level_counts
from weirwatch.plans.views import anomaly_counts, threat_counts, top_anomalies, top_threats

MAX_REPORT_ROWS = 1000


def write_metric_csv(summary: DataFrame, path: str) -> None:
    """A profile row as ``metric,value`` lines; null becomes empty."""
    named = summary.select(F.col("dataset").alias("_d"), "*")
    first = named.select(F.lit("dataset").alias("metric"), F.col("_d").alias("value"))
    rows = first.unionByName(metric_rows(summary).drop("dataset"))
    rows.coalesce(1).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def read_metric_csv(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """The lines back as ``dataset, metric, value`` rows."""
    rows = spark.read.schema("metric STRING, value STRING").option("header", True).csv(path)
    return rows.select(F.lit(dataset).alias("dataset"), "metric", "value")


def markdown_table(df: DataFrame, limit: int = MAX_REPORT_ROWS) -> str:
    """A small result as a Markdown table; more than ``limit`` rows are an error, never cut."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"a report table has more than {limit} rows")
    lines = ["| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    for row in rows:
        cells = [", ".join(v) if isinstance(v, list) else "" if v is None else str(v) for v in row]
        lines.append("| " + " | ".join(cells) + " |")
    return "\n".join(lines)


def quality_report(logs: DataFrame, kind: str, dataset: str) -> str:
    top = profile_top_values(logs, kind).orderBy("column_name", "value_rank")
    parts = [f"# Quality of {dataset}", markdown_table(metric_rows(profile(logs, kind, dataset)))]
    return "\n\n".join([*parts, "## Top values", markdown_table(top)]) + "\n"


def model_report(scores: DataFrame, features: DataFrame, model_version: str) -> str:
    of_version = scores.where(F.col("model_version") == model_version)
    parts = [
        f"# Model {model_version}",
        markdown_table(anomaly_counts(of_version)),
        "## Top windows",
        markdown_table(top_anomalies(of_version, features, model_version)),
    ]
    return "\n\n".join(parts) + "\n"


def threat_report(threats: DataFrame, model_version: str) -> str:
    of_version = threats.where(F.col("model_version") == model_version)
    parts = [
        f"# Threats of {model_version}",
        markdown_table(threat_counts(of_version)),
        "## Levels",
        markdown_table(threat_level_counts(of_version)),
        "## Top windows",
        markdown_table(top_threats(of_version, model_version)),
    ]
    return "\n\n".join(parts) + "\n"


def evaluation_report(metrics: DataFrame, summary: DataFrame, evaluation_id: str) -> str:
    of_run = metrics.select("ranking_method", "metric_name", "k_value", "metric_value")
    order = ["ranking_method", "metric_name", "k_value"]
    parts = [
        f"# Evaluation {evaluation_id}",
        "## Precision and recall",
        markdown_table(of_run.where("k_value > 0").orderBy(*order)),
        "## Flags",
        markdown_table(of_run.where("k_value = 0").orderBy(*order)),
        "## Scenarios",
        markdown_table(summary),
    ]
    return "\n\n".join(parts) + "\n"


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """Store a report as one text file in a folder."""
    spark.createDataFrame([(text,)], "value STRING").coalesce(1).write.mode("overwrite").text(path)
