"""Analyst views over the score tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirwatch.fixed_values import (
    ALERT_LIMIT_DEFAULT,
    ALERT_LIMIT_MAX,
    HIGH_ANOMALY_SCORE,
    INCIDENT_LIMIT,
    THREAT_LEVELS,
    TIMELINE_LIMIT,
    TOP_WINDOWS,
)
from weirwatch.functions.windows import window_start
from weirwatch.operators.ranking import top_rows

SERIOUS = ["high", "critical"]
CONTEXT = ["module_id", "endpoint_template", "endpoint_group", "status_family"]


def latest_model_version(scores: DataFrame) -> str:
    """Version of the newest scores; without any it is an error."""
    row = scores.agg(F.max_by("model_version", "scored_at").alias("v")).first()
    if row.v is None:
        raise ValueError("no scores to choose a model version from")
    return row.v


def _of_version(threats: DataFrame, model_version: str | None) -> DataFrame:
    version = model_version or latest_model_version(threats)
    return threats.where(F.col("model_version") == version)


def overview(threats: DataFrame, model_version: str | None = None) -> DataFrame:
    """One row: counts, mean scores, time range and windows per level."""
    version = model_version or latest_model_version(threats)
    rows = _of_version(threats, version)
    levels = []
    for level, _ in THREAT_LEVELS:
        levels += [F.lit(level), F.count_if(F.col("threat_level") == level)]
    return rows.agg(
        F.lit(version).alias("model_version"),
        F.count("*").alias("total_windows"),
        F.count_if(F.col("anomaly_score") >= HIGH_ANOMALY_SCORE).alias("high_anomaly_score_windows"),
        F.count_if("is_security_relevant").alias("security_relevant_windows"),
        F.count_if(F.col("threat_level").isin(SERIOUS)).alias("high_or_critical_windows"),
        F.coalesce(F.avg("anomaly_score"), F.lit(0.0)).alias("avg_anomaly_score"),
        F.coalesce(F.avg("threat_score"), F.lit(0.0)).alias("avg_threat_score"),
        F.min("window_start").alias("first_window"),
        F.max("window_start").alias("last_window"),
        F.create_map(*levels).alias("threat_level_counts"),
    )


def timeline(
    threats: DataFrame,
    model_version: str | None = None,
    limit: int = TIMELINE_LIMIT,
    tz: str = "UTC",
) -> DataFrame:
    """Newest hours that hold windows, newest first."""
    start = F.col("window_start")
    if tz == "UTC":
        bucket = F.date_trunc("hour", start)
    else:
        local = F.from_utc_timestamp(start, tz)
        bucket = F.to_utc_timestamp(F.date_trunc("hour", local), tz)
    hourly = (
        _of_version(threats, model_version)
        .groupBy(bucket.alias("bucket"))
        .agg(
            F.count("*").alias("total_windows"),
            F.count_if("is_security_relevant").alias("security_relevant_windows"),
            F.count_if(F.col("threat_level").isin(SERIOUS)).alias("high_or_critical_windows"),
            F.max("threat_score").alias("max_threat_score"),
            F.max("anomaly_score").alias("max_anomaly_score"),
        )
    )
    return top_rows(hourly, [F.col("bucket").desc()], limit)


@dataclass(frozen=True)
class AlertFilter:
    """Optional equality filters; what is None is not applied."""

    model_version: str | None = None
    threat_level: str | None = None
    security_relevant: bool | None = None
    ip_hash: str | None = None
    limit: int = ALERT_LIMIT_DEFAULT

    def __post_init__(self) -> None:
        if self.threat_level and self.threat_level not in [name for name, _ in THREAT_LEVELS]:
            raise ValueError(f"unknown threat level: {self.threat_level}")

    def conditions(self) -> list[Column]:
        wanted = {
            "threat_level": self.threat_level or None,
            "is_security_relevant": self.security_relevant,
            "ip_hash": self.ip_hash or None,
        }
        return [F.col(name) == F.lit(value) for name, value in wanted.items() if value is not None]


ALERT_ORDER = ["threat_score", "anomaly_score", "window_start"]


def _alert_order() -> list[Column]:
    return [*[F.col(c).desc() for c in ALERT_ORDER], F.col("ip_hash").asc()]


def with_context(alerts: DataFrame, logs: DataFrame, window: str = "5 minutes") -> DataFrame:
    """Add the most frequent route of each alert's window.

    ``alerts`` holds at most ``ALERT_LIMIT_MAX`` rows, so its keys are
    broadcast and the log is filtered as it is scanned. The best route of a
    window is a minimum over (rows, template, ...), which combines partially
    and never gathers the routes of a window in one place. Where the log has a
    day column, the days of the alerts prune its partitions.
    """
    keys = ["window_start", "ip_hash"]
    wanted = alerts.select(*keys)
    rows = logs.withColumn("window_start", window_start(F.col("timestamp"), window))
    if "log_date" in logs.columns:
        # A window may run into later days.
        last = F.to_date(F.col("window_start") + F.expr(f"interval {window}") - F.expr("interval 1 microsecond"))
        wanted = wanted.withColumn("log_date", F.explode(F.sequence(F.to_date("window_start"), last)))
        hits = rows.join(F.broadcast(wanted), [*keys, "log_date"])
    else:
        hits = rows.join(F.broadcast(wanted), keys)
    counted = hits.groupBy(*keys, *CONTEXT).agg(F.count("*").alias("n"))
    # Most rows first, then template order with nulls last; further columns
    # only make the choice definite.
    route = F.struct(
        (-F.col("n")).alias("n"),
        *[
            part
            for c in ["endpoint_template", "module_id", "endpoint_group", "status_family"]
            for part in (F.col(c).isNull().alias(f"{c}_null"), F.col(c).alias(c))
        ],
    )
    best = counted.groupBy(*keys).agg(F.min(route).alias("route"))
    best = best.select(*keys, *[F.col("route")[c].alias(c) for c in CONTEXT])
    # At most one row per alert.
    return alerts.join(F.broadcast(best), keys, "left")


# The columns of an alert.
ALERT_COLUMNS = [
    "window_start",
    "ip_hash",
    "model_version",
    "threat_score",
    "threat_level",
    "is_security_relevant",
    "reasons",
    "anomaly_score",
    "anomaly_rank",
    "request_count",
    "suspicious_path_count",
    "error_count",
    "error_rate",
    "unique_endpoint_count",
    "static_asset_count",
    "off_hours",
]


def alerts(
    threats: DataFrame, logs: DataFrame, filters: AlertFilter = AlertFilter(), window: str = "5 minutes"
) -> DataFrame:
    """Highest threat rows with the main route of their window.

    The limit comes before the join with the log: the join keeps every alert,
    so the result is the same and only a few windows of the log are needed.
    """
    rows = _of_version(threats, filters.model_version)
    conditions = filters.conditions()
    if conditions:
        rows = rows.where(reduce(and_, conditions))
    limit = max(1, min(filters.limit, ALERT_LIMIT_MAX))
    chosen = top_rows(rows.select(*ALERT_COLUMNS), _alert_order(), limit)
    return with_context(chosen, logs, window).orderBy(*_alert_order())


def incident(
    threats: DataFrame, logs: DataFrame, model_version: str | None = None, window: str = "5 minutes", tz: str = "UTC"
) -> DataFrame:
    """Alerts of the latest day that has scores; empty if there are none."""
    rows = _of_version(threats, model_version)
    start = F.col("window_start")
    day = F.to_date(start if tz == "UTC" else F.from_utc_timestamp(start, tz))
    latest = rows.agg(F.max(day).alias("day")).scalar()
    of_day = rows.where(day == latest).select(*ALERT_COLUMNS)
    chosen = top_rows(of_day, _alert_order(), INCIDENT_LIMIT)
    return (
        with_context(chosen, logs, window)
        .withColumn("incident_date", day)
        .orderBy(*_alert_order())
    )


def top_anomalies(scores: DataFrame, features: DataFrame, model_version: str | None = None, limit: int = TOP_WINDOWS) -> DataFrame:
    """Best ranked windows with a few of their features."""
    rows = _of_version(scores, model_version).where(F.col("anomaly_rank") <= limit)
    shown = ["request_count", "suspicious_path_count", "error_rate", "unique_endpoint_count"]
    # The rank filter leaves at most ``limit`` rows.
    return (
        features.select("window_start", "ip_hash", *shown)
        .join(
            F.broadcast(rows.select("window_start", "ip_hash", "anomaly_rank", "anomaly_score")),
            ["window_start", "ip_hash"],
        )
        .orderBy("anomaly_rank")
        .select("anomaly_rank", "window_start", "ip_hash", "anomaly_score", *shown)
    )


def top_threats(threats: DataFrame, model_version: str | None = None, limit: int = TOP_WINDOWS) -> DataFrame:
    rows = _of_version(threats, model_version)
    order = [
        F.col("threat_score").desc(),
        F.col("anomaly_score").desc(),
        F.col("window_start").asc(),
        F.col("ip_hash").asc(),
    ]
    return top_rows(rows.select(*[c for c in ALERT_COLUMNS if c != "model_version"]), order, limit)


def threat_counts(threats: DataFrame) -> DataFrame:
    """Rows scored, relevant rows and high or critical rows of a run."""
    return threats.agg(
        F.count("*").alias("rows_scored"),
        F.count_if("is_security_relevant").alias("security_relevant_rows"),
        F.count_if(F.col("threat_level").isin(SERIOUS)).alias("high_or_critical_rows"),
    )


def anomaly_counts(scores: DataFrame) -> DataFrame:
    """Rows scored, predicted anomalies and their share."""
    return scores.agg(
        F.count("*").alias("rows_scored"),
        F.count_if("is_anomaly").alias("anomaly_rows"),
        F.coalesce(F.avg(F.col("is_anomaly").cast("double")), F.lit(0.0)).alias("anomaly_rate"),
    )


def latest_evaluation_id(metrics: DataFrame) -> str | None:
    """Newest evaluation, None if there is none."""
    return metrics.agg(F.max_by("evaluation_id", "created_at").alias("v")).first().v


def evaluation_summary(
    metrics: DataFrame, scored: DataFrame, evaluation_id: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Metrics and scenario rows of an evaluation; both empty without one."""
    from weirwatch.plans.evaluation import scenario_summary

    chosen = evaluation_id or latest_evaluation_id(metrics)
    is_chosen = F.col("evaluation_id") == F.lit(chosen)
    listed = metrics.where(is_chosen).select(
        "ranking_method", "metric_name", "k_value", "metric_value"
    )
    return (
        listed.orderBy("ranking_method", "metric_name", "k_value"),
        scenario_summary(scored.where(is_chosen)),
    )
