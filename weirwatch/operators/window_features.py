"""Behavioural features per fixed time window and entity.

A window of one entity may hold a large part of all rows, so nothing here
keeps a group's rows or values together. Rows are first collapsed to one per
combination of window, entity and the columns counted distinctly; partial
aggregation does most of that before the shuffle. Sums, maxima and distinct
counts are taken from the collapsed rows, and the 95th percentile comes from
:mod:`weirwatch.operators.quantiles`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirwatch.functions.casts import safe_ratio
from weirwatch.functions.windows import off_hours, window_start
from weirwatch.operators.quantiles import exact_quantile

FIVE_MINUTES = "5 minutes"


@dataclass(frozen=True)
class FeatureSpec:
    """What to count for one kind of log."""

    entity: str
    count_name: str
    distinct: dict[str, str]
    flags: dict[str, Callable[[], Column]]
    error_flag: str
    duration: str
    sizes: dict[str, str] = field(default_factory=dict)
    rarity: bool = False


def _family(*names: str) -> Callable[[], Column]:
    return lambda: F.col("status_family").isin(*names)


def _flag(name: str) -> Callable[[], Column]:
    return lambda: F.col(name)


REQUESTS = FeatureSpec(
    entity="ip_hash",
    count_name="request_count",
    distinct={
        "endpoint_template": "unique_endpoint_count",
        "endpoint_group": "unique_endpoint_group_count",
        "method": "unique_method_count",
        "user_agent_category": "unique_user_agent_category_count",
    },
    flags={
        "static_asset_count": _flag("is_static_asset"),
        "suspicious_path_count": _flag("has_suspicious_path_pattern"),
        "sensitive_query_count": _flag("has_sensitive_query_key"),
        "status_2xx_count": _family("2xx"),
        "status_3xx_count": _family("3xx"),
        "status_4xx_count": _family("4xx"),
        "status_5xx_count": _family("5xx"),
        "error_count": _family("4xx", "5xx"),
    },
    error_flag="error_count",
    duration="latency_ms",
    sizes={"response_size": "avg_response_size"},
    rarity=True,
)

APP_EVENTS = FeatureSpec(
    entity="user_id_hash",
    count_name="event_count",
    distinct={
        "tenant_hash": "unique_tenant_count",
        "endpoint_template": "unique_endpoint_count",
        "endpoint_group": "unique_endpoint_group_count",
        "method": "unique_method_count",
    },
    flags={
        "suspicious_path_count": _flag("has_suspicious_path_pattern"),
        "error_count": _flag("has_error"),
        "status_2xx_count": _family("2xx"),
        "status_4xx_count": _family("4xx"),
        "request_sensitive_key_count": _flag("request_data_has_sensitive_key"),
        "response_sensitive_key_count": _flag("response_data_has_sensitive_key"),
        "header_sensitive_key_count": _flag("headers_has_sensitive_key"),
    },
    error_flag="error_count",
    duration="response_time_ms",
)


def endpoint_frequency(logs: DataFrame) -> DataFrame:
    """Rows per endpoint template over all logs, null template included."""
    return logs.groupBy("endpoint_template").agg(F.count("*").alias("endpoint_count"))


def endpoint_rarity(logs: DataFrame) -> DataFrame:
    """``-ln(share of all rows)`` per template.

    The total is a scalar subquery over the frequencies, so it is one number in
    the plan, no row is paired with another, and one exchange serves both.
    """
    frequency = endpoint_frequency(logs)
    total = frequency.agg(F.sum("endpoint_count").cast("double").alias("n")).scalar()
    return frequency.withColumn(
        "endpoint_rarity", -F.log(F.col("endpoint_count") / F.nullif(total, F.lit(0.0)))
    )


def _sum_and_count(value: Column, name: str) -> list[Column]:
    return [F.sum(value).alias(f"_{name}_sum"), F.count(value).alias(f"_{name}_n")]


def _mean(name: str) -> Column:
    total, n = F.sum(f"_{name}_sum"), F.sum(f"_{name}_n")
    return total / F.nullif(n.cast("double"), F.lit(0.0))


def window_features(
    logs: DataFrame,
    spec: FeatureSpec,
    window: str = FIVE_MINUTES,
    tz: str = "UTC",
    p95: str = "exact",
    rarity: DataFrame | None = None,
) -> DataFrame:
    """One row per window and entity; rows without the entity are left out.

    ``rarity`` replaces the endpoint rarity of ``logs`` by a given table, for
    refreshing a few windows without a pass over the whole log. ``p95`` may be
    ``approximate`` for the built-in sketch.
    """
    if p95 not in ("exact", "approximate"):
        raise ValueError(f"unknown p95: {p95}")
    keys = ["window_start", spec.entity]
    rows = logs.where(F.col(spec.entity).isNotNull() & F.col("timestamp").isNotNull())
    rows = rows.withColumn("window_start", window_start(F.col("timestamp"), window))

    duration = F.col(spec.duration).cast("double")
    partial = [F.count("*").alias("_rows"), F.max(duration).alias("_longest")]
    partial += _sum_and_count(duration, "duration")
    for column in spec.sizes:
        partial += _sum_and_count(F.col(column).cast("double"), column)
    partial += [F.count_if(make()).alias(name) for name, make in spec.flags.items()]
    detail = rows.groupBy(*keys, *spec.distinct).agg(*partial)

    if spec.rarity:
        rarity = endpoint_rarity(logs) if rarity is None else rarity
        detail = detail.join(
            rarity.select("endpoint_template", "endpoint_rarity"), "endpoint_template", "left"
        ).withColumns(
            {
                "_rarity_sum": F.col("endpoint_rarity") * F.col("_rows"),
                "_rarity_n": F.when(F.col("endpoint_rarity").isNotNull(), F.col("_rows")),
            }
        )

    suffix = spec.duration
    final = [F.sum("_rows").alias(spec.count_name)]
    final += [F.count_distinct(F.col(c)).alias(name) for c, name in spec.distinct.items()]
    final += [F.sum(name).alias(name) for name in spec.flags]
    final += [_mean("duration").alias(f"avg_{suffix}"), F.max("_longest").alias(f"max_{suffix}")]
    final += [_mean(c).alias(name) for c, name in spec.sizes.items()]
    if spec.rarity:
        final.append(_mean("rarity").alias("avg_endpoint_rarity"))
    features = detail.groupBy(*keys).agg(*final)

    if p95 == "exact":
        tail = exact_quantile(rows, keys, spec.duration, 0.95, f"p95_{suffix}")
    else:
        tail = rows.groupBy(*keys).agg(
            F.percentile_approx(duration, 0.95, 10_000).alias(f"p95_{suffix}")
        )
    features = features.join(tail, keys, "left").withColumns(
        {
            "error_rate": safe_ratio(F.col(spec.error_flag), F.col(spec.count_name)),
            "off_hours": off_hours(F.col("window_start"), tz),
        }
    )
    return features.select(*keys, *feature_columns(spec))


def feature_columns(spec: FeatureSpec) -> list[str]:
    """Feature names in table order."""
    names = [spec.count_name, *spec.distinct.values()]
    for flag in spec.flags:
        names.append(flag)
        if flag == spec.error_flag:
            names.append("error_rate")
    names += [f"{kind}_{spec.duration}" for kind in ("avg", "p95", "max")]
    names += list(spec.sizes.values())
    if spec.rarity:
        names.append("avg_endpoint_rarity")
    return [*names, "off_hours"]


def ip_window_features(
    logs: DataFrame, window: str = FIVE_MINUTES, tz: str = "UTC", **options
) -> DataFrame:
    """Twenty features per client and window of the request log."""
    return window_features(logs, REQUESTS, window, tz, **options)


def user_window_features(
    logs: DataFrame, window: str = FIVE_MINUTES, tz: str = "UTC", **options
) -> DataFrame:
    """Features per user and window of the application log."""
    return window_features(logs, APP_EVENTS, window, tz, **options)


def feature_summary(request_features: DataFrame, app_features: DataFrame) -> DataFrame:
    """Row counts and maxima of both feature tables, in one row."""
    apps = app_features.agg(
        F.count("*").alias("rows"),
        F.max("event_count").alias("events"),
        F.max("error_count").alias("errors"),
    ).agg(F.first(F.struct("rows", "events", "errors")).alias("app"))
    app = apps.scalar()
    return request_features.agg(
        F.count("*").alias("request_feature_rows"),
        F.max("request_count").alias("max_request_count"),
        F.max("suspicious_path_count").alias("max_suspicious_path_count"),
    ).select(
        "request_feature_rows",
        app["rows"].alias("app_feature_rows"),
        "max_request_count",
        "max_suspicious_path_count",
        app["events"].alias("max_app_event_count"),
        app["errors"].alias("max_app_error_count"),
    )
