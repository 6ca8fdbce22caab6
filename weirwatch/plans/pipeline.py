"""The refresh chain: features, model, scores, threats, evaluation."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirwatch.operators.forest import fit_forest, load_forest, save_forest, score_forest
from weirwatch.operators.threat import score_threats
from weirwatch.operators.window_features import ip_window_features, user_window_features
from weirwatch.plans.evaluation import evaluation_metrics, score_scenarios
from weirwatch.plans.scenarios import scenarios
from weirwatch.plans.views import latest_model_version
from weirwatch.sources.tables import DAY, read_table, upsert, with_day

FEATURE_KEYS = ["window_start", "ip_hash"]
USER_KEYS = ["window_start", "user_id_hash"]
SCORE_KEYS = ["window_start", "ip_hash", "model_version"]
SCENARIO_KEYS = ["evaluation_id", "synthetic_id"]
METRIC_KEYS = ["evaluation_id", "ranking_method", "metric_name", "k_value"]


@dataclass(frozen=True)
class Warehouse:
    """Paths of the tables below one root."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"


def stamp_id(prefix: str, now: datetime | None = None) -> str:
    """Version or evaluation id from the UTC time."""
    return f"{prefix}_{(now or datetime.now(timezone.utc)).strftime('%Y%m%d_%H%M%S')}"


def build_features(
    spark: SparkSession, wh: Warehouse, window: str = "5 minutes", tz: str = "UTC", rebuild: bool = False
) -> None:
    """Feature tables from the log tables. Without ``rebuild`` old windows stay."""
    for name, log, keys, build in (
        ("request_features", "request_logs", FEATURE_KEYS, ip_window_features),
        ("app_features", "app_logs", USER_KEYS, user_window_features),
    ):
        try:
            logs = read_table(spark, wh.path(log))
        except FileNotFoundError:
            continue
        rows = with_day(build(logs, window, tz), "window_start")
        upsert(spark, wh.path(name), rows, keys, partition_by=DAY, rebuild=rebuild, part_of_key=True)


def train(
    spark: SparkSession,
    wh: Warehouse,
    model_version: str | None = None,
    contamination: str | float = "auto",
    **options,
) -> str:
    """Train on the feature table, store the model and the scores."""
    version = model_version or stamp_id("request_iforest")
    features = read_table(spark, wh.path("request_features"))
    forest = fit_forest(features, version, contamination, **options)
    save_forest(forest, wh.path("models"))
    scores = score_forest(features, forest).withColumn("scored_at", F.current_timestamp())
    upsert(spark, wh.path("anomaly_scores"), scores, SCORE_KEYS, partition_by="model_version")
    return version


def score_windows(spark: SparkSession, wh: Warehouse, model_version: str | None = None) -> str:
    """Threat scores of a model's windows; none to score is an error."""
    scores = read_table(spark, wh.path("anomaly_scores"))
    version = model_version or latest_model_version(scores)
    chosen = scores.where(F.col("model_version") == version)
    threats = score_threats(chosen, read_table(spark, wh.path("request_features")))
    threats = threats.withColumn("scored_at", F.current_timestamp())
    done = upsert(spark, wh.path("threat_scores"), threats, SCORE_KEYS, partition_by="model_version")
    if done == 0:
        raise ValueError(f"no scored windows for model version {version}")
    return version


def evaluate(
    spark: SparkSession,
    wh: Warehouse,
    model_version: str | None = None,
    rows_per_scenario: int = 100,
    evaluation_id: str | None = None,
) -> str:
    """Score synthetic scenarios with a stored model and store the metrics."""
    scores = read_table(spark, wh.path("anomaly_scores"))
    version = model_version or latest_model_version(scores)
    forest = load_forest(spark, wh.path("models"), version)
    features = read_table(spark, wh.path("request_features"))
    run = evaluation_id or stamp_id("synthetic_eval")
    scored = score_scenarios(scenarios(features, rows_per_scenario), features, forest)
    stamped = scored.withColumns(
        {
            "evaluation_id": F.lit(run),
            "model_version": F.lit(version),
            "created_at": F.current_timestamp(),
        }
    )
    upsert(spark, wh.path("scenario_scores"), stamped, SCENARIO_KEYS)
    metrics = evaluation_metrics(scored, run, version)
    metrics = metrics.withColumn("created_at", F.current_timestamp())
    upsert(spark, wh.path("scenario_metrics"), metrics, METRIC_KEYS)
    return run


def run_pipeline(
    spark: SparkSession, wh: Warehouse, model_version: str | None = None, **options
) -> DataFrame:
    """Rebuild everything from the log tables; returns the threat table."""
    build_features(spark, wh, rebuild=True)
    version = train(spark, wh, model_version, **options)
    score_windows(spark, wh, version)
    evaluate(spark, wh, version)
    return read_table(spark, wh.path("threat_scores")).where(F.col("model_version") == version)
