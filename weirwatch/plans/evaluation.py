"""Evaluation of the ranking on labelled scenario rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirwatch.fixed_values import EVALUATION_KS, REQUEST_FEATURES
from weirwatch.operators.forest import Forest, raw_scores
from weirwatch.operators.ranking import global_rank, min_max
from weirwatch.operators.threat import threat_score
from weirwatch.session import materialize

# Names of the rankings and flags in the metric table.
RANKINGS = [("anomaly_only", "anomaly_rank"), ("anomaly_plus_threat_score", "threat_rank")]
FLAGS = [("anomaly_only_flag", "is_anomaly"), ("threat_score_flag", "is_security_relevant")]

GENERATION_ORDER = ["scenario_index", "row_index"]


def score_scenarios(synthetic: DataFrame, features: DataFrame, forest: Forest) -> DataFrame:
    """Score scenario rows with a stored model.

    The anomaly score is scaled over real and scenario rows together, as a
    scenario must be judged against real traffic.
    """
    extra = [c for c in synthetic.columns if c not in REQUEST_FEATURES]
    real = features.select(*REQUEST_FEATURES, F.lit(False).alias("_synthetic"))
    both = real.unionByName(synthetic.withColumn("_synthetic", F.lit(True)), allowMissingColumns=True)
    raw = materialize(
        raw_scores(both, forest).select(
            *extra, *REQUEST_FEATURES, "_synthetic", "raw_decision_score"
        ),
        "evaluation-scores",
    )
    scaled = min_max(raw, -F.col("raw_decision_score"), "anomaly_score")
    kept = scaled.where(F.col("_synthetic")).drop("_synthetic")
    kept = kept.withColumn("is_anomaly", F.col("raw_decision_score") < 0)
    return rank_scenarios(threat_score(kept))


def rank_scenarios(scored: DataFrame) -> DataFrame:
    """Ranks by anomaly and by threat score; ties keep generation order."""
    ties = [F.col(c).asc() for c in GENERATION_ORDER]
    ranked = global_rank(scored, [F.col("anomaly_score").desc(), *ties], "anomaly_rank")
    return global_rank(ranked, [F.col("threat_score").desc(), *ties], "threat_rank")


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), F.lit(0.0))


def _metric(method: str, name: str, k: int, value: Column) -> Column:
    return F.struct(
        F.lit(method).alias("ranking_method"),
        F.lit(name).alias("metric_name"),
        F.lit(k).alias("k_value"),
        value.alias("metric_value"),
    )


def ranking_metrics(scored: DataFrame, ks: list[int] = EVALUATION_KS) -> DataFrame:
    """Precision and recall at k of both rankings, from one aggregation."""
    attack = F.col("is_attack_like")
    counts = [F.count("*").alias("n"), F.count_if(attack).alias("attacks")]
    counts += [
        F.count_if(attack & (F.col(rank) <= k)).alias(f"{rank}_{k}") for _, rank in RANKINGS for k in ks
    ]
    metrics = []
    for method, rank in RANKINGS:
        for k in ks:
            hits = F.col(f"{rank}_{k}")
            seen = F.least(F.lit(k), F.col("n"))
            metrics.append(_metric(method, "precision_at_k", k, _ratio(hits, seen)))
            metrics.append(_metric(method, "recall_at_k", k, _ratio(hits, F.col("attacks"))))
    return scored.agg(*counts).select(F.inline(F.array(*metrics)))


def flag_metrics(scored: DataFrame) -> DataFrame:
    """Precision, recall and false positives of both flags."""
    attack = F.col("is_attack_like")
    counts = []
    for _, flag in FLAGS:
        hit = F.col(flag)
        counts += [
            F.count_if(hit & attack).alias(f"{flag}_tp"),
            F.count_if(hit & ~attack).alias(f"{flag}_fp"),
            F.count_if(~hit & attack).alias(f"{flag}_fn"),
            F.count_if(~hit & ~attack).alias(f"{flag}_tn"),
        ]
    metrics = []
    for method, flag in FLAGS:
        tp, fp, fn, tn = (F.col(f"{flag}_{part}") for part in ("tp", "fp", "fn", "tn"))
        values = {
            "precision": _ratio(tp, tp + fp),
            "recall": _ratio(tp, tp + fn),
            "false_positive_rate": _ratio(fp, fp + tn),
            "predicted_positive_count": (tp + fp).cast("double"),
            "false_positive_count": fp.cast("double"),
        }
        metrics += [_metric(method, name, 0, value) for name, value in values.items()]
    return scored.agg(*counts).select(F.inline(F.array(*metrics)))


def evaluation_metrics(scored: DataFrame, evaluation_id: str, model_version: str) -> DataFrame:
    rows = ranking_metrics(scored).unionByName(flag_metrics(scored))
    return rows.select(
        F.lit(evaluation_id).alias("evaluation_id"),
        F.lit(model_version).alias("model_version"),
        "ranking_method",
        "metric_name",
        "k_value",
        "metric_value",
    )


def scenario_summary(scored: DataFrame) -> DataFrame:
    """Per scenario: rows, mean scores and relevant rows; attacks first."""
    return (
        scored.groupBy("scenario_name", "is_attack_like")
        .agg(
            F.count("*").alias("rows"),
            F.avg("anomaly_score").alias("avg_anomaly_score"),
            F.avg("threat_score").alias("avg_threat_score"),
            F.count_if("is_security_relevant").alias("security_relevant_rows"),
        )
        .orderBy(F.col("is_attack_like").desc(), "scenario_name")
    )


def result_counts(scored: DataFrame) -> DataFrame:
    attack = F.col("is_attack_like")
    return scored.agg(
        F.count("*").alias("rows_evaluated"),
        F.count_if(attack).alias("attack_like_rows"),
        F.count_if(~attack).alias("benign_rows"),
    )
