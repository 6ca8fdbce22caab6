import hashlib
import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weirwatch.fixed_values import REQUEST_FEATURES, SCENARIO_COLUMNS, SCENARIOS
from weirwatch.operators import forest as forests
from weirwatch.operators.dedupe import first_write_wins, last_write_wins
from weirwatch.operators.profile import nearest_rank_p95, profile, top_values
from weirwatch.operators.quantiles import exact_quantile
from weirwatch.operators.ranking import global_rank, min_max, normalize_and_rank
from weirwatch.operators.threat import threat_level_counts, threat_score
from weirwatch.operators.window_features import ip_window_features
from weirwatch.sources import event_adapter as adapter

from conftest import SF_DIR


def nearest(values, p):
    ordered = sorted(values)
    return ordered[min(len(ordered) - 1, round((len(ordered) - 1) * p))]


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(7)
    n = 20000
    group = rng.integers(0, 40, n)
    group[rng.random(n) < 0.4] = 0
    value = np.round(rng.gamma(2, 80, n), 3)
    value[group == 3] = 7.0
    value[group == 4] *= -1
    frame = pd.DataFrame({"g": group, "v": value})
    return frame, spark.createDataFrame(frame).repartition(8)


@pytest.mark.parametrize("method,levels,p", [("interpolated", 1, 0.95), ("interpolated", 2, 0.5), ("nearest", 2, 0.95)])
def test_quantile_of_groups(skewed, method, levels, p):
    frame, df = skewed
    got = exact_quantile(df, ["g"], "v", p, "q", method, levels).toPandas()
    got = got.set_index("g").q.sort_index()
    by = frame.groupby("g").v
    want = by.quantile(p) if method == "interpolated" else by.apply(lambda s: nearest(s, p))
    assert np.allclose(got, want, rtol=0, atol=1e-9)


def test_quantile_of_small_cases(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "v DOUBLE")
    assert math.isclose(exact_quantile(df, [], "v", 0.95, "q").first().q, 8.95)
    assert exact_quantile(df.where("v < 0"), [], "v", 0.5, "q").count() == 0
    for n, index in ((11, 10), (31, 28)):
        rows = spark.range(n).select(F.col("id").cast("double").alias("v"))
        assert nearest_rank_p95(rows, "v").first().p95 == index


def test_dense_values_need_no_luck(spark):
    """All values in one narrow band, so the first buckets tell nothing."""
    rows = spark.range(30001).select((F.lit(100.0) + F.col("id") / 1e7).alias("v")).repartition(8)
    got = exact_quantile(rows, [], "v", 0.5, "q", levels=2).first().q
    assert got == 100.0 + 15000 / 1e7


def test_global_rank_is_a_permutation_along_the_order(spark):
    rows = spark.range(5000).select("id", (F.col("id") % 3).alias("score")).repartition(7)
    ranked = global_rank(rows, [F.col("score").desc(), F.col("id").asc()], "r", partitions=6).toPandas()
    want = ranked.sort_values(["score", "id"], ascending=[False, True]).id.tolist()
    assert ranked.sort_values("r").id.tolist() == want
    assert sorted(ranked.r) == list(range(1, 5001))


def test_min_max_of_equal_values_is_zero(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "v DOUBLE")
    assert [r.s for r in min_max(df, F.col("v"), "s").collect()] == [0.0, 0.0]


def test_normalized_scores(spark):
    rows = [(i, f"k{i}", -0.1 * (i % 4)) for i in range(40)]
    df = spark.createDataFrame(rows, "window_start INT, ip_hash STRING, raw_decision_score DOUBLE")
    got = normalize_and_rank(df).orderBy("anomaly_rank").collect()
    assert got[0].anomaly_score == 1.0 and got[-1].anomaly_score == 0.0
    assert [r.window_start for r in got[:10]] == [3, 7, 11, 15, 19, 23, 27, 31, 35, 39]


def test_write_order_rules(spark):
    rows = [("a", 1, 10), ("a", 2, 20), ("b", 1, 30), (None, 1, 40), (None, 1, 40)]
    df = spark.createDataFrame(rows, "k STRING, o INT, v INT")
    last = sorted((r.k or "", r.v) for r in last_write_wins(df, ["k"], "o").collect())
    first = sorted((r.k or "", r.v) for r in first_write_wins(df, ["k"], "o").collect())
    assert last == [("", 40), ("", 40), ("a", 20), ("b", 30)]
    assert first == [("", 40), ("", 40), ("a", 10), ("b", 30)]


def context(**values):
    base = dict(anomaly_score=0.0, suspicious_path_count=0, error_rate=0.0, error_count=0, request_count=1,
                unique_endpoint_count=1, static_asset_count=0, off_hours=False)
    return {**base, **values}


def judge(spark, *rows):
    df = spark.createDataFrame([{**context(**r), "i": i} for i, r in enumerate(rows)])
    return threat_score(df).orderBy("i").collect()


# (anomaly, requests, suspicious, error rate, errors, endpoints, off-hours) -> score, level
PUBLISHED = [
    (1.0, 768, 267, 0.5859, 450, 181, False, 100.0, "critical"),
    (0.8522, 495, 56, 0.1838, 91, 39, True, 83.83, "critical"),
    (0.9967, 31, 31, 0.9677, 30, 30, False, 82.88, "critical"),
    (0.8844, 309, 31, 0.2265, 70, 41, False, 80.95, "critical"),
    (0.8425, 575, 0, 0.1635, 94, 89, True, 65.49, "high"),
    (0.7785, 144, 13, 0.2153, 31, 18, True, 57.25, "medium"),
]


def test_threat_scores_known(spark):
    rows = [
        dict(anomaly_score=a, request_count=n, suspicious_path_count=s, error_rate=r, error_count=e,
             unique_endpoint_count=u, off_hours=o)
        for a, n, s, r, e, u, o, _, _ in PUBLISHED
    ]
    for got, case in zip(judge(spark, *rows), PUBLISHED):
        assert abs(got.threat_score - case[7]) < 0.01 and got.threat_level == case[8]
        assert got.is_security_relevant


def test_threat_edges(spark):
    static = dict(request_count=10, static_asset_count=8, anomaly_score=0.7)
    plain, kept, off, empty, none = judge(
        spark,
        static,
        {**static, "error_rate": 0.05},
        dict(anomaly_score=0.1, request_count=10, static_asset_count=10),
        dict(request_count=0, anomaly_score=0.5),
        dict(anomaly_score=0.5999),
    )
    assert plain.threat_score == 6.5 and plain.reasons == ["high anomaly score", "mostly static asset traffic"]
    assert kept.threat_score == 24.5
    assert off.threat_score == 0.0 and off.threat_level == "low"
    assert empty.threat_score == 17.5
    assert none.reasons == ["low-priority statistical anomaly"] and not none.is_security_relevant


def test_threat_score_grows_with_suspicious_requests(spark):
    got = judge(spark, *[dict(anomaly_score=0.3, request_count=300, suspicious_path_count=n) for n in range(0, 120, 7)])
    scores = [r.threat_score for r in got]
    assert scores == sorted(scores)


def test_all_levels_are_listed(spark):
    df = spark.createDataFrame([("low",), ("low",)], "threat_level STRING")
    got = [(r.threat_level, r.windows) for r in threat_level_counts(df).collect()]
    assert got == [("critical", 0), ("high", 0), ("medium", 0), ("low", 2)]


def test_features_keep_every_row(spark):
    logs = adapter.request_logs(spark, SF_DIR)
    logs = logs.withColumn("ip_hash", F.when(F.col("status_code") != 500, F.col("ip_hash")))
    logs = logs.withColumn("endpoint_template", F.when(F.col("method") != "PUT", F.col("endpoint_template")))
    features = ip_window_features(logs).toPandas()
    assert features.request_count.sum() == logs.where("ip_hash IS NOT NULL").count()
    # Rarity counts the rows without a client too and skips null templates.
    total = logs.count()
    share = logs.where("endpoint_template = '/.env'").count() / total
    only = ip_window_features(logs.where("endpoint_template = '/.env' OR method = 'PUT'"), rarity=spark.createDataFrame([("/.env", -math.log(share))], "endpoint_template STRING, endpoint_rarity DOUBLE"))
    values = set(only.where("avg_endpoint_rarity IS NOT NULL").toPandas().avg_endpoint_rarity.round(9))
    assert values == {round(-math.log(share), 9)}


def test_window_p95_equals_the_built_in_percentile(spark):
    logs = adapter.request_logs(spark, SF_DIR)
    a = ip_window_features(logs).select("window_start", "ip_hash", F.round("p95_latency_ms", 6))
    rows = logs.where("ip_hash is not null and timestamp is not null").withColumn("window_start", F.window("timestamp", "5 minutes")["start"])
    b = rows.groupBy("window_start", "ip_hash").agg(F.round(F.percentile("latency_ms", 0.95), 6))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_profile_of_dirty_rows(spark):
    rows = [("", "a", "", None), (None, "", "12.5", True), ("2024-01-01T00:00:00Z", "a", "x", False)]
    df = spark.createDataFrame(rows, "timestamp STRING, ip_hash STRING, latency_ms STRING, has_suspicious_path_pattern BOOLEAN")
    df = df.selectExpr("*", "'t' AS endpoint_template", "false AS has_sensitive_query_key", "null AS response_size")
    got = profile(df, "request", "d").first()
    assert (got.missing_timestamp, got.missing_ip_hash, got.unique_ip_hashes) == (2, 1, 1)
    assert (got.latency_avg_ms, got.latency_p95_ms, got.suspicious_path_rows) == (12.5, 12.5, 1)
    top = {(r.value, r.rows, r.value_rank) for r in top_values(df, ["ip_hash"]).collect()}
    assert top == {("a", 2, 1), ("missing", 1, 2)}


def features_with_outliers(spark, n=3000, outliers=10):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame({f: rng.normal(10, 1, n + outliers) for f in REQUEST_FEATURES if f != "off_hours"})
    frame.iloc[n:] = rng.uniform(60, 90, (outliers, frame.shape[1]))
    frame["off_hours"] = False
    frame.loc[::50, "avg_latency_ms"] = np.nan
    frame["window_start"] = np.arange(len(frame))
    frame["ip_hash"] = "k"
    df = spark.createDataFrame(frame)
    return df.withColumn("avg_latency_ms", F.when(~F.isnan("avg_latency_ms"), F.col("avg_latency_ms")))


def test_forest(spark):
    features = features_with_outliers(spark)
    a = forests.fit_forest(features, "v", trees=50, sample=64)
    b = forests.fit_forest(features.repartition(11), "v", trees=50, sample=64)
    assert a.nodes.exceptAll(b.nodes).count() == 0
    scored = forests.score_forest(features, a).toPandas().sort_values("anomaly_rank")
    assert set(scored.window_start[:10]) == set(range(3000, 3010))
    assert scored.anomaly_score.between(0, 1).all() and scored.is_anomaly[scored.anomaly_rank <= 10].all()
    few = forests.Forest(a.nodes.where("tree_id < 4"), a.params, "v")
    x = forests.raw_scores(features, few).select("window_start", F.round("raw_decision_score", 12))
    y = forests.raw_scores_in_catalyst(features, few).select("window_start", F.round("raw_decision_score", 12))
    assert x.exceptAll(y).count() == 0
    share = forests.fit_forest(features, "v", contamination=0.1, trees=50, sample=64)
    assert abs(forests.score_forest(features, share).where("is_anomaly").count() - 301) <= 1


def test_hand_made_tree(spark):
    """One split at 5: one row on the left, three on the right."""
    nodes = spark.createDataFrame(
        [(0, 0, 0, 5.0, 1, 2, 4, 0), (0, 1, -1, 0.0, -1, -1, 1, 1), (0, 2, -1, 0.0, -1, -1, 3, 1)],
        forests.NODE_SCHEMA,
    )
    params = spark.createDataFrame(
        [("v", 4, -0.5, ["x"], {"x": 9.0})],
        "model_version STRING, sample INT, score_offset DOUBLE, feature_columns ARRAY<STRING>, medians MAP<STRING, DOUBLE>",
    )
    df = spark.createDataFrame([(1, 4.0), (2, 6.0), (3, None)], "i INT, x DOUBLE")
    got = [r.raw_decision_score for r in forests.raw_scores(df, forests.Forest(nodes, params, "v")).orderBy("i").collect()]
    c = lambda n: 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n
    left, right = 0.5 - 2 ** (-1 / c(4)), 0.5 - 2 ** (-(1 + c(3)) / c(4))
    assert np.allclose(got, [left, right, right])


def test_every_tree_gets_the_rows_with_the_least_draws(spark):
    """Against a plain computation over all rows; few rows in a batch, so that parts are merged often."""
    rows = [(i, f"k{i % 7}", float(i)) for i in range(900)]
    df = spark.createDataFrame(rows, "window_start INT, ip_hash STRING, x DOUBLE")
    prime = 2**31 - 1

    def number(text, at, size):
        return int(hashlib.sha256(text.encode()).hexdigest()[at : at + size], 16)

    want = {}
    for t in range(5):
        a1, b1, c1, a2, b2, c2 = (number(f"9|tree|{t}", 7 * i, 7) for i in range(6))
        drawn = []
        for i, k, x in rows:
            h1, h2 = (number(f"{i}|{k}|9", at, 7) for at in (0, 7))
            drawn.append(((a1 * h1 + b1 * h2 + c1) % prime * 2**31 + (a2 * h1 + b2 * h2 + c2) % prime, x))
        want[t] = sorted(drawn)[:40]
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        for parts in (1, 13):
            got = {}
            for r in forests.subsamples(df.repartition(parts), [F.col("x")], forests.KEYS, 5, 40, 9).collect():
                got.setdefault(r.tree_id, []).append((r.draw, r.x[0]))
            assert {t: sorted(v) for t, v in got.items()} == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    all_rows = forests.subsamples(df.limit(30), [F.col("x")], forests.KEYS, 5, 40, 9).groupBy("tree_id").count()
    assert {r["count"] for r in all_rows.collect()} == {30} and all_rows.count() == 5


def test_the_forest_of_few_rows_and_of_none(spark, folder):
    features = features_with_outliers(spark, 1, 0)
    one = forests.fit_forest(features, "v", trees=3)
    assert [r.feature for r in one.nodes.collect()] == [-1] * 3
    assert forests.score_forest(features, one).count() == 1
    with pytest.raises(ValueError):
        forests.fit_forest(features.limit(0), "v", trees=3)
    with pytest.raises(FileNotFoundError):
        forests.load_forest(spark, folder, "v")
    forests.save_forest(one, folder)
    assert forests.load_forest(spark, folder, "v").nodes.exceptAll(one.nodes).count() == 0


def test_contamination_values():
    assert forests.parse_contamination("auto") == "auto" and forests.parse_contamination("0.5") == 0.5
    for bad in ("0", 0.6, "x"):
        with pytest.raises(ValueError):
            forests.parse_contamination(bad)


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 10**6))
def test_expected_path_grows(n):
    a, b = forests.expected_path(np.array([n, n + 1]))
    assert 0.0 <= a <= b + 1e-12


def test_scenario_table():
    assert len(SCENARIOS) == 7 and all(len(s) == len(SCENARIO_COLUMNS) for s in SCENARIOS)
