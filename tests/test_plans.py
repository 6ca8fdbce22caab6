import json
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from weirwatch.plans import evaluation, ingest, landed, scenarios, views
from weirwatch.plans.pipeline import Warehouse, run_pipeline, train
from weirwatch.operators.threat import threat_score
from weirwatch.operators.window_features import endpoint_rarity, ip_window_features
from weirwatch.session import materialize
from weirwatch.sources import event_adapter as adapter
from weirwatch.sources import reports, tables
from weirwatch.streaming import jobs

from conftest import SF_DIR


@pytest.fixture(scope="module")
def features(spark):
    return materialize(ip_window_features(adapter.request_logs(spark, SF_DIR)), "features")


# Published mean anomaly and threat score per scenario.
PUBLISHED = {
    "endpoint_scanning": (0.8108, 88.38),
    "suspicious_probe_off_hours": (0.8280, 82.98),
    "request_burst_scan": (0.8798, 84.79),
    "repeated_error_attempts": (0.6329, 48.15),
    "static_asset_burst": (0.7401, 19.90),
    "popular_endpoint_spike": (0.4493, 27.72),
    "slow_backend_no_security_signal": (0.5647, 19.76),
}


def test_scenarios_reach_the_published_scores(spark, features):
    rows = scenarios.scenarios(features, 5)
    assert rows.count() == 35 and rows.select("synthetic_id").distinct().count() == 35
    score = F.create_map(*[F.lit(x) for n, (a, _) in PUBLISHED.items() for x in (n, a)])
    judged = threat_score(rows.withColumn("anomaly_score", score[F.col("scenario_name")]))
    for r in judged.select("scenario_name", "threat_score", "is_attack_like", "is_security_relevant").distinct().collect():
        assert abs(r.threat_score - PUBLISHED[r.scenario_name][1]) < 0.02
        assert r.is_attack_like == r.is_security_relevant


def test_scenarios_repeat_short_bases(spark, features):
    few = features.limit(3)
    rows = scenarios.scenarios(few, 10)
    assert rows.count() == 70 and rows.select("base_window_start", "base_ip_hash").distinct().count() == 3
    first = rows.where("scenario_index = 1").orderBy("row_index").collect()
    assert [r.synthetic_id for r in first][0] == "01_0001_endpoint_scanning"
    assert [r.row_index for r in first] == list(range(1, 11))
    with pytest.raises(ValueError):
        scenarios.scenarios(features.where("request_count < 0"), 10)


def test_metrics_of_a_perfect_ranking(spark):
    rows = [(i, i < 400, i + 1, i + 1, True, i < 400) for i in range(700)]
    df = spark.createDataFrame(rows, "i INT, is_attack_like BOOLEAN, anomaly_rank INT, threat_rank INT, is_anomaly BOOLEAN, is_security_relevant BOOLEAN")
    got = {(r.ranking_method, r.metric_name, r.k_value): r.metric_value for r in evaluation.evaluation_metrics(df, "e", "v").collect()}
    assert len(got) == 34
    for k, recall in ((10, 0.025), (20, 0.05), (50, 0.125), (100, 0.25), (200, 0.5), (300, 0.75)):
        assert got["anomaly_only", "precision_at_k", k] == 1.0
        assert got["anomaly_plus_threat_score", "recall_at_k", k] == recall
    assert round(got["anomaly_only_flag", "precision", 0], 4) == 0.5714
    assert got["anomaly_only_flag", "false_positive_rate", 0] == 1.0
    assert got["threat_score_flag", "predicted_positive_count", 0] == 400.0
    none = evaluation.ranking_metrics(df.where("not is_attack_like and i < 0"))
    assert {r.metric_value for r in none.collect()} == {0.0}


def test_the_context_is_the_main_route_of_the_window(spark, features):
    """Against a count of all rows in plain Python; among equally frequent routes the first by name, no template last."""
    logs = adapter.request_logs(spark, SF_DIR)
    logs = logs.withColumn("endpoint_template", F.when(F.col("method") != "PUT", F.col("endpoint_template")))
    chosen = features.orderBy(F.desc("request_count"), "window_start", "ip_hash").limit(50).select("window_start", "ip_hash")
    routes = {}
    for r in logs.select("timestamp", "ip_hash", "endpoint_template", *views.CONTEXT).collect():
        window = r.timestamp.replace(minute=r.timestamp.minute // 5 * 5, second=0, microsecond=0)
        route = (r.endpoint_template is None, r.endpoint_template or "", r.module_id, r.endpoint_group, r.status_family)
        routes.setdefault((window, r.ip_hash), Counter())[route] += 1
    got = views.with_context(chosen, logs).collect()
    assert len(got) == 50
    for r in got:
        (missing, template, *rest), _ = min(routes[r.window_start, r.ip_hash].items(), key=lambda item: (-item[1], item[0]))
        assert (r.endpoint_template, r.module_id, r.endpoint_group, r.status_family) == (None if missing else template, *rest)


def threats(spark, rows):
    schema = """window_start TIMESTAMP, ip_hash STRING, model_version STRING, threat_score DOUBLE, threat_level STRING,
      is_security_relevant BOOLEAN, anomaly_score DOUBLE, scored_at INT"""
    df = spark.createDataFrame(rows, schema)
    extra = {c: F.lit(0) for c in views.ALERT_COLUMNS if c not in df.columns}
    return df.withColumns({**extra, "reasons": F.array(F.lit("x")), "off_hours": F.lit(False)})


def test_views(spark):
    t = [datetime(2024, 1, d, h, 5) for d, h in ((1, 3), (1, 3), (2, 23))]
    table = threats(spark, [
        (t[0], "a", "v1", 90.0, "critical", True, 0.9, 1),
        (t[0], "a", "v2", 70.0, "high", True, 0.7, 2),
        (t[1], "b", "v2", 10.0, "low", False, 0.2, 2),
        (t[2], "a", "v2", 40.0, "medium", True, 0.6, 2),
    ])
    logs = adapter.request_logs(spark, SF_DIR).limit(0)
    row = views.overview(table).first()
    assert (row.model_version, row.total_windows, row.high_anomaly_score_windows) == ("v2", 3, 2)
    assert row.threat_level_counts == {"critical": 0, "high": 1, "medium": 1, "low": 1}
    assert [r.total_windows for r in views.timeline(table).collect()] == [1, 2]
    assert [r.threat_score for r in views.alerts(table, logs).collect()] == [70.0, 40.0, 10.0]
    one = views.alerts(table, logs, views.AlertFilter(ip_hash="a", security_relevant=True, limit=0))
    assert [r.threat_score for r in one.collect()] == [70.0]
    assert views.alerts(table, logs, views.AlertFilter(model_version="v1")).first().threat_score == 90.0
    assert [r.threat_score for r in views.incident(table, logs).collect()] == [40.0]
    with pytest.raises(ValueError):
        views.AlertFilter(threat_level="extreme")
    with pytest.raises(ValueError):
        views.latest_model_version(table.limit(0))
    assert views.latest_evaluation_id(spark.createDataFrame([], "evaluation_id STRING, created_at TIMESTAMP")) is None


def test_mark_and_pull(spark, folder):
    state, logs = f"{folder}/state", f"{folder}/logs"
    assert ingest.high_water_mark(spark, state, logs, "s") is None
    newer, older = datetime(2024, 1, 1, 12), datetime(2024, 1, 1, 11)
    for mark in (newer, older, None):
        ingest.save_state(spark, state, "s", mark, 5, "run", "raw")
    assert ingest.high_water_mark(spark, state, logs, "s") == newer
    assert ingest.high_water_mark(spark, state, logs, "other") is None
    rows = [{"timestamp": f"2024-01-01T11:{m}:00Z"} for m in ("54", "55", "59")] + [{"timestamp": "bad"}]
    entries = spark.createDataFrame([(json.dumps(r),) for r in rows], "value STRING")
    assert ingest.pull_since(entries, newer).count() == 2
    assert ingest.pull_since(entries, None, now=F.lit(datetime(2024, 1, 1, 12, 56))).count() == 1


def test_pulls_open_only_files_that_reach_the_mark(spark, folder):
    import os

    os.mkdir(f"{folder}/in")
    places = (f"{folder}/in", f"{folder}/files", f"{folder}/logs", f"{folder}/state", "salt")
    names = lambda since: [p.rsplit("/", 1)[1] for p in landed.files_since(spark, *places[:2], since)]
    land(f"{folder}/in", "a", [entry(0, 1, "k1"), entry(10, 0, "k2")])
    land(f"{folder}/in", "b", [entry(27, 0, "k3"), entry(20, 0, "k4")])
    land(f"{folder}/in", "c", ["", "  "])
    assert landed.pull_landed(spark, *places, freshness_minutes=None) == 4
    assert landed.refresh_file_times(spark, *places[:2]) == 0
    land(f"{folder}/in", "d", [entry(24, 0, "k5"), entry(40, 0, "k6"), entry(1, 0, "too late")])
    since = ingest.pulled_from(ingest.high_water_mark(spark, places[3], places[2], "requests"), 5, 60, None)
    assert names(None) == ["a", "b", "c", "d"] and names(since) == ["b", "d"]  # "d" is not indexed yet
    assert landed.refresh_file_times(spark, *places[:2]) == 1 and names(since) == ["b", "d"]
    # Entries in the overlap come again and replace themselves; one before it is in no pull's range.
    assert landed.pull_landed(spark, *places) == 3
    rows = {r.request_hash: r.timestamp.minute for r in tables.read_table(spark, places[2]).collect()}
    assert sorted(rows.values()) == [0, 10, 20, 24, 27, 40]
    # A file that changed counts as new; one without readable times is always opened.
    land(f"{folder}/in", "a", [entry(50, 0, "k7"), entry(50, 1, "k8"), entry(50, 2, "k9")])
    land(f"{folder}/in", "e", [json.dumps({"timestamp": "bad"})])
    assert landed.pull_landed(spark, *places, refused_path=f"{folder}/refused") == 4
    assert tables.read_table(spark, f"{folder}/refused").count() == 1
    assert "e" in names(F.lit(datetime(2030, 1, 1))) and names(F.lit(datetime(2030, 1, 1))) == ["e"]
    assert landed.files_since(spark, places[0], f"{folder}/no-index", since) == sorted(landed.files_since(spark, *places[:2], None))


def test_pipeline(spark, folder):
    wh = Warehouse(folder)
    logs = adapter.request_logs(spark, SF_DIR).withColumn("load_order", F.col("timestamp"))
    tables.load_request_logs(spark, logs, wh.path("request_logs"))
    done = run_pipeline(spark, wh, "m1", trees=20)
    assert done.count() == tables.read_table(spark, wh.path("request_features")).count()
    train(spark, wh, "m2", trees=20, contamination=0.1)
    scores = tables.read_table(spark, wh.path("anomaly_scores"))
    assert views.latest_model_version(scores) == "m2" and scores.select("model_version").distinct().count() == 2
    metrics, summary = views.evaluation_summary(
        tables.read_table(spark, wh.path("scenario_metrics")), tables.read_table(spark, wh.path("scenario_scores"))
    )
    assert metrics.count() == 34 and [r.rows for r in summary.collect()] == [100] * 7
    assert [r.is_attack_like for r in summary.collect()] == [True] * 4 + [False] * 3
    text = reports.threat_report(done, "m1") + reports.evaluation_report(metrics, summary, "e")
    assert "critical" in text and "precision_at_k" in text


def entry(minute, second, key, ip="c1", path="/a", status=200):
    stamp = f"2024-01-01T00:{minute:02d}:{second:02d}Z"
    payload = {"startTime": stamp, "ip": ip, "resource": path, "status": status, "latency": "0.1s"}
    if key:
        payload["requestId"] = key
    return json.dumps({"timestamp": stamp, "protoPayload": payload})


def land(folder, name, lines):
    with open(f"{folder}/{name}", "w") as out:
        out.write("\n".join(lines) + "\n")


def test_stream_ingest_keeps_late_rows(spark, folder):
    import os

    os.mkdir(f"{folder}/in")
    run = lambda: jobs.start_ingest(
        jobs.stream_entries(spark, f"{folder}/in", 1), f"{folder}/logs", "salt", f"{folder}/cp", f"{folder}/features"
    ).awaitTermination()
    land(f"{folder}/in", "a", [entry(30, 0, "k1"), entry(30, 1, "k2"), "broken {"])
    run()
    land(f"{folder}/in", "b", [entry(1, 0, "k3"), entry(30, 1, "k2", status=500)])
    run()
    stored = tables.read_table(spark, f"{folder}/logs")
    assert stored.count() == 3
    got = {(r.window_start.minute, r.request_count, r.error_count) for r in tables.read_table(spark, f"{folder}/features").collect()}
    assert got == {(0, 1, 0), (30, 2, 1)}


def test_live_counters(spark, folder):
    import os

    os.mkdir(f"{folder}/in")
    land(f"{folder}/in", "a", [entry(0, 1, "k1"), entry(0, 2, "k1"), entry(0, 3, "k2", path="/.env", status=404), entry(4, 59, None), entry(4, 59, None)])
    land(f"{folder}/in", "b", [entry(40, 0, "k9")])
    land(f"{folder}/in", "c", [entry(59, 0, "k10")])
    # One batch: files of equal times come in any order.
    rows = jobs.live_requests(jobs.stream_entries(spark, f"{folder}/in"), "salt")
    q = (
        jobs.live_counters(rows).writeStream.format("memory").queryName("live_counts").outputMode("append")
        .option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    got = {(r.window_start.minute, r.request_count, r.unique_endpoint_count, r.suspicious_path_count, r.error_count)
           for r in spark.table("live_counts").collect()}
    assert (0, 4, 2, 1, 1) in got


def test_live_counters_over_batches_in_any_order(spark, folder):
    import os

    os.mkdir(f"{folder}/in")
    run = lambda: jobs.start_live_counters(
        jobs.stream_lines(spark, f"{folder}/in", 1), f"{folder}/logs", f"{folder}/counts", f"{folder}/refused", "salt", f"{folder}/cp"
    ).awaitTermination()
    counts = lambda: {
        (r.window_start.minute, r.request_count, r.unique_endpoint_count, r.suspicious_path_count, r.error_count)
        for r in jobs.read_counters(spark, f"{folder}/counts").collect()
    }
    # The latest first, a file a batch.
    land(f"{folder}/in", "c", [entry(59, 0, "k10"), "broken {", ""])
    run()
    land(f"{folder}/in", "b", [entry(40, 0, "k9"), json.dumps({"protoPayload": {"ip": "c1"}})])
    run()
    land(f"{folder}/in", "a", [entry(0, 1, "k1"), entry(0, 2, "k1"), entry(0, 3, "k2", path="/.env", status=404), entry(4, 59, None), entry(4, 59, None)])
    run()
    assert counts() == {(0, 4, 2, 1, 1), (40, 1, 1, 0, 0), (55, 1, 1, 0, 0)}
    refused = jobs.read_refused(spark, f"{folder}/refused").collect()
    assert sorted((r.reason, r.file_path[-1]) for r in refused) == [("no timestamp", "b"), ("not one JSON object", "c")]
    # A request that comes again at another time leaves its old window.
    land(f"{folder}/in", "d", [entry(50, 0, "k9")])
    run()
    assert counts() == {(0, 4, 2, 1, 1), (50, 1, 1, 0, 0), (55, 1, 1, 0, 0)}


def test_refresh_uses_a_snapshot(spark, folder):
    logs = adapter.request_logs(spark, SF_DIR)
    path = f"{folder}/logs"
    tables.load_request_logs(spark, logs.withColumn("load_order", F.col("timestamp")), path)
    windows = jobs.affected_windows(logs)
    jobs.refresh_windows(spark, path, f"{folder}/features", windows, endpoint_rarity(logs))
    a = tables.read_table(spark, f"{folder}/features").drop("log_date")
    b = ip_window_features(logs).select(a.columns)
    rounded = lambda df: df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
    assert rounded(a).exceptAll(rounded(b)).count() == 0 and a.count() == b.count()


def test_context_of_a_window_across_midnight(spark):
    import datetime as dt

    start = dt.datetime(2024, 1, 1, 23, 55)
    late = dt.datetime(2024, 1, 2, 0, 1)
    rows = [(start, "/x"), (late, "/y"), (late, "/y")]
    logs = spark.createDataFrame([(t, "c", e, "m", "g", "2xx") for t, e in rows], "timestamp TIMESTAMP, ip_hash STRING, endpoint_template STRING, module_id STRING, endpoint_group STRING, status_family STRING")
    window = "2 days"
    from weirwatch.functions.windows import window_start

    alerts = logs.select(window_start(F.col("timestamp"), window).alias("window_start"), "ip_hash").distinct()
    plain = views.with_context(alerts, logs, window).collect()
    dated = views.with_context(alerts, tables.with_day(logs), window).collect()
    assert sorted(map(str, plain)) == sorted(map(str, dated))
    assert any(r.endpoint_template == "/y" for r in dated)
