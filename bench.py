"""Time the headline jobs; prints one JSON line.

BENCH_SF_DIR   table folder, default /root/testdata/sf0.1
BENCH_CPUS     local cores, default all
BENCH_COPIES   times the log is repeated, each copy a day later, default 1

Jobs read stored logs and raw entries in several files, as they do in
production. Adapting and writing the request log is timed as ``store_logs``.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import functions as F

from weirwatch.operators import forest as forests
from weirwatch.operators.profile import profile, profile_top_values
from weirwatch.operators.threat import score_threats
from weirwatch.operators.window_features import ip_window_features, user_window_features
from weirwatch.plans import views
from weirwatch.plans.evaluation import evaluation_metrics, score_scenarios
from weirwatch.plans.scenarios import scenarios
from weirwatch.session import local_session, materialize
from weirwatch.sources import event_adapter as adapter
from weirwatch.sources import raw


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    copies = int(os.environ.get("BENCH_COPIES", "1"))
    spark = local_session(cpus, app="bench", shuffle=int(cpus))
    times: dict[str, float] = {}

    def timed(name, job):
        start = time.time()
        result = job()
        times[name] = round(time.time() - start, 3)
        return result

    def drain(df):
        df.write.format("noop").mode("overwrite").save()

    def spread(df):
        if copies > 1:
            day = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
            df = df.withColumn("_d", day).withColumn("timestamp", F.col("timestamp") + F.make_dt_interval("_d"))
            df = df.drop("_d")
        return df.repartition(int(cpus) * (2 if copies > 1 else 1))

    # Start the engine and the Python workers before the clock runs.
    drain(spark.range(10).repartition(2).groupBy("id").count())

    logs = timed("store_logs", lambda: materialize(spread(adapter.request_logs(spark, sf_dir)), "logs"))
    apps = materialize(spread(adapter.app_logs(spark, sf_dir)), "apps")
    entries = materialize(adapter.raw_requests(spark, sf_dir).repartition(int(cpus)), "entries")
    timed("anonymize_requests", lambda: drain(raw.request_rows(entries, "salt")))
    features = timed("ip_window_features", lambda: materialize(ip_window_features(logs), "features"))
    timed("user_window_features", lambda: drain(user_window_features(apps)))
    timed("profile_requests", lambda: drain(profile(logs, "request", "requests")))
    timed("profile_top_values", lambda: drain(profile_top_values(logs, "request")))
    model = timed("fit_forest", lambda: forests.fit_forest(features, "bench"))
    scores = timed("score_forest", lambda: materialize(forests.score_forest(features, model), "scores"))
    threats = timed(
        "threat_score",
        lambda: materialize(score_threats(scores, features).withColumn("scored_at", F.lit(0)), "threats"),
    )
    timed("overview", lambda: views.overview(threats).collect())
    timed("alerts_with_context", lambda: views.alerts(threats, logs).collect())
    timed("timeline_hourly", lambda: views.timeline(threats).collect())
    timed("incident_latest_day", lambda: views.incident(threats, logs).collect())
    timed(
        "evaluate",
        lambda: evaluation_metrics(
            score_scenarios(scenarios(features), features, model), "bench", "bench"
        ).collect(),
    )
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_jobs_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(found.group(1)) if found else None,
                "copies": copies,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
