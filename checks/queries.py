"""One query per operator over the given tables, for checks and the bench.

Doubles are rounded and times printed so that two engines can be compared.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirwatch.fixed_values import REQUEST_FEATURES, THREAT_LEVELS
from weirwatch.functions import casts, identity, urls
from weirwatch.functions.paths import generalize_paths
from weirwatch.functions.windows import window_start
from weirwatch.operators import forest as forests
from weirwatch.operators import window_features as wf
from weirwatch.operators.dedupe import first_write_wins, last_write_wins
from weirwatch.operators.profile import (
    metric_rows,
    nearest_rank_p95,
    profile,
    profile_top_values,
)
from weirwatch.operators.quantiles import exact_quantile
from weirwatch.operators.ranking import min_max, normalize_and_rank
from weirwatch.operators.threat import score_threats, threat_level_counts, threat_score
from weirwatch.plans import evaluation as ev
from weirwatch.plans import frequencies, ingest, landed, views
from weirwatch.plans.pipeline import METRIC_KEYS, SCENARIO_KEYS, Warehouse, run_pipeline
from weirwatch.plans.scenarios import scenarios
from weirwatch.session import ensure_session, materialize, scratch_path
from weirwatch.sources import event_adapter as adapter
from weirwatch.sources import catalogue, jsonl, raw, reports, tables
from weirwatch.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(ensure_session(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stamp(column: str | Column, fraction: bool = False) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss" + (".SSSSSS" if fraction else ""))


DOUBLES = {"error_rate": 6, "anomaly_score": 6, "avg_endpoint_rarity": 6, "avg_response_size": 6}


def printable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles, print times and join lists."""
    shown = []
    for name, kind in df.dtypes:
        column = F.col(name)
        if kind == "double":
            column = F.round(column, digits)
        elif kind == "timestamp":
            column = stamp(column)
        elif kind == "array<string>":
            column = F.array_join(column, "; ")
        shown.append(column.alias(name))
    return df.select(*shown)


def _stamped(df: DataFrame) -> DataFrame:
    """Times with their fractions, doubles rounded, all columns kept."""
    times = [name for name, kind in df.dtypes if kind == "timestamp"]
    return printable(df.withColumns({name: stamp(name, True) for name in times}))


# --- inputs ------------------------------------------------------------------


@query
def adapt_request_logs(spark, sf_dir):
    logs = adapter.request_logs(spark, sf_dir)
    return printable(logs.withColumn("timestamp", stamp("timestamp", True)))


@query
def adapt_app_logs(spark, sf_dir):
    logs = adapter.app_logs(spark, sf_dir)
    return printable(logs.withColumn("timestamp", stamp("timestamp", True)))


@query
def anonymize_requests(spark, sf_dir):
    entries = adapter.raw_requests(spark, sf_dir)
    return _stamped(raw.request_rows(entries, adapter.SALT, keep=("event_id",)))


@query
def anonymize_app_events(spark, sf_dir):
    entries = adapter.raw_app_events(spark, sf_dir)
    return _stamped(raw.app_rows(entries, adapter.SALT, keep=("event_id",)))


# --- scalar functions --------------------------------------------------------


@query
def clean_path(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", urls.clean_path(F.col("url")).alias("path"))


@query
def query_key_summary(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        urls.query_key_count(url).alias("query_key_count"),
        urls.has_sensitive_query_key(url).alias("has_sensitive_query_key"),
    )


def _page_paths(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return generalize_paths(
        pages.select("page_id", urls.clean_path(F.col("url")).alias("endpoint_path"))
    )


@query
def generalize_page_paths(spark, sf_dir):
    return _page_paths(spark, sf_dir)


QUERIES["generalize_paths"] = QUERIES.pop("generalize_page_paths")


@query
def endpoint_groups(spark, sf_dir):
    shown = ["endpoint_group", "has_suspicious_path_pattern"]
    rows = _page_paths(spark, sf_dir).select(*shown)
    rows = rows.unionByName(adapter.request_logs(spark, sf_dir).select(*shown))
    return rows.groupBy(*shown).agg(F.count("*").alias("rows"))


@query
def user_agent_category(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", urls.user_agent_category(F.col("text")).alias("category"))


@query
def hash_entities(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        identity.hash_entity(F.col("c_name"), adapter.SALT).alias("name_hash"),
        identity.hash_entity(F.col("c_custkey"), adapter.SALT).alias("key_hash"),
    )


@query
def event_identity(spark, sf_dir):
    """Equal events share an identity: every event is given twice here, and one row of each identity is left."""
    logs = adapter.app_logs(spark, sf_dir)
    twice = logs.unionByName(logs)
    hashed = twice.withColumn("event_hash", identity.event_hash(twice))
    found = hashed.groupBy("event_hash").agg(
        F.any_value(F.struct(*logs.columns)).alias("event"), F.count("*").alias("copies")
    )
    return _stamped(found.select("event.*", "copies"))


@query
def lenient_casts(spark, sf_dir):
    events = adapter.read_events(spark, sf_dir)
    k = F.col("k")
    text = (
        F.when(k % 4 == 0, F.concat(F.lit(" "), k.cast("string"), F.lit(" ")))
        .when(k % 4 == 1, F.format_string("%.2f", "value"))
        .when(k % 4 == 2, F.lit("12d"))
        .otherwise(F.lit(""))
    )
    seconds = F.when(k % 4 < 2, F.concat(F.trim(text), F.lit("s"))).otherwise(text)
    return events.select(
        "event_id",
        casts.lenient_int(text).alias("as_int"),
        casts.lenient_double(text).alias("as_double"),
        casts.latency_ms(seconds).alias("latency_ms"),
    )


@query
def jsonl_scan(spark, sf_dir):
    """Entries and bad lines of JSON-lines files written from the events."""
    k, entry = F.col("k"), F.col("value")
    lines = adapter.raw_requests(spark, sf_dir).join(
        adapter.read_events(spark, sf_dir).select("event_id", "k"), "event_id"
    )
    lines = lines.select(
        F.when(k % 10 == 0, F.concat(entry, F.lit(" {")))
        .when(k % 10 == 1, F.concat(F.lit("["), entry, F.lit("]")))
        .when(k % 10 == 2, F.lit("   "))
        .otherwise(entry)
        .alias("value")
    )
    folder = scratch_path(spark, "jsonl")
    lines.write.text(folder)
    event = F.regexp_extract("value", "insert-([0-9]+)", 1).alias("event_id")
    good = jsonl.read_entries(spark, folder, "quarantine").select(F.lit("entry").alias("kind"), event)
    return good.unionByName(jsonl.bad_lines(spark, folder).select(F.col("problem").alias("kind"), event))


@query
def array_file_scan(spark, sf_dir):
    """Files of one JSON array each, 2,000 events a file, read and anonymised."""
    folder = scratch_path(spark, "arrays")
    entries = adapter.raw_requests(spark, sf_dir).withColumn("file", F.expr("event_id div 2000"))
    arrays = entries.groupBy("file").agg(F.concat(F.lit("["), F.array_join(F.collect_list("value"), ", "), F.lit("]")).alias("value"))
    arrays.write.partitionBy("file").text(folder)
    entries = jsonl.read_array_file(spark, f"{folder}/*")
    event = F.regexp_extract("value", "insert-([0-9]+)", 1).cast("bigint")
    rows = raw.request_rows(entries.withColumn("event_id", event), adapter.SALT, keep=("event_id",))
    shown = ["event_id", "timestamp", "module_id", "method", "status_code", "endpoint_path", "has_sensitive_query_key", "ip_hash"]
    return _stamped(rows.select(*shown))


@query
def jsonl_sink(spark, sf_dir):
    """The request log written as JSON lines and read back with its types."""
    folder = scratch_path(spark, "sink")
    logs = adapter.request_logs(spark, sf_dir)
    jsonl.write_jsonl(logs, folder)
    return _stamped(jsonl.read_request_log(spark, folder).select(*logs.columns))


@query
def catalogue_scan(spark, sf_dir):
    """Both logs read through a catalogue that names their files and types."""
    root = scratch_path(spark, "catalogue")
    jsonl.write_jsonl(adapter.request_logs(spark, sf_dir), f"{root}/requests")
    jsonl.write_jsonl(adapter.app_logs(spark, sf_dir), f"{root}/apps")
    listed = {
        "requests": {"path": f"{root}/requests", "type": "request_log", "description": "Requests"},
        "apps": {"path": f"{root}/apps", "type": "structured_app_log"},
    }
    reports.write_text(spark, json.dumps(listed), f"{root}/list")
    parts = []
    for name, dataset in catalogue.load_catalogue(spark, f"{root}/list").items():
        rows = catalogue.read_dataset(spark, dataset)
        entity, duration = ("ip_hash", "latency_ms") if name == "requests" else ("user_id_hash", "response_time_ms")
        parts.append(
            rows.select(
                F.lit(name).alias("dataset"), F.lit(dataset.type).alias("type"), F.lit(dataset.description).alias("description"),
                "timestamp", F.col(entity).alias("entity"), F.col(duration).alias("duration"),
                "endpoint_path", "endpoint_template", "status_code", "request_hash",
            )
        )
    return _stamped(parts[0].unionByName(parts[1]))


# --- loads -------------------------------------------------------------------


def _batches(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """All requests, then every third one again with another status."""
    events = adapter.read_events(spark, sf_dir).select("event_id")
    key = identity.hash_entity(F.col("event_id"), adapter.SALT)
    ids = events.select("event_id", key.alias("request_hash"))
    logs = adapter.request_logs(spark, sf_dir).join(ids, "request_hash")
    logs = logs.select(
        "event_id",
        F.when(F.col("event_id") % 50 != 0, F.col("request_hash")).alias("request_hash"),
        "timestamp",
        "status_code",
        "module_id",
    )
    again = logs.where(F.col("event_id") % 3 == 0).withColumn("status_code", F.lit(999))
    first = logs.withColumn("load_order", F.lit(1))
    return first.drop("event_id"), again.withColumn("load_order", F.lit(2)).drop("event_id")


def _loaded(df: DataFrame) -> DataFrame:
    return df.select(
        "request_hash", stamp("timestamp", True).alias("timestamp"), "status_code", "module_id"
    )


@query
def dedupe_last_write(spark, sf_dir):
    first, again = _batches(spark, sf_dir)
    return _loaded(last_write_wins(first.unionByName(again), ["request_hash"], "load_order"))


@query
def dedupe_first_write(spark, sf_dir):
    first, again = _batches(spark, sf_dir)
    return _loaded(first_write_wins(first.unionByName(again), ["request_hash"], "load_order"))


@query
def upsert_request_logs(spark, sf_dir):
    """Two loads into a table partitioned by day."""
    path = scratch_path(spark, "request-logs")
    for batch in _batches(spark, sf_dir):
        tables.load_request_logs(spark, batch, path)
    return _loaded(tables.read_table(spark, path))


@query
def insert_app_events(spark, sf_dir):
    """The same application events loaded twice count once."""
    path = scratch_path(spark, "app-logs")
    logs = adapter.app_logs(spark, sf_dir).withColumn("load_order", F.col("timestamp"))
    for _ in range(2):
        tables.load_app_logs(spark, logs, path)
    stored = tables.read_table(spark, path)
    shown = ["level", "event", "response_time_ms", "user_id_hash", "tenant_hash", "request_hash", "endpoint_template", "has_error"]
    return printable(stored.select(stamp("timestamp", True).alias("timestamp"), *shown))


@query
def truncate_and_reload(spark, sf_dir):
    """All application events, then a reload without the views: nothing of the first load is left."""
    path = scratch_path(spark, "reloaded")
    logs = adapter.app_logs(spark, sf_dir).withColumn("load_order", F.col("timestamp"))
    tables.load_app_logs(spark, logs, path)
    tables.load_app_logs(spark, logs.where(F.col("event") != "view"), path, reload=True)
    shown = [c for c in logs.columns if c != "load_order"]
    return _stamped(tables.read_table(spark, path).select(*shown))


@query
def high_water_mark(spark, sf_dir):
    """Mark after loading all but the views, and what the next pull takes."""
    entries = adapter.raw_requests(spark, sf_dir).join(
        adapter.read_events(spark, sf_dir).select("event_id", "kind"), "event_id"
    )
    loaded = entries.where(F.col("kind") != "view")
    mark = loaded.agg(F.max(ingest.entry_timestamp()).alias("t")).first().t
    state, logs = scratch_path(spark, "state"), scratch_path(spark, "no-logs")
    ingest.save_state(spark, state, "requests", mark, 0, "run", "")
    stored = ingest.high_water_mark(spark, state, logs, "requests")
    pulled = ingest.pull_since(entries, stored)
    return pulled.agg(F.count("*").alias("pulled_rows")).select(
        stamp(F.lit(stored), True).alias("mark"),
        stamp(F.lit(stored) - F.make_dt_interval(mins=F.lit(5)), True).alias("since"),
        "pulled_rows",
    )


@query
def incremental_ingest(spark, sf_dir):
    """Three pulls of growing exports end with every request once."""
    root = scratch_path(spark, "ingest")
    entries = adapter.raw_requests(spark, sf_dir).join(
        adapter.read_events(spark, sf_dir).select("event_id", "timestamp", "k"), "event_id"
    )
    entries = materialize(entries.withColumn("load_order", F.col("event_id")), "entries")
    span = entries.agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b")).first()
    for part in (1, 2, 3):
        until = span.a + (span.b - span.a) * part / 3
        export = entries.where(F.col("timestamp") <= F.lit(until)).select("value", "load_order")
        ingest.ingest_requests(
            spark, export, f"{root}/logs", f"{root}/state", adapter.SALT, run_id=str(part), freshness_minutes=None
        )
    stored = tables.read_table(spark, f"{root}/logs")
    shown = ["request_hash", "module_id", "method", "status_code", "has_sensitive_query_key"]
    return stored.select(stamp("timestamp", True).alias("timestamp"), *shown)


@query
def indexed_pulls(spark, sf_dir):
    """Three pulls from a folder in which files of a later time land; each opens the files that reach its mark."""
    root = scratch_path(spark, "landed")
    entries = adapter.raw_requests(spark, sf_dir).join(adapter.read_events(spark, sf_dir).select("event_id", "timestamp"), "event_id")
    entries = materialize(entries, "entries")
    span = entries.agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b")).first()
    cuts = [span.a + (span.b - span.a) * part / 3 for part in (1, 2)]
    moment = F.col("timestamp")
    for part in (moment <= F.lit(cuts[0]), (moment > F.lit(cuts[0])) & (moment <= F.lit(cuts[1])), moment > F.lit(cuts[1])):
        entries.where(part).repartitionByRange(4, "timestamp").select("value").write.mode("append").text(f"{root}/in")
        landed.pull_landed(spark, f"{root}/in", f"{root}/files", f"{root}/logs", f"{root}/state", adapter.SALT, freshness_minutes=None)
    stored = tables.read_table(spark, f"{root}/logs")
    shown = ["request_hash", "module_id", "method", "status_code", "has_sensitive_query_key"]
    return stored.select(stamp("timestamp", True).alias("timestamp"), *shown)


@query
def landed_file_times(spark, sf_dir):
    """The index of landed files, one file a user: least and greatest entry time and lines, some without a time."""
    root = scratch_path(spark, "file-times")
    events = adapter.read_events(spark, sf_dir)
    moment = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    value = F.to_json(F.struct(F.when(F.col("k") % 9 != 0, moment).alias("timestamp"), "event_id"))
    lines = events.select("client", value.alias("value"))
    lines.repartition(F.col("client")).write.partitionBy("client").text(f"{root}/in")
    landed.refresh_file_times(spark, f"{root}/in/*", f"{root}/files")
    files = tables.read_table(spark, f"{root}/files")
    client = F.regexp_extract("file_path", "client=([0-9]+)", 1).cast("bigint").alias("client")
    return files.select(client, stamp("low", True).alias("low"), stamp("high", True).alias("high"), "n_lines", "n_untimed")


@query
def refused_lines(spark, sf_dir):
    """A stream of files with broken lines, read by two runs: what each refused, and no row without a key twice."""
    root = scratch_path(spark, "refused")
    k, event = F.col("k"), F.col("event_id").cast("string")
    lines = adapter.read_events(spark, sf_dir).select(
        F.when(k % 10 == 0, F.concat(event, F.lit(" {")))
        .when(k % 10 == 1, F.concat(F.lit("["), event, F.lit("]")))
        .when(k % 10 == 2, F.concat(F.lit('{"event": '), event, F.lit("}")))
        .when(k % 10 == 3, F.lit("   "))
        .otherwise(F.concat(F.lit('{"timestamp": "2024-01-01T00:00:00Z", "event": '), event, F.lit("}")))
        .alias("value")
    )
    lines.repartition(6).write.text(f"{root}/landed")
    for run in ("first", "second"):
        jobs.start_ingest(
            jobs.stream_lines(spark, f"{root}/landed", 2), f"{root}/logs", adapter.SALT, f"{root}/{run}", refused_path=f"{root}/refused"
        ).awaitTermination()
    refused = jobs.read_refused(spark, f"{root}/refused").groupBy("reason", "line_hash").agg(F.sum("n_lines").alias("n_lines"))
    loaded = tables.read_table(spark, f"{root}/logs").agg(F.count(F.lit(1)).alias("n_lines"))
    return refused.unionByName(loaded.select(F.lit("loaded").alias("reason"), F.lit(None).cast("string").alias("line_hash"), "n_lines"))


@query
def scores_of_two_versions(spark, sf_dir):
    """Scores of the versions "001" and "1" in one table, that of "001" loaded twice: two texts, one row a key."""
    scores, _ = _scores(spark, sf_dir)
    path = scratch_path(spark, "versions")
    for version, factor in (("001", 5.0), ("1", -1.0), ("001", 1.0)):
        rows = scores.select("window_start", "ip_hash", F.lit(version).alias("model_version"), (F.col("raw_decision_score") * factor).alias("score"))
        tables.upsert(spark, path, rows, ["window_start", "ip_hash", "model_version"], partition_by="model_version")
    return printable(tables.read_table(spark, path), 9)


@query
def maintained_rarity(spark, sf_dir):
    """Window rarity kept up to date over three loads, the last of which moves requests; equal to a rebuild."""
    root = scratch_path(spark, "frequencies")
    logs = materialize(adapter.request_logs(spark, sf_dir).withColumn("load_order", F.col("timestamp")), "logs")
    third = F.pmod(F.xxhash64("request_hash"), F.lit(3))
    early = logs.withColumns({"timestamp": F.col("timestamp") - F.expr("interval 2 days"), "endpoint_template": F.lit("/elsewhere")})
    at = frequencies.FrequencyTables(f"{root}/kept")
    for load in (logs.where(third == 0).unionByName(early.where(third == 1)), logs.where(third == 2), logs.where(third == 1)):
        tables.load_request_logs(spark, load, f"{root}/logs")
        frequencies.refresh(spark, f"{root}/logs", at)
    return printable(frequencies.window_rarity(spark, at))


# --- profiles ----------------------------------------------------------------


@query
def profile_requests(spark, sf_dir):
    return profile(adapter.request_logs(spark, sf_dir), "request", "requests")


@query
def profile_app_events(spark, sf_dir):
    return profile(adapter.app_logs(spark, sf_dir), "app", "app_events")


@query
def profile_top(spark, sf_dir):
    return profile_top_values(adapter.request_logs(spark, sf_dir), "request")


QUERIES["profile_top_values"] = QUERIES.pop("profile_top")


@query
def profile_app_top_values(spark, sf_dir):
    return profile_top_values(adapter.app_logs(spark, sf_dir), "app")


@query
def nearest_rank_p95_of_tables(spark, sf_dir):
    lines, events = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "events")
    parts = [
        nearest_rank_p95(df, column).select(F.lit(name).alias("measure"), "p95")
        for name, df, column in (
            ("extended_price", lines, "l_extendedprice"),
            ("quantity", lines, "l_quantity"),
            ("event_value", events, "value"),
        )
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


QUERIES["nearest_rank_p95"] = QUERIES.pop("nearest_rank_p95_of_tables")


@query
def quality_metric_upsert(spark, sf_dir):
    """Profiles stored as metric rows; storing one again changes nothing."""
    path = scratch_path(spark, "metrics")
    requests = metric_rows(profile(adapter.request_logs(spark, sf_dir), "request", "requests"))
    apps = metric_rows(profile(adapter.app_logs(spark, sf_dir), "app", "app_events"))
    for rows in (requests, apps, requests):
        tables.load_quality_metrics(spark, rows, path)
    return _numbers(tables.read_table(spark, path))


def _numbers(rows: DataFrame) -> DataFrame:
    """Metric texts as a number where they are one."""
    number = F.col("value").try_cast("double")
    text = F.when(number.isNull(), F.col("value"))
    return rows.select(*[c for c in rows.columns if c != "value"], F.round(number, 6).alias("number"), text.alias("text"))


@query
def metric_csv(spark, sf_dir):
    """The metrics of both logs written as CSV files and read back."""
    root = scratch_path(spark, "csv")
    parts = []
    for logs, kind, name in (
        (adapter.request_logs(spark, sf_dir), "request", "requests"),
        (adapter.app_logs(spark, sf_dir), "app", "app_events"),
    ):
        reports.write_metric_csv(profile(logs, kind, name), f"{root}/{name}")
        parts.append(reports.read_metric_csv(spark, f"{root}/{name}", name))
    return _numbers(parts[0].unionByName(parts[1]))


@query
def quality_report(spark, sf_dir):
    """The Markdown report of the request log, stored, read back and taken apart into the cells of its tables."""
    path = scratch_path(spark, "report")
    reports.write_text(spark, reports.quality_report(adapter.request_logs(spark, sf_dir), "request", "requests"), path)
    cells = F.split(F.expr("substring(value, 3, length(value) - 4)"), " \\| ", -1)
    lines = spark.read.text(path).where("value LIKE '| %' AND value NOT LIKE '| ---%'").select(cells.alias("c"))
    lines = lines.where(~F.col("c")[0].isin("dataset", "column_name"))
    third = F.col("c")[2].try_cast("double")
    return lines.select(
        F.col("c")[0].alias("first"),
        F.col("c")[1].alias("second"),
        F.round(third, 6).alias("third"),
        F.when(third.isNull(), F.col("c")[2]).alias("text"),
        F.get("c", F.lit(3)).cast("int").alias("fourth"),
    )


# --- features ----------------------------------------------------------------


@query
def endpoint_rarity(spark, sf_dir):
    return printable(wf.endpoint_rarity(adapter.request_logs(spark, sf_dir)), 9)


def _features(spark, sf_dir, window="5 minutes"):
    return wf.ip_window_features(adapter.request_logs(spark, sf_dir), window)


@query
def ip_window_features(spark, sf_dir):
    return printable(_features(spark, sf_dir))


@query
def ip_window_features_1h(spark, sf_dir):
    return printable(_features(spark, sf_dir, "1 hour"))


@query
def window_p95_distributed(spark, sf_dir):
    """The window p95 by itself."""
    logs = adapter.request_logs(spark, sf_dir)
    rows = logs.withColumn("window_start", window_start(F.col("timestamp")))
    keys = ["window_start", "ip_hash"]
    return printable(
        exact_quantile(rows, keys, "latency_ms", 0.95, "p95_latency_ms")
    )


@query
def price_median_distributed(spark, sf_dir):
    """A median per group where one group holds a third of the rows."""
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "part_group", F.when(F.col("l_partkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_partkey") % 50)
    )
    return printable(
        exact_quantile(
            lines, ["part_group"], "l_extendedprice", 0.5, "median", levels=2
        )
    )


@query
def user_window_features(spark, sf_dir):
    return printable(wf.user_window_features(adapter.app_logs(spark, sf_dir)))


@query
def feature_summary(spark, sf_dir):
    return wf.feature_summary(
        _features(spark, sf_dir), wf.user_window_features(adapter.app_logs(spark, sf_dir))
    )


@query
def feature_medians(spark, sf_dir):
    return printable(forests.feature_medians(materialize(_features(spark, sf_dir), "features")))


# --- scores ------------------------------------------------------------------

ANOMALY_CUT = -0.3


def proxy_raw() -> Column:
    """A stand-in for a model score that SQL can state; low for outliers."""
    busy = F.least(F.col("request_count") / F.lit(300.0), F.lit(1.0))
    probing = F.least(F.col("suspicious_path_count") / F.lit(20.0), F.lit(1.0))
    return F.round(-(F.lit(0.5) * busy + F.lit(0.3) * F.col("error_rate") + F.lit(0.2) * probing), 9)


def _scores(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Proxy scores and the features they come from."""
    features = materialize(_features(spark, sf_dir), "features")
    ranked = normalize_and_rank(features.withColumn("raw_decision_score", proxy_raw()))
    scores = ranked.select(
        "window_start",
        "ip_hash",
        F.lit("proxy").alias("model_version"),
        "anomaly_score",
        "raw_decision_score",
        (F.col("raw_decision_score") < ANOMALY_CUT).alias("is_anomaly"),
        "anomaly_rank",
    )
    return scores, features


def _threats(spark, sf_dir) -> DataFrame:
    return score_threats(*_scores(spark, sf_dir)).withColumn("scored_at", F.lit(0))


@query
def normalize_and_rank_windows(spark, sf_dir):
    scores, _ = _scores(spark, sf_dir)
    shown = ["window_start", "ip_hash", "raw_decision_score", "anomaly_score", "anomaly_rank"]
    return printable(scores.select(*shown), 9)


QUERIES["normalize_and_rank"] = QUERIES.pop("normalize_and_rank_windows")


@query
def anomaly_counts(spark, sf_dir):
    return printable(views.anomaly_counts(_scores(spark, sf_dir)[0]), 9)


@query
def contamination_cut(spark, sf_dir):
    """Score below which the given share of the training rows lies."""
    scores = materialize(_features(spark, sf_dir).select(proxy_raw().alias("s")), "scores")
    return printable(exact_quantile(scores, [], "s", 0.05, "cut", levels=2))


def _shown_threats(threats: DataFrame) -> DataFrame:
    hidden = {"model_version", "scored_at"}
    return printable(threats.select(*[c for c in threats.columns if c not in hidden]))


@query
def threat_scores(spark, sf_dir):
    return _shown_threats(_threats(spark, sf_dir))


QUERIES["threat_score"] = QUERIES.pop("threat_scores")


@query
def threat_levels(spark, sf_dir):
    return threat_level_counts(_threats(spark, sf_dir))


QUERIES["threat_level_counts"] = QUERIES.pop("threat_levels")


@query
def threat_counts(spark, sf_dir):
    return views.threat_counts(_threats(spark, sf_dir))


# --- views -------------------------------------------------------------------


@query
def overview(spark, sf_dir):
    row = views.overview(_threats(spark, sf_dir))
    levels = [F.col("threat_level_counts")[name].alias(name) for name, _ in THREAT_LEVELS]
    return printable(row.select(*[c for c in row.columns if c != "threat_level_counts"], *levels))


def _alerts(spark, sf_dir, filters):
    logs = adapter.request_logs(spark, sf_dir)
    return _shown_threats(views.alerts(_threats(spark, sf_dir), logs, filters))


@query
def alerts_with_context(spark, sf_dir):
    return _alerts(spark, sf_dir, views.AlertFilter())


@query
def alerts_filtered(spark, sf_dir):
    return _alerts(
        spark, sf_dir, views.AlertFilter(threat_level="medium", security_relevant=True, limit=500)
    )


@query
def timeline_hourly(spark, sf_dir):
    return printable(views.timeline(_threats(spark, sf_dir)))


@query
def incident_latest_day(spark, sf_dir):
    rows = views.incident(_threats(spark, sf_dir), adapter.request_logs(spark, sf_dir))
    return _shown_threats(rows.withColumn("incident_date", F.col("incident_date").cast("string")))


@query
def top_anomaly_windows(spark, sf_dir):
    return printable(views.top_anomalies(*_scores(spark, sf_dir), model_version="proxy"))


@query
def top_threat_windows(spark, sf_dir):
    return _shown_threats(views.top_threats(_threats(spark, sf_dir)))


# --- evaluation --------------------------------------------------------------


@query
def synthetic_scenarios(spark, sf_dir):
    features = materialize(_features(spark, sf_dir), "features")
    return printable(scenarios(features), 9)


QUERIES["scenarios"] = QUERIES.pop("synthetic_scenarios")


def _evaluated(spark, sf_dir) -> DataFrame:
    """Scenario rows with proxy scores scaled over real and scenario rows."""
    features = materialize(_features(spark, sf_dir), "features")
    real = features.select(*REQUEST_FEATURES, F.lit(False).alias("synthetic"))
    made = scenarios(features).withColumn("synthetic", F.lit(True))
    both = real.unionByName(made, allowMissingColumns=True)
    both = both.withColumn("raw_decision_score", proxy_raw())
    scaled = min_max(both, -F.col("raw_decision_score"), "anomaly_score").where("synthetic")
    flagged = scaled.withColumn("is_anomaly", F.col("raw_decision_score") < ANOMALY_CUT)
    return ev.rank_scenarios(threat_score(flagged))


@query
def scenario_threats(spark, sf_dir):
    rows = _evaluated(spark, sf_dir).select(
        *"""synthetic_id anomaly_score is_anomaly threat_score threat_level is_security_relevant
        reasons anomaly_rank threat_rank""".split()
    )
    return printable(rows)


@query
def precision_recall_at_k(spark, sf_dir):
    return printable(ev.ranking_metrics(_evaluated(spark, sf_dir)), 9)


@query
def confusion_metrics(spark, sf_dir):
    return printable(ev.flag_metrics(_evaluated(spark, sf_dir)), 9)


@query
def scenario_summary(spark, sf_dir):
    rows = printable(ev.scenario_summary(_evaluated(spark, sf_dir)))
    return rows.withColumn("avg_threat_score", F.round("avg_threat_score", 4))


@query
def evaluation_of_latest(spark, sf_dir):
    """Metrics, scenario rows and row counts of the newest of two stored evaluations."""
    root = scratch_path(spark, "evaluations")
    scored = materialize(_evaluated(spark, sf_dir), "evaluated")
    for run, rows, moment in (("new", scored, "2024-01-02"), ("old", scored.where("is_attack_like"), "2024-01-01")):
        stamped = {"evaluation_id": F.lit(run), "created_at": F.lit(moment).cast("timestamp")}
        metrics = ev.evaluation_metrics(rows, run, "proxy").withColumn("created_at", stamped["created_at"])
        tables.upsert(spark, f"{root}/metrics", metrics, METRIC_KEYS)
        tables.upsert(spark, f"{root}/scores", rows.withColumns(stamped), SCENARIO_KEYS)
    stored = tables.read_table(spark, f"{root}/scores")
    metrics, summary = views.evaluation_summary(tables.read_table(spark, f"{root}/metrics"), stored)
    rows = summary.select(F.col("scenario_name").alias("ranking_method"), F.lit("rows").alias("metric_name"), F.col("rows").cast("double").alias("metric_value"))
    counts = ev.result_counts(stored.where("evaluation_id = 'new'"))
    pairs = F.array(*[F.struct(F.lit(c).alias("metric_name"), F.col(c).cast("double").alias("metric_value")) for c in counts.columns])
    counts = counts.select(F.inline(pairs))
    parts = [df.withColumn("part", F.lit(name)) for name, df in (("metric", metrics), ("rows", rows), ("counts", counts))]
    both = parts[0].unionByName(parts[1], allowMissingColumns=True)
    return printable(both.unionByName(parts[2], allowMissingColumns=True), 9)


# --- model -------------------------------------------------------------------


@query
def fit_forest(spark, sf_dir):
    """Node table of a forest trained on the window features."""
    features = materialize(_features(spark, sf_dir), "features")
    return printable(forests.fit_forest(features, "forest").nodes)


@query
def score_forest(spark, sf_dir):
    features = materialize(_features(spark, sf_dir), "features")
    model = forests.fit_forest(features, "forest", contamination=0.1)
    return printable(forests.score_forest(features, model), forests.SCORE_DIGITS)


@query
def evaluate_forest(spark, sf_dir):
    """Metrics of a trained forest on the scenarios."""
    features = materialize(_features(spark, sf_dir), "features")
    model = forests.fit_forest(features, "forest")
    scored = ev.score_scenarios(scenarios(features), features, model)
    return printable(ev.evaluation_metrics(materialize(scored, "scored"), "run", "forest"), 9)


def _warehouse(spark, sf_dir) -> Warehouse:
    wh = Warehouse(scratch_path(spark, "warehouse"))
    requests = adapter.request_logs(spark, sf_dir).withColumn("load_order", F.col("timestamp"))
    apps = adapter.app_logs(spark, sf_dir).withColumn("load_order", F.col("timestamp"))
    tables.load_request_logs(spark, requests, wh.path("request_logs"))
    tables.load_app_logs(spark, apps, wh.path("app_logs"))
    return wh


@query
def refresh_end_to_end(spark, sf_dir):
    """Load, features, model, threats and evaluation through stored tables."""
    wh = _warehouse(spark, sf_dir)
    return _shown_threats(run_pipeline(spark, wh, "forest"))


@query
def stored_feature_table(spark, sf_dir):
    """The stored feature table after two builds."""
    from weirwatch.plans.pipeline import build_features

    wh = _warehouse(spark, sf_dir)
    build_features(spark, wh)
    build_features(spark, wh)
    stored = tables.read_table(spark, wh.path("request_features"))
    return printable(stored.drop("log_date"))


# --- streams -----------------------------------------------------------------


@query
def streaming_ip_windows(spark, sf_dir):
    """Window features kept up to date by a stream of landed files.

    The files arrive in any order, so windows are refreshed several times and
    late rows count. Rarity comes from a fixed snapshot.
    """
    root = scratch_path(spark, "stream")
    entries = _plain_entries(spark, sf_dir)
    entries.select("value").repartition(6).write.text(f"{root}/landed")
    snapshot = materialize(wf.endpoint_rarity(adapter.request_logs(spark, sf_dir)), "rarity")
    stream = jobs.stream_entries(spark, f"{root}/landed", files_per_batch=2)
    running = jobs.start_ingest(
        stream, f"{root}/logs", adapter.SALT, f"{root}/checkpoint", f"{root}/features", snapshot
    )
    running.awaitTermination()
    stored = tables.read_table(spark, f"{root}/features")
    return printable(stored.drop("log_date"))


@query
def streaming_live_counters(spark, sf_dir):
    """Counts per window and client kept by a stream of files that land in any order, among broken lines."""
    root = scratch_path(spark, "counters")
    entries = _plain_entries(spark, sf_dir).select("value")
    broken = entries.limit(3).select(F.concat("value", F.lit("}")).alias("value"))
    entries.unionByName(broken).repartition(6).write.text(f"{root}/landed")
    jobs.start_live_counters(
        jobs.stream_lines(spark, f"{root}/landed", 2), f"{root}/logs", f"{root}/counters", f"{root}/refused", adapter.SALT, f"{root}/checkpoint"
    ).awaitTermination()
    return printable(jobs.read_counters(spark, f"{root}/counters"))


def _plain_entries(spark, sf_dir) -> DataFrame:
    """Raw entries that give exactly the adapted request log."""
    logs = adapter.request_logs(spark, sf_dir).join(
        adapter.read_events(spark, sf_dir).select(
            identity.hash_entity(F.col("event_id"), adapter.SALT).alias("request_hash"),
            F.col("event_id").cast("string").alias("event"),
            F.col("client").cast("string").alias("client"),
            "k",
            "value",
        ),
        "request_hash",
    )
    agent = F.when(
        F.col("user_agent_category").isNotNull(),
        F.element_at(
            F.create_map(
                *[
                    F.lit(x)
                    for pair in (
                        ("bot", "ExampleBot/2.1"),
                        ("mobile_browser", "Mozilla/5.0 Mobile"),
                        ("script_or_api_client", "curl/8.5.0"),
                        ("desktop_browser", "Mozilla/5.0 Firefox/126.0"),
                    )
                    for x in pair
                ]
            ),
            F.col("user_agent_category"),
        ),
    )
    payload = F.struct(
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("startTime"),
        F.col("module_id").alias("moduleId"),
        "method",
        F.col("status_code").alias("status"),
        F.format_string("%.6fs", F.col("value") / 100).alias("latency"),
        F.col("response_size").alias("responseSize"),
        F.when(F.col("has_sensitive_query_key"), F.concat("endpoint_path", F.lit("?token=x")))
        .otherwise(F.col("endpoint_path"))
        .alias("resource"),
        F.col("client").alias("ip"),
        agent.alias("userAgent"),
        F.col("event").alias("requestId"),
    )
    return logs.select(F.to_json(F.struct(payload.alias("protoPayload"))).alias("value"))
