"""Loads that read an entry once, spread a pull over tasks, and leave stored days alone."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from weirwatch.plans import ingest
from weirwatch.sources import snapshots, tables
from weirwatch.streaming import jobs


@pytest.fixture()
def scratch(folder, monkeypatch):
    """The folder that holds all intermediate tables of a test."""
    monkeypatch.setattr("weirwatch.session.scratch_root", lambda spark: f"{folder}/scratch")
    return Path(folder, "scratch")


def stored_columns(spark, scratch):
    return {c for part in scratch.glob("weirwatch/*") for c in spark.read.parquet(str(part)).columns}


def request(at, name):
    return f'{{"timestamp": "{at}", "protoPayload": {{"requestId": "{name}", "resource": "/a"}}}}'


def test_a_pull_reads_each_entry_once(spark, folder, scratch):
    seen = spark.sparkContext.accumulator(0)

    def counted(value):
        seen.add(1)
        return value

    lines = [request(f"2024-01-01T00:00:{i:02d}Z", f"r{i}") for i in range(20)] + ['{"event": 1}'] * 2
    raw = spark.createDataFrame([(v, i) for i, v in enumerate(lines)], "value STRING, load_order BIGINT").coalesce(1)
    entries = raw.select(F.udf(counted, "string")("value").alias("value"), "load_order")
    loaded = ingest.ingest_requests(
        spark, entries, f"{folder}/logs", f"{folder}/state", "salt", freshness_minutes=None, refused_path=f"{folder}/refused"
    )
    assert loaded == 20 and seen.value == 22
    assert [r.n_lines for r in tables.read_table(spark, f"{folder}/refused").collect()] == [2]
    assert "value" not in stored_columns(spark, scratch)


def test_a_pull_of_one_stretch_of_a_file_is_dealt_out_anew(spark, folder):
    lines = [(request(f"2024-01-01T00:{i % 60:02d}:00Z", f"r{i}"), i) for i in range(10)]
    entries = spark.createDataFrame(lines, "value STRING, load_order BIGINT")
    plans = []
    materialize = ingest.materialize
    ingest.materialize = lambda df, name: plans.append(df._jdf.queryExecution().toString()) or materialize(df, name)
    try:
        ingest.ingest_requests(spark, entries, f"{folder}/logs", f"{folder}/state", "salt", freshness_minutes=None)
    finally:
        ingest.materialize = materialize
    assert any("REBALANCE" in p.upper() for p in plans)


def test_stream_lines_are_stored_as_rows_and_hashes_only(spark, folder, scratch):
    lines = [request("2024-01-01T00:00:01Z", "a"), "{broken", "{broken", '{"event": 1}', "[1]", "   "]
    Path(folder, "in").mkdir()
    Path(folder, "in", "x.txt").write_text("\n".join(lines) + "\n")
    jobs.start_ingest(
        jobs.stream_lines(spark, f"{folder}/in"), f"{folder}/logs", "salt", f"{folder}/ck", refused_path=f"{folder}/refused"
    ).awaitTermination()
    refused = jobs.read_refused(spark, f"{folder}/refused").collect()
    assert sorted((r.reason, r.n_lines) for r in refused) == [("no timestamp", 1), ("not one JSON object", 1), ("not one JSON object", 2)]
    assert tables.read_table(spark, f"{folder}/logs").count() == 1
    assert not {"value", "line"} & stored_columns(spark, scratch)


def test_new_keys_leave_the_stored_day_as_it_is(spark, folder):
    path = f"{folder}/t"

    def load(key, status):
        rows = [(key, datetime(2024, 1, 1), status, 1)]
        tables.load_request_logs(spark, spark.createDataFrame(rows, "request_hash STRING, timestamp TIMESTAMP, status_code INT, load_order INT"), path)
        return set(snapshots.latest(spark, path).data)

    first, second = load("a", 200), load("b", 200)
    assert first < second
    load("a", 500)  # a stored key: its day is rewritten, and the key is there once
    load(None, 204)
    stored = sorted(tuple(r) for r in tables.read_table(spark, path).select(F.coalesce("request_hash", F.lit("-")), "status_code").collect())
    assert stored == [("-", 204), ("a", 500), ("b", 200)]


def test_intermediate_row_groups_are_small(spark, folder, scratch):
    import pyarrow.parquet as pq

    from weirwatch.session import materialize

    rows = spark.range(0, 300_000, 1, 1).select(F.concat_ws("", *[F.sha2(F.concat_ws("-", "id", F.lit(i)), 256) for i in range(2)]).alias("v"))
    materialize(rows, "wide").count()
    files = list(scratch.glob("weirwatch/wide-*/*.parquet"))
    assert sum(pq.ParquetFile(f).num_row_groups for f in files) >= 3
