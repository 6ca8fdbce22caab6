"""Snapshots, the key index, the file ledger and maintained frequencies."""

import contextlib
import io
import json
import os
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from weirwatch.operators.window_features import ip_window_features
from weirwatch.plans import frequencies, ingest
from weirwatch.sources import event_adapter as adapter
from weirwatch.sources import key_index, snapshots, tables
from weirwatch.streaming import jobs

from conftest import SF_DIR
from test_plans import entry, land


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def scores(spark, version, *values):
    return spark.createDataFrame([(f"w{i}", version, v) for i, v in enumerate(values)], "w STRING, model_version STRING, score DOUBLE")


def test_versions_stay_text(spark, folder):
    path, keys = f"{folder}/t", ["w", "model_version"]
    for version, value in (("001", 1.0), ("1", 2.0), ("001", 3.0)):
        tables.upsert(spark, path, scores(spark, version, value), keys, partition_by="model_version")
    stored = tables.read_table(spark, path)
    assert dict(stored.dtypes)["model_version"] == "string"
    assert sorted(map(tuple, stored.collect())) == [("w0", "001", 3.0), ("w0", "1", 2.0)]
    # Any text is a version: separators, nothing, and null.
    for version in ("a/b=c%", "", None):
        tables.upsert(spark, path, scores(spark, version, 9.0), keys, partition_by="model_version")
    assert {r.model_version for r in tables.read_table(spark, path).collect()} == {"001", "1", "a/b=c%", "", None}


def test_a_write_that_is_cut_off_leaves_the_table(spark, folder):
    path = f"{folder}/t"
    tables.overwrite(scores(spark, "a", 1.0), path)
    before = snapshots.latest(spark, path)
    snapshots.write_data(scores(spark, "b", 7.0), path)  # written, never published
    os.makedirs(f"{path}/manifest/commit=1/_temporary/0")
    open(f"{path}/manifest/commit=1/_temporary/0/part-0.parquet", "w").write("half")
    assert snapshots.latest(spark, path) == before
    assert [r.score for r in tables.read_table(spark, path).collect()] == [1.0]
    tables.overwrite(scores(spark, "c", 5.0), path)
    assert [r.score for r in tables.read_table(spark, path).collect()] == [5.0]
    assert [r.score for r in tables.read_table(spark, path, commit=0).collect()] == [1.0]


def test_a_failing_load_leaves_the_table(spark, folder):
    path = f"{folder}/t"
    tables.overwrite(scores(spark, "a", 1.0), path)
    bad = scores(spark, "a", 2.0).withColumn("score", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        tables.upsert(spark, path, bad, ["w"])
    with pytest.raises(ValueError, match="lacks columns"):
        tables.upsert(spark, path, scores(spark, "a", 2.0).withColumn("more", F.lit(1)), ["w"])
    assert [r.score for r in tables.read_table(spark, path).collect()] == [1.0]


def test_a_reader_keeps_its_snapshot(spark, folder):
    path = f"{folder}/t"
    tables.overwrite(scores(spark, "a", 1.0, 2.0), path)
    reader = tables.read_table(spark, path)
    tables.upsert(spark, path, scores(spark, "a", 5.0), ["w"])
    tables.overwrite(scores(spark, "z", 8.0), path)
    assert sorted(r.score for r in reader.collect()) == [1.0, 2.0]
    assert snapshots.commits(spark, path) == [0, 1, 2]
    assert snapshots.expire(spark, path, keep=1) == 2
    assert snapshots.commits(spark, path) == [2] and len(os.listdir(f"{path}/data")) == 1
    assert [r.score for r in tables.read_table(spark, path).collect()] == [8.0]


def test_two_writers(spark, folder):
    path = f"{folder}/t"
    tables.overwrite(scores(spark, "a", 1.0), path)
    old = snapshots.latest(spark, path)
    tables.overwrite(scores(spark, "b", 2.0), path)
    with pytest.raises(snapshots.ConcurrentWrite):
        snapshots.publish(spark, old, old)
    assert [r.score for r in tables.read_table(spark, path).collect()] == [2.0]


def test_empty_tables(spark, folder):
    path = f"{folder}/t"
    tables.upsert(spark, path, scores(spark, "a"), ["w"], partition_by="model_version")
    assert tables.read_table(spark, path).count() == 0 and tables.read_table(spark, path).columns == ["w", "model_version", "score"]
    tables.upsert(spark, path, scores(spark, "a", 4.0), ["w"], partition_by="model_version")
    tables.upsert(spark, path, scores(spark, "a"), ["w"], partition_by="model_version")
    assert tables.read_table(spark, path).count() == 1


FIRST = date(2024, 1, 1)


def log(spark, rows):
    """Rows of (key, day number, value)."""
    return spark.createDataFrame([(k, FIRST + timedelta(d), v) for k, d, v in rows], "k STRING, log_date DATE, v INT")


def stored_rows(spark, path):
    return sorted(((r.k, (r.log_date - FIRST).days, r.v) for r in tables.read_table(spark, path).collect()), key=str)


@pytest.mark.parametrize("keep", ["last", "first"])
@pytest.mark.parametrize("clash", [False, True])
def test_loads_equal_a_plain_table(spark, folder, monkeypatch, keep, clash):
    """Random loads whose keys move between days; index hashes may clash, and runs are merged."""
    monkeypatch.setattr(key_index, "MOST_RUNS", 3)
    if clash:
        real = F.xxhash64
        monkeypatch.setattr(key_index.F, "xxhash64", lambda *c: F.pmod(real(*c), F.lit(5)))
    draw, path, want, keyless = random.Random(f"{keep}{clash}"), f"{folder}/t", {}, []
    for _ in range(5):
        batch = {f"k{draw.randrange(30)}": (draw.randrange(6), draw.randrange(100)) for _ in range(draw.randint(1, 12))}
        for k, v in batch.items():
            if keep == "last" or k not in want:
                want[k] = v
        extra = [(None, draw.randrange(6), draw.randrange(100)) for _ in range(2)]
        keyless += extra
        tables.upsert(spark, path, log(spark, [(k, *v) for k, v in batch.items()] + extra), ["k"], keep, partition_by="log_date")
    assert stored_rows(spark, path) == sorted([(k, *v) for k, v in want.items()] + keyless, key=str)


def test_a_load_reads_few_keys_and_days(spark, folder):
    """One key of a hundred comes in: its buckets of the index are opened, and its days of the table."""
    path = f"{folder}/t"
    n, days = 3000, 30
    tables.upsert(spark, path, log(spark, [(f"k{i}", i % days, i) for i in range(n)]), ["k"], partition_by="log_date")
    old = snapshots.latest(spark, path)
    few = log(spark, [(f"k{i}", 3 + i % 2, -i) for i in range(0, 30)])
    few = few.where("k in ('k3', 'k4', 'k13', 'k14')").withColumn("log_date", F.lit(FIRST + timedelta(3)))
    hits = key_index.lookup(spark, old, key_index.entries(few, ["k"], "log_date"))
    text = plan(hits)
    assert "PartitionFilters" in text and "bucket" in text and "/data/" not in text
    assert {(r.part, r.key_hash) for r in hits.collect()} and {r.part for r in hits.collect()} == {str(FIRST + timedelta(d)) for d in (3, 4, 13, 14)}
    opened = hits.inputFiles()
    assert not any("/data/" in f for f in opened)
    tables.upsert(spark, path, few, ["k"], partition_by="log_date")
    new = snapshots.latest(spark, path)
    touched = {str(FIRST + timedelta(d)) for d in (3, 4, 13, 14)}
    assert snapshots.changed_parts(old, new) == touched
    assert {f for f, p in old.data if p not in touched} <= {f for f, _ in new.data}
    matches = tables.stored_matches(spark, path, few.select("k"), ["k"])
    assert matches.count() == 4 and len({f.split("_part=")[1].split("/")[0] for f in matches.inputFiles() if "_part=" in f}) <= 4
    assert tables.read_table(spark, path).count() == n


def test_compaction(spark, folder):
    path = f"{folder}/t"
    for i in range(6):
        tables.upsert(spark, path, log(spark, [(f"k{i}", 0, i)]), ["k"], "first", partition_by="log_date")
    before = stored_rows(spark, path)
    assert tables.compact(spark, path, most=3) == 1 and tables.compact(spark, path, most=3) == 0
    assert stored_rows(spark, path) == before and len(snapshots.latest(spark, path).data) == 1


def ingest_run(spark, folder, checkpoint, per_batch=1):
    lines = jobs.stream_lines(spark, f"{folder}/in", per_batch)
    jobs.start_ingest(lines, f"{folder}/logs", "salt", f"{folder}/{checkpoint}", refused_path=f"{folder}/refused").awaitTermination()


def test_files_read_again_count_once(spark, folder):
    os.mkdir(f"{folder}/in")
    untimed = json.dumps({"protoPayload": {"ip": "c1"}})
    land(f"{folder}/in", "a", [entry(0, 1, None), entry(0, 1, None), entry(0, 2, "k1"), "broken {", "broken {", untimed])
    land(f"{folder}/in", "b", [entry(0, 1, None), "[1]"])
    ingest_run(spark, folder, "one")
    rows = lambda: sorted((r.request_hash is None, r.timestamp) for r in tables.read_table(spark, f"{folder}/logs").collect())
    want = [(False, datetime(2024, 1, 1, 0, 0, 2))] + [(True, datetime(2024, 1, 1, 0, 0, 1))] * 3
    refused = lambda: sorted((r.reason, r.n_lines, r.file_path[-1]) for r in jobs.read_refused(spark, f"{folder}/refused").collect())
    bad = [("no timestamp", 1, "a"), ("not one JSON object", 1, "b"), ("not one JSON object", 2, "a")]
    assert rows() == want and refused() == bad
    # Another run over the same files, dealt into other batches, adds only what is new.
    land(f"{folder}/in", "c", [entry(0, 1, None)])
    ingest_run(spark, folder, "two", per_batch=3)
    assert rows() == [*want, want[-1]] and refused() == bad
    assert {r.file_path[-1] for r in tables.loaded_files(spark, f"{folder}/logs").collect()} == {"a", "b", "c"}


def test_a_batch_run_twice_counts_once(spark, folder):
    os.mkdir(f"{folder}/in")
    land(f"{folder}/in", "a", [entry(0, 1, None), entry(0, 2, "k1")])
    batch = jobs.stream_lines(spark, f"{folder}/in")
    for run in ("x", "y"):  # as after a crash between the load and the stream's own commit
        jobs.start_live_counters(batch, f"{folder}/logs", f"{folder}/counts", f"{folder}/refused", "salt", f"{folder}/{run}").awaitTermination()
    assert [r.request_count for r in jobs.read_counters(spark, f"{folder}/counts").collect()] == [2]


def raw_entry(stamp, key):
    return json.dumps({"timestamp": stamp, "protoPayload": {"requestId": key, "ip": "c"}})


def test_pull_without_a_mark_takes_the_last_hour(spark, folder):
    now = F.lit(datetime(2024, 1, 1, 12)).cast("timestamp")
    lines = [raw_entry("2020-01-01T00:00:00Z", "old"), raw_entry("2024-01-01T11:30:00Z", "new"), raw_entry("soon", "odd"), raw_entry("soon", "odd")]
    entries = spark.createDataFrame([(v, i) for i, v in enumerate(lines)], "value STRING, load_order INT")
    args = (spark, entries, f"{folder}/logs", f"{folder}/state", "salt")
    with pytest.raises(ValueError, match="no timestamp"):
        ingest.ingest_requests(*args, now=now)
    for _ in range(2):
        assert ingest.ingest_requests(*args, now=now, refused_path=f"{folder}/refused") == 1
    assert [r.timestamp for r in tables.read_table(spark, f"{folder}/logs").collect()] == [datetime(2024, 1, 1, 11, 30)]
    assert [(r.reason, r.n_lines) for r in tables.read_table(spark, f"{folder}/refused").collect()] == [("no timestamp", 2)]
    # The mark is stored: a later pull goes back by the overlap only, whatever the time.
    late = spark.createDataFrame([(raw_entry("2024-01-01T11:26:00Z", "late"), 1), (raw_entry("2024-01-01T11:00:00Z", "gone"), 2)], "value STRING, load_order INT")
    assert ingest.ingest_requests(spark, late, f"{folder}/logs", f"{folder}/state", "salt") == 1
    assert ingest.ingest_requests(spark, entries, f"{folder}/all", f"{folder}/state2", "salt", freshness_minutes=None, refused_path=f"{folder}/r2") == 2


def test_frequencies_read_touched_days_only(spark, folder, monkeypatch):
    logs = adapter.request_logs(spark, SF_DIR).withColumn("load_order", F.col("timestamp"))
    day = F.to_date("timestamp")
    moved = logs.withColumn("timestamp", F.col("timestamp") + F.expr("interval 3 days"))
    path, at = f"{folder}/logs", frequencies.FrequencyTables(f"{folder}/kept")
    tables.load_request_logs(spark, logs, path)
    everything = frequencies.refresh(spark, path, at)
    assert everything == {str(r[0]) for r in logs.select(day).distinct().collect()}
    asked = []
    real = frequencies.read_table

    def watched(spark, where, parts=None, commit=None):
        if where == path:
            asked.append(parts)
        return real(spark, where, parts, commit)

    monkeypatch.setattr(frequencies, "read_table", watched)
    assert frequencies.refresh(spark, path, at) == set() and asked == []
    more = moved.orderBy("request_hash").limit(20).withColumn("request_hash", F.concat("request_hash", F.lit("x")))
    gone = logs.orderBy("request_hash").limit(5).withColumn("timestamp", F.to_timestamp(F.lit("2024-03-01 10:00:00")))
    for load in (more, gone):
        tables.load_request_logs(spark, load, path)
        days = frequencies.refresh(spark, path, at)
        assert asked[-1] is not None and set(asked[-1]) == days
    whole = tables.read_table(spark, path)
    want = {(r.window_start, r.ip_hash): (r.request_count, round(r.avg_endpoint_rarity, 9)) for r in ip_window_features(whole).collect() if r.avg_endpoint_rarity is not None}
    got = {(r.window_start, r.ip_hash): (r.request_count, round(r.avg_endpoint_rarity, 9)) for r in frequencies.window_rarity(spark, at).collect() if r.avg_endpoint_rarity is not None}
    assert got == want
    counts = {r.endpoint_template: r.endpoint_count for r in frequencies.rarity(spark, at).collect()}
    assert counts == {r.endpoint_template: r["count"] for r in whole.groupBy("endpoint_template").count().collect()}
