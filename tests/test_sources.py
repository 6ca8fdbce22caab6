import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from weirwatch.functions.identity import event_hash
from weirwatch.sources import catalogue, jsonl, raw, reports, tables


def write(folder, name, text):
    path = f"{folder}/{name}"
    with open(path, "w", encoding="utf-8") as out:
        out.write(text)
    return path


LINES = ['{"a":1}', "", "   \t", '{"a":', "[1]", '{"b":"é"}', "7", '{"a":1}{"b":2}', '{"a":1} x']


def test_bad_lines_have_numbers(spark, folder):
    path = write(folder, "x.jsonl", "\n".join(LINES) + "\n")
    bad = jsonl.bad_lines(spark, path).orderBy("line_number").collect()
    assert [(r.line_number, r.problem) for r in bad] == [
        (4, "Invalid JSON"), (5, "Expected JSON object"), (7, "Expected JSON object"),
        (8, "Invalid JSON"), (9, "Invalid JSON"),
    ]
    good = jsonl.read_entries(spark, path, "quarantine").orderBy("load_order").collect()
    assert [r.value for r in good] == ['{"a":1}', '{"b":"é"}']
    with pytest.raises(Exception, match="not one JSON object"):
        jsonl.read_entries(spark, path).count()


def test_line_numbers_across_splits(spark, folder):
    lines = [json.dumps({"i": i}) if i % 1000 else "oops" for i in range(1, 20001)]
    path = write(folder, "big.jsonl", "\n".join(lines) + "\n")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        bad = [r.line_number for r in jsonl.bad_lines(spark, path).orderBy("line_number").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert bad == list(range(1000, 20001, 1000))


def test_array_file(spark, folder):
    path = write(folder, "x.json", json.dumps([{"timestamp": "t", "n": {"m": 1}}, {"timestamp": "u"}], indent=1))
    got = [json.loads(r.value) for r in jsonl.read_array_file(spark, path).orderBy("load_order").collect()]
    assert got == [{"timestamp": "t", "n": {"m": 1}}, {"timestamp": "u"}]


def test_typed_log_and_sink(spark, folder):
    rows = [
        {"timestamp": "2024-01-01T00:00:00Z", "status_code": "404", "latency_ms": "12d", "response_size": "7",
         "is_static_asset": True, "request_hash": "h"},
        {"timestamp": "2024-01-01T00:00:01Z", "status_code": 200, "latency_ms": 1.5, "path_depth": "x"},
    ]
    path = write(folder, "log.jsonl", "\n".join(json.dumps(r) for r in rows))
    got = jsonl.read_request_log(spark, path).orderBy("timestamp")
    assert len(got.columns) == 30
    a, b = got.collect()
    assert (a.status_code, a.latency_ms, a.response_size, a.is_static_asset) == (404, None, 7, True)
    assert (b.status_code, b.latency_ms, b.path_depth, b.request_hash) == (200, 1.5, None, None)
    jsonl.write_jsonl(got.select("status_code", "request_hash").limit(2).coalesce(1), f"{folder}/out")
    back = [json.loads(r.value) for r in spark.read.text(f"{folder}/out").collect()]
    assert {"status_code": 200, "request_hash": None} in back


def test_catalogue(spark, folder):
    write(folder, "log.jsonl", '{"timestamp":"2024-01-01T00:00:00Z"}\n')
    sets = {"r": {"path": f"{folder}/log.jsonl", "type": "request_log", "description": "d"}}
    path = write(folder, "sets.json", json.dumps(sets))
    loaded = catalogue.load_catalogue(spark, path)
    assert loaded["r"].type == "request_log"
    assert catalogue.read_dataset(spark, loaded["r"]).count() == 1
    with pytest.raises(ValueError):
        catalogue.load_catalogue(spark, write(folder, "none.json", "{}"))


def entries(spark, *items):
    return spark.createDataFrame([(json.dumps(i),) for i in items], "value STRING")


def test_request_fallbacks(spark):
    labels = {"labels": {"module_id": "m", "version_id": "v"}}
    got = raw.request_rows(
        entries(
            spark,
            {"timestamp": "", "resource": labels, "httpRequest": {"status": 500}, "insertId": "i",
             "protoPayload": {"startTime": "2024-01-01T00:00:00Z", "moduleId": "", "requestId": "",
                              "resource": "/x?key=1", "responseSize": 12, "finished": True}},
            {"timestamp": "2024-01-01T00:00:01Z", "httpRequest": {"status": 500},
             "protoPayload": {"status": None, "moduleId": "own", "latency": "0.5s"}},
            {"timestamp": "2024-01-01T00:00:02Z", "protoPayload": {"status": "abc"}},
            {"timestamp": "2024-01-01T00:00:03Z"},
        ),
        "salt",
    ).orderBy("timestamp")
    assert len(got.columns) == 28
    a, b, c, d = got.collect()
    assert (a.module_id, a.version_id, a.status_code, a.status_family) == ("m", "v", 500, "5xx")
    assert a.request_hash and a.response_size == 12 and a.finished and a.has_sensitive_query_key
    # A status that is present but null does not fall back.
    assert (b.status_code, b.module_id, b.latency_ms, b.endpoint_path) == (None, "own", 500.0, None)
    assert c.status_code is None and d.endpoint_template == "/" and d.query_key_count == 0


def test_app_entries(spark):
    got = raw.app_rows(
        entries(
            spark,
            {"timestamp": "2024-01-01T00:00:00Z",
             "jsonPayload": {"error": None, "requestData": "{\"token\":1}", "headers": {"Cookie": "x", "cookie": 1},
                             "userId": 7, "responseTime": "12", "url": "/v1/a"}},
            {"timestamp": "2024-01-01T00:00:01Z", "jsonPayload": {"error": "boom", "requestData": {"a": {"b": 1}}}},
            {"timestamp": "2024-01-01T00:00:02Z", "jsonPayload": "text"},
            {"timestamp": "2024-01-01T00:00:03Z", "textPayload": "text"},
        ),
        "salt",
    ).orderBy("timestamp")
    assert len(got.columns) == 28
    a, b = got.collect()
    assert a.has_error and a.error_text_length == 0 and a.response_time_ms == 12.0
    # Text that looks like an object is no object.
    assert (a.request_data_key_count, a.headers_key_count, a.headers_has_sensitive_key) == (0, 1, True)
    assert (b.error_text_length, b.request_data_key_count, b.request_data_has_sensitive_key) == (4, 1, False)


DAY = datetime(2024, 1, 1)


def log(spark, *rows):
    schema = "request_hash STRING, timestamp TIMESTAMP, status_code INT, load_order INT"
    return spark.createDataFrame(rows, schema)


def test_request_upsert_last_wins(spark, folder):
    path = f"{folder}/log"
    next_day = datetime(2024, 1, 2)
    tables.load_request_logs(spark, log(spark, ("a", DAY, 1, 1), ("a", DAY, 2, 2), (None, DAY, 3, 3), (None, DAY, 3, 4), ("b", next_day, 5, 5)), path)
    batch = log(spark, ("a", next_day, 9, 1), ("c", next_day, 4, 2))
    for _ in range(2):
        tables.load_request_logs(spark, batch, path)
    got = {(r.request_hash, r.timestamp, r.status_code) for r in tables.read_table(spark, path).collect()}
    assert got == {("a", next_day, 9), ("b", next_day, 5), ("c", next_day, 4), (None, DAY, 3)}
    assert tables.read_table(spark, path).count() == 5
    # The first day still holds the rows without a key; move them too.
    only = log(spark, ("x", DAY, 1, 1))
    tables.load_request_logs(spark, only, path)
    tables.load_request_logs(spark, log(spark, ("x", next_day, 2, 1)), path)
    assert tables.read_table(spark, path).where("request_hash = 'x'").count() == 1


def test_day_that_loses_all_rows_disappears(spark, folder):
    path = f"{folder}/log"
    tables.load_request_logs(spark, log(spark, ("a", DAY, 1, 1)), path)
    tables.load_request_logs(spark, log(spark, ("a", datetime(2024, 1, 2), 2, 1)), path)
    got = tables.read_table(spark, path).collect()
    assert [(r.request_hash, r.status_code) for r in got] == [("a", 2)]


def test_missing_timestamp_refuses_the_load(spark, folder):
    with pytest.raises(Exception, match="no timestamp"):
        tables.load_request_logs(spark, log(spark, ("a", None, 1, 1)), f"{folder}/log")


def test_app_load_first_wins(spark, folder):
    path = f"{folder}/app"
    rows = [("r", "x", DAY, 1), ("r", "y", DAY, 2), ("r", "x", DAY, 3)]
    df = spark.createDataFrame(rows, "request_hash STRING, event STRING, timestamp TIMESTAMP, load_order INT")
    for _ in range(2):
        tables.load_app_logs(spark, df, path)
    assert tables.read_table(spark, path).count() == 2
    tables.load_app_logs(spark, df.where("event = 'y'"), path, reload=True)
    assert tables.read_table(spark, path).count() == 1


def test_event_hash_sees_every_column(spark):
    df = spark.createDataFrame([(1, None), (1, ""), (1, None)], "b INT, a STRING")
    assert df.select(event_hash(df).alias("h")).distinct().count() == 2


def test_upsert_small_table(spark, folder):
    path = f"{folder}/t"
    first = spark.createDataFrame([("d", "m", "1"), ("d", "n", "2")], "dataset STRING, metric STRING, value STRING")
    tables.load_quality_metrics(spark, first, path)
    tables.load_quality_metrics(spark, first.where("metric = 'm'").withColumn("value", F.lit("9")), path)
    assert {(r.metric, r.value) for r in tables.read_table(spark, path).collect()} == {("m", "9"), ("n", "2")}
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, f"{folder}/none")


def test_metric_csv_round_trip(spark, folder):
    summary = spark.createDataFrame([("d", 3, None)], "dataset STRING, row_count INT, latency_avg_ms DOUBLE")
    reports.write_metric_csv(summary, f"{folder}/m")
    got = {r.metric: r.value for r in reports.read_metric_csv(spark, f"{folder}/m", "d").collect()}
    assert got == {"dataset": "d", "row_count": "3", "latency_avg_ms": None}


def test_broken_array_file_is_an_error(spark, folder):
    with open(f"{folder}/a.json", "w") as f:
        f.write('[{"a": 1}, {"a":')
    with pytest.raises(Exception, match="not a JSON array"):
        jsonl.read_array_file(spark, f"{folder}/a.json").collect()
