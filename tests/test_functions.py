from datetime import datetime

from pyspark.sql import functions as F

from weirwatch.functions import casts, identity, paths, urls, windows


def test_hash_entity(one):
    got = one(lambda v: identity.hash_entity(v, "salt"), "1.2.3.4", "", None)
    assert got == ["63c9490119d110b7", None, None]


def test_clean_path_scrubs_in_order(one):
    uuid = "550e8400-e29b-41d4-a716-446655440000"
    got = one(
        urls.clean_path,
        f"/u/a@b.co/12345/1234567890123456/{uuid}/x-9999-y",
        "http://h",
        "//foo/bar",
        "",
        None,
        "/a b|c{x}?k=1&Token=z#f",
        "https://u@h.org:80/p/q?x#y",
        "/" + "a" * 3000,
    )
    assert got[0] == "/u/{email}/{num}/{hex}/{uuid}/x-{num}-y"
    assert got[1:7] == ["/", "/bar", None, None, "/a b|c{x}", "/p/q"]
    assert got[7] == "/{hex}"


def test_query_keys(one):
    values = ["/a b|c{x}?k=1&Token=z#f", "/a", None, "/a?&&x", "/a#?token=1", "/a?sid"]
    assert one(urls.query_key_count, *values) == [2, 0, 0, 1, 0, 1]
    assert one(urls.has_sensitive_query_key, *values) == [True, False, False, False, False, True]


def test_payload_keys(spark):
    rows = [({"Token": "x", "a": "1", "A": "2"},), ({},), (None,)]
    df = spark.createDataFrame(rows, "m MAP<STRING, STRING>")
    got = df.select(
        urls.payload_key_count(F.col("m")).alias("n"), urls.has_sensitive_payload_key(F.col("m")).alias("s")
    ).collect()
    assert [(r.n, r.s) for r in got] == [(2, True), (0, False), (0, False)]


def test_user_agent_category(one):
    got = one(
        urls.user_agent_category,
        "Mozilla Googlebot", "Mozilla Android", "Mozilla/5.0", "curl/8", "x", "", None,
    )
    assert got == ["bot", "mobile_browser", "desktop_browser", "script_or_api_client", "other", None, None]


def test_casts(one):
    assert one(casts.latency_ms, "0.1234567s", "12", "abc", "", "1.5ss", "12d", None) == [
        123.457, 12000.0, None, None, None, None, None,
    ]
    assert one(casts.lenient_int, " 12 ", "12.7", "abc", "", "99999999999") == [12, None, None, None, None]
    assert one(casts.lenient_double, " 1e3 ", "12d", "nan", ".5") == [1000.0, None, None, 0.5]
    assert one(lambda v: casts.status_family(casts.lenient_int(v)), "200", "0", None, "404") == [
        "2xx", "0xx", None, "4xx",
    ]
    assert one(casts.lenient_timestamp, "2024-01-01T02:00:00+02:00", "2024-01-01T00:00:00.5Z", "no", "") == [
        datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 0, 500000), None, None,
    ]


PATHS = [
    ("/api/items/42", "/api/items/{num}", "api"),
    ("/A-B/a-b", "/a-b/{slug}", "application_route"),
    ("/abcdef123456/X.MAP", "/{hex}/{static_file}", "static_asset"),
    ("/x/" + "y" * 31, "/x/{long_segment}", "application_route"),
    ("/1/2/3/4/5/6/7", "/{num}/{num}/{num}/{num}/{num}/{num}", "application_route"),
    ("//", "/", "root"),
    (None, "/", "root"),
    ("/order-{num}/x", "/order-{num}/x", "application_route"),
    ("/API/x.js", "/api/{static_file}", "api"),
    ("/a/backup.css", "/a/{static_file}", "static_asset"),
    ("/a/.git/config", "/a/.git/config", "suspicious_probe"),
    ("/v2/x", "/v2/x", "versioned_api"),
    ("/v3/x", "/v3/x", "application_route"),
    ("/u/{EMAIL}", "/u/{email}", "application_route"),
]


def test_generalize_paths(spark):
    df = spark.createDataFrame([(i, p[0]) for i, p in enumerate(PATHS)], "i INT, endpoint_path STRING")
    got = paths.generalize_paths(df).orderBy("i").collect()
    assert [(r.endpoint_template, r.endpoint_group) for r in got] == [p[1:] for p in PATHS]
    by_path = {r.endpoint_path: r for r in got}
    assert by_path[None].path_depth == 0 and by_path[None].path_length == 0
    assert not by_path[None].has_suspicious_path_pattern and not by_path[None].is_static_asset
    # The flag is independent of the group.
    assert by_path["/a/backup.css"].has_suspicious_path_pattern
    assert by_path["/1/2/3/4/5/6/7"].path_depth == 7


def test_windows(spark):
    times = ["05:55:00", "05:59:59.999999", "06:00:00", "21:55:00", "22:00:00", "00:07:31"]
    df = spark.createDataFrame([(f"2024-01-01 {t}",) for t in times], "t STRING")
    df = df.select(F.col("t").cast("timestamp").alias("t"))
    start = windows.window_start(F.col("t"))
    got = df.select("t", start.alias("w"), windows.off_hours(start).alias("off"), F.window("t", "5 minutes").start.alias("s"))
    rows = got.orderBy("t").collect()
    assert all(r.w == r.s for r in rows)
    assert [r.off for r in rows] == [True, True, True, False, False, True]
    assert windows.window_seconds("1 hour") == 3600


def test_off_hours_in_a_zone(spark):
    df = spark.sql("SELECT timestamp'2024-06-07 20:35:00' AS t")
    got = df.select(windows.off_hours(F.col("t")).alias("u"), windows.off_hours(F.col("t"), "Europe/Berlin").alias("b"))
    assert tuple(got.first()) == (False, True)
