"""Web logs out of a generic event stream.

The events table has an id, a time, a user, a type, a value and a JSON bag
``{"k": 0..99}``. It is too sparse for five-minute windows, so its clock runs
sixty times faster here and users fold into a few clients, one of them hot
with more than a third of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirwatch.functions.casts import status_family
from weirwatch.functions.identity import hash_entity
from weirwatch.functions.paths import generalize_paths

SALT = "salt"
_ORIGIN = 1_704_067_200_000_000  # 2024-01-01 UTC in microseconds


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    # The column has no zone; the session zone is UTC.
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    folded = F.when(F.col("user_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id") % 10)
    return events.select(
        "event_id",
        F.timestamp_micros(
            F.lit(_ORIGIN) + F.expr(f"(unix_micros(cast(ts as timestamp)) - {_ORIGIN}L) div 60")
        ).alias("timestamp"),
        micros.alias("micros"),
        "user_id",
        folded.cast("bigint").alias("client"),
        F.col("event_type").alias("kind"),
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def _path() -> Column:
    kind, k = F.col("kind"), F.col("k")
    ks = k.cast("string")
    probe = (
        F.when(k % 4 == 0, F.lit("/wp-login.php"))
        .when(k % 4 == 1, F.lit("/.env"))
        .when(k % 4 == 2, F.lit("/backup/db.sql"))
        .otherwise(F.concat(F.lit("/missing/page-"), ks))
    )
    return (
        F.when(kind == "view", F.concat(F.lit("/api/items/"), F.col("event_id").cast("string")))
        .when(kind == "click", F.concat(F.lit("/static/app-"), ks, F.lit(".js")))
        .when(
            kind == "purchase",
            F.concat(F.lit("/v1/orders/"), ks, F.lit("/line-item-"), (k % 7).cast("string")),
        )
        .when(kind == "signup", F.lit("/account/sign-up-now"))
        .otherwise(probe)
    )


def _method() -> Column:
    kind = F.col("kind")
    return F.when(kind == "purchase", "POST").when(kind == "signup", "PUT").otherwise("GET")


def _status() -> Column:
    kind, k = F.col("kind"), F.col("k")
    return (
        F.when(kind == "error", F.when(k % 4 == 0, 500).otherwise(404))
        .when((kind == "click") & (k < 60), 304)
        .otherwise(200)
    )


def _module() -> Column:
    return F.when(F.col("k") % 2 == 0, F.lit("web")).otherwise(F.lit("worker"))


def request_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generalised request log rows."""
    k = F.col("k")
    status = _status()
    rows = read_events(spark, sf_dir).select(
        "timestamp",
        _module().alias("module_id"),
        _method().alias("method"),
        status.alias("status_code"),
        status_family(status).alias("status_family"),
        (F.col("value") * 10).alias("latency_ms"),
        F.when(k % 17 != 0, k * 100).cast("bigint").alias("response_size"),
        _path().alias("endpoint_path"),
        ((F.col("kind") == "view") & (k % 10 == 0)).alias("has_sensitive_query_key"),
        hash_entity(F.col("client"), SALT).alias("ip_hash"),
        F.when(k % 50 == 0, F.lit(None).cast("string"))
        .when(k % 5 == 0, F.lit("bot"))
        .when(k % 5 == 1, F.lit("mobile_browser"))
        .when(k % 5 == 2, F.lit("script_or_api_client"))
        .otherwise(F.lit("desktop_browser"))
        .alias("user_agent_category"),
        hash_entity(F.col("event_id"), SALT).alias("request_hash"),
    )
    return generalize_paths(rows)


def app_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generalised application log rows."""
    k = F.col("k")
    status = F.when(k % 3 != 0, _status())
    rows = read_events(spark, sf_dir).select(
        "timestamp",
        _module().alias("module_id"),
        F.when(F.col("kind") == "error", F.lit("error")).otherwise(F.lit("info")).alias("level"),
        F.col("kind").alias("event"),
        _method().alias("method"),
        status.alias("status_code"),
        status_family(status).alias("status_family"),
        (F.col("value") * 10).alias("response_time_ms"),
        _path().alias("endpoint_path"),
        hash_entity(F.col("client"), SALT).alias("user_id_hash"),
        F.when(k % 9 != 0, hash_entity(F.col("user_id") % 4, SALT)).alias("tenant_hash"),
        hash_entity(F.expr("event_id div 2"), SALT).alias("request_hash"),
        (F.col("kind") == "error").alias("has_error"),
        (k % 11 == 0).alias("request_data_has_sensitive_key"),
        (k % 13 == 0).alias("response_data_has_sensitive_key"),
        (k % 19 == 0).alias("headers_has_sensitive_key"),
    )
    return generalize_paths(rows)


# One agent text per user-agent category; index k % 5, and none for k % 50 == 0.
AGENTS = [
    "Mozilla/5.0 (compatible; ExampleBot/2.1)",
    "Mozilla/5.0 (Linux; Android 14) Mobile",
    "curl/8.5.0",
    "Mozilla/5.0 (X11; Linux x86_64) Firefox/126.0",
    "ExampleReader/1.0",
]


def _agent() -> Column:
    k = F.col("k")
    texts = F.array(*[F.lit(a) for a in AGENTS])
    return F.when(k % 50 != 0, F.element_at(texts, k % 5 + 1))


def raw_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw request entries as JSON text, with their repeats and gaps.

    Some entries take their status, module or identity from the fallback
    fields, some carry unparsable numbers, and some have e-mails or long
    numbers in the path.
    """
    k, event = F.col("k"), F.col("event_id").cast("string")
    stamp = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    query = (
        F.when((F.col("kind") == "view") & (k % 10 == 0), F.concat(F.lit("?Token="), event, F.lit("&page=2#top")))
        .when(k % 7 == 0, F.lit("?page=1&&size=20"))
        .otherwise(F.lit(""))
    )
    scheme = F.when(k % 6 == 0, F.lit("https://www.example.org")).otherwise(F.lit(""))
    mail = F.when(k % 23 == 0, F.concat(F.lit("/u/user"), k.cast("string"), F.lit("@example.org"))).otherwise(F.lit(""))
    payload = F.struct(
        stamp.alias("startTime"),
        F.when(k % 4 != 0, _module()).alias("moduleId"),
        _method().alias("method"),
        F.when(k % 5 != 0, _status().cast("string")).alias("status"),
        F.when(k % 31 == 0, F.lit("n/a"))
        .otherwise(F.format_string("%.6fs", F.col("value") / 100))
        .alias("latency"),
        F.when(k % 17 != 0, (k * 100).cast("string")).alias("responseSize"),
        F.concat(scheme, mail, _path(), query).alias("resource"),
        F.lit("www.example.org").alias("host"),
        F.col("client").cast("string").alias("ip"),
        _agent().alias("userAgent"),
        F.when(k % 8 != 0, event).alias("requestId"),
    )
    entry = F.struct(
        F.when(k % 3 != 0, stamp).alias("timestamp"),
        F.concat(F.lit("insert-"), event).alias("insertId"),
        F.struct(F.struct(F.lit("fallback").alias("module_id")).alias("labels")).alias("resource"),
        F.struct(_status().alias("status")).alias("httpRequest"),
        payload.alias("protoPayload"),
    )
    return read_events(spark, sf_dir).select("event_id", F.to_json(entry).alias("value"))


def raw_app_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw application entries as JSON text; some have no object payload."""
    k, event = F.col("k"), F.col("event_id").cast("string")
    stamp = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    data = F.when(
        k % 11 == 0, F.map_from_arrays(F.array(F.lit("Token"), F.lit("page")), F.array(event, F.lit("1")))
    ).when(k % 2 == 0, F.create_map(F.lit("page"), event))
    headers = F.when(k % 19 == 0, F.create_map(F.lit("Authorization"), F.lit("x"), F.lit("Accept"), F.lit("y")))
    payload = F.struct(
        F.when(F.col("kind") == "error", F.lit("error")).otherwise(F.lit("info")).alias("level"),
        F.col("kind").alias("event"),
        _method().alias("method"),
        F.when(k % 3 != 0, _status().cast("string")).otherwise(F.lit("none")).alias("status"),
        F.floor(F.col("value") * 10).cast("string").alias("responseTime"),
        _path().alias("url"),
        F.col("client").cast("string").alias("userId"),
        F.when(k % 9 != 0, (F.col("user_id") % 4).cast("string")).otherwise(F.lit("")).alias("shopId"),
        F.when(F.col("kind") == "error", F.concat(F.lit("failed "), event)).alias("error"),
        data.alias("requestData"),
        headers.alias("headers"),
    )
    entry = F.struct(
        stamp.alias("timestamp"),
        stamp.alias("receiveTimestamp"),
        F.concat(F.lit("insert-"), event).alias("insertId"),
        F.struct(F.struct(_module().alias("module_id")).alias("labels")).alias("resource"),
        F.when(k % 29 != 0, payload).alias("jsonPayload"),
    )
    return read_events(spark, sf_dir).select("event_id", F.to_json(entry).alias("value"))
