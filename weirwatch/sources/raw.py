"""Raw log entries to anonymised rows.

Both projections take a DataFrame with one JSON entry per row in ``value`` and
keep no raw address, host, agent, identifier or payload.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirwatch.functions.casts import (
    first_present,
    latency_ms,
    lenient_int,
    lenient_long,
    lenient_timestamp,
    none_if_empty,
    status_family,
)
from weirwatch.functions.identity import hash_entity
from weirwatch.functions.paths import generalize_paths
from weirwatch.functions.urls import (
    agent_family,
    has_sensitive_key,
    has_sensitive_payload_key,
    key_count,
    payload_key_count,
    query_keys,
    with_clean_path,
)
from weirwatch.schemas import RAW_APP, RAW_REQUEST


def _has_key(text: str, section: str, key: str) -> Column:
    """Whether a section of the entry has a key, even with a null value."""
    keys = F.json_object_keys(F.get_json_object(text, f"$.{section}"))
    return F.coalesce(F.array_contains(keys, key), F.lit(False))


def anonymize_requests(entries: DataFrame, salt: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Request entries to the 22 anonymised columns.

    ``keep`` names columns of the input to carry along, such as the load order.
    """
    p, labels = F.col("e.protoPayload"), F.col("e.resource.labels")
    # The status falls back only where its key is absent. Entries with a value
    # need no second look at the text.
    status = (
        F.when(p["status"].isNotNull(), p["status"])
        .when(_has_key("value", "protoPayload", "status"), F.lit(None).cast("string"))
        .otherwise(F.col("e.httpRequest.status"))
    )
    # Columns used more than once are made in steps of their own.
    parsed = entries.select(*keep, "value", F.from_json("value", RAW_REQUEST).alias("e"))
    parsed = parsed.select(
        *keep,
        "e",
        lenient_int(status).alias("_status"),
        query_keys(p["resource"]).alias("_keys"),
        F.lower(none_if_empty(p["userAgent"])).alias("_agent"),
        p["resource"].alias("_resource"),
    )
    parsed = with_clean_path(parsed, "_resource", "_path")
    status, keys = F.col("_status"), F.col("_keys")
    return parsed.select(
        *keep,
        lenient_timestamp(first_present(F.col("e.timestamp"), p["startTime"])).alias("timestamp"),
        lenient_timestamp(p["startTime"]).alias("start_time"),
        lenient_timestamp(p["endTime"]).alias("end_time"),
        first_present(p["moduleId"], labels["module_id"]).alias("module_id"),
        first_present(p["versionId"], labels["version_id"]).alias("version_id"),
        p["method"].alias("method"),
        status.alias("status_code"),
        status_family(status).alias("status_family"),
        latency_ms(p["latency"]).alias("latency_ms"),
        lenient_long(p["responseSize"]).alias("response_size"),
        F.col("_path").alias("endpoint_path"),
        key_count(keys).alias("query_key_count"),
        has_sensitive_key(keys).alias("has_sensitive_query_key"),
        hash_entity(p["host"], salt).alias("host_hash"),
        hash_entity(p["ip"], salt).alias("ip_hash"),
        agent_family(F.col("_agent")).alias("user_agent_category"),
        hash_entity(p["userAgent"], salt).alias("user_agent_hash"),
        p["urlMapEntry"].alias("url_map_entry"),
        p["finished"].try_cast("boolean").alias("finished"),
        p["appEngineRelease"].alias("app_engine_release"),
        hash_entity(first_present(p["traceId"], F.col("e.trace")), salt).alias("trace_hash"),
        hash_entity(first_present(p["requestId"], F.col("e.insertId")), salt).alias("request_hash"),
    )


def anonymize_app(entries: DataFrame, salt: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Application entries with an object payload to 22 anonymised columns."""
    parsed = entries.select(
        *keep,
        F.from_json("value", RAW_APP).alias("e"),
        F.get_json_object("value", "$.jsonPayload").alias("payload_text"),
    ).select(
        *keep,
        "e",
        F.json_object_keys("payload_text").alias("payload_keys"),
    )
    parsed = parsed.where(F.col("payload_keys").isNotNull() & F.col("e.jsonPayload").isNotNull())
    p, labels = F.col("e.jsonPayload"), F.col("e.resource.labels")
    parsed = parsed.withColumns({"_status": lenient_int(p["status"]), "_resource": p["url"]})
    parsed = with_clean_path(parsed, "_resource", "_path")
    status = F.col("_status")
    return parsed.select(
        *keep,
        lenient_timestamp(first_present(F.col("e.timestamp"), p["timestamp"])).alias("timestamp"),
        lenient_timestamp(F.col("e.receiveTimestamp")).alias("receive_timestamp"),
        labels["module_id"].alias("module_id"),
        labels["version_id"].alias("version_id"),
        p["level"].alias("level"),
        p["event"].alias("event"),
        p["method"].alias("method"),
        status.alias("status_code"),
        status_family(status).alias("status_family"),
        lenient_int(p["responseTime"]).cast("double").alias("response_time_ms"),
        F.col("_path").alias("endpoint_path"),
        hash_entity(p["userId"], salt).alias("user_id_hash"),
        hash_entity(p["shopId"], salt).alias("tenant_hash"),
        hash_entity(first_present(p["requestId"], F.col("e.insertId")), salt).alias("request_hash"),
        F.array_contains("payload_keys", "error").alias("has_error"),
        F.coalesce(F.length(p["error"]), F.lit(0)).alias("error_text_length"),
        payload_key_count(p["requestData"]).alias("request_data_key_count"),
        has_sensitive_payload_key(p["requestData"]).alias("request_data_has_sensitive_key"),
        payload_key_count(p["responseData"]).alias("response_data_key_count"),
        has_sensitive_payload_key(p["responseData"]).alias("response_data_has_sensitive_key"),
        payload_key_count(p["headers"]).alias("headers_key_count"),
        has_sensitive_payload_key(p["headers"]).alias("headers_has_sensitive_key"),
    )


def request_rows(entries: DataFrame, salt: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw request entries to the 28 columns of the request log."""
    return generalize_paths(anonymize_requests(entries, salt, keep))


def app_rows(entries: DataFrame, salt: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw application entries to the 28 columns of the application log."""
    return generalize_paths(anonymize_app(entries, salt, keep))
