"""Declared schemas of the log tables and of the raw entries."""

from __future__ import annotations

# Raw request entry. Leaves are text so that one value of another type cannot
# null its neighbours; casts follow later.
RAW_REQUEST = """
    timestamp STRING,
    trace STRING,
    insertId STRING,
    resource STRUCT<labels: STRUCT<module_id: STRING, version_id: STRING>>,
    httpRequest STRUCT<status: STRING>,
    protoPayload STRUCT<
        startTime: STRING, endTime: STRING, moduleId: STRING, versionId: STRING,
        method: STRING, status: STRING, latency: STRING, responseSize: STRING,
        resource: STRING, host: STRING, ip: STRING, userAgent: STRING,
        urlMapEntry: STRING, finished: STRING, appEngineRelease: STRING,
        traceId: STRING, requestId: STRING>
"""

# Raw application entry. The nested objects are maps: only their keys are
# read, and a value that is not an object becomes null.
RAW_APP = """
    timestamp STRING,
    receiveTimestamp STRING,
    insertId STRING,
    resource STRUCT<labels: STRUCT<module_id: STRING, version_id: STRING>>,
    jsonPayload STRUCT<
        timestamp: STRING, level: STRING, event: STRING, method: STRING,
        status: STRING, responseTime: STRING, url: STRING, userId: STRING,
        shopId: STRING, requestId: STRING, error: STRING,
        requestData: MAP<STRING, STRING>, responseData: MAP<STRING, STRING>,
        headers: MAP<STRING, STRING>>
"""

_PATH_FEATURES = """
    endpoint_group STRING, endpoint_template STRING, path_depth INT,
    path_length INT, is_static_asset BOOLEAN, has_suspicious_path_pattern BOOLEAN
"""

# Anonymised and generalised logs, 28 columns each.
REQUEST_LOG = f"""
    timestamp TIMESTAMP, start_time TIMESTAMP, end_time TIMESTAMP,
    module_id STRING, version_id STRING, method STRING, status_code INT,
    status_family STRING, latency_ms DOUBLE, response_size BIGINT,
    endpoint_path STRING, query_key_count INT, has_sensitive_query_key BOOLEAN,
    host_hash STRING, ip_hash STRING, user_agent_category STRING,
    user_agent_hash STRING, url_map_entry STRING, finished BOOLEAN,
    app_engine_release STRING, trace_hash STRING, request_hash STRING,
    {_PATH_FEATURES}
"""

APP_LOG = f"""
    timestamp TIMESTAMP, receive_timestamp TIMESTAMP, module_id STRING,
    version_id STRING, level STRING, event STRING, method STRING,
    status_code INT, status_family STRING, response_time_ms DOUBLE,
    endpoint_path STRING, user_id_hash STRING, tenant_hash STRING,
    request_hash STRING, has_error BOOLEAN, error_text_length INT,
    request_data_key_count INT, request_data_has_sensitive_key BOOLEAN,
    response_data_key_count INT, response_data_has_sensitive_key BOOLEAN,
    headers_key_count INT, headers_has_sensitive_key BOOLEAN,
    {_PATH_FEATURES}
"""


def column_types(schema: str) -> dict[str, str]:
    """Name to type of a flat schema text."""
    fields = [f.split() for f in schema.replace("\n", " ").split(",")]
    return {name: kind for name, kind in fields}
