"""DuckDB statements that state each query's expected result.

Written from the rules, not from the Spark code: the log rows are expected
values per event kind, counts and quantiles use the database's own functions.
"""

from __future__ import annotations

from weirwatch.fixed_values import SCENARIO_COLUMNS, SCENARIOS
from weirwatch.sources.event_adapter import AGENTS

EVENTS = """
ev AS (
  SELECT event_id, user_id, event_type AS kind, value,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k,
         CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id % 10 END AS client,
         make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 60) AS moment
  FROM events
)"""

ENTITY = "substr(sha256('salt' || CAST({} AS VARCHAR)), 1, 16)"
PATH = """CASE kind
    WHEN 'view' THEN '/api/items/' || event_id
    WHEN 'click' THEN '/static/app-' || k || '.js'
    WHEN 'purchase' THEN '/v1/orders/' || k || '/line-item-' || (k % 7)
    WHEN 'signup' THEN '/account/sign-up-now'
    ELSE CASE k % 4 WHEN 0 THEN '/wp-login.php' WHEN 1 THEN '/.env'
                    WHEN 2 THEN '/backup/db.sql' ELSE '/missing/page-' || k END END"""
TEMPLATE = """CASE kind
    WHEN 'view' THEN '/api/items/{num}'
    WHEN 'click' THEN '/static/{static_file}'
    WHEN 'purchase' THEN '/v1/orders/{num}/{slug}'
    WHEN 'signup' THEN '/account/{slug}'
    ELSE CASE k % 4 WHEN 0 THEN '/wp-login.php' WHEN 1 THEN '/.env'
                    WHEN 2 THEN '/backup/db.sql' ELSE '/missing/{slug}' END END"""
GROUP = """CASE kind
    WHEN 'view' THEN 'api' WHEN 'click' THEN 'static_asset'
    WHEN 'purchase' THEN 'versioned_api' WHEN 'signup' THEN 'application_route'
    ELSE CASE WHEN k % 4 < 3 THEN 'suspicious_probe' ELSE 'application_route' END END"""
STATUS = """CASE WHEN kind = 'error' THEN CASE WHEN k % 4 = 0 THEN 500 ELSE 404 END
              WHEN kind = 'click' AND k < 60 THEN 304 ELSE 200 END"""
METHOD = "CASE kind WHEN 'purchase' THEN 'POST' WHEN 'signup' THEN 'PUT' ELSE 'GET' END"
MODULE = "CASE WHEN k % 2 = 0 THEN 'web' ELSE 'worker' END"
SUSPICIOUS = "(kind = 'error' AND k % 4 < 3)"
TS = "strftime({}, '%Y-%m-%d %H:%M:%S')"
TS_US = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"

REQUESTS = f"""
req AS (
  SELECT event_id, moment, {MODULE} AS module_id, {METHOD} AS method, {STATUS} AS status_code,
         ({STATUS}) // 100 || 'xx' AS status_family, value * 10 AS latency_ms,
         CASE WHEN k % 17 <> 0 THEN CAST(k * 100 AS BIGINT) END AS response_size,
         {PATH} AS endpoint_path, (kind = 'view' AND k % 10 = 0) AS has_sensitive_query_key,
         {ENTITY.format('client')} AS ip_hash,
         CASE WHEN k % 50 = 0 THEN NULL WHEN k % 5 = 0 THEN 'bot' WHEN k % 5 = 1 THEN 'mobile_browser'
              WHEN k % 5 = 2 THEN 'script_or_api_client' ELSE 'desktop_browser' END AS user_agent_category,
         {ENTITY.format('event_id')} AS request_hash,
         {GROUP} AS endpoint_group, {TEMPLATE} AS endpoint_template,
         len(list_filter(string_split({PATH}, '/'), lambda x: x <> '')) AS path_depth,
         length({PATH}) AS path_length, (kind = 'click') AS is_static_asset,
         {SUSPICIOUS} AS has_suspicious_path_pattern
  FROM ev
)"""

APPS = f"""
app AS (
  SELECT event_id, moment, {MODULE} AS module_id,
         CASE WHEN kind = 'error' THEN 'error' ELSE 'info' END AS level, kind AS event,
         {METHOD} AS method, CASE WHEN k % 3 <> 0 THEN {STATUS} END AS status_code,
         CASE WHEN k % 3 <> 0 THEN ({STATUS}) // 100 || 'xx' END AS status_family,
         value * 10 AS response_time_ms, {PATH} AS endpoint_path,
         {ENTITY.format('client')} AS user_id_hash,
         CASE WHEN k % 9 <> 0 THEN {ENTITY.format('(user_id % 4)')} END AS tenant_hash,
         {ENTITY.format('(event_id // 2)')} AS request_hash, (kind = 'error') AS has_error,
         k % 11 = 0 AS request_data_has_sensitive_key, k % 13 = 0 AS response_data_has_sensitive_key,
         k % 19 = 0 AS headers_has_sensitive_key,
         {GROUP} AS endpoint_group, {TEMPLATE} AS endpoint_template,
         len(list_filter(string_split({PATH}, '/'), lambda x: x <> '')) AS path_depth,
         length({PATH}) AS path_length, (kind = 'click') AS is_static_asset,
         {SUSPICIOUS} AS has_suspicious_path_pattern
  FROM ev
)"""


def bucket(minutes: int) -> str:
    width = minutes * 60_000_000
    return f"make_timestamp((epoch_us(moment) // {width}) * {width})"


OFF = "(hour(ws) < 6 OR hour(ws) >= 22)"


def ip_features(minutes: int = 5) -> str:
    return f"""
freq AS (
  SELECT endpoint_template, -ln(count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM req)) AS rarity
  FROM req GROUP BY endpoint_template
),
feat AS (
  SELECT ws, ip_hash, count(*) AS request_count,
         count(DISTINCT endpoint_template) AS unique_endpoint_count,
         count(DISTINCT endpoint_group) AS unique_endpoint_group_count,
         count(DISTINCT method) AS unique_method_count,
         count(DISTINCT user_agent_category) AS unique_user_agent_category_count,
         count(*) FILTER (WHERE is_static_asset) AS static_asset_count,
         count(*) FILTER (WHERE has_suspicious_path_pattern) AS suspicious_path_count,
         count(*) FILTER (WHERE has_sensitive_query_key) AS sensitive_query_count,
         count(*) FILTER (WHERE status_code // 100 = 2) AS status_2xx_count,
         count(*) FILTER (WHERE status_code // 100 = 3) AS status_3xx_count,
         count(*) FILTER (WHERE status_code // 100 = 4) AS status_4xx_count,
         count(*) FILTER (WHERE status_code // 100 = 5) AS status_5xx_count,
         count(*) FILTER (WHERE status_code >= 400) AS error_count,
         count(*) FILTER (WHERE status_code >= 400) / CAST(count(*) AS DOUBLE) AS error_rate,
         avg(latency_ms) AS avg_latency_ms, quantile_cont(latency_ms, 0.95) AS p95_latency_ms,
         max(latency_ms) AS max_latency_ms, avg(response_size) AS avg_response_size,
         avg(rarity) AS avg_endpoint_rarity, {OFF} AS off_hours
  FROM (SELECT r.*, {bucket(minutes)} AS ws, f.rarity FROM req r LEFT JOIN freq f USING (endpoint_template))
  GROUP BY ws, ip_hash
)"""


USER_FEATURES = f"""
ufeat AS (
  SELECT ws, user_id_hash, count(*) AS event_count,
         count(DISTINCT tenant_hash) AS unique_tenant_count,
         count(DISTINCT endpoint_template) AS unique_endpoint_count,
         count(DISTINCT endpoint_group) AS unique_endpoint_group_count,
         count(DISTINCT method) AS unique_method_count,
         count(*) FILTER (WHERE has_suspicious_path_pattern) AS suspicious_path_count,
         count(*) FILTER (WHERE has_error) AS error_count, count(*) FILTER (WHERE has_error) / CAST(count(*) AS DOUBLE) AS error_rate,
         count(*) FILTER (WHERE status_family = '2xx') AS status_2xx_count,
         count(*) FILTER (WHERE status_family = '4xx') AS status_4xx_count,
         avg(response_time_ms) AS avg_response_time_ms,
         quantile_cont(response_time_ms, 0.95) AS p95_response_time_ms,
         max(response_time_ms) AS max_response_time_ms,
         count(*) FILTER (WHERE request_data_has_sensitive_key) AS request_sensitive_key_count,
         count(*) FILTER (WHERE response_data_has_sensitive_key) AS response_sensitive_key_count,
         count(*) FILTER (WHERE headers_has_sensitive_key) AS header_sensitive_key_count, {OFF} AS off_hours
  FROM (SELECT *, {bucket(5)} AS ws FROM app) GROUP BY ws, user_id_hash
)"""

IP_COLUMNS = [
    "request_count", "unique_endpoint_count", "unique_endpoint_group_count", "unique_method_count",
    "unique_user_agent_category_count", "static_asset_count", "suspicious_path_count",
    "sensitive_query_count", "status_2xx_count", "status_3xx_count", "status_4xx_count",
    "status_5xx_count", "error_count", "error_rate", "avg_latency_ms", "p95_latency_ms",
    "max_latency_ms", "avg_response_size", "avg_endpoint_rarity", "off_hours",
]
USER_COLUMNS = [
    "event_count", "unique_tenant_count", "unique_endpoint_count", "unique_endpoint_group_count",
    "unique_method_count", "suspicious_path_count", "error_count", "error_rate", "status_2xx_count",
    "status_4xx_count", "avg_response_time_ms", "p95_response_time_ms", "max_response_time_ms",
    "request_sensitive_key_count", "response_sensitive_key_count", "header_sensitive_key_count",
    "off_hours",
]
DOUBLES = {
    "error_rate", "avg_latency_ms", "p95_latency_ms", "max_latency_ms", "avg_response_size",
    "avg_endpoint_rarity", "avg_response_time_ms", "p95_response_time_ms", "max_response_time_ms",
}


def rounded(columns: list[str]) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" if c in DOUBLES else c for c in columns)


BASE = f"WITH {EVENTS}, {REQUESTS}"
FEATURES = f"{BASE}, {ip_features()}"

# The stand-in for a model score: a plain function of the features, low for outliers.
RAW = """-(CAST(0.5 AS DOUBLE) * least(request_count / CAST(300 AS DOUBLE), 1)
   + CAST(0.3 AS DOUBLE) * error_rate
   + CAST(0.2 AS DOUBLE) * least(suspicious_path_count / CAST(20 AS DOUBLE), 1))"""

POINTS = """(anomaly_score * 35
  + CASE WHEN suspicious_path_count >= 100 THEN 30 WHEN suspicious_path_count >= 20 THEN 22
         WHEN suspicious_path_count > 0 THEN 12 ELSE 0 END
  + CASE WHEN error_count >= 10 AND error_rate >= 0.5 THEN 18
         WHEN error_count >= 10 AND error_rate >= 0.2 THEN 12 WHEN error_count >= 50 THEN 10 ELSE 0 END
  + CASE WHEN request_count >= 500 THEN 12 WHEN request_count >= 150 THEN 8 ELSE 0 END
  + CASE WHEN unique_endpoint_count >= 100 THEN 12 WHEN unique_endpoint_count >= 30 THEN 8 ELSE 0 END
  + CASE WHEN off_hours AND (request_count >= 100 OR suspicious_path_count > 0 OR error_count >= 10)
         THEN 6 ELSE 0 END
  - CASE WHEN static_asset_count / CAST(request_count AS DOUBLE) >= 0.8 AND suspicious_path_count = 0
          AND error_rate < 0.05 THEN 18 ELSE 0 END)"""

REASONS = """list_filter([
    CASE WHEN anomaly_score >= 0.8 THEN 'very high anomaly score'
         WHEN anomaly_score >= 0.6 THEN 'high anomaly score' END,
    CASE WHEN suspicious_path_count >= 100 THEN 'large number of suspicious path probes'
         WHEN suspicious_path_count >= 20 THEN 'repeated suspicious path probes'
         WHEN suspicious_path_count > 0 THEN 'suspicious path pattern present' END,
    CASE WHEN error_count >= 10 AND error_rate >= 0.5 THEN 'high error rate with repeated failures'
         WHEN error_count >= 10 AND error_rate >= 0.2 THEN 'elevated error rate'
         WHEN error_count >= 50 THEN 'large number of error responses' END,
    CASE WHEN request_count >= 500 THEN 'high request burst'
         WHEN request_count >= 150 THEN 'elevated request volume' END,
    CASE WHEN unique_endpoint_count >= 100 THEN 'very broad endpoint access pattern'
         WHEN unique_endpoint_count >= 30 THEN 'broad endpoint access pattern' END,
    CASE WHEN off_hours AND (request_count >= 100 OR suspicious_path_count > 0 OR error_count >= 10)
         THEN 'activity occurred during off-hours' END,
    CASE WHEN static_asset_count / CAST(request_count AS DOUBLE) >= 0.8 AND suspicious_path_count = 0
          AND error_rate < 0.05 THEN 'mostly static asset traffic' END
  ], lambda x: x IS NOT NULL)"""


def threat_ctes(source: str, out: str) -> str:
    return f"""
{out}_points AS (
  SELECT *, greatest(least(CAST(round_even({POINTS}, 4) AS DOUBLE), 100), 0) AS threat_score, {REASONS} AS found
  FROM {source}
),
{out} AS (
  SELECT * EXCLUDE (found),
         CASE WHEN threat_score >= 80 THEN 'critical' WHEN threat_score >= 60 THEN 'high'
              WHEN threat_score >= 35 THEN 'medium' ELSE 'low' END AS threat_level,
         threat_score >= 35 AND len(found) > 0 AS is_security_relevant,
         CASE WHEN len(found) = 0 THEN 'low-priority statistical anomaly'
              ELSE array_to_string(found, '; ') END AS reasons
  FROM {out}_points
)"""


SCALED = f"""
raw AS (SELECT *, round({RAW}, 9) AS raw_decision_score FROM feat),
scaled AS (
  SELECT *, (-raw_decision_score - min(-raw_decision_score) OVER ())
            / (max(-raw_decision_score) OVER () - min(-raw_decision_score) OVER ()) AS anomaly_score
  FROM raw
),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY anomaly_score DESC, ws, ip_hash) AS anomaly_rank,
         raw_decision_score < -0.3 AS is_anomaly
  FROM scaled
)"""
SCORES = f"{FEATURES}, {SCALED}"
THREATS = f"{SCORES}, {threat_ctes('ranked', 'threats')}"

ALERT_FIELDS = """strftime(t.ws, '%Y-%m-%d %H:%M:%S') AS window_start, t.ip_hash, t.threat_score,
  t.threat_level, t.is_security_relevant, t.reasons, round(t.anomaly_score, 6) AS anomaly_score,
  t.anomaly_rank, t.request_count, t.suspicious_path_count, t.error_count,
  round(t.error_rate, 6) AS error_rate, t.unique_endpoint_count, t.static_asset_count, t.off_hours"""
ALERT_ORDER = "t.threat_score DESC, t.anomaly_score DESC, t.ws DESC, t.ip_hash"


# The main route of every window and client: rows are counted once for the whole log, by the window that the time
# falls into, and the routes of a window are ranked by count, then by name.
ROUTES = """routes AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, moment, TIMESTAMP '1970-01-01') AS slot, ip_hash AS client, endpoint_template,
         module_id, endpoint_group, status_family, count(*) AS hits
  FROM req GROUP BY ALL
),
main_route AS (
  SELECT * FROM routes
  QUALIFY row_number() OVER (
    PARTITION BY slot, client ORDER BY hits DESC, endpoint_template, module_id, endpoint_group, status_family) = 1
)"""


def alerts(condition: str, limit: int, more: str = "") -> str:
    return f"""{THREATS},
{ROUTES},
chosen AS (SELECT t.* FROM threats t WHERE {condition} ORDER BY {ALERT_ORDER} LIMIT {limit})
SELECT {ALERT_FIELDS}{more}, m.module_id, m.endpoint_template, m.endpoint_group, m.status_family
FROM chosen t LEFT JOIN main_route m ON m.slot = t.ws AND m.client = t.ip_hash"""


# The scenario table, as the library holds it.
SCENARIO_VALUES = ",\n  ".join(
    f"({i}, {', '.join(repr(v) if isinstance(v, str) else str(v).lower() for v in row)})" for i, row in enumerate(SCENARIOS, start=1)
)
SCENARIO_ROWS = f"""
scenario(i, {', '.join(SCENARIO_COLUMNS)}) AS (VALUES
  {SCENARIO_VALUES}
),
quiet AS (
  SELECT ws, ip_hash FROM feat
  WHERE suspicious_path_count = 0 AND error_rate <= 0.05 AND request_count >= 2
),
pool AS (
  SELECT ws, ip_hash FROM quiet WHERE (SELECT count(*) FROM quiet) >= 100
  UNION ALL
  SELECT ws, ip_hash FROM feat WHERE (SELECT count(*) FROM quiet) < 100
),
sample AS (
  SELECT ws AS base_ws, ip_hash AS base_ip,
         row_number() OVER (ORDER BY sha256(epoch_us(ws) // 1000000 || '|' || ip_hash || '|42'), ws, ip_hash) AS j
  FROM pool QUALIFY j <= 100
),
synthetic AS (
  SELECT s.*, x.j, x.base_ws, x.base_ip, error_count / CAST(request_count AS DOUBLE) AS error_rate,
         printf('%02d_%04d_%s', s.i, x.j, s.scenario_name) AS synthetic_id,
         printf('synthetic_%02d_%04d', s.i, x.j) AS ip_hash
  FROM scenario s, sample x
)"""

EVALUATED = f"""{FEATURES}, {SCENARIO_ROWS},
both_rows AS (
  SELECT i, j, synthetic_id, scenario_name, is_attack_like, round({RAW}, 9) AS raw_decision_score,
         request_count, unique_endpoint_count, static_asset_count, suspicious_path_count,
         error_count, error_rate, off_hours FROM synthetic
  UNION ALL
  SELECT NULL, NULL, NULL, NULL, NULL, round({RAW}, 9), request_count, unique_endpoint_count,
         static_asset_count, suspicious_path_count, error_count, error_rate, off_hours FROM feat
),
scaled AS (
  SELECT *, (-raw_decision_score - min(-raw_decision_score) OVER ())
            / (max(-raw_decision_score) OVER () - min(-raw_decision_score) OVER ()) AS anomaly_score,
         raw_decision_score < -0.3 AS is_anomaly
  FROM both_rows
),
{threat_ctes('(SELECT * FROM scaled WHERE i IS NOT NULL)', 'judged')},
evaluated AS (
  SELECT *, row_number() OVER (ORDER BY anomaly_score DESC, i, j) AS anomaly_rank,
         row_number() OVER (ORDER BY threat_score DESC, i, j) AS threat_rank
  FROM judged
)"""



def forest_ctes(trees: int = 200, sample: int = 256, seed: int = 42) -> str:
    """The isolation forest of all windows, one statement a level, as ``nodes``.

    A tree takes the rows with the least draws, a linear function of the key's digest modulo 2^31 - 1; a node cuts a
    feature with two values or more, chosen, like the place of the cut, by the digest of tree and node.
    """
    prime, levels = (1 << 31) - 1, (sample - 1).bit_length()
    inputs = [f"round(coalesce(CAST({c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM feat)), 6)" for c in IP_COLUMNS]
    hexed = "CAST('0x' || substr({}, {}, {}) AS BIGINT)"
    width = len(IP_COLUMNS)
    steps = []
    for d in range(levels + 1):
        lows = ", ".join(f"min(x[{i}])" for i in range(1, width + 1))
        highs = ", ".join(f"max(x[{i}])" for i in range(1, width + 1))
        steps.append(f"""
range_{d} AS MATERIALIZED (
  SELECT tree, node, count(*) AS size, [{lows}] AS low, [{highs}] AS high, sha256('{seed}|node|' || tree || '|' || node) AS d
  FROM rows_{d} GROUP BY tree, node
),
choice_{d} AS (
  SELECT *, list_filter(range(1, {width + 1}), lambda i: high[i] > low[i]) AS usable,
         (SELECT ceil(log2(greatest(2, least({sample}, count(*))))) FROM feat) AS deepest FROM range_{d}
),
picked_{d} AS (
  SELECT *, CASE WHEN {d} < deepest AND size > 1 AND len(usable) > 0
            THEN usable[1 + {hexed.format('d', 1, 7)} % greatest(len(usable), 1)] END AS f,
         low[f] + {hexed.format('d', 8, 13)} / CAST({1 << 52} AS DOUBLE) * (high[f] - low[f]) AS place FROM choice_{d}
),
node_{d} AS MATERIALIZED (
  SELECT tree, node, size, {d} AS depth, f, CASE WHEN place < high[f] THEN place ELSE low[f] END AS cut FROM picked_{d}
),
rows_{d + 1} AS MATERIALIZED (
  SELECT r.tree, 2 * r.node + CASE WHEN r.x[n.f] <= n.cut THEN 1 ELSE 2 END AS node, r.x
  FROM rows_{d} r JOIN node_{d} n USING (tree, node) WHERE n.f IS NOT NULL
)""")
    nodes = " UNION ALL ".join(f"SELECT * FROM node_{d}" for d in range(levels + 1))
    numbers = ", ".join(f"{hexed.format('d', 1 + 7 * i, 7)} AS {n}" for i, n in enumerate(("a1", "b1", "c1", "a2", "b2", "c2")))
    return f"""
inputs AS MATERIALIZED (
  SELECT *, [{', '.join(inputs)}] AS x, sha256(epoch_us(ws) || '|' || ip_hash || '|{seed}') AS d FROM feat
),
numbered AS (
  SELECT ws, ip_hash, {hexed.format('d', 1, 7)} AS h1, {hexed.format('d', 8, 7)} AS h2, {hexed.format('d', 15, 15)} AS tie FROM inputs
),
factors AS (SELECT tree, {numbers} FROM (SELECT tree, sha256('{seed}|tree|' || tree) AS d FROM range({trees}) t(tree))),
drawn AS MATERIALIZED (
  SELECT tree, ws, ip_hash FROM numbered, factors QUALIFY row_number() OVER (PARTITION BY tree ORDER BY
    (a1 * h1 + b1 * h2 + c1) % {prime} * {prime + 1} + (a2 * h1 + b2 * h2 + c2) % {prime}, tie) <= {sample}
),
rows_0 AS MATERIALIZED (SELECT tree, 0 AS node, x FROM drawn JOIN inputs USING (ws, ip_hash)),{','.join(steps)},
nodes AS MATERIALIZED ({nodes})"""


def path_ctes(rows: str, key: str, trees: int = 200, sample: int = 256) -> str:
    """``paths``: the mean path of every row of ``rows``, with inputs ``x``, as a share of a search's in the sample."""
    levels = (sample - 1).bit_length()
    search = "CASE WHEN {0} > 2 THEN 2 * (ln({0} - 1) + 0.5772156649015329::DOUBLE) - 2 * ({0} - 1) / CAST({0} AS DOUBLE) WHEN {0} = 2 THEN 1 ELSE 0 END"
    steps = [f"walk_0 AS (SELECT {key}, x, tree, 0 AS node FROM {rows}, range({trees}) t(tree))"]
    for d in range(levels):
        steps.append(f"""walk_{d + 1} AS MATERIALIZED (
  SELECT {key}, x, tree, CASE WHEN f IS NULL THEN node WHEN x[f] <= cut THEN 2 * node + 1 ELSE 2 * node + 2 END AS node
  FROM walk_{d} JOIN nodes USING (tree, node))""")
    return f"""{', '.join(steps)},
paths AS MATERIALIZED (
  SELECT {key}, fsum(depth + {search.format('size')}) / {trees} / (SELECT {search.format('max(size)')} FROM nodes) AS path
  FROM walk_{levels} JOIN nodes USING (tree, node) GROUP BY {key}
)"""


RANKED = """
scaled AS (
  SELECT *, (-raw_decision_score - min(-raw_decision_score) OVER ())
            / (max(-raw_decision_score) OVER () - min(-raw_decision_score) OVER ()) AS anomaly_score FROM raw
),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY anomaly_score DESC, ws, ip_hash) AS anomaly_rank, raw_decision_score < 0 AS is_anomaly FROM scaled
)"""
FOREST = f"{FEATURES}, {forest_ctes()}"
WINDOW_PATHS = f"{FOREST}, {path_ctes('inputs', 'ws, ip_hash')}"
FOREST_SCORES = f"""{WINDOW_PATHS},
raw AS (SELECT feat.*, round(CAST(0.5 AS DOUBLE) - pow(2, -path), 10) AS raw_decision_score FROM feat JOIN paths USING (ws, ip_hash)),
{RANKED}"""
# The share of the windows taken as outliers moves the scores by their quantile.
CUT_SCORES = f"""{WINDOW_PATHS},
cut AS (SELECT quantile_cont(round(CAST(0.5 AS DOUBLE) - pow(2, -path), 10), 0.1) AS cut FROM paths),
raw AS (
  SELECT feat.*, round(-pow(2, -path) - (CAST(-0.5 AS DOUBLE) + cut), 10) AS raw_decision_score
  FROM cut, feat JOIN paths USING (ws, ip_hash)
),
{RANKED}"""
FOREST_THREATS = f"{FOREST_SCORES}, {threat_ctes('ranked', 'threats')}"
FOREST_JUDGED = f"""{FOREST}, {SCENARIO_ROWS},
judged_rows AS MATERIALIZED (
  SELECT i * 1000 + j AS id, i, j, is_attack_like, {', '.join(IP_COLUMNS)},
         [{', '.join(f'round(CAST({c} AS DOUBLE), 6)' for c in IP_COLUMNS)}] AS x FROM synthetic
  UNION ALL
  SELECT -row_number() OVER (ORDER BY ws, ip_hash), NULL, NULL, NULL, {', '.join(IP_COLUMNS)}, x FROM inputs
),
{path_ctes('judged_rows', 'id')},
raw AS (SELECT r.*, round(CAST(0.5 AS DOUBLE) - pow(2, -path), 10) AS raw_decision_score FROM judged_rows r JOIN paths USING (id)),
scaled AS (
  SELECT *, raw_decision_score < 0 AS is_anomaly, (-raw_decision_score - min(-raw_decision_score) OVER ())
            / (max(-raw_decision_score) OVER () - min(-raw_decision_score) OVER ()) AS anomaly_score FROM raw
),
{threat_ctes('(SELECT * FROM scaled WHERE i IS NOT NULL)', 'judged')},
evaluated AS (
  SELECT *, row_number() OVER (ORDER BY anomaly_score DESC, i, j) AS anomaly_rank,
         row_number() OVER (ORDER BY threat_score DESC, i, j) AS threat_rank
  FROM judged
)"""

# Metrics of both rankings and both flags of ``evaluated``.
RANK_METRICS = """ranks AS (
  SELECT 'anomaly_only' AS ranking_method, anomaly_rank AS r, is_attack_like FROM evaluated
  UNION ALL SELECT 'anomaly_plus_threat_score', threat_rank, is_attack_like FROM evaluated
),
hits AS (
  SELECT ranking_method, k_value, count(*) FILTER (WHERE is_attack_like AND r <= k_value) AS h,
         least(k_value, count(*)) AS seen, count(*) FILTER (WHERE is_attack_like) AS attacks
  FROM ranks, (VALUES (10), (20), (50), (100), (200), (300)) ks(k_value) GROUP BY ranking_method, k_value
),
rank_metrics AS (
  SELECT ranking_method, 'precision_at_k' AS metric_name, k_value, round(h / CAST(seen AS DOUBLE), 9) AS metric_value FROM hits
  UNION ALL SELECT ranking_method, 'recall_at_k', k_value, round(h / CAST(attacks AS DOUBLE), 9) FROM hits
)"""
FLAG_METRICS = """flags AS (
  SELECT 'anomaly_only_flag' AS ranking_method, is_anomaly AS p, is_attack_like AS a FROM evaluated
  UNION ALL SELECT 'threat_score_flag', is_security_relevant, is_attack_like FROM evaluated
),
table_of_four AS (
  SELECT ranking_method, CAST(count(*) FILTER (WHERE p AND a) AS DOUBLE) AS tp,
         CAST(count(*) FILTER (WHERE p AND NOT a) AS DOUBLE) AS fp, CAST(count(*) FILTER (WHERE NOT p AND a) AS DOUBLE) AS fn,
         CAST(count(*) FILTER (WHERE NOT p AND NOT a) AS DOUBLE) AS tn FROM flags GROUP BY ranking_method
),
flag_metrics AS (
  SELECT ranking_method, metric_name, 0 AS k_value, round(v, 9) AS metric_value FROM (UNPIVOT (
    SELECT ranking_method, coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
           coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
           coalesce(fp / nullif(fp + tn, 0), 0) AS false_positive_rate,
           tp + fp AS predicted_positive_count, fp AS false_positive_count FROM table_of_four)
    ON precision, recall, false_positive_rate, predicted_positive_count, false_positive_count
    INTO NAME metric_name VALUE v)
)"""

CLEAN_PAGE = r"""
page AS (
  SELECT page_id, url,
         regexp_replace(regexp_replace(regexp_replace(regexp_replace(
           CASE WHEN raw_path = '' THEN '/' ELSE raw_path END,
           '[^/@\s]+@[^/@\s]+\.[^/@\s]+', '{email}', 'g'),
           '\b[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\b', '{uuid}', 'g'),
           '\b[0-9a-fA-F]{16,}\b', '{hex}', 'g'), '\b\d{4,}\b', '{num}', 'g') AS path
  FROM (SELECT page_id, url, regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1)
        AS raw_path FROM pages)
)"""

STATIC_END = r"regexp_matches(lower({}), '\.(css|js|png|jpg|jpeg|gif|svg|ico|webp|wav|mp3|woff|woff2|ttf|map)$')"
PROBE = (
    r"regexp_matches(lower({}), '\.env|\.git|\.ds_store|wp-admin|wp-login|phpmyadmin|backup|dump|\.sql"
    r"|gitconfig|database|passwd|shadow')"
)
GENERAL = f"""
parts AS (SELECT *, list_filter(string_split(path, '/'), lambda x: x <> '') AS segs FROM page),
general AS (
  SELECT page_id, path AS endpoint_path,
    '/' || array_to_string(list_transform(segs[1:6], lambda s, i:
      CASE WHEN lower(s) IN ('{{uuid}}', '{{num}}', '{{hex}}', '{{email}}') THEN lower(s)
           WHEN regexp_full_match(s, '[0-9]+') THEN '{{num}}'
           WHEN regexp_full_match(s, '[a-fA-F0-9]{{12,}}') THEN '{{hex}}'
           WHEN {STATIC_END.format('s')} THEN '{{static_file}}'
           WHEN i > 1 AND regexp_full_match(lower(s), '[a-z0-9]+(-[a-z0-9]+)+') THEN '{{slug}}'
           WHEN length(s) > 30 THEN '{{long_segment}}' ELSE lower(s) END), '/') AS endpoint_template,
    CASE WHEN len(segs) = 0 THEN 'root' WHEN lower(segs[1]) = 'api' THEN 'api'
         WHEN {STATIC_END.format('segs[-1]')} THEN 'static_asset' WHEN {PROBE.format('path')} THEN 'suspicious_probe'
         WHEN lower(segs[1]) IN ('v1', 'v2') THEN 'versioned_api' ELSE 'application_route' END AS endpoint_group,
    len(segs) AS path_depth, length(path) AS path_length,
    coalesce({STATIC_END.format('segs[-1]')}, false) AS is_static_asset,
    {PROBE.format('path')} AS has_suspicious_path_pattern
  FROM parts
)"""
PAGE_FEATURES = f"WITH {CLEAN_PAGE}, {GENERAL}"

SENSITIVE = "'token','access_token','refresh_token','id_token','key','apikey','api_key','password','pass','secret','session','sid','email'"

# Rows of the upsert queries: every event once, then every third event again with a new status.
UPSERTED = f"""{BASE},
batch AS (
  SELECT CASE WHEN event_id % 50 <> 0 THEN request_hash END AS request_hash, moment, status_code, module_id,
         1 AS batch, event_id FROM req
  UNION ALL
  SELECT CASE WHEN event_id % 50 <> 0 THEN request_hash END, moment, 999, module_id, 2, event_id
  FROM req WHERE event_id % 3 = 0
)
SELECT request_hash, {TS_US.format('moment')} AS timestamp, status_code, module_id FROM batch
QUALIFY request_hash IS NULL OR row_number() OVER (PARTITION BY request_hash ORDER BY batch ORDERING) = 1"""

UA_CASE = """CASE WHEN regexp_matches(t, 'bot|crawler|spider|slurp') THEN 'bot'
  WHEN regexp_matches(t, 'mobile|android|iphone') THEN 'mobile_browser'
  WHEN regexp_matches(t, 'mozilla|chrome|safari|firefox') THEN 'desktop_browser'
  WHEN regexp_matches(t, 'curl|wget|python-requests|postman') THEN 'script_or_api_client'
  ELSE 'other' END"""

RAW_QUERY = "(kind = 'view' AND k % 10 = 0)"
RAW_PATH = f"""(CASE WHEN k % 23 = 0 THEN '/u/{{email}}' ELSE '' END ||
  regexp_replace({PATH}, '\\b\\d{{4,}}\\b', '{{num}}', 'g'))"""

FEATURE_SELECT = f"SELECT {TS.format('ws')} AS window_start, ip_hash, {rounded(IP_COLUMNS)} FROM feat"

TOP = {
    "request": ["status_family", "method", "module_id", "endpoint_group", "user_agent_category"],
    "app": ["level", "method", "status_family", "endpoint_group"],
}


def top_values(cte: str, columns: list[str]) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, coalesce(nullif({c}, ''), 'missing') AS value FROM {cte}" for c in columns
    )
    return f"""SELECT column_name, value, count(*) AS rows,
       row_number() OVER (PARTITION BY column_name ORDER BY count(*) DESC, value) AS value_rank
FROM ({parts}) GROUP BY column_name, value QUALIFY value_rank <= 10"""


def nearest(cte: str, column: str) -> str:
    return f"""(SELECT v FROM (SELECT {column} AS v, row_number() OVER (ORDER BY {column}) - 1 AS r,
      count(*) OVER () AS n FROM {cte} WHERE {column} IS NOT NULL)
      WHERE r = least(n - 1, CAST(round_even((n - 1) * CAST(0.95 AS DOUBLE), 0) AS BIGINT)))"""


ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'"
PROFILE_REQUESTS = f"""{BASE}
SELECT 'requests' AS dataset, count(*) AS row_count, 18 AS column_count,
  {ISO.format('min(moment)')} AS start_time, {ISO.format('max(moment)')} AS end_time,
  count(*) FILTER (WHERE moment IS NULL) AS missing_timestamp, count(*) FILTER (WHERE ip_hash IS NULL) AS missing_ip_hash,
  count(*) FILTER (WHERE endpoint_template IS NULL) AS missing_endpoint_template,
  count(DISTINCT ip_hash) AS unique_ip_hashes, count(DISTINCT endpoint_template) AS unique_endpoint_templates,
  count(*) FILTER (WHERE has_suspicious_path_pattern) AS suspicious_path_rows,
  count(*) FILTER (WHERE has_sensitive_query_key) AS sensitive_query_rows,
  CAST(round_even(avg(latency_ms), 3) AS DOUBLE) AS latency_avg_ms, {nearest('req', 'latency_ms')} AS latency_p95_ms,
  max(latency_ms) AS latency_max_ms, CAST(round_even(avg(response_size), 3) AS DOUBLE) AS response_size_avg
FROM req"""
PROFILE_APP = f"""WITH {EVENTS}, {APPS}
SELECT 'app_events' AS dataset, count(*) AS row_count, 22 AS column_count,
  {ISO.format('min(moment)')} AS start_time, {ISO.format('max(moment)')} AS end_time,
  count(*) FILTER (WHERE moment IS NULL) AS missing_timestamp, count(*) FILTER (WHERE user_id_hash IS NULL) AS missing_user_id_hash,
  count(*) FILTER (WHERE tenant_hash IS NULL) AS missing_tenant_hash,
  count(*) FILTER (WHERE endpoint_template IS NULL) AS missing_endpoint_template,
  count(DISTINCT user_id_hash) AS unique_user_hashes, count(DISTINCT tenant_hash) AS unique_tenant_hashes,
  count(DISTINCT endpoint_template) AS unique_endpoint_templates, count(*) FILTER (WHERE has_error) AS error_rows,
  count(*) FILTER (WHERE has_suspicious_path_pattern) AS suspicious_path_rows,
  count(*) FILTER (WHERE request_data_has_sensitive_key) AS request_sensitive_key_rows,
  CAST(round_even(avg(response_time_ms), 3) AS DOUBLE) AS response_time_avg_ms,
  {nearest('app', 'response_time_ms')} AS response_time_p95_ms,
  max(response_time_ms) AS response_time_max_ms
FROM app"""


# Scalar metrics of both logs as rows: a number where the value is one, else its text.
METRIC_ROWS = f"""WITH r AS ({PROFILE_REQUESTS}), a AS ({PROFILE_APP}),
texts AS (
  SELECT 'requests' AS dataset, metric, v FROM (UNPIVOT (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM r) ON COLUMNS(*) INTO NAME metric VALUE v)
  UNION ALL
  SELECT 'app_events', metric, v FROM (UNPIVOT (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM a) ON COLUMNS(*) INTO NAME metric VALUE v)
),
metric_rows AS (
  SELECT dataset, metric, round(try_cast(v AS DOUBLE), 6) AS number, CASE WHEN try_cast(v AS DOUBLE) IS NULL THEN v END AS text FROM texts
)"""
_PATH_SHOWN = "endpoint_path, endpoint_group, endpoint_template, path_depth, path_length, is_static_asset, has_suspicious_path_pattern"
REQUEST_SHOWN = f"""{TS_US.format('moment')} AS timestamp, module_id, method, status_code, status_family, round(latency_ms, 6) AS latency_ms,
  response_size, has_sensitive_query_key, ip_hash, user_agent_category, request_hash, {_PATH_SHOWN}"""
APP_SHOWN = f"""{TS_US.format('moment')} AS timestamp, module_id, level, event, method, status_code, status_family,
  round(response_time_ms, 6) AS response_time_ms, user_id_hash, tenant_hash, request_hash, has_error, request_data_has_sensitive_key,
  response_data_has_sensitive_key, headers_has_sensitive_key, {_PATH_SHOWN}"""


def oracle_sql() -> dict[str, str]:
    log_columns = """module_id, method, status_code, status_family, endpoint_path, endpoint_group,
      endpoint_template, path_depth, path_length, is_static_asset, has_suspicious_path_pattern"""
    return {
        "adapt_request_logs": f"""{BASE} SELECT {TS_US.format('moment')} AS timestamp, {log_columns},
          round(latency_ms, 6) AS latency_ms, response_size, has_sensitive_query_key, ip_hash,
          user_agent_category, request_hash FROM req""",
        "adapt_app_logs": f"""WITH {EVENTS}, {APPS} SELECT {TS_US.format('moment')} AS timestamp, {log_columns},
          level, event, round(response_time_ms, 6) AS response_time_ms, user_id_hash, tenant_hash, request_hash,
          has_error, request_data_has_sensitive_key, response_data_has_sensitive_key,
          headers_has_sensitive_key FROM app""",
        "anonymize_requests": f"""WITH {EVENTS}, page AS (SELECT event_id AS page_id, {RAW_PATH} AS path FROM ev), {GENERAL}
          SELECT event_id, {TS_US.format('moment')} AS timestamp, {TS_US.format('moment')} AS start_time, NULL AS end_time, NULL AS version_id,
          {ENTITY.format("'www.example.org'")} AS host_hash, NULL AS url_map_entry, CAST(NULL AS BOOLEAN) AS finished, NULL AS app_engine_release, NULL AS trace_hash,
          CASE WHEN k % 50 <> 0 THEN substr(sha256('salt' || [{', '.join(f"'{a}'" for a in AGENTS)}][k % 5 + 1]), 1, 16) END AS user_agent_hash,
          CASE WHEN k % 4 = 0 THEN 'fallback' ELSE {MODULE} END AS module_id, {METHOD} AS method,
          {STATUS} AS status_code, ({STATUS}) // 100 || 'xx' AS status_family,
          CASE WHEN k % 31 <> 0 THEN round(CAST(printf('%.6f', value / 100) AS DOUBLE) * 1000, 3) END AS latency_ms,
          CASE WHEN k % 17 <> 0 THEN CAST(k * 100 AS BIGINT) END AS response_size,
          g.* EXCLUDE (page_id),
          CASE WHEN {RAW_QUERY} THEN 2 WHEN k % 7 = 0 THEN 2 ELSE 0 END AS query_key_count,
          {RAW_QUERY} AS has_sensitive_query_key, {ENTITY.format('client')} AS ip_hash,
          CASE WHEN k % 50 = 0 THEN NULL WHEN k % 5 = 0 THEN 'bot' WHEN k % 5 = 1 THEN 'mobile_browser'
               WHEN k % 5 = 2 THEN 'script_or_api_client' WHEN k % 5 = 3 THEN 'desktop_browser'
               ELSE 'other' END AS user_agent_category,
          CASE WHEN k % 8 <> 0 THEN {ENTITY.format('event_id')}
               ELSE {ENTITY.format("('insert-' || event_id)")} END AS request_hash
          FROM ev JOIN general g ON page_id = event_id""",
        "anonymize_app_events": f"""WITH {EVENTS}, page AS (
            SELECT event_id AS page_id, regexp_replace({PATH}, '\\b\\d{{4,}}\\b', '{{num}}', 'g') AS path FROM ev), {GENERAL}
          SELECT event_id, {TS_US.format('moment')} AS timestamp, {TS_US.format('moment')} AS receive_timestamp, NULL AS version_id,
          false AS response_data_has_sensitive_key, g.* EXCLUDE (page_id),
          {MODULE} AS module_id, CASE WHEN kind = 'error' THEN 'error' ELSE 'info' END AS level, kind AS event,
          {METHOD} AS method, CASE WHEN k % 3 <> 0 THEN {STATUS} END AS status_code,
          CASE WHEN k % 3 <> 0 THEN ({STATUS}) // 100 || 'xx' END AS status_family,
          floor(value * 10) AS response_time_ms,
          {ENTITY.format('client')} AS user_id_hash,
          CASE WHEN k % 9 <> 0 THEN {ENTITY.format('(user_id % 4)')} END AS tenant_hash,
          {ENTITY.format("('insert-' || event_id)")} AS request_hash, kind = 'error' AS has_error,
          CASE WHEN kind = 'error' THEN 7 + length(CAST(event_id AS VARCHAR)) ELSE 0 END AS error_text_length,
          CASE WHEN k % 11 = 0 THEN 2 WHEN k % 2 = 0 THEN 1 ELSE 0 END AS request_data_key_count,
          k % 11 = 0 AS request_data_has_sensitive_key, 0 AS response_data_key_count,
          CASE WHEN k % 19 = 0 THEN 2 ELSE 0 END AS headers_key_count, k % 19 = 0 AS headers_has_sensitive_key
          FROM ev JOIN general g ON page_id = event_id WHERE k % 29 <> 0""",
        "clean_path": f"WITH {CLEAN_PAGE} SELECT page_id, path FROM page",
        "query_key_summary": f"""WITH q AS (
            SELECT page_id, list_transform(list_filter(string_split(
              regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '&'), lambda x: x <> ''),
              lambda x: lower(split_part(x, '=', 1))) AS keys FROM pages)
          SELECT page_id, len(keys) AS query_key_count,
            list_has_any(keys, [{SENSITIVE}]) AS has_sensitive_query_key FROM q""",
        "generalize_paths": f"{PAGE_FEATURES} SELECT * FROM general",
        "endpoint_groups": f"""{PAGE_FEATURES}, {EVENTS}, {REQUESTS}
          SELECT endpoint_group, has_suspicious_path_pattern, count(*) AS rows FROM (
            SELECT endpoint_group, has_suspicious_path_pattern FROM general
            UNION ALL SELECT endpoint_group, has_suspicious_path_pattern FROM req) GROUP BY ALL""",
        "user_agent_category": f"""SELECT doc_id, CASE WHEN t <> '' THEN {UA_CASE} END AS category FROM (
          SELECT doc_id, lower(text) AS t FROM documents)""",
        "hash_entities": f"""SELECT c_custkey, {ENTITY.format('c_name')} AS name_hash,
          {ENTITY.format('c_custkey')} AS key_hash FROM customer""",
        "event_identity": f"""WITH {EVENTS}, {APPS} SELECT {APP_SHOWN}, 2 * count(*) AS copies FROM app GROUP BY ALL""",
        "lenient_casts": """WITH t AS (SELECT event_id, value, CAST(regexp_extract(props, '"k": *([0-9]+)', 1)
            AS INTEGER) AS k FROM events)
          SELECT event_id, CASE WHEN k % 4 = 0 THEN k END AS as_int,
            CASE WHEN k % 4 IN (0, 1) THEN CASE WHEN k % 4 = 0 THEN CAST(k AS DOUBLE) ELSE value END END AS as_double,
            CASE k % 4 WHEN 0 THEN CAST(k * 1000 AS DOUBLE) WHEN 1 THEN round(value * 1000, 3) END AS latency_ms
          FROM t""",
        "dedupe_last_write": UPSERTED.replace("ORDERING", "DESC"),
        "dedupe_first_write": UPSERTED.replace("ORDERING", "ASC"),
        "upsert_request_logs": UPSERTED.replace("ORDERING", "DESC"),
        "insert_app_events": f"""WITH {EVENTS}, {APPS} SELECT {TS_US.format('moment')} AS timestamp, level, event,
          round(response_time_ms, 6) AS response_time_ms, user_id_hash, tenant_hash, request_hash, endpoint_template, has_error FROM app""",
        "endpoint_rarity": f"""{BASE} SELECT endpoint_template, count(*) AS endpoint_count,
          round(-ln(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE)), 9) AS endpoint_rarity
          FROM req GROUP BY endpoint_template""",
        "ip_window_features": f"{FEATURES} {FEATURE_SELECT}",
        "ip_window_features_1h": f"{BASE}, {ip_features(60)} {FEATURE_SELECT}",
        "window_p95_distributed": f"""{FEATURES} SELECT {TS.format('ws')} AS window_start, ip_hash,
          round(p95_latency_ms, 6) AS p95_latency_ms FROM feat""",
        "price_median_distributed": """SELECT CASE WHEN l_partkey % 3 = 0 THEN 0 ELSE l_partkey % 50 END AS part_group,
          round(quantile_cont(l_extendedprice, 0.5), 6) AS median FROM lineitem GROUP BY part_group""",
        "user_window_features": f"""WITH {EVENTS}, {APPS}, {USER_FEATURES}
          SELECT {TS.format('ws')} AS window_start, user_id_hash, {rounded(USER_COLUMNS)} FROM ufeat""",
        "feature_summary": f"""{FEATURES}, {APPS}, {USER_FEATURES} SELECT
          (SELECT count(*) FROM feat) AS request_feature_rows, (SELECT count(*) FROM ufeat) AS app_feature_rows,
          (SELECT max(request_count) FROM feat) AS max_request_count,
          (SELECT max(suspicious_path_count) FROM feat) AS max_suspicious_path_count,
          (SELECT max(event_count) FROM ufeat) AS max_app_event_count,
          (SELECT max(error_count) FROM ufeat) AS max_app_error_count""",
        "feature_medians": f"""{FEATURES} SELECT feature, round(quantile_cont(v, 0.5), 6) AS median FROM (
          UNPIVOT (SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in IP_COLUMNS)} FROM feat)
          ON {', '.join(IP_COLUMNS)} INTO NAME feature VALUE v) GROUP BY feature""",
        "contamination_cut": f"""{FEATURES} SELECT round(quantile_cont(round({RAW}, 9), 0.05), 6) AS cut FROM feat""",
        "profile_requests": PROFILE_REQUESTS,
        "profile_app_events": PROFILE_APP,
        "profile_top_values": f"{BASE} {top_values('req', TOP['request'])}",
        "profile_app_top_values": f"WITH {EVENTS}, {APPS} {top_values('app', TOP['app'])}",
        "nearest_rank_p95": f"""SELECT 'extended_price' AS measure, {nearest('lineitem', 'l_extendedprice')} AS p95
          UNION ALL SELECT 'quantity', {nearest('lineitem', 'l_quantity')}
          UNION ALL SELECT 'event_value', {nearest('events', 'value')}""",
        "quality_metric_upsert": f"{METRIC_ROWS} SELECT * FROM metric_rows WHERE metric <> 'dataset'",
        "metric_csv": f"{METRIC_ROWS} SELECT * FROM metric_rows",
        "quality_report": f"""{METRIC_ROWS}, top AS ({BASE} {top_values('req', TOP['request'])})
          SELECT dataset AS first, metric AS second, number AS third, text, NULL AS fourth FROM metric_rows WHERE dataset = 'requests' AND metric <> 'dataset'
          UNION ALL SELECT column_name, value, rows, NULL, value_rank FROM top""",
        "jsonl_sink": f"{BASE} SELECT {REQUEST_SHOWN} FROM req",
        "catalogue_scan": f"""WITH {EVENTS}, {REQUESTS}, {APPS}
          SELECT 'requests' AS dataset, 'request_log' AS type, 'Requests' AS description, {TS_US.format('moment')} AS timestamp, ip_hash AS entity,
            round(latency_ms, 6) AS duration, endpoint_path, endpoint_template, status_code, request_hash FROM req
          UNION ALL SELECT 'apps', 'structured_app_log', '', {TS_US.format('moment')}, user_id_hash, round(response_time_ms, 6), endpoint_path, endpoint_template,
            status_code, request_hash FROM app""",
        "truncate_and_reload": f"WITH {EVENTS}, {APPS} SELECT {APP_SHOWN} FROM app WHERE event <> 'view'",
        "array_file_scan": f"""WITH {EVENTS} SELECT event_id, {TS_US.format('moment')} AS timestamp,
          CASE WHEN k % 4 = 0 THEN 'fallback' ELSE {MODULE} END AS module_id, {METHOD} AS method, {STATUS} AS status_code, {RAW_PATH} AS endpoint_path,
          {RAW_QUERY} AS has_sensitive_query_key, {ENTITY.format('client')} AS ip_hash FROM ev""",
        "evaluation_of_latest": f"""{EVALUATED}, {RANK_METRICS}, {FLAG_METRICS} SELECT 'metric' AS part, * FROM (SELECT * FROM rank_metrics UNION ALL BY NAME SELECT * FROM flag_metrics)
          UNION ALL BY NAME SELECT 'rows' AS part, scenario_name AS ranking_method, 'rows' AS metric_name, NULL AS k_value, CAST(count(*) AS DOUBLE) AS metric_value
            FROM evaluated GROUP BY scenario_name
          UNION ALL BY NAME SELECT 'counts' AS part, NULL AS ranking_method, metric_name, NULL AS k_value, CAST(v AS DOUBLE) AS metric_value FROM (UNPIVOT (
            SELECT count(*) AS rows_evaluated, count(*) FILTER (WHERE is_attack_like) AS attack_like_rows,
                   count(*) FILTER (WHERE NOT is_attack_like) AS benign_rows FROM evaluated)
            ON rows_evaluated, attack_like_rows, benign_rows INTO NAME metric_name VALUE v)""",
        "normalize_and_rank": f"""{SCORES} SELECT {TS.format('ws')} AS window_start, ip_hash,
          raw_decision_score, round(anomaly_score, 9) AS anomaly_score, anomaly_rank FROM ranked""",
        "anomaly_counts": f"""{SCORES} SELECT count(*) AS rows_scored, count(*) FILTER (WHERE is_anomaly) AS anomaly_rows,
          round(avg(CAST(is_anomaly AS INTEGER)), 9) AS anomaly_rate FROM ranked""",
        "threat_score": f"{THREATS} SELECT {ALERT_FIELDS} FROM threats t",
        "threat_level_counts": f"""{THREATS} SELECT l.threat_level, count(t.ws) AS windows
          FROM (VALUES ('critical'), ('high'), ('medium'), ('low')) l(threat_level)
          LEFT JOIN threats t USING (threat_level) GROUP BY l.threat_level""",
        "threat_counts": f"""{THREATS} SELECT count(*) AS rows_scored,
          count(*) FILTER (WHERE is_security_relevant) AS security_relevant_rows,
          count(*) FILTER (WHERE threat_level IN ('high', 'critical')) AS high_or_critical_rows FROM threats""",
        "overview": f"""{THREATS} SELECT 'proxy' AS model_version, count(*) AS total_windows,
          count(*) FILTER (WHERE anomaly_score >= 0.6) AS high_anomaly_score_windows,
          count(*) FILTER (WHERE is_security_relevant) AS security_relevant_windows,
          count(*) FILTER (WHERE threat_level IN ('high', 'critical')) AS high_or_critical_windows,
          round(avg(anomaly_score), 6) AS avg_anomaly_score, round(avg(threat_score), 6) AS avg_threat_score,
          {TS.format('min(ws)')} AS first_window, {TS.format('max(ws)')} AS last_window,
          count(*) FILTER (WHERE threat_level = 'critical') AS critical, count(*) FILTER (WHERE threat_level = 'high') AS high,
          count(*) FILTER (WHERE threat_level = 'medium') AS medium, count(*) FILTER (WHERE threat_level = 'low') AS low FROM threats""",
        "alerts_with_context": alerts("true", 50),
        "alerts_filtered": alerts("t.threat_level = 'medium' AND t.is_security_relevant", 200),
        "timeline_hourly": f"""{THREATS} SELECT {TS.format("date_trunc('hour', ws)")} AS bucket,
          count(*) AS total_windows, count(*) FILTER (WHERE is_security_relevant) AS security_relevant_windows,
          count(*) FILTER (WHERE threat_level IN ('high', 'critical')) AS high_or_critical_windows,
          max(threat_score) AS max_threat_score, round(max(anomaly_score), 6) AS max_anomaly_score
          FROM threats GROUP BY date_trunc('hour', ws) ORDER BY date_trunc('hour', ws) DESC LIMIT 48""",
        "incident_latest_day": alerts("CAST(t.ws AS DATE) = (SELECT max(CAST(ws AS DATE)) FROM threats)", 10, ", strftime(t.ws, '%Y-%m-%d') AS incident_date"),
        "top_anomaly_windows": f"""{SCORES} SELECT anomaly_rank, {TS.format('ws')} AS window_start, ip_hash,
          round(anomaly_score, 6) AS anomaly_score, request_count, suspicious_path_count,
          round(error_rate, 6) AS error_rate, unique_endpoint_count FROM ranked WHERE anomaly_rank <= 20""",
        "top_threat_windows": f"""{THREATS} SELECT {ALERT_FIELDS} FROM threats t
          ORDER BY threat_score DESC, t.anomaly_score DESC, ws, ip_hash LIMIT 20""",
        "scenarios": f"""{FEATURES}, {SCENARIO_ROWS} SELECT synthetic_id, scenario_name, is_attack_like, ip_hash, i AS scenario_index, j AS row_index,
          {', '.join(f'round({c}, 9) AS {c}' if c in DOUBLES else c for c in IP_COLUMNS)},
          {TS.format('base_ws')} AS base_window_start, base_ip AS base_ip_hash FROM synthetic""",
        "scenario_threats": f"""{EVALUATED} SELECT synthetic_id, round(anomaly_score, 6) AS anomaly_score,
          is_anomaly, round(threat_score, 4) AS threat_score, threat_level, is_security_relevant, reasons,
          anomaly_rank, threat_rank FROM evaluated""",
        "precision_recall_at_k": f"{EVALUATED}, {RANK_METRICS} SELECT * FROM rank_metrics",
        "confusion_metrics": f"{EVALUATED}, {FLAG_METRICS} SELECT * FROM flag_metrics",
        "fit_forest": f"""{FOREST} SELECT tree AS tree_id, node AS node_id, coalesce(f, 0) - 1 AS feature,
          CASE WHEN f IS NULL THEN 0 ELSE round(cut, 6) END AS threshold, CASE WHEN f IS NULL THEN -1 ELSE 2 * node + 1 END AS left_id,
          CASE WHEN f IS NULL THEN -1 ELSE 2 * node + 2 END AS right_id, size, depth FROM nodes""",
        "score_forest": f"""{CUT_SCORES} SELECT {TS.format('ws')} AS window_start, ip_hash, 'IsolationForest' AS model_name,
          'forest' AS model_version, round(anomaly_score, 10) AS anomaly_score, raw_decision_score + 0.0 AS raw_decision_score,
          is_anomaly, anomaly_rank FROM ranked""",
        "evaluate_forest": f"""{FOREST_JUDGED}, {RANK_METRICS}, {FLAG_METRICS} SELECT 'run' AS evaluation_id, 'forest' AS model_version, *
          FROM (SELECT * FROM rank_metrics UNION ALL BY NAME SELECT * FROM flag_metrics)""",
        "refresh_end_to_end": f"{FOREST_THREATS} SELECT {ALERT_FIELDS} FROM threats t",
        "scenario_summary": f"""{EVALUATED} SELECT scenario_name, is_attack_like, count(*) AS rows,
          round(avg(anomaly_score), 6) AS avg_anomaly_score, round(avg(threat_score), 4) AS avg_threat_score,
          count(*) FILTER (WHERE is_security_relevant) AS security_relevant_rows FROM evaluated GROUP BY ALL""",
        "high_water_mark": f"""WITH {EVENTS}, m AS (SELECT max(moment) AS mark FROM ev WHERE kind <> 'view')
          SELECT {TS_US.format('mark')} AS mark, {TS_US.format('mark - INTERVAL 5 MINUTE')} AS since,
            (SELECT count(*) FROM ev WHERE moment >= mark - INTERVAL 5 MINUTE) AS pulled_rows FROM m""",
        "incremental_ingest": f"""WITH {EVENTS} SELECT {TS_US.format('moment')} AS timestamp,
          CASE WHEN k % 8 <> 0 THEN {ENTITY.format('event_id')} ELSE {ENTITY.format("('insert-' || event_id)")} END AS request_hash,
          CASE WHEN k % 4 = 0 THEN 'fallback' ELSE {MODULE} END AS module_id, {METHOD} AS method, {STATUS} AS status_code,
          {RAW_QUERY} AS has_sensitive_query_key FROM ev""",
        "indexed_pulls": f"""WITH {EVENTS} SELECT {TS_US.format('moment')} AS timestamp,
          CASE WHEN k % 8 <> 0 THEN {ENTITY.format('event_id')} ELSE {ENTITY.format("('insert-' || event_id)")} END AS request_hash,
          CASE WHEN k % 4 = 0 THEN 'fallback' ELSE {MODULE} END AS module_id, {METHOD} AS method, {STATUS} AS status_code,
          {RAW_QUERY} AS has_sensitive_query_key FROM ev""",
        "landed_file_times": f"""WITH {EVENTS} SELECT client, {TS_US.format('min(moment) FILTER (WHERE k % 9 <> 0)')} AS low,
          {TS_US.format('max(moment) FILTER (WHERE k % 9 <> 0)')} AS high, count(*) AS n_lines, count(*) FILTER (WHERE k % 9 = 0) AS n_untimed
          FROM ev GROUP BY client""",
        "refused_lines": f"""WITH {EVENTS}, t AS (SELECT k % 10 AS m, CASE k % 10 WHEN 0 THEN event_id || ' {{' WHEN 1 THEN '[' || event_id || ']'
            ELSE '{{"event": ' || event_id || '}}' END AS line FROM ev)
          SELECT CASE WHEN m = 2 THEN 'no timestamp' ELSE 'not one JSON object' END AS reason, {ENTITY.format('line')} AS line_hash, count(*) AS n_lines
          FROM t WHERE m < 3 GROUP BY ALL
          UNION ALL SELECT 'loaded', NULL, count(*) FROM t WHERE m > 3""",
        "scores_of_two_versions": f"""{SCORES} SELECT {TS.format('ws')} AS window_start, ip_hash, v.version AS model_version,
          round(raw_decision_score * v.factor, 9) AS score FROM ranked, (VALUES ('001', 1.0), ('1', -1.0)) v(version, factor)""",
        "maintained_rarity": f"""{FEATURES} SELECT {TS.format('ws')} AS window_start, ip_hash, request_count,
          round(avg_endpoint_rarity, 6) AS avg_endpoint_rarity FROM feat""",
        "jsonl_scan": f"""WITH {EVENTS} SELECT CASE WHEN k % 10 = 0 THEN 'Invalid JSON' WHEN k % 10 = 1 THEN 'Expected JSON object'
          ELSE 'entry' END AS kind, CAST(event_id AS VARCHAR) AS event_id FROM ev WHERE k % 10 <> 2""",
        "streaming_ip_windows": f"{FEATURES} {FEATURE_SELECT}",
        "streaming_live_counters": f"""{FEATURES} SELECT {TS.format('ws')} AS window_start, ip_hash, request_count,
          unique_endpoint_count, suspicious_path_count, error_count, round(max_latency_ms, 6) AS max_latency_ms FROM feat""",
        "stored_feature_table": f"{FEATURES} {FEATURE_SELECT}",
    }
