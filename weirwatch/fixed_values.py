"""Word lists, patterns, labels and lookup tables.

Everything in this module is data that decides results and must not drift:
changing an entry changes which rows are flagged, how they are grouped or how
they are scored.
"""

# Query keys whose presence marks a request as sensitive.
SENSITIVE_QUERY_KEYS = [
    "token",
    "access_token",
    "refresh_token",
    "id_token",
    "key",
    "apikey",
    "api_key",
    "password",
    "pass",
    "secret",
    "session",
    "sid",
    "email",
]

# Payload and header keys that mark an application event.
SENSITIVE_PAYLOAD_KEYS = [
    "token",
    "access_token",
    "refresh_token",
    "id_token",
    "key",
    "apikey",
    "api_key",
    "password",
    "pass",
    "secret",
    "session",
    "sid",
    "authorization",
    "cookie",
    "email",
]

# Patterns scrubbed out of a URL path, applied in this order.
# (placeholder, pattern); word classes are Unicode-aware, see functions.paths.
PATH_SCRUBBERS = [
    ("{email}", r"[^/@\s]+@[^/@\s]+\.[^/@\s]+"),
    ("{uuid}", r"\b[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\b"),
    ("{hex}", r"\b[0-9a-fA-F]{16,}\b"),
    ("{num}", r"\b\d{4,}\b"),
]

# File extensions of static assets.
STATIC_EXTENSIONS = [
    ".css",
    ".js",
    ".png",
    ".jpg",
    ".jpeg",
    ".gif",
    ".svg",
    ".ico",
    ".webp",
    ".wav",
    ".mp3",
    ".woff",
    ".woff2",
    ".ttf",
    ".map",
]

# Substrings that make a path suspicious.
SUSPICIOUS_PATH_PATTERNS = [
    ".env",
    ".git",
    ".ds_store",
    "wp-admin",
    "wp-login",
    "phpmyadmin",
    "backup",
    "dump",
    ".sql",
    "gitconfig",
    "database",
    "db.sql",
    "passwd",
    "shadow",
]

# Shapes of one path segment.
SEGMENT_PLACEHOLDERS = ["{uuid}", "{num}", "{hex}", "{email}"]
SEGMENT_DIGITS = r"\d+"
SEGMENT_HEX = r"[a-fA-F0-9]+"
SEGMENT_HEX_MIN = 12
SEGMENT_SLUG = r"[a-z0-9]+(?:-[a-z0-9]+){1,}"
SEGMENT_LONG = 30
TEMPLATE_DEPTH = 6
VERSION_SEGMENTS = ["v1", "v2"]

# User-agent categories, first match wins, else "other".
USER_AGENT_MARKERS = [
    ("bot", ["bot", "crawler", "spider", "slurp"]),
    ("mobile_browser", ["mobile", "android", "iphone"]),
    ("desktop_browser", ["mozilla", "chrome", "safari", "firefox"]),
    ("script_or_api_client", ["curl", "wget", "python-requests", "postman"]),
]

# The twenty model features, in model order.
REQUEST_FEATURES = [
    "request_count",
    "unique_endpoint_count",
    "unique_endpoint_group_count",
    "unique_method_count",
    "unique_user_agent_category_count",
    "static_asset_count",
    "suspicious_path_count",
    "sensitive_query_count",
    "status_2xx_count",
    "status_3xx_count",
    "status_4xx_count",
    "status_5xx_count",
    "error_count",
    "error_rate",
    "avg_latency_ms",
    "p95_latency_ms",
    "max_latency_ms",
    "avg_response_size",
    "avg_endpoint_rarity",
    "off_hours",
]

# Threat levels, highest first, with their lower score bound.
THREAT_LEVELS = [("critical", 80.0), ("high", 60.0), ("medium", 35.0), ("low", None)]
RELEVANT_LEVELS = ["medium", "high", "critical"]
ANOMALY_WEIGHT = 35.0
MAX_THREAT_SCORE = 100.0
NO_REASON = "low-priority statistical anomaly"

# Off-hours are hours before the first or from the second bound.
OFF_HOURS_END = 6
OFF_HOURS_START = 22

# Read-model limits and thresholds.
HIGH_ANOMALY_SCORE = 0.6
ALERT_LIMIT_DEFAULT = 50
ALERT_LIMIT_MAX = 200
INCIDENT_LIMIT = 10
TIMELINE_LIMIT = 48
TOP_WINDOWS = 20
TOP_VALUES = 10

# Ranking cut-offs of the evaluation.
EVALUATION_KS = [10, 20, 50, 100, 200, 300]

# The isolation forest.
FOREST_TREES = 200
FOREST_SAMPLE = 256
FOREST_SEED = 42
MODEL_NAME = "IsolationForest"

# Synthetic scenarios in their numbering order. The columns are
# name, attack-like, then the features in REQUEST_FEATURES order without
# error_rate (which is error_count / request_count).
SCENARIO_COLUMNS = ["scenario_name", "is_attack_like"] + [
    f for f in REQUEST_FEATURES if f != "error_rate"
]
SCENARIOS = [
    ("endpoint_scanning", True, 220, 120, 5, 2, 1, 0, 45, 0,
     20, 0, 190, 10, 200, 130.0, 360.0, 1200.0, 900.0, 7.5, False),
    ("suspicious_probe_off_hours", True, 140, 70, 5, 2, 1, 0, 80, 1,
     25, 5, 105, 5, 110, 160.0, 420.0, 1500.0, 700.0, 8.0, True),
    ("request_burst_scan", True, 650, 90, 4, 3, 1, 20, 20, 0,
     480, 20, 145, 5, 150, 180.0, 520.0, 1800.0, 1200.0, 6.5, False),
    ("repeated_error_attempts", True, 180, 4, 2, 1, 1, 0, 0, 0,
     20, 0, 155, 5, 160, 140.0, 380.0, 1000.0, 650.0, 4.0, False),
    ("static_asset_burst", False, 700, 12, 1, 1, 1, 680, 0, 0,
     500, 197, 3, 0, 3, 80.0, 210.0, 600.0, 3500.0, 1.0, False),
    ("popular_endpoint_spike", False, 550, 3, 2, 1, 1, 0, 0, 0,
     520, 30, 0, 0, 0, 120.0, 260.0, 650.0, 1400.0, 1.2, False),
    ("slow_backend_no_security_signal", False, 50, 5, 2, 1, 1, 0, 0, 0,
     48, 2, 0, 0, 0, 1600.0, 3200.0, 8000.0, 1600.0, 1.8, False),
]

# Incremental pull.
OVERLAP_MINUTES = 5
FRESHNESS_MINUTES = 60
