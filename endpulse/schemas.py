"""Explicit schemas of the state tables and of the job inputs.

Times are epoch seconds (LongType); ``now`` is always a job parameter, so a
run repeated on the same inputs gives the same tables.
"""

from pyspark.sql import types as T

_S, _L, _D, _B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _struct(*fields, required=()):
    return T.StructType([T.StructField(n, t, n not in required) for n, t in fields])


CATALOG = _struct(
    ("proxy_hash", _S), ("raw_link", _S), ("scheme", _S),
    ("first_seen_at", _L), ("last_seen_at", _L), ("last_checked_at", _L),
    ("last_status", _S), ("reason", _S),
    ("latency_ms", _D), ("mbps", _D),
    ("exit_ip", _S), ("country", _S), ("city", _S),
)

DEAD = _struct(
    ("proxy_hash", _S), ("raw_link", _S), ("scheme", _S), ("reason", _S),
    ("created_at", _L), ("expires_at", _L),
)

SELECTED = _struct(
    ("proxy_hash", _S), ("selected_at", _L), ("raw_link", _S),
    ("latency_ms", _D), ("mbps", _D),
    ("exit_ip", _S), ("country", _S), ("city", _S),
)

SOURCE_STATE = _struct(("link", _S), ("last_data_hash", _S))

FRESH = _struct(("proxy_hash", _S), ("raw_link", _S), ("scheme", _S))

# One row per finished test. seq is the order of arrival and is unique.
RESULTS = _struct(
    ("seq", _L), ("proxy_hash", _S), ("kind", _S), ("success", _B), ("reason", _S),
    ("latency_ms", _D), ("exit_ip", _S), ("country", _S), ("city", _S), ("mbps", _D),
)

PAYLOADS = _struct(("source", _S), ("content", T.BinaryType()))
CONVERTED = _struct(("link", _S), ("outbound", _S))
RESOLUTIONS = _struct(("host", _S), ("address", _S))
# One row per address that a lookup found; a failed lookup has one without.
LOOKUPS = _struct(("host", _S), ("address", _S), ("resolved_at", _L), ("ok", _B))
GEO_NETWORKS = _struct(
    ("network", _S), ("iso_code", _S), ("country_name", _S), ("city", _S))

CATALOG_COLUMNS = CATALOG.fieldNames()

# Values of last_status and reason.
STATUS_UNKNOWN = "unknown"
STATUS_DEAD = "dead"
REASON_OK = "ok"
REASON_UNKNOWN = "unknown"
REASON_INVALID = "invalid_proxy_uri"
REASON_URL_FAILED = "url_test_failed"
REASON_SPEED_FAILED = "speed_test_failed"
REASON_TOO_SLOW = "speed_below_threshold"
REASON_CIDR = "cidr_discarded"
REASON_COUNTRY = "discarded_filtering"

# The two ways of a filter by a list.
METHODS = ("include", "exclude")


def check_method(method):
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, not {method!r}")
