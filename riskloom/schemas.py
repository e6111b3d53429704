"""Row types that cross operator boundaries."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- Fixed values: names and limits shared with producers and consumers ----
EVENT_TYPES = ("CONTENT_REPORT", "POLICY_MATCH", "USER_BLOCK", "MODERATION_DECISION")
FAILURE_REASONS = (
    "NULL_PAYLOAD",
    "MALFORMED_JSON",
    "UNSUPPORTED_SCHEMA_VERSION",
    "CONTRACT_VIOLATION",
)
SUPPORTED_EVENT_VERSIONS = (1, 2)
EVENT_FIELDS_V1 = (
    "schema_version",
    "event_id",
    "occurred_at",
    "ingested_at",
    "actor_id",
    "content_id",
    "event_type",
    "severity",
    "attributes",
)
EVENT_FIELDS_V2 = EVENT_FIELDS_V1 + ("tenant_id", "trace_id")
DEFAULT_TENANT = "default"
QUARANTINE_VERSION = 1
PREVIEW_BYTES = 256 * 1024
MESSAGE_CHARS = 512
CAPACITY_RULE_ID = "__state_capacity__"
CAPACITY_SCORE = 100
DEFAULT_HISTORY_CAP = 100_000
DEFAULT_TTL_MS = 24 * 60 * 60 * 1000
HOT_KEY_PREFIX = "safety:risk:actor:"
# ---- End of fixed values ----


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType(
        [T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields]
    )


RAW_RECORD = _struct(
    ("key", T.BinaryType()),
    ("value", T.BinaryType()),
    ("topic", T.StringType()),
    ("partition", T.IntegerType()),
    ("offset", T.LongType()),
    ("timestamp", T.TimestampType()),
)

SAFETY_EVENT = _struct(
    ("schema_version", T.IntegerType()),
    ("event_id", T.StringType()),
    ("occurred_at", T.TimestampType()),
    ("ingested_at", T.TimestampType()),
    ("tenant_id", T.StringType()),
    ("trace_id", T.StringType()),
    ("actor_id", T.StringType()),
    ("content_id", T.StringType()),
    ("event_type", T.StringType()),
    ("severity", T.IntegerType()),
    ("attributes", T.MapType(T.StringType(), T.StringType())),
)

QUARANTINE_EVENT = _struct(
    ("schema_version", T.IntegerType()),
    ("quarantine_id", T.StringType()),
    ("source_topic", T.StringType()),
    ("source_partition", T.IntegerType()),
    ("source_offset", T.LongType()),
    ("source_timestamp", T.LongType()),
    ("failure_reason", T.StringType()),
    ("failure_message", T.StringType()),
    ("original_payload_bytes", T.IntegerType()),
    ("payload_truncated", T.BooleanType()),
    ("payload_base64", T.StringType()),
    ("payload_sha256", T.StringType()),
)

RISK_SIGNAL = _struct(
    ("signal_id", T.StringType()),
    ("actor_id", T.StringType()),
    ("triggering_event_id", T.StringType()),
    ("rule_id", T.StringType()),
    ("risk_score", T.IntegerType()),
    ("reason", T.StringType()),
    ("observed_event_count", T.LongType()),
    ("observed_severity_sum", T.LongType()),
    ("emitted_at", T.TimestampType()),
)

RULE = _struct(
    ("rule_pos", T.IntegerType()),
    ("rule_id", T.StringType()),
    ("window_ms", T.LongType()),
    ("minimum_events", T.LongType()),
    ("minimum_severity_sum", T.LongType()),
    ("risk_score", T.IntegerType()),
    ("event_types", T.ArrayType(T.StringType())),
    ("required_attributes", T.MapType(T.StringType(), T.StringType())),
)

HOT_STATE = _struct(
    ("key", T.StringType()),
    ("actor_id", T.StringType()),
    ("emitted_at_ms", T.LongType()),
    ("payload", T.StringType()),
    ("expires_at", T.TimestampType()),
)
