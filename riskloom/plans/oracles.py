"""The queries in plain SQL, over the whole tables, by other means.

The engine counts with running sums; the SQL recounts every window with a self join.
"""

from __future__ import annotations

from riskloom import schemas
from riskloom.operators.rules import Rule
from riskloom.plans import queries, tables
from riskloom.plans.tables import BURST, CAP, POLICY

_RETENTION_MS = max(rule.window_ms for rule in POLICY)


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# ---- Inputs -------------------------------------------------------------------------

_DELAY = " ".join(f"WHEN event_id % {m} = 0 THEN {d}" for m, d in tables.DELAYS)
_TYPE = " ".join(f"WHEN {_quote(a)} THEN {_quote(b)}" for a, b in tables.TYPES.items())

_SRC = f"""src AS (
  SELECT event_id AS number, CAST(event_id AS VARCHAR) AS event_id,
    CAST(user_id AS VARCHAR) AS actor_id, epoch_us(ts) AS occurred_us, ts,
    CASE event_type {_TYPE} END AS event_type,
    CAST(least(100, floor(value)) AS INTEGER) AS severity,
    json_extract_string(props, '$.k') AS k,
    epoch_us(ts) + CASE {_DELAY} ELSE 0 END AS arrived_us
  FROM events)"""

_SENT = f"""sent AS (
  SELECT *, 0 AS copy FROM src
  UNION ALL SELECT * REPLACE (arrived_us + {tables.RESENT_AFTER_US} AS arrived_us), 1
  FROM src WHERE number % {tables.RESENT_EVERY} = 0)"""

_SENT_STALE = f"""sent AS (
  SELECT *, 0 AS copy FROM src
  UNION ALL SELECT * REPLACE (arrived_us + {tables.RESENT_AFTER_US} AS arrived_us), 1
  FROM src WHERE number % {tables.RESENT_EVERY} = 0
  UNION ALL SELECT * REPLACE (arrived_us + {tables.STALE_AFTER_US} AS arrived_us), 2
  FROM src WHERE number % {tables.STALE_EVERY} = 0)"""

# Accepted events with the running maximum of event time.
_DEDUP = """firsts AS (
  SELECT actor_id, event_id, min(arrived_us) AS arrived_us FROM sent GROUP BY 1, 2),
ev AS (
  SELECT s.*, s.occurred_us // 1000 AS ms FROM sent s
  JOIN firsts f ON s.actor_id = f.actor_id AND s.event_id = f.event_id
    AND s.arrived_us = f.arrived_us),
run AS (
  SELECT *, max(ms) OVER (PARTITION BY actor_id ORDER BY arrived_us, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS m FROM ev)"""

_BASE = f"WITH {_SRC},\n{_SENT},\n{_DEDUP}"

# Every event with everything of its actor that had arrived and is still retained.
_LIVE = f"""live AS (
  SELECT a.actor_id, a.event_id, a.arrived_us, a.m, a.ms AS a_ms, a.event_type AS a_type,
    a.k AS a_k, b.event_id AS b_id, b.ms AS b_ms, b.severity AS b_sev,
    b.event_type AS b_type, b.k AS b_k,
    row_number() OVER (PARTITION BY a.actor_id, a.event_id
      ORDER BY b.occurred_us DESC, b.event_id DESC) AS newness
  FROM run a JOIN run b ON a.actor_id = b.actor_id
    AND (b.arrived_us, b.event_id) <= (a.arrived_us, a.event_id)
    AND b.ms BETWEEN a.m - {{retention}} AND a.m)"""

_ID_HASH = "md5(event_id || ':' || rule_id)"
_SIGNAL_ID = f"""substr({_ID_HASH},1,8) || '-' || substr({_ID_HASH},9,4) || '-3' ||
  substr({_ID_HASH},14,3) || '-' ||
  substr('89ab', 1 + (instr('0123456789abcdef', substr({_ID_HASH},17,1)) - 1) % 4, 1) ||
  substr({_ID_HASH},18,3) || '-' || substr({_ID_HASH},21,12)"""


def _matches(rule: Rule, event_type: str, k: str) -> str:
    tests = ["true"]
    if rule.event_types:
        tests.append(f"{event_type} IN ({', '.join(map(_quote, rule.event_types))})")
    for name, value in rule.required_attributes.items():
        assert name == "k"
        tests.append(f"{k} = {_quote(value)}")
    return " AND ".join(tests)


def _signals(
    rules: tuple[Rule, ...] = POLICY, cap: int | None = None, base: str = _BASE
) -> str:
    """CTEs up to ``sig``: all signals with arrival order and rule position."""
    retention = max(rule.window_ms for rule in rules)
    held = f"newness <= {cap}" if cap else "true"
    parts = []
    for pos, rule in enumerate(rules):
        parts.append(
            f"""SELECT actor_id, event_id, arrived_us, m, {pos} AS rule_pos,
  {_quote(rule.rule_id)} AS rule_id, {rule.risk_score} AS risk_score,
  count(*) AS n, CAST(sum(b_sev) AS BIGINT) AS total, NULL AS evicted
FROM live WHERE a_ms >= m - {retention} AND {held} AND b_ms >= m - {rule.window_ms}
  AND {_matches(rule, "a_type", "a_k")} AND {_matches(rule, "b_type", "b_k")}
GROUP BY ALL HAVING n >= {rule.minimum_events} AND total >= {rule.minimum_severity_sum}"""
        )
        # An event that is late for a short rule, or was evicted by its own arrival,
        # still triggers; with nothing to count it can only fire at zero minimums,
        # which no rule has.
        assert rule.minimum_events > 0
    if cap:
        parts.append(
            f"""SELECT actor_id, event_id, arrived_us, m, -1 AS rule_pos,
  {_quote(schemas.CAPACITY_RULE_ID)} AS rule_id, {schemas.CAPACITY_SCORE} AS risk_score,
  count(*) FILTER (newness <= {cap}) AS n,
  CAST(sum(b_sev) FILTER (newness <= {cap}) AS BIGINT) AS total, count(*) - n AS evicted
FROM (SELECT *, count(*) OVER (PARTITION BY actor_id, event_id) AS live_n FROM live
  WHERE a_ms >= m - {retention}) WHERE live_n > {cap} AND newness <= {cap} + 1
GROUP BY ALL"""
        )
    union = "\nUNION ALL ".join(parts)
    capacity_reason = (
        f"'history_capacity={cap}, evicted=' || evicted || ', operator_action_required=true'"
    )
    return f"""{base},
{_LIVE.format(retention=retention)},
raw_sig AS ({union}),
sig AS (SELECT {_SIGNAL_ID} AS signal_id, actor_id, event_id AS triggering_event_id,
  rule_id, risk_score,
  CASE WHEN rule_pos < 0 THEN {capacity_reason}
    ELSE 'events=' || n || ', severity_sum=' || total END AS reason,
  n AS observed_event_count, total AS observed_severity_sum, m AS emitted_at_ms,
  arrived_us, rule_pos FROM raw_sig)"""


_COLUMNS = (
    "signal_id, actor_id, triggering_event_id, rule_id, risk_score, reason, "
    "observed_event_count, observed_severity_sum, emitted_at_ms"
)

_HOT = f"""hot AS (SELECT * FROM sig QUALIFY row_number() OVER (PARTITION BY actor_id
  ORDER BY emitted_at_ms DESC, arrived_us DESC, triggering_event_id DESC, rule_pos DESC) = 1)"""

_STORED = """stored AS (
  SELECT *, arrived_us AS stored_at_us FROM sig
  UNION ALL SELECT *, arrived_us + 60000000 FROM sig
  WHERE CAST(triggering_event_id AS BIGINT) % 7 = 0
  UNION ALL SELECT * REPLACE (emitted_at_ms + 5 AS emitted_at_ms), arrived_us + 120000000
  FROM sig WHERE CAST(triggering_event_id AS BIGINT) % 11 = 0),
final AS (SELECT * FROM stored QUALIFY row_number() OVER (
  PARTITION BY actor_id, emitted_at_ms, signal_id ORDER BY stored_at_us DESC) = 1)"""

_STORED_COLUMNS = (
    "actor_id, signal_id, rule_id, observed_event_count, observed_severity_sum, "
    "emitted_at_ms, stored_at_us"
)

# ---- Raw records --------------------------------------------------------------------

_V2 = "((number % 2 = 1 AND kind NOT IN (3, 12, 14)) OR kind IN (13, 18))"
_ISO = "strftime(make_timestamp({0}), '%Y-%m-%dT%H:%M:%S.%f')"
_TOPIC = "CASE number % 3 " + " ".join(
    f"WHEN {i} THEN {_quote(t)}" for i, t in enumerate(tables.TOPICS)
) + " END"
_OVERSIZED = f"number % {tables.OVERSIZED_EVERY} = 19"

_RAW = f"""{_SRC}, {_SENT},
kinds AS (SELECT *, number % 97 AS kind, {_TOPIC} AS topic, number * 2 + copy AS "offset"
  FROM sent),
bodies AS (SELECT *, {_V2} AS v2,
  '{{"schema_version":' || CASE kind WHEN 3 THEN '99' WHEN 14 THEN '"1"'
    ELSE CASE WHEN {_V2} THEN '2' ELSE '1' END END
  || ',"event_id":"' || event_id || '","occurred_at":"' || {_ISO.format("occurred_us")}
  || CASE WHEN kind = 11 THEN '' ELSE 'Z' END
  || '","ingested_at":"' || {_ISO.format("occurred_us + 1000000")} || 'Z"'
  || CASE WHEN kind = 13 THEN '' WHEN {_V2} OR kind = 12
    THEN ',"tenant_id":"tenant-' || (number % 5) || '"' ELSE '' END
  || CASE WHEN kind = 18 THEN ',"trace_id":5' WHEN NOT {_V2} THEN ''
    WHEN number % 4 = 1 THEN ',"trace_id":null' ELSE ',"trace_id":"trace-' || number || '"' END
  || CASE kind WHEN 8 THEN '' WHEN 15 THEN ',"actor_id":" "'
    ELSE ',"actor_id":"' || actor_id || '"' END
  || CASE WHEN kind = 21 THEN ',"content_id":null'
    ELSE ',"content_id":"content-' || (number % 100) || '"' END
  || ',"event_type":"' || CASE WHEN kind = 9 THEN 'NOPE' ELSE event_type END || '"'
  || ',"severity":' || CASE kind WHEN 5 THEN '101' WHEN 17 THEN '"' || severity || '"'
    WHEN 20 THEN '45.9' WHEN 22 THEN severity || ',"severity":77' ELSE '' || severity END
  || ',"attributes":' || CASE kind WHEN 16 THEN '[]' WHEN 10 THEN '{{"k":' || k || '}}'
    ELSE '{{"k":"' || k || '","source":"driver"}}' END || '}}' AS body FROM kinds),
raw AS (SELECT *, CASE WHEN kind = 0 THEN NULL
  WHEN {_OVERSIZED} THEN repeat('x', {tables.OVERSIZED_BYTES})
  WHEN kind = 1 THEN 'not-json-' || event_id WHEN kind = 2 THEN body || '{{}}'
  WHEN kind = 4 THEN '{{"surprise":1,' || substr(body, 2)
  WHEN kind = 6 THEN '' WHEN kind = 7 THEN '[1]' ELSE body END AS payload FROM bodies),
classed AS (SELECT *,
  CASE WHEN kind = 0 THEN 'NULL_PAYLOAD'
    WHEN {_OVERSIZED} OR kind IN (1, 2) THEN 'MALFORMED_JSON'
    WHEN kind = 3 THEN 'UNSUPPORTED_SCHEMA_VERSION'
    WHEN kind BETWEEN 4 AND 18 THEN 'CONTRACT_VIOLATION' END AS reason,
  CASE WHEN kind = 0 THEN 'Kafka record value is null'
    WHEN {_OVERSIZED} OR kind IN (1, 2) THEN 'malformed JSON'
    WHEN kind = 3 THEN 'unsupported schema_version: 99'
    WHEN kind = 4 THEN 'unknown field: surprise'
    WHEN kind = 5 THEN 'invalid safety event: severity must be in [0,100]'
    WHEN kind IN (6, 7) THEN 'event must be a JSON object'
    WHEN kind IN (8, 15) THEN 'invalid safety event: actor_id must be text'
    WHEN kind = 9 THEN 'invalid safety event: unknown event_type: NOPE'
    WHEN kind = 10 THEN 'invalid safety event: attribute values must be strings'
    WHEN kind = 11 THEN 'invalid safety event: Text ''' || {_ISO.format("occurred_us")}
      || ''' could not be parsed as an instant'
    WHEN kind = 12 THEN 'unknown field: tenant_id'
    WHEN kind = 13 THEN 'invalid safety event: tenant_id must be text'
    WHEN kind = 14 THEN 'invalid safety event: schema_version must be integer'
    WHEN kind = 16 THEN 'invalid safety event: attributes must be object'
    WHEN kind = 17 THEN 'invalid safety event: severity must be integer'
    WHEN kind = 18 THEN 'invalid safety event: trace_id must be text' END AS message
  FROM raw),
ok AS (SELECT * REPLACE (CASE kind WHEN 20 THEN 45 WHEN 22 THEN 77 ELSE severity END AS severity)
  FROM classed WHERE reason IS NULL),
poison AS (SELECT 1 AS schema_version, topic || ':0:' || "offset" AS quarantine_id,
  topic AS source_topic, 0 AS source_partition, "offset" AS source_offset,
  arrived_us // 1000 AS source_timestamp, reason AS failure_reason,
  message AS failure_message,
  CAST(octet_length(encode(coalesce(payload, ''))) AS INTEGER) AS original_payload_bytes,
  octet_length(encode(coalesce(payload, ''))) > {schemas.PREVIEW_BYTES} AS payload_truncated,
  base64(encode(substr(coalesce(payload, ''), 1, {schemas.PREVIEW_BYTES}))) AS payload_base64,
  sha256(coalesce(payload, '')) AS payload_sha256
  FROM classed WHERE reason IS NOT NULL)"""
# All payload text is ASCII, so substr counts bytes.

_WITH_RAW = f"WITH {_RAW}"
_RAW_EVENTS = f"""WITH {_RAW},
{_DEDUP.replace("FROM sent", "FROM ok")}"""

_ENCODED = """'{"schema_version":1,"quarantine_id":"' || quarantine_id
  || '","source_topic":"' || source_topic || '","source_partition":' || source_partition
  || ',"source_offset":' || source_offset || ',"source_timestamp":' || source_timestamp
  || ',"failure_reason":"' || failure_reason || '","failure_message":"' || failure_message
  || '","original_payload_bytes":' || original_payload_bytes || ',"payload_truncated":'
  || payload_truncated || ',"payload_base64":"' || payload_base64
  || '","payload_sha256":"' || payload_sha256 || '"}'"""


def _contract(version: int) -> str:
    """Violated checks of one contract, from what was done to each record."""
    v2_doc = "(v2 OR kind IN (13, 18))"
    has_tenant = "((v2 AND kind <> 13) OR kind = 12)"
    has_trace = "(v2 OR kind = 18)"
    if version == 1:
        extra = f"kind = 4 OR {has_tenant} OR {has_trace}"
        wrong_version = f"kind IN (3, 14) OR {v2_doc}"
    else:
        extra = "kind = 4"
        wrong_version = f"kind IN (3, 14) OR NOT {v2_doc}"
    checks = {
        "additional_properties": extra,
        "schema_version": wrong_version,
        "occurred_at": "kind = 11",
        "actor_id": "kind = 8",
        "event_type": "kind = 9",
        "severity": "kind IN (5, 17, 20)",
        "attributes": "kind IN (10, 16)",
    }
    if version == 2:
        checks["tenant_id"] = f"NOT {has_tenant}"
        checks["trace_id"] = "kind = 18"
    cases = ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in checks.items())
    return f"""SELECT {version} AS contract, unnest(CASE
    WHEN kind IN (0, 1, 2, 6, 7) OR {_OVERSIZED} THEN ['object']
    WHEN len(list_filter([{cases}], lambda x: x IS NOT NULL)) = 0 THEN ['valid']
    ELSE list_filter([{cases}], lambda x: x IS NOT NULL) END) AS "check" FROM raw"""


def _lanes(prefix: str) -> str:
    row = "concat_ws('|', " + ", ".join(
        f"{prefix}{c}"
        for c in (
            "signal_id",
            "actor_id",
            "triggering_event_id",
            "rule_id",
            "risk_score",
            "observed_event_count",
            "observed_severity_sum",
        )
    ) + ")"
    return " || '-' || ".join(
        f"coalesce(sum(CAST('0x' || substr(sha256({row}), {1 + 15 * i}, 15) AS BIGINT)), 0)"
        for i in range(4)
    )


def _reconciled(expected: str, observed: str) -> str:
    """Outcome counts and side checksums of two relations."""
    fields = (
        "actor_id",
        "triggering_event_id",
        "rule_id",
        "risk_score",
        "observed_event_count",
        "observed_severity_sum",
    )
    same = " AND ".join(f"e.{c} IS NOT DISTINCT FROM o.{c}" for c in fields)
    return f"""SELECT CASE WHEN o.signal_id IS NULL THEN 'missing'
    WHEN e.signal_id IS NULL THEN 'unexpected' WHEN {same} THEN 'equal'
    ELSE 'different' END AS outcome, count(*) AS records,
  count(DISTINCT coalesce(o.actor_id, e.actor_id)) AS actors, CAST(NULL AS VARCHAR) AS checksum
FROM {expected} e FULL JOIN {observed} o ON e.signal_id = o.signal_id GROUP BY 1
UNION ALL SELECT 'side:expected', count(*), NULL, {_lanes("")} FROM {expected}
UNION ALL SELECT 'side:observed', count(*), NULL, {_lanes("")} FROM {observed}"""


# The rules of the policy file, written out once more by hand.
_CATALOG = """c(rule_pos, rule_id, window_ms, minimum_events, minimum_severity_sum, risk_score,
  event_types, required_attributes) AS (VALUES
  (0, 'burst-24h', 86400000::BIGINT, 3::BIGINT, 120::BIGINT, 80, '', '{}'),
  (1, 'reports-6h', 21600000, 2, 20, 60, 'CONTENT_REPORT,POLICY_MATCH', '{}'),
  (2, 'sustained-72h', 259200000, 5, 150, 90, '', '{}'),
  (3, 'tagged-48h', 172800000, 1, 10, 70, '', '{"k":"7"}')),
m AS (SELECT count(*) AS everything,
  count(*) FILTER (event_type IN ('CONTENT_REPORT', 'POLICY_MATCH')) AS reports,
  count(*) FILTER (k = '7') AS tagged FROM sent)
SELECT c.*, CASE rule_pos WHEN 1 THEN reports WHEN 3 THEN tagged ELSE everything END
  AS matching_arrivals FROM c, m"""


def _matched(source: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT event_id, arrived_us, {pos} AS rule_pos, {_quote(r.rule_id)} AS rule_id "
        f"FROM {source} WHERE {_matches(r, 'event_type', 'k')}"
        for pos, r in enumerate(POLICY)
    )


_HISTORY = f"""{_BASE},
{_LIVE.format(retention=_RETENTION_MS)}"""
_LATENCY = "greatest(0, arrived_us // 1000 - (occurred_us + (number % 5) * 700000) // 1000)"


def oracles() -> dict[str, str]:
    policy, capped = _signals(), _signals(cap=CAP)
    short = POLICY[1]
    rank = "greatest(1, CAST(ceil({q} * n) AS BIGINT))"
    percentiles = ", ".join(
        f"max(latency_ms) FILTER (r = {rank.format(q=q)}) AS {name}"
        for name, q in (("p50", "CAST(0.50 AS DOUBLE)"), ("p95", "CAST(0.95 AS DOUBLE)"), ("p99", "CAST(0.99 AS DOUBLE)"))
    )
    return {
        "multi_topic_union": f"""{_WITH_RAW} SELECT topic, 0 AS partition, count(*) AS records,
  min("offset") AS first_offset, max("offset") AS last_offset,
  CAST(sum(octet_length(encode(payload))) AS BIGINT) AS payload_bytes FROM raw GROUP BY topic""",
        "rules_catalog": f"WITH {_SRC}, {_SENT}, {_CATALOG}",
        "policy_file_signals": f"{policy} SELECT {_COLUMNS} FROM sig",
        "cross_topic_signal": f"{_signals((BURST,), base=_RAW_EVENTS)} SELECT {_COLUMNS} FROM sig",
        "decode_outcomes": f"""{_WITH_RAW} SELECT topic, "offset",
  coalesce(reason, 'ACCEPTED') AS outcome, coalesce(message, '') AS message FROM classed""",
        "unknown_field_audit": f"""{_WITH_RAW} SELECT topic, substr(message, 16) AS field,
  count(*) AS records FROM classed WHERE message LIKE 'unknown field: %' GROUP BY 1, 2""",
        "attribute_explode": f"""{_WITH_RAW} SELECT topic, "offset", event_id, 'k' AS name,
  k AS value FROM ok UNION ALL SELECT topic, "offset", event_id, 'source', 'driver' FROM ok""",
        "v1_v2_normalise": f"""{_WITH_RAW} SELECT topic, "offset",
  CASE WHEN v2 THEN 2 ELSE 1 END AS schema_version, event_id, occurred_us,
  occurred_us + 1000000 AS ingested_us,
  CASE WHEN v2 THEN 'tenant-' || (number % 5) ELSE 'default' END AS tenant_id,
  CASE WHEN NOT v2 THEN event_id WHEN number % 4 = 1 THEN '(none)'
    ELSE 'trace-' || number END AS trace_id, actor_id,
  CASE WHEN kind = 21 THEN '(none)' ELSE 'content-' || (number % 100) END AS content_id,
  event_type, severity FROM ok""",
        "schema_contract_report": f"""{_WITH_RAW} SELECT contract, "check", count(*) AS records
FROM ({_contract(1)} UNION ALL {_contract(2)}) GROUP BY 1, 2""",
        "quarantine_contract_report": f"""{_WITH_RAW} SELECT CASE (source_offset // 2) % 8
    WHEN 0 THEN 'additional_properties' WHEN 1 THEN 'schema_version'
    WHEN 2 THEN 'source_partition' WHEN 3 THEN 'payload_truncated'
    WHEN 4 THEN 'payload_sha256' WHEN 5 THEN 'object' ELSE 'valid' END AS "check",
  count(*) AS records FROM poison GROUP BY 1""",
        "route_counts": f"""{_WITH_RAW} SELECT topic,
  count(*) FILTER (reason IS NULL) AS accepted_records_total,
  count(*) FILTER (reason IS NOT NULL) AS quarantined_records_total FROM classed GROUP BY 1""",
        "quarantine_records": f"{_WITH_RAW} SELECT * FROM poison",
        "quarantine_encode": f"{_WITH_RAW} SELECT quarantine_id AS key, {_ENCODED} AS value FROM poison",
        "quarantine_roundtrip": f"""{_WITH_RAW} SELECT quarantine_id AS key,
  CASE d WHEN 0 THEN 'malformed JSON' WHEN 3 THEN 'unknown field: surprise' ELSE '' END
    AS decode_failure,
  CASE WHEN d IN (0, 3) THEN '' ELSE payload_sha256 END AS payload_sha256,
  CASE WHEN d IN (0, 3) THEN -1 ELSE original_payload_bytes END AS original_payload_bytes
FROM (SELECT *, (source_offset // 2) % 6 AS d FROM poison)""",
        "quarantine_faults": f"""{_WITH_RAW} SELECT quarantine_id AS key, CASE d
    WHEN 0 THEN 'invalid quarantine record: quarantine_id must not be blank'
    WHEN 1 THEN 'invalid quarantine record: unknown failure_reason'
    WHEN 2 THEN 'invalid quarantine record: payload_sha256 must be 64 lowercase hex characters'
    WHEN 3 THEN 'invalid quarantine record: payload_base64 must be valid base64'
    ELSE '' END AS decode_failure
FROM (SELECT *, (source_offset // 2) % 6 AS d FROM poison)""",
        "quarantine_integrity": f"""{_WITH_RAW} SELECT quarantine_id AS id, CASE d
    WHEN 0 THEN 'quarantine_id must match the source coordinate'
    WHEN 2 THEN 'payload_sha256 must be 64 lowercase hex characters'
    WHEN 4 THEN CASE
      WHEN original_payload_bytes = 0 THEN 'original_payload_bytes must be >= 0'
      ELSE 'payload preview length is inconsistent with truncation metadata' END
    WHEN 6 THEN 'payload_base64 must be valid base64' ELSE 'sound' END AS integrity
FROM (SELECT *, (source_offset // 2) % 8 AS d FROM poison)""",
        "quarantine_by_reason": f"""{_WITH_RAW} SELECT failure_reason, source_topic,
  count(*) AS records FROM poison GROUP BY 1, 2""",
        "identical_poison": f"""{_WITH_RAW} SELECT payload_sha256, count(*) AS records,
  max(original_payload_bytes) AS original_payload_bytes,
  bool_or(payload_truncated) AS any_truncated FROM poison GROUP BY 1""",
        "quarantine_distinct": f"""{_WITH_RAW} SELECT failure_reason,
  count(*) + count(*) FILTER (source_offset % 3 = 0) AS deliveries,
  count(DISTINCT quarantine_id) AS identities FROM poison GROUP BY 1""",
        "rule_matches": f"WITH {_SRC}, {_SENT} {_matched('sent')}",
        "rule_matches_attr": f"""WITH {_SRC}, {_SENT} SELECT 'tag-' || k AS rule_id, event_type,
  count(*) AS arrivals, count(DISTINCT actor_id) AS actors FROM sent
WHERE CAST(k AS INTEGER) IN (SELECT * FROM range(0, 100, 9))
  AND event_type IN ('CONTENT_REPORT', 'USER_BLOCK') GROUP BY 1, 2""",
        "rule_validation_gaps": """WITH per AS (SELECT user_id AS u, count(*) AS n,
    floor(avg(value)) AS mean FROM events GROUP BY 1)
SELECT CAST(u AS INTEGER) AS rule_pos, concat_ws('; ',
  CASE WHEN u % 11 = 0 OR u % 13 = 0 THEN 'rule_id must be non-blank text' END,
  CASE WHEN u % 3 = 0 OR u % 5 = 0 OR u % 7 = 0 OR mean < 0 THEN 'invalid rule thresholds' END,
  CASE WHEN u % 4 = 0 THEN 'risk_score must be in [0,100]' END,
  CASE WHEN u % 5 = 0 THEN 'minimum_events above history cap' END) AS violations
FROM per""",
        "rule_validation_report": f"""WITH per AS (SELECT user_id AS u, count(*) AS n,
    floor(avg(value)) AS mean, bool_or(event_type = 'view') AS has_view
  FROM events GROUP BY 1),
cand AS (SELECT *, CASE WHEN u % 13 = 0 THEN '{schemas.CAPACITY_RULE_ID}'
  WHEN u % 11 = 0 THEN '  ' WHEN u % 7 = 0 THEN 'rule-' || (u % 100)
  ELSE 'rule-user-' || u END AS rule_id FROM per),
ranked AS (SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY u) AS r FROM cand)
SELECT CAST(u AS INTEGER) AS rule_pos, rule_id, concat_ws('; ',
  CASE WHEN trim(rule_id) = '' THEN 'rule_id must be non-blank text' END,
  CASE WHEN rule_id = '{schemas.CAPACITY_RULE_ID}' THEN 'rule_id is reserved' END,
  CASE WHEN r > 1 THEN 'duplicate rule_id' END,
  CASE WHEN n <= 60 OR mean < 20 THEN 'invalid rule thresholds' END,
  CASE WHEN n > 80 THEN 'risk_score must be in [0,100]' END,
  CASE WHEN u % 17 = 0 AND has_view THEN 'unknown event_type' END,
  CASE WHEN n > 75 THEN 'minimum_events above history cap' END) AS violations FROM ranked""",
        "dedup_first_arrival": f"""WITH {_SRC}, {_SENT_STALE}
SELECT actor_id, event_id, min(arrived_us) AS arrived_us FROM sent GROUP BY 1, 2""",
        "dedup_ttl": f"""WITH {_SRC}, {_SENT_STALE},
f AS (SELECT actor_id, event_id, min(arrived_us) AS first_us FROM sent GROUP BY 1, 2)
SELECT s.actor_id, s.event_id, s.arrived_us FROM sent s JOIN f USING (actor_id, event_id)
WHERE arrived_us = first_us OR arrived_us // 1000 >= first_us // 1000 + {schemas.DEFAULT_TTL_MS}""",
        "running_max_event_time": f"""{_BASE} SELECT actor_id, event_id, m AS max_ms,
  m - {_RETENTION_MS} AS cutoff_ms FROM run""",
        "history_size": f"""{_HISTORY} SELECT r.actor_id, r.event_id, count(b_id) AS history_n,
  CAST(coalesce(sum(b_sev), 0) AS BIGINT) AS history_sum
FROM run r LEFT JOIN live USING (actor_id, event_id) GROUP BY 1, 2""",
        "rule_signals": f"{_signals((BURST,))} SELECT {_COLUMNS} FROM sig",
        "multi_rule_signals": f"{policy} SELECT {_COLUMNS}, rule_pos FROM sig",
        "late_arrival_signals": f"""{policy} SELECT {_COLUMNS} FROM sig
WHERE (actor_id, triggering_event_id) IN (SELECT (actor_id, event_id) FROM run WHERE ms < m)""",
        "short_rule_late": f"""{_HISTORY} SELECT r.actor_id, r.event_id, r.m AS max_ms,
  count(b_id) AS counted, CAST(coalesce(sum(b_sev), 0) AS BIGINT) AS severity_sum
FROM run r LEFT JOIN live l ON r.actor_id = l.actor_id AND r.event_id = l.event_id
  AND b_ms >= r.m - {short.window_ms} AND {_matches(short, "b_type", "b_k")}
WHERE r.ms < r.m - {short.window_ms} AND r.ms >= r.m - {_RETENTION_MS}
  AND {_matches(short, "r.event_type", "r.k")} GROUP BY 1, 2, 3""",
        "late_beyond_history": f"""{_BASE} SELECT actor_id, event_id, ms AS occurred_ms,
  m AS max_ms FROM run WHERE ms < m - {_RETENTION_MS}""",
        "capacity_evictions": f"""{capped} SELECT actor_id, triggering_event_id AS event_id,
  1 AS evicted, observed_event_count AS history_n, observed_severity_sum AS history_sum
FROM sig WHERE rule_pos = -1""",
        "capacity_signals": f"{capped} SELECT {_COLUMNS} FROM sig",
        "stable_signal_ids": f"""WITH {_SRC}, m AS ({_matched("src")})
SELECT event_id, rule_id, {_SIGNAL_ID} AS signal_id FROM m""",
        "actor_history_topk": f"""{policy}, {_STORED}
SELECT actor_id, row_number() OVER (PARTITION BY actor_id
  ORDER BY emitted_at_ms DESC, signal_id DESC) AS recency, signal_id, emitted_at_ms
FROM final QUALIFY recency <= 10""",
        "hot_state_latest": f"{policy}, {_HOT} SELECT {_COLUMNS} FROM hot",
        "hot_state_ttl": f"""{policy},
hot AS (SELECT * FROM sig WHERE arrived_us // 1000 <= {queries.STATE_AS_OF_MS}
  QUALIFY row_number() OVER (PARTITION BY actor_id ORDER BY arrived_us DESC,
    triggering_event_id DESC, rule_pos DESC) = 1)
SELECT actor_id, signal_id, arrived_us // 1000 AS written_ms,
  arrived_us // 1000 + {schemas.DEFAULT_TTL_MS} AS expires_ms FROM hot
WHERE expires_ms > {queries.STATE_AS_OF_MS}""",
        "hot_state_upsert": f"""{policy.replace("WITH ", "WITH RECURSIVE ", 1)},
writes AS (SELECT *, row_number() OVER (PARTITION BY actor_id
    ORDER BY written_ms, emitted_at_ms, signal_id) AS pos
  FROM (SELECT actor_id, signal_id, emitted_at_ms, arrived_us // 1000 + late_ms AS written_ms
    FROM sig JOIN (VALUES (1, 0), {", ".join(f"({m}, {h * queries.HOUR_MS})" for m, h in queries.REPLAYED)}
    ) AS v(every, late_ms) ON emitted_at_ms % every = 0)),
fold AS (
  SELECT *, 1 AS accepted_writes FROM writes WHERE pos = 1
  UNION ALL
  SELECT f.actor_id, CASE WHEN ok THEN w.signal_id ELSE f.signal_id END,
    CASE WHEN ok THEN w.emitted_at_ms ELSE f.emitted_at_ms END,
    CASE WHEN ok THEN w.written_ms ELSE f.written_ms END,
    w.pos, f.accepted_writes + CAST(ok AS INT)
  FROM fold f JOIN writes w ON w.actor_id = f.actor_id AND w.pos = f.pos + 1,
    LATERAL (SELECT w.emitted_at_ms >= f.emitted_at_ms
      OR w.written_ms >= f.written_ms + {schemas.DEFAULT_TTL_MS} AS ok))
SELECT actor_id, signal_id, emitted_at_ms, written_ms, accepted_writes FROM fold
QUALIFY row_number() OVER (PARTITION BY actor_id ORDER BY pos DESC) = 1""",
        "hot_state_payload": f"""{policy}, {_HOT}
SELECT '{schemas.HOT_KEY_PREFIX}' || actor_id AS key, actor_id, emitted_at_ms,
  '{{"signal_id":"' || signal_id || '","actor_id":"' || actor_id
  || '","triggering_event_id":"' || triggering_event_id || '","rule_id":"' || rule_id
  || '","risk_score":' || risk_score || ',"reason":"' || reason
  || '","observed_event_count":' || observed_event_count
  || ',"observed_severity_sum":' || observed_severity_sum || ',"emitted_at":"'
  || strftime(make_timestamp(emitted_at_ms * 1000), '%Y-%m-%dT%H:%M:%S')
  || CASE WHEN emitted_at_ms % 1000 = 0 THEN ''
    ELSE '.' || lpad(CAST(emitted_at_ms % 1000 AS VARCHAR), 3, '0') END
  || 'Z"}}' AS payload FROM hot""",
        "history_final": f"{policy}, {_STORED} SELECT {_STORED_COLUMNS} FROM final",
        "history_latest_by_signal": f"""{policy}, {_STORED} SELECT {_STORED_COLUMNS} FROM stored
QUALIFY row_number() OVER (PARTITION BY signal_id
  ORDER BY stored_at_us DESC, emitted_at_ms DESC) = 1""",
        "history_rule_stats": f"""{policy}, {_STORED} SELECT rule_id, count(*) AS signals,
  min(observed_event_count) AS least_events, max(observed_event_count) AS most_events,
  max(observed_severity_sum) AS most_severity FROM final GROUP BY 1""",
        "dual_sink_consistency": f"""{_signals(base=_RAW_EVENTS)}
SELECT actor_id, max(emitted_at_ms) AS emitted_at_ms, max(emitted_at_ms) AS newest_ms,
  true AS in_history FROM sig GROUP BY 1""",
        "history_by_rule": f"""{_signals(base=_RAW_EVENTS)} SELECT actor_id,
  triggering_event_id, signal_id, observed_event_count FROM sig
WHERE rule_id = 'burst-24h'""",
        "history_append": f"""{_signals(base=_RAW_EVENTS)},
edge AS (SELECT min(arrived_us) AS a, max(arrived_us) AS b FROM raw)
SELECT CAST(arrived_us >= a + (b - a) // 2 + 1 AS BIGINT) AS batch_id, actor_id, signal_id,
  rule_id, observed_event_count FROM sig, edge""",
        "store_reconciliation": f"""{policy},
observed AS (SELECT * REPLACE (
    CASE WHEN CAST(triggering_event_id AS BIGINT) % 47 = 0 THEN 'x' || signal_id
      ELSE signal_id END AS signal_id,
    observed_event_count + CASE WHEN CAST(triggering_event_id AS BIGINT) % 43 = 0
      THEN 1 ELSE 0 END AS observed_event_count)
  FROM sig WHERE CAST(triggering_event_id AS BIGINT) % 41 <> 0)
{_reconciled("sig", "observed")}""",
        "pipeline_metrics": f"""{capped},
sizes AS (SELECT r.actor_id, r.event_id, r.arrived_us, r.ms < r.m - {_RETENTION_MS} AS late,
    count(b_id) AS live_n FROM run r LEFT JOIN live USING (actor_id, event_id)
  GROUP BY ALL),
held AS (SELECT least(live_n, {CAP}) AS n FROM sizes QUALIFY row_number() OVER (
  PARTITION BY actor_id ORDER BY arrived_us DESC, event_id DESC) = 1),
totals AS (SELECT count(*) AS accepted, count(*) FILTER (late) AS late,
  count(*) FILTER (live_n > {CAP} AND NOT late) AS full FROM sizes)
SELECT (SELECT count(*) FROM sent) AS events_total,
  (SELECT count(*) FROM sent) - accepted AS duplicates_total,
  (SELECT count(*) FROM sig) AS risk_signals_total,
  CAST(accepted - late - (SELECT count(*) FROM sig WHERE rule_pos = -1)
    - (SELECT sum(n) FROM held) AS BIGINT) AS history_expired_events_total,
  late AS late_events_beyond_history_total,
  (SELECT count(*) FROM sig WHERE rule_pos = -1) AS state_capacity_breaches_total,
  (SELECT count(*) FROM sig WHERE rule_pos = -1) AS state_capacity_evictions_total
FROM totals""",
        "throughput_per_minute": f"""WITH {_SRC}, {_SENT}
SELECT arrived_us // 60000000 * 60000 AS interval_start_ms, count(*) AS events,
  round(count(*) / CAST(60 AS DOUBLE), 6) AS events_per_second FROM sent GROUP BY 1""",
        "latency_percentiles": f"""WITH {_SRC}, {_SENT},
l AS (SELECT event_type, {_LATENCY} AS latency_ms FROM sent),
o AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY latency_ms) AS r,
  count(*) OVER (PARTITION BY event_type) AS n FROM l)
SELECT event_type, max(n) AS n, {percentiles}, max(latency_ms) AS max FROM o GROUP BY 1""",
        "summary_stats": """SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean,
  round(median(value), 6) AS median,
  round(coalesce(stddev_samp(value), 0), 6) AS sample_standard_deviation,
  avg(value) > 0 AS coefficient_of_variation_applicable,
  CASE WHEN avg(value) > 0 THEN round(coalesce(stddev_samp(value), 0) / avg(value) * 100, 6) END
    AS coefficient_of_variation_percent,
  min(value) AS min, max(value) AS max FROM events GROUP BY 1""",
        "summary_with_gaps": """WITH v AS (SELECT event_type,
    CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events)
SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean,
  round(median(value), 6) AS median,
  round(coalesce(stddev_samp(value), 0), 6) AS sample_standard_deviation,
  avg(value) > 0 AS coefficient_of_variation_applicable,
  CASE WHEN avg(value) > 0 THEN round(coalesce(stddev_samp(value), 0) / avg(value) * 100, 6) END
    AS coefficient_of_variation_percent,
  min(value) AS min, max(value) AS max FROM v GROUP BY 1""",
        "percentiles_with_gaps": """WITH o AS (
  SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) AS r,
    count(*) OVER (PARTITION BY event_type) AS n FROM events WHERE event_id % 7 <> 0)
SELECT event_type, max(n) AS n, max(value) FILTER (r = ceil(0.5 * n)) AS p50,
  max(value) FILTER (r = ceil(0.95 * n)) AS p95,
  max(value) FILTER (r = ceil(0.99 * n)) AS p99, max(value) AS max FROM o GROUP BY 1""",
        "sequence_drift": """WITH s AS (SELECT event_type, CAST(ts AS DATE) AS day,
    CAST(count(*) AS DOUBLE) AS rate FROM events GROUP BY 1, 2),
i AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY day) AS i,
  count(*) OVER (PARTITION BY event_type) AS size FROM s),
h AS (SELECT event_type, count(*) AS n, avg(rate) FILTER (i <= size // 2) AS a,
  avg(rate) FILTER (i > size // 2) AS b, regr_slope(rate, i) AS slope FROM i GROUP BY 1)
SELECT event_type, n, round(a, 6) AS first_half_mean, round(b, 6) AS second_half_mean,
  round((b - a) / a * 100, 6) AS second_half_vs_first_half_percent,
  round(slope, 6) AS linear_slope FROM h""",
        "bounded_replay": f"{_signals(base=_RAW_EVENTS)} SELECT {_COLUMNS} FROM sig",
        "late_not_dropped": f"""{_signals(base=_RAW_EVENTS)} SELECT {_COLUMNS} FROM sig
WHERE (actor_id, triggering_event_id) IN (SELECT (actor_id, event_id) FROM run WHERE ms < m)""",
        "idle_history_reclaim": f"""{_RAW_EVENTS},
mark AS (SELECT min(reached) - 10000 - 1 AS w FROM (
  SELECT topic, max(occurred_us // 1000) AS reached FROM ok GROUP BY topic)),
tops AS (SELECT *, max(ms) OVER (PARTITION BY actor_id) AS top FROM run)
SELECT actor_id, count(*) AS stored_events FROM tops, mark
WHERE ms >= greatest(top, w) - {_RETENTION_MS} GROUP BY actor_id""",
        "stream_metrics": f"""{_signals(cap=CAP, base=_RAW_EVENTS)},
sizes AS (SELECT r.actor_id, r.event_id, r.arrived_us, r.ms < r.m - {_RETENTION_MS} AS late,
    count(b_id) AS live_n FROM run r LEFT JOIN live USING (actor_id, event_id)
  GROUP BY ALL),
held AS (SELECT least(live_n, {CAP}) AS n FROM sizes QUALIFY row_number() OVER (
  PARTITION BY actor_id ORDER BY arrived_us DESC, event_id DESC) = 1),
totals AS (SELECT count(*) AS accepted, count(*) FILTER (late) AS late FROM sizes)
SELECT (SELECT count(*) FROM ok) AS accepted_records_total,
  (SELECT count(*) FROM poison) AS quarantined_records_total,
  (SELECT count(*) FROM ok) AS events_total,
  (SELECT count(*) FROM ok) - accepted AS duplicates_total,
  (SELECT count(*) FROM sig) AS risk_signals_total,
  CAST(accepted - late - (SELECT count(*) FROM sig WHERE rule_pos = -1)
    - (SELECT sum(n) FROM held) AS BIGINT) AS history_expired_events_total,
  late AS late_events_beyond_history_total,
  (SELECT count(*) FROM sig WHERE rule_pos = -1) AS state_capacity_breaches_total,
  (SELECT count(*) FROM sig WHERE rule_pos = -1) AS state_capacity_evictions_total
FROM totals""",
        "event_time_lag": f"""WITH {_SRC}, {_SENT}
SELECT greatest(0, arrived_us // 1000 - occurred_us // 1000) AS event_time_lag_ms FROM sent
ORDER BY arrived_us DESC, event_id DESC LIMIT 1""",
        "consumer_lag": f"""{_WITH_RAW}, c AS (SELECT topic, max("offset") + 1 AS end_offset,
  coalesce(max("offset") FILTER (arrived_us <= {queries.CONSUMED_UNTIL_MS}000) + 1,
    min("offset")) AS consumed_offset FROM raw GROUP BY 1)
SELECT topic, 0 AS partition, end_offset, consumed_offset,
  end_offset - consumed_offset AS pending_records FROM c""",
    }
