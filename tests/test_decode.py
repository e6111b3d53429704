import base64
import datetime as dt
import hashlib
import json
import random

import pytest

from riskloom import schemas
from riskloom.operators import contracts, decode, quarantine
from riskloom.operators.rules import Rule
from riskloom.operators.signals import risk_signals
from riskloom.operators.timeline import Evaluation
from riskloom.sources.records import SOURCE_ORDER

AT = dt.datetime(2031, 4, 9, 7, 30)
BASE = {
    "attributes": {"channel": "live", "lang": "pt"},
    "severity": 62,
    "event_type": "USER_BLOCK",
    "content_id": "clip/0031",
    "actor_id": "member:árvore",
    "ingested_at": "2031-04-09T07:30:04.250Z",
    "occurred_at": "2031-04-09T07:30:00Z",
    "event_id": "9f2c",
    "schema_version": 1,
}


def text(without=(), **changes):
    return json.dumps({k: v for k, v in {**BASE, **changes}.items() if k not in without})


def raw_frame(spark, payloads):
    rows = [
        (
            None,
            None if p is None else bytearray(p if isinstance(p, bytes) else p.encode()),
            "reports.eu",
            0,
            i,
            AT,
        )
        for i, p in enumerate(payloads)
    ]
    return spark.createDataFrame(rows, schemas.RAW_RECORD)


def decoded(spark, payloads):
    return decode.decode_records(raw_frame(spark, payloads)).orderBy("offset").collect()


BAD = "invalid safety event: "
V2 = {"schema_version": 2, "tenant_id": "forum"}
REJECTED = [
    (None, "NULL_PAYLOAD", "Kafka record value is null"),
    ("not-json", "MALFORMED_JSON", "malformed JSON"),
    (text() + "{}", "MALFORMED_JSON", "malformed JSON"),
    (b"\xff\xfe", "MALFORMED_JSON", "malformed JSON"),
    ("[1]", "CONTRACT_VIOLATION", "event must be a JSON object"),
    ("null", "CONTRACT_VIOLATION", "event must be a JSON object"),
    ("", "CONTRACT_VIOLATION", "event must be a JSON object"),
    (" \n", "CONTRACT_VIOLATION", "event must be a JSON object"),
    (text(schema_version=3), "UNSUPPORTED_SCHEMA_VERSION", "unsupported schema_version: 3"),
    ('{"schema_version":7}', "UNSUPPORTED_SCHEMA_VERSION", "unsupported schema_version: 7"),
    ("{}", "CONTRACT_VIOLATION", BAD + "schema_version must be integer"),
    (text(schema_version="1"), "CONTRACT_VIOLATION", BAD + "schema_version must be integer"),
    (text(schema_version=2**31), "CONTRACT_VIOLATION", BAD + "schema_version must be integer"),
    (text(zz=1, surprise=1), "CONTRACT_VIOLATION", "unknown field: zz"),
    (text(tenant_id="t"), "CONTRACT_VIOLATION", "unknown field: tenant_id"),
    (text(schema_version=2), "CONTRACT_VIOLATION", BAD + "tenant_id must be text"),
    (text(event_id=" "), "CONTRACT_VIOLATION", BAD + "event_id must be text"),
    (text(event_id=5), "CONTRACT_VIOLATION", BAD + "event_id must be text"),
    (text(["actor_id"]), "CONTRACT_VIOLATION", BAD + "actor_id must be text"),
    (text(content_id=""), "CONTRACT_VIOLATION", BAD + "content_id must be text"),
    (text(**V2, trace_id=1), "CONTRACT_VIOLATION", BAD + "trace_id must be text"),
    (text(event_type="NOPE"), "CONTRACT_VIOLATION", BAD + "unknown event_type: NOPE"),
    (text(severity=101), "CONTRACT_VIOLATION", BAD + "severity must be in [0,100]"),
    (text(severity=-1), "CONTRACT_VIOLATION", BAD + "severity must be in [0,100]"),
    (text(severity="62"), "CONTRACT_VIOLATION", BAD + "severity must be integer"),
    (text(attributes=[]), "CONTRACT_VIOLATION", BAD + "attributes must be object"),
    (text(attributes={"a": 1}), "CONTRACT_VIOLATION", BAD + "attribute values must be strings"),
    (text(attributes={"a": None}), "CONTRACT_VIOLATION", BAD + "attribute values must be strings"),
]


def test_rejections_name_the_first_failure(spark):
    rows = decoded(spark, [payload for payload, _, _ in REJECTED])
    assert [(r.failure_reason, r.failure_message) for r in rows] == [r[1:] for r in REJECTED]
    assert all(r.event is None for r in rows)


def test_accepted_events(spark):
    v1, v2, cut, plain, twice, marked, huge = decoded(
        spark,
        [
            text(),
            text(**V2, trace_id="span-4c"),
            text(severity=62.9, schema_version=1.9),
            text(["content_id"], attributes=None),
            text()[:-1] + ',"severity":17}',
            b"\xef\xbb\xbf" + text().encode(),
            text(attributes={"k": "x" * 100_000}),
        ],
    )
    assert v1.failure_reason is None
    assert (v1.event.tenant_id, v1.event.trace_id) == ("default", BASE["event_id"])
    assert v1.event.attributes == BASE["attributes"]
    assert v1.event.occurred_at == AT
    assert (v2.event.tenant_id, v2.event.trace_id) == ("forum", "span-4c")
    assert (cut.event.severity, cut.event.schema_version) == (62, 1)
    assert (plain.event.content_id, plain.event.attributes) == (None, {})
    assert twice.event.severity == 17
    assert marked.event.event_id == BASE["event_id"]
    assert len(huge.event.attributes["k"]) == 100_000


@pytest.mark.parametrize(
    "instant, expected",
    [
        ("2031-04-09T07:30:00.5Z", AT + dt.timedelta(milliseconds=500)),
        ("2031-04-09T07:30:00.123456789Z", AT + dt.timedelta(microseconds=123456)),
        ("2031-04-09T10:30:00+03:00", AT),
        ("2031-04-09t07:30:00z", AT),
        ("2031-04-09T07:30:00.Z", AT),
        ("2031-04-08T24:00:00Z", AT - dt.timedelta(hours=7, minutes=30)),
        ("2031-04-08T23:59:60Z", AT - dt.timedelta(hours=7, minutes=30, seconds=1)),
        ("2031-04-09T07:30Z", None),
        ("2031-04-09 07:30:00Z", None),
        ("2031-04-09", None),
        ("2031-04-09T07:30:00", None),
        ("2031-02-30T07:30:00Z", None),
        ("2031-04-09T07:30:00Z\n", None),
        ("2031-04-09T07:30:00 UTC", None),
    ],
)
def test_instants(spark, instant, expected):
    row = decoded(spark, [text(occurred_at=instant)])[0]
    assert (row.event.occurred_at if row.event else None) == expected


def strictly_json(payload):
    def reject(name):
        raise ValueError(name)

    try:
        json.loads(payload, parse_constant=reject)
    except ValueError:
        return False
    return True


def test_strictness_equals_a_strict_parser(spark):
    rng = random.Random(5)
    pieces = ['{', '}', '[', ']', ',', ':', '"a"', '"v"', "'a'", '1', '01', '-', 'null', 'NaN',
              'true', '{"a":1}', '{}', '[]', ' ', '\n', '"', '1.5e3', '},{', '],[', '//', '\\']
    payloads = ["".join(rng.choices(pieces, k=rng.randrange(1, 7))) for _ in range(3000)]
    payloads += ['1,"x":2', '1}', '1],[2', '{"a":1}}', '{"a":1},null', '1}{"a":2', '{"a":1}]']
    # Text of white space only counts as "no object", not as malformed.
    payloads = [p for p in dict.fromkeys(payloads) if p.strip()]
    rows = decoded(spark, payloads)
    accepted = [r.failure_reason != "MALFORMED_JSON" for r in rows]
    wrong = [(p, a) for p, a in zip(payloads, accepted) if a != strictly_json(p)]
    assert wrong == []
    assert 30 < sum(accepted) < len(payloads) - 30


def test_filters_do_not_repeat_the_decode(spark):
    frame = decode.accepted_events(decode.decode_records(raw_frame(spark, [text()])))
    plan = frame.where("event_type = 'X'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1


def evidence(spark, payloads):
    rejected = decode.rejected_records(decode.decode_records(raw_frame(spark, payloads)))
    return quarantine.evidence(rejected)


def test_evidence(spark):
    big = b"x" * 262_145
    rows = evidence(spark, [None, "not-json", text(), big]).orderBy("source_offset").collect()
    none, small, large = rows
    assert (none.failure_reason, none.payload_base64, none.original_payload_bytes) == (
        "NULL_PAYLOAD", "", 0,
    )
    assert small.quarantine_id == "reports.eu:0:1"
    assert (small.original_payload_bytes, small.payload_truncated) == (8, False)
    assert base64.b64decode(small.payload_base64) == b"not-json"
    assert small.payload_sha256 == hashlib.sha256(b"not-json").hexdigest()
    assert large.payload_truncated and large.original_payload_bytes == 262_145
    assert len(large.payload_base64) == 4 * -(-262_144 // 3)
    assert large.payload_sha256 == hashlib.sha256(big).hexdigest()


POISON = b"<?xml?>"
RECORD = {
    "schema_version": 1,
    "quarantine_id": "reports.eu:11:70507",
    "source_topic": "reports.eu",
    "source_partition": 11,
    "source_offset": 70507,
    "source_timestamp": 1_933_486_200_000,
    "failure_reason": "MALFORMED_JSON",
    "failure_message": "malformed JSON",
    "original_payload_bytes": len(POISON),
    "payload_truncated": False,
    "payload_base64": base64.b64encode(POISON).decode(),
    "payload_sha256": hashlib.sha256(POISON).hexdigest(),
}
INVALID = "invalid quarantine record: "


def test_quarantine_records_read_back_strictly(spark):
    values = [
        json.dumps(RECORD),
        json.dumps({**RECORD, "surprise": 1}),
        json.dumps(RECORD) + "{}",
        json.dumps({**RECORD, "original_payload_bytes": 8}),
        json.dumps({**RECORD, "payload_sha256": "z" + RECORD["payload_sha256"][1:]}),
        json.dumps({**RECORD, "quarantine_id": "reports.eu:11:70508"}),
        json.dumps({**RECORD, "payload_truncated": "no"}),
        json.dumps({**RECORD, "failure_message": ""}),
        json.dumps({**RECORD, "payload_base64": "*"}),
        "[]",
    ]
    frame = spark.createDataFrame(list(enumerate(values)), "n int, value string")
    rows = quarantine.decode(frame).orderBy("n").collect()
    bad = "invalid quarantine record: "
    assert [r.decode_failure for r in rows] == [
        None,
        "unknown field: surprise",
        "malformed JSON",
        bad + "payload preview length is inconsistent with truncation metadata",
        bad + "payload_sha256 must be 64 lowercase hex characters",
        bad + "quarantine_id must match the source coordinate",
        bad + "payload_truncated must be boolean",
        bad + "failure_message must not be blank",
        bad + "payload_base64 must be valid base64",
        "quarantine record must be an object",
    ]
    assert {k: rows[0][k] for k in RECORD} == RECORD
    encoded = quarantine.encode(quarantine.decode(frame).where("decode_failure IS NULL"))
    assert json.loads(encoded.first().value) == RECORD
    assert list(json.loads(encoded.first().value)) == list(RECORD)


@pytest.mark.parametrize(
    "changes, failure",
    [
        ({"quarantine_id": " ", "source_partition": "x"}, "quarantine_id must not be blank"),
        ({"failure_reason": "OTHER", "failure_message": 5}, "unknown failure_reason"),
        ({"source_partition": -1, "failure_reason": "OTHER"}, "unknown failure_reason"),
        (
            {"payload_sha256": RECORD["payload_sha256"] + "\n"},
            "payload_sha256 must be 64 lowercase hex characters",
        ),
        ({"payload_base64": "PD94 bWw/Pg=="}, "payload_base64 must be valid base64"),
        ({"payload_base64": "PD94bWw/Pg==\n"}, "payload_base64 must be valid base64"),
    ],
)
def test_the_first_failure_of_a_quarantine_record(spark, changes, failure):
    frame = spark.createDataFrame([(json.dumps({**RECORD, **changes}),)], "value string")
    assert quarantine.decode(frame).first().decode_failure == INVALID + failure


def test_contracts_separate_the_versions(spark):
    raw = raw_frame(spark, [text(), text(**V2), text(severity=62.9), "1"])

    def violations(version):
        rows = contracts.contract_violations(raw, version).orderBy("offset").collect()
        return [r.violations for r in rows]

    assert violations(1) == [
        [], ["additional_properties", "schema_version"], ["severity"], ["object"],
    ]
    assert violations(2) == [
        ["schema_version", "tenant_id"], [], ["schema_version", "severity", "tenant_id"], ["object"],
    ]


def test_decoded_records_in_source_order(spark):
    """From raw records to signals, ordered by source coordinates."""
    payloads = [text(event_id=f"e{i % 5}", severity=40) for i in range(7)] + ["not-json"]
    decoded_rows = decode.decode_records(raw_frame(spark, payloads))
    events = decode.accepted_events(decoded_rows, *SOURCE_ORDER)
    rule = Rule("r", 60_000, 3, 120, 90)
    for options in ({}, {"actor_rows": 2}, {"history_cap": 4, "actor_rows": 2}):
        spec = Evaluation((rule,), arrival=SOURCE_ORDER, stage_input=True, **options)
        rows = risk_signals(events, spec).where("rule_pos >= 0").orderBy("offset").collect()
        expected = [("e2", 3), ("e3", 4), ("e4", min(5, options.get("history_cap", 5)))]
        assert [(r.triggering_event_id, r.observed_event_count) for r in rows] == expected
