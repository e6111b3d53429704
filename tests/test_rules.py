import json

import pytest

from riskloom.operators import quarantine, rules
from riskloom.operators.rules import Rule
from riskloom.sources.policy import PolicyError, load_policy, parse_policy
from riskloom.sources.records import parse_topics

RULE = {
    "rule_id": "pile-on",
    "required_attributes": {"channel": "live"},
    "event_types": ["USER_BLOCK"],
    "risk_score": 35,
    "minimum_severity_sum": 7,
    "minimum_events": 5,
    "window_ms": 5_400_000,
}


def policy(*entries):
    return json.dumps({"rules": list(entries)})


def test_policy_file(spark, tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(json.dumps({"rules": [RULE]}, indent=2))
    loaded = load_policy(spark, str(path))
    assert loaded == (
        Rule("pile-on", 5_400_000, 5, 7, 35, ("USER_BLOCK",), {"channel": "live"}),
    )
    row = rules.rules_frame(spark, loaded).first()
    assert (row.rule_pos, row.rule_id, row.event_types) == (0, "pile-on", ["USER_BLOCK"])


@pytest.mark.parametrize(
    "text",
    [
        "[]",
        "{}",
        '{"rules":[]}',
        "not json",
        json.dumps({"rules": [RULE], "surprise": 1}),
        policy(RULE, RULE),
        policy({**RULE, "surprise": 1}),
        policy({**RULE, "event_types": ["NOPE"]}),
        policy({**RULE, "event_types": "CONTENT_REPORT"}),
        policy({**RULE, "required_attributes": {"a": 1}}),
        policy({**RULE, "rule_id": " "}),
        policy({**RULE, "window_ms": 0}),
        policy({**RULE, "window_ms": 1.5}),
        policy({**RULE, "minimum_events": 0}),
        policy({**RULE, "minimum_severity_sum": -1}),
        policy({**RULE, "risk_score": 101}),
        policy({k: v for k, v in RULE.items() if k != "risk_score"}),
    ],
)
def test_rejected_policies(text):
    with pytest.raises(PolicyError):
        parse_policy(text)


def test_a_policy_error_says_all_that_is_wrong():
    with pytest.raises(PolicyError) as error:
        parse_policy(policy({**RULE, "window_ms": "1", "surprise": 1}, {**RULE, "rule_id": "\t"}))
    for part in ("rule 0: surprise", "rule 0: window_ms", "rule 1: rule_id"):
        assert part in str(error.value)


def test_violations_of_rows_with_gaps(spark):
    good = (0, "good", 1, 1, 0, 50, [], {})
    rows = [
        good,
        (1, "gap", None, 1, 0, 50, [], {}),
        (2, "gap2", 1, None, 0, 50, [], {}),
        (3, "gap3", 1, 1, None, 50, [], {}),
        (4, "gap4", 1, 1, 0, None, [], {}),
        (5, "\t\n", 1, 1, 0, 50, [], {}),
        (6, None, 1, 1, 0, 50, [], {}),
        (7, "good", 1, 1, 0, 50, [], {}),
    ]
    schema = (
        "rule_pos int, rule_id string, window_ms bigint, minimum_events bigint, "
        "minimum_severity_sum bigint, risk_score int, event_types array<string>, "
        "required_attributes map<string,string>"
    )
    found = rules.violations(spark.createDataFrame(rows, schema), 100).orderBy("rule_pos")
    assert [len(r.violations) for r in found.collect()] == [0, 1, 2, 1, 1, 1, 1, 1]


def test_topics():
    names = parse_topics("content-events, activity-events,moderation-events")
    assert names == ["content-events", "activity-events", "moderation-events"]
    assert quarantine.default_topic(names) == "content-events.quarantine"
    for bad in (None, " ", "a,", "a,,b", "a,b, a"):
        with pytest.raises(ValueError):
            parse_topics(bad)
