"""Rule policy files."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from riskloom import schemas
from riskloom.operators.rules import Rule

# ---- Fixed values: the fields of one rule in a policy file ----
RULE_FIELDS = (
    "rule_id",
    "window_ms",
    "minimum_events",
    "minimum_severity_sum",
    "risk_score",
    "event_types",
    "required_attributes",
)
# ---- End of fixed values ----


def _is_whole(value: object) -> bool:
    return isinstance(value, int) and not isinstance(value, bool)


def _is_text_map(value: object) -> bool:
    return isinstance(value, dict) and all(isinstance(v, str) for v in value.values())


def _names_events(value: object) -> bool:
    return isinstance(value, list) and all(v in schemas.EVENT_TYPES for v in value)


# What every field of a rule must be; fields with a default may be absent.
_REQUIRED = object()
_CHECKS = {
    "rule_id": (
        _REQUIRED,
        lambda v: isinstance(v, str) and bool(v.strip()),
        "a text that is not blank",
    ),
    **{name: (_REQUIRED, _is_whole, "a whole number") for name in RULE_FIELDS[1:5]},
    "event_types": ([], _names_events, "a list of known event types"),
    "required_attributes": ({}, _is_text_map, "an object of texts"),
}


class PolicyError(ValueError):
    """The policy file does not hold a usable rule set; says everything that is wrong."""


def load_policy(spark: SparkSession, path: str) -> tuple[Rule, ...]:
    """Read one policy file through Spark, so any file system Spark knows works."""
    files = spark.read.text(path, wholetext=True).take(2)
    if len(files) != 1:
        raise PolicyError(f"{path} must be one file")
    return parse_policy(files[0].value)


def parse_policy(text: str) -> tuple[Rule, ...]:
    """The rules of a policy text. What follows its JSON value is ignored."""
    try:
        policy, _ = json.JSONDecoder().raw_decode(text.lstrip())
    except json.JSONDecodeError as error:
        raise PolicyError(f"the policy is no JSON: {error}") from error
    entries = policy.get("rules") if isinstance(policy, dict) else None
    if not isinstance(entries, list) or not entries or len(policy) > 1:
        raise PolicyError("a policy is an object with nothing but a list of rules")
    wrong = [
        f"rule {place}: {problem}"
        for place, entry in enumerate(entries)
        for problem in _problems(entry)
    ]
    if wrong:
        raise PolicyError("; ".join(wrong))
    rules = [_rule(entry) for entry in entries]
    repeated = {r.rule_id for r in rules if sum(o.rule_id == r.rule_id for o in rules) > 1}
    if repeated:
        raise PolicyError(f"rule ids occur more than once: {sorted(repeated)}")
    return tuple(rules)


def _problems(entry: object) -> list[str]:
    if not isinstance(entry, dict):
        return ["must be an object"]
    found = [f"{name} is not a field of a rule" for name in entry if name not in _CHECKS]
    for name, (default, is_right, wanted) in _CHECKS.items():
        if not is_right(entry.get(name, None if default is _REQUIRED else default)):
            found.append(f"{name} must be {wanted}")
    return found


def _rule(entry: dict) -> Rule:
    given = {
        name: entry.get(name, default) for name, (default, _, _) in _CHECKS.items()
    }
    # The score is a 32-bit number, as the wire contract's reader takes it.
    given["risk_score"] = (given["risk_score"] + 2**31) % 2**32 - 2**31
    given["event_types"] = tuple(dict.fromkeys(given["event_types"]))
    try:
        return Rule(**given)
    except ValueError as error:
        raise PolicyError(f"rule {given['rule_id']}: {error}") from error
