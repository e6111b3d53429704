"""Brute force for small fixtures: every rule recounted from all arrivals, each time."""

from __future__ import annotations

import hashlib
import uuid
from collections import defaultdict


def signal_id(event_id: str, rule_id: str) -> str:
    digest = hashlib.md5(f"{event_id}:{rule_id}".encode()).digest()
    return str(uuid.UUID(bytes=digest, version=3))


def matches(rule, event) -> bool:
    if rule.event_types and event["event_type"] not in rule.event_types:
        return False
    held = event["attributes"]
    return all(held.get(k) == v for k, v in rule.required_attributes.items())


def signals(events, rules, cap=100_000):
    """(actor, event, rule, count, sum, emitted ms, evicted) per signal; arrival order."""
    found = []
    longest = max(rule.window_ms for rule in rules)
    arrived = defaultdict(list)
    for event in events:
        before = arrived[event["actor_id"]]
        if any(e["event_id"] == event["event_id"] for e in before):
            continue
        before.append(event)
        end = max(e["us"] // 1000 for e in before)
        # What is inside the longest window now was inside it at its own arrival too.
        live = [e for e in before if e["us"] // 1000 >= end - longest]
        live.sort(key=lambda e: (e["us"], e["event_id"]))
        held = live[-cap:]
        if event["us"] // 1000 < end - longest:
            continue
        who, what = event["actor_id"], event["event_id"]
        if len(live) > cap:
            total = sum(e["severity"] for e in held)
            found.append((who, what, "__state_capacity__", len(held), total, end))
        for rule in rules:
            if not matches(rule, event):
                continue
            inside = [
                e
                for e in held
                if matches(rule, e) and e["us"] // 1000 >= end - rule.window_ms
            ]
            total = sum(e["severity"] for e in inside)
            if len(inside) >= rule.minimum_events and total >= rule.minimum_severity_sum:
                found.append((who, what, rule.rule_id, len(inside), total, end))
    return found
