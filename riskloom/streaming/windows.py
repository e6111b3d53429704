"""Rolling windows of one actor, kept up to date row by row.

Small and free of Spark: the processor feeds it what one micro-batch brings. All
windows only ever lose their oldest events, so each is a heap with a running sum.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from riskloom import schemas
from riskloom.operators.rules import Rule


class Held(NamedTuple):
    """An event as the history keeps it; sorts by time, then id."""

    occurred_us: int
    event_id: str
    severity: int
    matched: str  # "1" or "0" per rule


class _Window:
    def __init__(self, events: Iterable[Held] = ()) -> None:
        self.events = sorted(events)
        self.severity = sum(e.severity for e in self.events)

    def add(self, event: Held) -> None:
        heapq.heappush(self.events, event)
        self.severity += event.severity

    def drop_oldest(self) -> Held:
        oldest = heapq.heappop(self.events)
        self.severity -= oldest.severity
        return oldest

    def drop_before(self, cutoff_ms: int) -> int:
        dropped = 0
        while self.events and self.events[0].occurred_us < cutoff_ms * 1000:
            self.drop_oldest()
            dropped += 1
        return dropped


class ActorWindows:
    """History and rule windows of an actor; ``arrive`` gives the signals of one event."""

    def __init__(
        self, rules: Sequence[Rule], cap: int, max_ms: int | None, held: Iterable[Held]
    ) -> None:
        self.rules, self.cap, self.max_ms = rules, cap, max_ms
        self.retention_ms = max(rule.window_ms for rule in rules)
        kept = sorted(held)
        if max_ms is not None:
            kept = [e for e in kept if e.occurred_us >= (max_ms - self.retention_ms) * 1000]
        self.history = _Window(kept[-cap:])
        self.windows = [
            _Window(e for e in self.history.events if e.matched[bit] == "1")
            for bit in range(len(rules))
        ]

    def arrive(self, event: Held) -> list[tuple]:
        """(rule_pos, count, severity sum, evicted) per signal, in emission order."""
        event_ms = event.occurred_us // 1000
        self.max_ms = event_ms if self.max_ms is None else max(self.max_ms, event_ms)
        self.history.drop_before(self.max_ms - self.retention_ms)
        if event_ms < self.max_ms - self.retention_ms:
            return []
        self.history.add(event)
        for bit, window in enumerate(self.windows):
            if event.matched[bit] == "1":
                window.add(event)
        signals = []
        if len(self.history.events) > self.cap:
            evicted = self.history.drop_oldest()
            for window in self.windows:
                # The oldest of the history can only be the oldest of a window.
                if window.events and window.events[0] == evicted:
                    window.drop_oldest()
            signals.append((-1, len(self.history.events), self.history.severity, 1))
        for bit, (rule, window) in enumerate(zip(self.rules, self.windows)):
            window.drop_before(self.max_ms - rule.window_ms)
            count, total = len(window.events), window.severity
            fires = count >= rule.minimum_events and total >= rule.minimum_severity_sum
            if event.matched[bit] == "1" and fires:
                signals.append((bit, count, total, 0))
        return signals


def signal_row(
    rules: Sequence[Rule], cap: int, pos: int, count: int, total: int, evicted: int
) -> tuple[str, int, str]:
    """rule_id, risk_score and reason of a signal."""
    if pos < 0:
        reason = f"history_capacity={cap}, evicted={evicted}, operator_action_required=true"
        return schemas.CAPACITY_RULE_ID, schemas.CAPACITY_SCORE, reason
    rule = rules[pos]
    return rule.rule_id, rule.risk_score, f"events={count}, severity_sum={total}"
