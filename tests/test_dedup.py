"""Duplicates that are forgotten after a time, against a loop over arrivals."""

import random

from riskloom.operators import dedup

TTL = 100


def brute(rows):
    accepted, last = [], {}
    for actor, event, at, n in sorted(rows, key=lambda r: (r[2], r[3])):
        if (actor, event) not in last or at >= last[actor, event] + TTL:
            last[actor, event] = at
            accepted.append((actor, event, at, n))
    return sorted(accepted)


def frame(spark, rows):
    return spark.createDataFrame(rows, "actor_id string, event_id string, at bigint, n bigint")


def found(spark, rows):
    accepted = dedup.accepted_arrivals(frame(spark, rows), ("at", "n"), "at", TTL)
    return sorted(tuple(r) for r in accepted.collect())


def test_equals_a_loop(spark):
    rng = random.Random(8)
    rows = [
        (f"a{rng.randrange(4)}", f"e{rng.randrange(3)}", rng.randrange(2000) // 7 * 7, i)
        for i in range(900)
    ]
    rows += [("once", "x", 5, 1000), ("twice", "x", 0, 1001), ("twice", "x", TTL, 1002)]
    rows += [("short", "x", 0, 1003), ("short", "x", TTL - 1, 1004)]
    rows += [("tied", "x", t, 2000 + 10 * t + i) for t in (0, TTL) for i in range(5)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows[:0]) == []


def test_a_year_of_daily_copies_takes_few_rounds(spark, monkeypatch):
    rows = [("a", "daily", day * TTL, day) for day in range(365)]
    rows += [("a", "often", t, 1000 + t) for t in range(0, 365 * TTL, 37)]
    rounds = []

    def is_empty(self):
        rounds.append(1)
        return len(self.take(1)) == 0

    monkeypatch.setattr(type(frame(spark, rows)), "isEmpty", is_empty)
    assert found(spark, rows) == brute(rows)
    assert len(rounds) <= 10

