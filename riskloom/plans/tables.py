"""The driver's ``events`` table seen as safety events and as raw records.

The table is in time order and clean, so disorder, copies and poison are added by rules
over ``event_id``, for every row of the table. ``plans.oracles`` states the same rules
in SQL.
"""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.rules import Rule
from riskloom.session import ensure_checkpoint_dir

HOUR_MS = 3_600_000
HOUR_US = HOUR_MS * 1000

# Delay between event time and arrival: (event_id modulus, delay). First match counts.
DELAYS = ((23, 80 * HOUR_US), (29, 30 * HOUR_US), (17, 2 * HOUR_US))
# Every RESENT_EVERY-th event arrives a second time, one second later.
RESENT_EVERY, RESENT_AFTER_US = 10, 1_000_000
# Every STALE_EVERY-th event arrives once more after the duplicate filter forgot it.
STALE_EVERY, STALE_AFTER_US = 37, 26 * HOUR_US
TYPES = {
    "click": "CONTENT_REPORT",
    "signup": "CONTENT_REPORT",
    "view": "POLICY_MATCH",
    "purchase": "USER_BLOCK",
    "error": "MODERATION_DECISION",
}
TOPICS = ("content-events", "activity-events", "moderation-events")
OVERSIZED_EVERY, OVERSIZED_BYTES = 4999, 262_145

BURST = Rule("burst-24h", 24 * HOUR_MS, 3, 120, 80)
POLICY = (
    BURST,
    Rule("reports-6h", 6 * HOUR_MS, 2, 20, 60, ("CONTENT_REPORT", "POLICY_MATCH")),
    Rule("sustained-72h", 72 * HOUR_MS, 5, 150, 90),
    Rule("tagged-48h", 48 * HOUR_MS, 1, 10, 70, (), {"k": "7"}),
)
# The same rules as a policy file.
_POLICY_FILE = Path(__file__).with_name("policy.json")
# The cap used by the capacity queries; small, as an actor has few events a day.
CAP = 8
ARRIVAL = ("arrived_us", "event_id")
# Rows of the table that one task makes records of.
TASK_ROWS = 100_000


def _micros(ntz: str) -> Column:
    """Epoch microseconds of a timestamp without time zone, read as UTC."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(ntz))


def policy_file(spark: SparkSession) -> str:
    """The package's policy file, put where every machine of the cluster can read it."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/policy-{uuid.uuid4()}"
    text = spark.createDataFrame([(_POLICY_FILE.read_text(encoding="utf-8"),)], "value string")
    text.coalesce(1).write.text(folder)
    return folder


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _spread(table: DataFrame) -> DataFrame:
    """Rows over all cores before record-wise work, at most about ``TASK_ROWS`` a task.

    A file is read in as many tasks as its bytes ask for, but the rows of a row group all
    come to one of them, so the tasks of a scan say little about where the rows are. The
    rows are counted from the file footers, and dealt out by their number.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(max(cores, -(-table.count() // TASK_ROWS)), "event_id")


def _per_event(table: DataFrame) -> DataFrame:
    """One row per table row: the event, its number and its arrival time."""
    number = F.col("event_id")
    delay = F.lit(0)
    for modulus, micros in reversed(DELAYS):
        delay = F.when(number % modulus == 0, F.lit(micros)).otherwise(delay)
    event_type = F.create_map(*[F.lit(x) for pair in TYPES.items() for x in pair])
    return table.select(
        number.alias("number"),
        number.cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("actor_id"),
        _micros("ts").alias("occurred_us"),
        event_type[F.col("event_type")].alias("event_type"),
        F.least(F.lit(100), F.floor("value")).cast("int").alias("severity"),
        F.get_json_object("props", "$.k").alias("k"),
        (_micros("ts") + delay).alias("arrived_us"),
    )


def _sent(rows: DataFrame, stale_copies: bool) -> DataFrame:
    """Adds the repeated arrivals; ``copy`` is 0 for the original."""
    number = F.col("number")

    def arrival(copy: int, after: int) -> Column:
        arrived = F.col("arrived_us") + after
        return F.struct(F.lit(copy).alias("copy"), arrived.alias("arrived_us"))

    arrivals = [
        arrival(0, 0),
        F.when(number % RESENT_EVERY == 0, arrival(1, RESENT_AFTER_US)),
    ]
    if stale_copies:
        arrivals.append(F.when(number % STALE_EVERY == 0, arrival(2, STALE_AFTER_US)))
    kept = [c for c in rows.columns if c != "arrived_us"]
    return (
        rows.select(*kept, F.explode(F.array(*arrivals)).alias("_a"))
        .where("_a IS NOT NULL")
        .select(*kept, "_a.*")
    )


def safety_events(spark: SparkSession, sf_dir: str, stale_copies: bool = False) -> DataFrame:
    """Events as they arrive: delayed, some twice. Arrival order is ``ARRIVAL``."""
    rows = _sent(_per_event(events_table(spark, sf_dir)), stale_copies)
    ingested_us = F.col("occurred_us") + (F.col("number") % 5) * 700_000
    return rows.select(
        "event_id",
        "actor_id",
        F.timestamp_micros("occurred_us").alias("occurred_at"),
        F.timestamp_micros(ingested_us).alias("ingested_at"),
        "event_type",
        "severity",
        F.create_map(F.lit("k"), F.col("k")).alias("attributes"),
        "arrived_us",
        "number",
        "copy",
    )


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records of three topics, valid and poison, with the event ``number``.

    What is wrong with a record depends on ``number % 97``.
    """
    rows = _sent(_per_event(_spread(events_table(spark, sf_dir))), stale_copies=False)
    number = F.col("number")
    kind = number % 97

    def quoted(text: Column) -> Column:
        return F.concat(F.lit('"'), text, F.lit('"'))

    def iso(micros: Column) -> Column:
        return F.date_format(F.timestamp_micros(micros), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")

    def pick(normal: Column, *cases: tuple[int, Column]) -> Column:
        chosen = normal
        for value, other in cases:
            chosen = F.when(kind == value, other).otherwise(chosen)
        return chosen

    v2 = (number % 2 == 1) & ~kind.isin(3, 12, 14) | kind.isin(13, 18)
    version = pick(
        F.when(v2, F.lit("2")).otherwise(F.lit("1")), (3, F.lit("99")), (14, F.lit('"1"'))
    )
    tenant = F.concat(F.lit(',"tenant_id":"tenant-'), (number % 5).cast("string"), F.lit('"'))
    trace = F.when(number % 4 == 1, F.lit(',"trace_id":null')).otherwise(
        F.concat(F.lit(',"trace_id":"trace-'), number.cast("string"), F.lit('"'))
    )
    severity = F.col("severity").cast("string")
    body = F.concat(
        F.lit('{"schema_version":'),
        version,
        F.lit(',"event_id":'),
        quoted(F.col("event_id")),
        F.lit(',"occurred_at":"'),
        iso(F.col("occurred_us")),
        pick(F.lit("Z"), (11, F.lit(""))),
        F.lit('","ingested_at":"'),
        iso(F.col("occurred_us") + 1_000_000),
        F.lit('Z"'),
        F.when(kind == 13, F.lit(""))
        .when(v2 | (kind == 12), tenant)
        .otherwise(F.lit("")),
        F.when(kind == 18, F.lit(',"trace_id":5')).when(v2, trace).otherwise(F.lit("")),
        F.when(kind == 8, F.lit(""))
        .when(kind == 15, F.lit(',"actor_id":" "'))
        .otherwise(F.concat(F.lit(',"actor_id":'), quoted(F.col("actor_id")))),
        F.when(kind == 21, F.lit(',"content_id":null')).otherwise(
            F.concat(F.lit(',"content_id":"content-'), (number % 100).cast("string"), F.lit('"'))
        ),
        F.lit(',"event_type":'),
        quoted(pick(F.col("event_type"), (9, F.lit("NOPE")))),
        F.lit(',"severity":'),
        pick(
            severity,
            (5, F.lit("101")),
            (17, quoted(severity)),
            (20, F.lit("45.9")),
            (22, F.concat(severity, F.lit(',"severity":77'))),
        ),
        F.lit(',"attributes":'),
        F.when(kind == 16, F.lit("[]"))
        .when(kind == 10, F.concat(F.lit('{"k":'), F.col("k"), F.lit("}")))
        .otherwise(
            F.concat(F.lit('{"k":"'), F.col("k"), F.lit('","source":"driver"}'))
        ),
        F.lit("}"),
    )
    text = pick(
        body,
        (1, F.concat(F.lit("not-json-"), F.col("event_id"))),
        (2, F.concat(body, F.lit("{}"))),
        (4, F.concat(F.lit('{"surprise":1,'), body.substr(F.lit(2), F.length(body)))),
        (6, F.lit("")),
        (7, F.lit("[1]")),
    )
    oversized = F.repeat(F.lit("x"), OVERSIZED_BYTES)
    text = F.when(number % OVERSIZED_EVERY == 19, oversized).otherwise(text)
    topic = F.array(*[F.lit(t) for t in TOPICS])[(number % 3).cast("int")]
    return rows.select(
        F.col("actor_id").cast("binary").alias("key"),
        F.when(kind != 0, text.cast("binary")).alias("value"),
        topic.alias("topic"),
        F.lit(0).alias("partition"),
        (number * 2 + F.col("copy")).alias("offset"),
        F.timestamp_micros("arrived_us").alias("timestamp"),
        "number",
        "copy",
        "arrived_us",
    )
