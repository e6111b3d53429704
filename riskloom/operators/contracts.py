"""The published event schemas as check columns.

The schemas and the decoder differ on purpose in a few places (a fraction that cuts to
an integer, blank text, a null attribute map), so both can be reported side by side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.functions import strict_json as sj
from riskloom.functions.instants import parse_instant
from riskloom.operators.decode import document

CONTRACTS = {1: schemas.EVENT_FIELDS_V1, 2: schemas.EVENT_FIELDS_V2}


def _checks(version: int) -> dict[str, Column]:
    """Check name to "violated" for one contract, over staged member columns."""

    def value(name: str) -> Column:
        return F.col(f"_written.{name}")

    def kind(name: str) -> Column:
        return F.col(f"_{name}_kind")

    def text(name: str) -> Column:
        return ~(sj.is_text(kind(name)) & (F.length(value(name)) > 0))

    def optional_text(name: str) -> Column:
        return ~sj.is_none(kind(name)) & ~sj.is_text(kind(name))

    def integral(name: str) -> Column:
        whole = sj.int32(value(name), kind(name))
        return F.when(value(name).try_cast("double") == whole, whole)

    def date_time(name: str) -> Column:
        given = F.when(sj.is_text(kind(name)), value(name))
        return parse_instant(given).isNull()

    allowed = F.array(*[F.lit(n) for n in CONTRACTS[version]])
    keys = F.map_keys(F.col("_doc").try_cast("map<string,variant>"))
    plain = sj.is_object(kind("attributes")) & sj.all_text_values(F.col("_attributes"))
    event_type = F.when(sj.is_text(kind("event_type")), value("event_type"))
    checks = {
        "additional_properties": F.size(F.array_except(keys, allowed)) > 0,
        "schema_version": integral("schema_version") != version,
        "event_id": text("event_id"),
        "occurred_at": date_time("occurred_at"),
        "ingested_at": date_time("ingested_at"),
        "actor_id": text("actor_id"),
        "content_id": optional_text("content_id"),
        "event_type": ~event_type.isin(*schemas.EVENT_TYPES),
        "severity": ~integral("severity").between(0, 100),
        "attributes": kind("attributes").isNotNull() & ~plain,
    }
    if version == 2:
        checks["tenant_id"] = text("tenant_id")
        checks["trace_id"] = optional_text("trace_id")
    # A test without an answer, as for an absent number, counts as violated.
    return {name: F.coalesce(test, F.lit(True)) for name, test in checks.items()}


def _quarantine_checks() -> dict[str, Column]:
    """Check name to "violated" for the schema of quarantine records."""

    def value(name: str) -> Column:
        return F.col(f"_written.{name}")

    def kind(name: str) -> Column:
        return F.col(f"_{name}_kind")

    def whole(name: str) -> Column:
        number = sj.int64(value(name), kind(name))
        return F.when(value(name).try_cast("double") == number, number)

    def text(name: str) -> Column:
        return F.when(sj.is_text(kind(name)), value(name))

    keys = F.map_keys(F.col("_doc").try_cast("map<string,variant>"))
    allowed = F.array(*[F.lit(n) for n in schemas.QUARANTINE_EVENT.fieldNames()])
    checks = {
        "additional_properties": F.size(F.array_except(keys, allowed)) > 0,
        "schema_version": whole("schema_version") != schemas.QUARANTINE_VERSION,
        "quarantine_id": F.length(text("quarantine_id")) == 0,
        "source_topic": F.length(text("source_topic")) == 0,
        "source_partition": whole("source_partition") < 0,
        "source_offset": whole("source_offset") < 0,
        "source_timestamp": whole("source_timestamp").isNull(),
        "failure_reason": ~text("failure_reason").isin(*schemas.FAILURE_REASONS),
        "failure_message": ~F.length(text("failure_message")).between(1, schemas.MESSAGE_CHARS),
        "original_payload_bytes": whole("original_payload_bytes") < 0,
        "payload_truncated": ~sj.is_boolean(kind("payload_truncated")),
        "payload_base64": text("payload_base64").isNull(),
        "payload_sha256": ~text("payload_sha256").rlike(r"\A[0-9a-f]{64}\z"),
    }
    return {name: F.coalesce(test, F.lit(True)) for name, test in checks.items()}


def quarantine_violations(encoded: DataFrame) -> DataFrame:
    """Encoded quarantine records (``value``) with the names of the failed checks."""
    fields = schemas.QUARANTINE_EVENT.fieldNames()
    return _violations(encoded, tuple(fields), _quarantine_checks())


def quarantine_report(encoded: DataFrame) -> DataFrame:
    """Violations per check of the quarantine schema, plus the number of valid records."""
    return _counted(quarantine_violations(encoded))


def contract_violations(raw: DataFrame, version: int) -> DataFrame:
    """Raw records with ``violations``: names of the failed checks of one contract.

    A payload that is not a JSON object fails the single check ``object``.
    """
    return _violations(raw, schemas.EVENT_FIELDS_V2, _checks(version))


def _violations(raw: DataFrame, fields: tuple[str, ...], checks: dict[str, Column]) -> DataFrame:
    staged = document(raw)
    kinds = [sj.kind(sj.member(F.col("_doc"), n)).alias(f"_{n}_kind") for n in fields]
    written = sj.members_as_text(F.col("_text"), fields)
    staged = staged.select(
        *staged.columns,
        *kinds,
        F.when(F.col("_is_object"), written).alias("_written"),
        sj.member(F.col("_doc"), "attributes").alias("_attributes"),
    )
    failed = [F.when(test, F.lit(name)) for name, test in checks.items()]
    violations = F.when(F.col("_is_object"), F.array_compact(F.array(*failed))).otherwise(
        F.array(F.lit("object"))
    )
    outcome = F.struct(violations.alias("violations"))
    return staged.select(*raw.columns, F.inline(F.array(outcome)))


def report(raw: DataFrame, version: int) -> DataFrame:
    """Violations per check of one contract, plus the number of valid records."""
    counted = _counted(contract_violations(raw, version))
    return counted.select(F.lit(version).alias("contract"), "check", "records")


def _counted(checked: DataFrame) -> DataFrame:
    valid = F.size("violations") == 0
    names = F.when(valid, F.array(F.lit("valid"))).otherwise(F.col("violations"))
    return (
        checked.select(F.explode(names).alias("check"))
        .groupBy("check")
        .agg(F.count("*").alias("records"))
    )
