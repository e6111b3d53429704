"""Strict event decode: raw records to events or failures, one expression tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.functions import strict_json as sj
from riskloom.functions.instants import parse_instant

_FIELDS = schemas.EVENT_FIELDS_V2
_SCALARS = tuple(name for name in _FIELDS if name != "attributes")
_TEXTS = tuple(n for n in _SCALARS if n not in ("schema_version", "severity"))
_PREFIX = "invalid safety event: "


def _names(names: tuple[str, ...]) -> Column:
    return F.array(*[F.lit(name) for name in names])


def decode_records(raw: DataFrame) -> DataFrame:
    """Add ``failure_reason``, ``failure_message`` and ``event`` to raw records.

    Exactly one of ``event`` and ``failure_reason`` is set. The checks run in contract
    order and the first failure names the record. Parsing is staged so that every
    payload is parsed a fixed number of times, whatever the number of checks.
    """
    text = F.col("_text")
    staged = document(raw)
    kinds = [
        sj.kind(sj.member(F.col("_doc"), name)).alias(f"_{name}_kind") for name in _FIELDS
    ]
    staged = staged.select(
        *staged.columns,
        *kinds,
        F.when(F.col("_is_object"), sj.members_as_text(text, _SCALARS)).alias("_written"),
        sj.member(F.col("_doc"), "attributes").alias("_attributes"),
    )

    def value(name: str) -> tuple[Column, Column]:
        return F.col(f"_written.{name}"), F.col(f"_{name}_kind")

    staged = staged.select(
        *staged.columns,
        *[sj.filled(*value(name)).alias(f"_{name}_text") for name in _TEXTS],
        sj.int32(*value("schema_version")).alias("_version"),
        sj.int32(*value("severity")).alias("_severity_int"),
    )
    version, v1 = F.col("_version"), F.col("_version") == 1
    allowed = F.when(v1, _names(schemas.EVENT_FIELDS_V1)).otherwise(
        _names(schemas.EVENT_FIELDS_V2)
    )
    attributes, attributes_kind = F.col("_attributes"), F.col("_attributes_kind")
    staged = staged.select(
        *staged.columns,
        parse_instant(F.col("_occurred_at_text")).alias("_occurred"),
        parse_instant(F.col("_ingested_at_text")).alias("_ingested"),
    )
    # The two checks with lambdas cannot be compiled; on their own, they do not keep
    # the others from it.
    staged = staged.select(
        *staged.columns,
        F.when(
            version.isin(*schemas.SUPPORTED_EVENT_VERSIONS),
            sj.first_other_key(text, F.col("_doc"), allowed),
        ).alias("_unknown"),
        F.when(
            sj.is_object(attributes_kind), ~sj.all_text_values(attributes)
        ).alias("_odd_attributes"),
    )

    def text_failure(name: str) -> Column:
        missing = F.col(f"_{name}_text").isNull()
        return F.when(missing, F.lit(f"{_PREFIX}{name} must be text"))

    def optional_failure(name: str) -> Column:
        given = ~sj.is_none(F.col(f"_{name}_kind"))
        return F.when(given, text_failure(name))

    def instant_failure(name: str, parsed: str) -> Column:
        quoted = F.concat(F.lit(f"{_PREFIX}Text '"), F.col(f"_{name}_text"))
        message = F.concat(quoted, F.lit("' could not be parsed as an instant"))
        return F.when(F.col(parsed).isNull(), message)

    def fails(test: Column, message: str) -> Column:
        return F.when(test, F.lit(f"{_PREFIX}{message}"))

    event_type, severity = F.col("_event_type_text"), F.col("_severity_int")
    unknown, odd_attributes = F.col("_unknown"), F.col("_odd_attributes")
    contract_failure = F.coalesce(
        F.when(~F.col("_is_object"), F.lit("event must be a JSON object")),
        fails(version.isNull(), "schema_version must be integer"),
        F.when(unknown.isNotNull(), F.concat(F.lit("unknown field: "), unknown)),
        text_failure("event_id"),
        text_failure("occurred_at"),
        instant_failure("occurred_at", "_occurred"),
        text_failure("ingested_at"),
        instant_failure("ingested_at", "_ingested"),
        F.when(version == 2, text_failure("tenant_id")),
        F.when(version == 2, optional_failure("trace_id")),
        text_failure("actor_id"),
        optional_failure("content_id"),
        text_failure("event_type"),
        F.when(
            ~event_type.isin(*schemas.EVENT_TYPES),
            F.concat(F.lit(f"{_PREFIX}unknown event_type: "), event_type),
        ),
        fails(severity.isNull(), "severity must be integer"),
        fails(
            ~sj.is_none(attributes_kind) & ~sj.is_object(attributes_kind),
            "attributes must be object",
        ),
        fails(odd_attributes, "attribute values must be strings"),
        fails(~severity.between(0, 100), "severity must be in [0,100]"),
    )
    malformed = text.isNull() | (~F.col("_is_json") & ~sj.is_blank(text))
    unsupported = F.col("_is_object") & ~version.isin(*schemas.SUPPORTED_EVENT_VERSIONS)
    failure = (
        F.when(
            F.col("value").isNull(),
            _failure("NULL_PAYLOAD", F.lit("Kafka record value is null")),
        )
        .when(malformed, _failure("MALFORMED_JSON", F.lit("malformed JSON")))
        .when(
            unsupported,
            _failure(
                "UNSUPPORTED_SCHEMA_VERSION",
                F.concat(F.lit("unsupported schema_version: "), version.cast("string")),
            ),
        )
        .when(
            contract_failure.isNotNull(),
            _failure("CONTRACT_VIOLATION", contract_failure),
        )
    )
    staged = staged.withColumn("_failure", failure)
    event_id = F.col("_event_id_text")
    event = F.struct(
        version.alias("schema_version"),
        event_id.alias("event_id"),
        F.col("_occurred").alias("occurred_at"),
        F.col("_ingested").alias("ingested_at"),
        F.when(v1, F.lit(schemas.DEFAULT_TENANT))
        .otherwise(F.col("_tenant_id_text"))
        .alias("tenant_id"),
        F.when(v1, event_id).otherwise(F.col("_trace_id_text")).alias("trace_id"),
        F.col("_actor_id_text").alias("actor_id"),
        F.col("_content_id_text").alias("content_id"),
        event_type.alias("event_type"),
        severity.alias("severity"),
        F.when(~odd_attributes, attributes.try_cast("map<string,string>"))
        .otherwise(F.create_map().cast("map<string,string>"))
        .alias("attributes"),
    )
    outcome = F.struct(
        F.col("_failure.reason").alias("failure_reason"),
        F.col("_failure.message").alias("failure_message"),
        F.when(F.col("_failure").isNull(), event).alias("event"),
    )
    # A filter on the outcome would be pushed below a plain projection, with the whole
    # check chain copied into it. It cannot move below inline(), so each record is
    # decoded once whatever is asked of the result.
    return staged.select(*raw.columns, F.inline(F.array(outcome)))


def document(raw: DataFrame) -> DataFrame:
    """Adds ``_text``, ``_is_json`` (the payload is one JSON value), ``_is_object`` and
    ``_doc`` (the payload when it is an object)."""
    text, value = F.col("_text"), F.col("_any")
    staged = raw.withColumn("_text", sj.utf8_text(F.col("value")))
    staged = staged.withColumn("_wrapped", sj.in_object(text))
    staged = staged.withColumn("_any", sj.single_value(text, F.col("_wrapped")))
    is_object = value.isNotNull() & sj.opens_object(text)
    return staged.select(
        *raw.columns,
        "_text",
        value.isNotNull().alias("_is_json"),
        is_object.alias("_is_object"),
        F.when(is_object, value).alias("_doc"),
    )


def _failure(reason: str, message: Column) -> Column:
    return F.struct(F.lit(reason).alias("reason"), message.alias("message"))


def accepted_events(decoded: DataFrame, *keep: str) -> DataFrame:
    """The events of valid records, with the named raw columns kept beside them."""
    return decoded.where(F.col("event").isNotNull()).select("event.*", *keep)


def rejected_records(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("failure_reason").isNotNull()).drop("event")
