"""Strict JSON reading with variant expressions only (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANK = r"^\p{javaWhitespace}*$"
_NUMBER_TYPE = r"^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL|DOUBLE|FLOAT)"
INT_MIN, INT_MAX = -(2**31), 2**31 - 1


def is_blank(text: Column) -> Column:
    """True for empty text and for text of white space only."""
    return text.rlike(_BLANK)


def utf8_text(payload: Column) -> Column:
    """Payload bytes as text without a byte order mark; NULL when not valid UTF-8."""
    bom = F.substring(payload, 1, 3) == F.unhex(F.lit("EFBBBF"))
    body = F.when(bom, payload.substr(F.lit(4), F.octet_length(payload)))
    text = body.otherwise(payload).cast("string")
    return F.when(F.is_valid_utf8(text), text)


def in_object(text: Column) -> Column:
    """Variant of ``{"v":text}``: NULL unless the text fits as one member value."""
    return F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))


def single_value(text: Column, object_form: Column) -> Column:
    """The one JSON value a text holds, NULL when it is anything else.

    Spark's parser ignores what follows the first value, so ``object_form`` may have
    ended early. A text that can close the object early, or that adds members to it,
    does not read as exactly one element of an array.
    """
    elements = F.json_array_length(F.concat(F.lit("["), text, F.lit("]")))
    return F.when(elements == 1, F.variant_get(object_form, "$.v", "variant"))


def members_as_text(text: Column, names: tuple[str, ...]) -> Column:
    """The named members of an object as they are written, read in one go.

    Texts come without quotes, so the kind of a member has to be asked of its variant;
    converting a variant to text would cost several times as much.
    """
    return F.from_json(text, ", ".join(f"{name} string" for name in names))


def opens_object(text: Column) -> Column:
    """Whether a text that is JSON holds an object."""
    return F.ltrim(text, F.lit(" \t\r\n")).startswith("{")


def member(document: Column, name: str) -> Column:
    """Member of an object as a variant; SQL NULL when absent."""
    return F.variant_get(document, f"$.{name}", "variant")


def kind(value: Column) -> Column:
    """Type of a variant as text; NULL for an absent member, VOID for a JSON null."""
    return F.schema_of_variant(value)


# The tests below take the kind of a value, so that it is worked out once per value.


def is_object(kind_of: Column) -> Column:
    return F.coalesce(kind_of.startswith("OBJECT"), F.lit(False))


def is_text(kind_of: Column) -> Column:
    return F.coalesce(kind_of == "STRING", F.lit(False))


def is_none(kind_of: Column) -> Column:
    """True for an absent member and for a JSON null."""
    return F.coalesce(kind_of == "VOID", F.lit(True))


def is_boolean(kind_of: Column) -> Column:
    return F.coalesce(kind_of == "BOOLEAN", F.lit(False))


def filled(text: Column, kind_of: Column) -> Column:
    """The text of a member, NULL unless it is a JSON text and not blank."""
    return F.when(is_text(kind_of) & ~is_blank(text), text)


def int32(digits: Column, kind_of: Column) -> Column:
    """A JSON number in the 32-bit range with its fraction cut off, else NULL.

    ``digits`` is the number as it was written.
    """
    number = digits.try_cast("double")
    in_range = number.between(float(INT_MIN), float(INT_MAX))
    return F.when(kind_of == "BIGINT", digits.try_cast("int")).when(
        kind_of.rlike(_NUMBER_TYPE) & in_range, number.cast("int")
    )


def int64(digits: Column, kind_of: Column) -> Column:
    """A JSON number in the 64-bit range with its fraction cut off, else NULL."""
    return F.when(kind_of == "BIGINT", digits.try_cast("bigint")).when(
        kind_of.rlike(_NUMBER_TYPE), digits.try_cast("double").try_cast("bigint")
    )


def all_text_values(value: Column) -> Column:
    """True when every member of an object is text."""
    members = F.map_values(value.try_cast("map<string,variant>"))
    return F.forall(members, lambda member: is_text(kind(member)))


def first_other_key(text: Column, document: Column, allowed: Column) -> Column:
    """First key in document order that is not allowed, else NULL.

    The sorted keys of the variant decide first; only a failing document is read a
    second time for the order of its keys.
    """
    keys = F.map_keys(document.try_cast("map<string,variant>"))
    in_order = F.filter(
        F.json_object_keys(text), lambda k: ~F.array_contains(allowed, k)
    )
    return F.when(
        F.size(F.array_except(keys, allowed)) > 0, F.get(in_order, F.lit(0))
    )
