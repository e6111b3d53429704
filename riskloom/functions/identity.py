"""Stable identities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def name_uuid(name: Column) -> Column:
    """Name-based UUID, version 3, of UTF-8 text without a namespace."""
    h = F.md5(name.cast("binary"))
    # Variant bits: the leading two bits of the 17th hex digit become "10".
    digit = (F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3)).bitwiseOR(8)
    return F.concat(
        F.substring(h, 1, 8),
        F.lit("-"),
        F.substring(h, 9, 4),
        F.lit("-3"),
        F.substring(h, 14, 3),
        F.lit("-"),
        F.lower(F.hex(digit)),
        F.substring(h, 18, 3),
        F.lit("-"),
        F.substring(h, 21, 12),
    )


def signal_id(event_id: Column, rule_id: Column) -> Column:
    """The same event and rule give the same id in every replay."""
    return name_uuid(F.concat(event_id, F.lit(":"), rule_id))
