"""Instants: strict ISO-8601 reading, canonical text, epoch arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DATE = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}"
_TIME = r"([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]"
_OFFSET = r"[+-](0[0-9]|1[0-7]):[0-5][0-9](:[0-5][0-9])?|[+-]18:00(:00)?"
# What producers write: capital letters and at least one digit after the point.
_USUAL = rf"{_DATE}T{_TIME}(\.[0-9]{{1,9}})?(Z|{_OFFSET})\z"
# Everything an instant may be, with the end of the day and the leap second.
_RARE = (
    rf"{_DATE}[Tt]({_TIME}(\.[0-9]{{0,9}})?|23:59:60(\.[0-9]{{0,9}})?|24:00:00(\.0{{0,9}})?)"
    rf"([Zz]|{_OFFSET})\z"
)


def parse_instant(text: Column) -> Column:
    """Timestamp of a full ISO instant, NULL for everything else.

    Spark's own cast also takes dates, blanks between date and time, and zone names;
    the patterns in front exclude those.
    """
    plain = F.regexp_replace(F.upper(text), r"\.(?=[Z+-])", "")
    plain = F.regexp_replace(plain, "T23:59:60", "T23:59:59")
    same_day = F.regexp_replace(plain, "T24:00:00", "T00:00:00").try_cast("timestamp")
    rare = F.when(
        plain.contains("T24:00:00"), same_day + F.expr("INTERVAL 24 HOURS")
    ).otherwise(plain.try_cast("timestamp"))
    return F.when(text.rlike(_USUAL), text.try_cast("timestamp")).when(
        text.rlike(_RARE), rare
    )


def instant_text(timestamp: Column) -> Column:
    """ISO text in UTC with 0, 3 or 6 fraction digits, whichever is shortest.

    The session time zone must be UTC (see ``session.prepare``).
    """
    micros = F.pmod(F.unix_micros(timestamp), F.lit(1_000_000))
    seconds = F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss")
    digits = F.lpad(micros.cast("string"), 6, "0")
    fraction = (
        F.when(micros == 0, F.lit(""))
        .when(micros % 1000 == 0, F.concat(F.lit("."), F.substring(digits, 1, 3)))
        .otherwise(F.concat(F.lit("."), digits))
    )
    return F.concat(seconds, fraction, F.lit("Z"))


def micros_to_millis(micros: Column) -> Column:
    """Epoch milliseconds, rounded down also before 1970."""
    whole = micros - F.pmod(micros, F.lit(1000))
    return F.call_function("div", whole, F.lit(1000))
