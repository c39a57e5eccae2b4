"""Epoch-millisecond dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from layerframe.functions import variants as V

# Field types whose values are treated as dates, and the first and
# last epoch millisecond of the years 1 to 9999.
DATE_TYPES = ["esriFieldTypeDate", "esriFieldTypeTimeOnly", "esriFieldTypeDateOnly"]
FIRST_MS = -62135596800000
LAST_MS = 253402300799999
DAY_MS = 86_400_000


def _two(value: Column) -> Column:
    return F.lpad(value.cast("string"), 2, "0")


def epoch_ms_to_iso(ms: Column) -> Column:
    """ISO-8601 UTC text of a BIGINT; null outside the years 1 to 9999.

    Plain date and integer arithmetic, so the session time zone has no say.
    """
    rest = F.pmod(ms, F.lit(DAY_MS))
    day = (ms - rest) / F.lit(DAY_MS)
    date = F.date_add(F.lit("1970-01-01").cast("date"), day.cast("int")).cast("string")
    hours = F.floor(rest / 3_600_000)
    minutes = F.floor(F.pmod(rest, F.lit(3_600_000)) / 60_000)
    seconds = F.floor(F.pmod(rest, F.lit(60_000)) / 1000)
    millis = F.pmod(rest, F.lit(1000))
    fraction = F.when(millis == 0, "").otherwise(
        F.concat(F.lit("."), F.lpad(millis.cast("string"), 3, "0"), F.lit("000"))
    )
    iso = F.concat(
        date, F.lit("T"), _two(hours), F.lit(":"), _two(minutes), F.lit(":"), _two(seconds),
        fraction, F.lit("+00:00"),
    )
    return F.when(ms.between(FIRST_MS, LAST_MS), iso)


def normalize_date(value: Column) -> Column:
    """ISO text of a VARIANT epoch value; anything unconvertible stays as it is."""
    return F.coalesce(V.let(V.as_int(value), epoch_ms_to_iso), V.text(value))


def to_timestamp(ms: Column) -> Column:
    """TIMESTAMP of a BIGINT, null outside the years 1 to 9999."""
    return F.when(ms.between(FIRST_MS, LAST_MS), F.timestamp_millis(ms))


def is_date_type(esri_type: Column) -> Column:
    return esri_type.isin(DATE_TYPES)
