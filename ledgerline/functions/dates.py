"""Calendar expressions that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UTC_NAMES = {"UTC", "Etc/UTC", "Z", "GMT", "+00:00"}


def epoch_date(seconds: Column, zone: str = "UTC") -> Column:
    """Calendar date of an epoch second in ``zone``.

    UTC is integer arithmetic only; other zones go through the time zone
    database, because a day there need not start at a multiple of 86400.
    """
    if zone in _UTC_NAMES:
        return F.date_from_unix_date(F.floor(seconds / F.lit(86400)).cast("int"))
    epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    wall_clock = F.convert_timezone(
        F.lit("UTC"), F.lit(zone), epoch + F.make_dt_interval(secs=seconds)
    )
    return wall_clock.cast("date")


def text_date(text: Column) -> Column:
    """ISO text as a date; NULL where the text is not a date."""
    return F.try_to_date(F.trim(text), "yyyy-MM-dd")
