"""Crawl times as text to timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_time(text: Column, zone: str | None = None) -> Column:
    """ISO text to a timestamp; text that is no time becomes null.

    An offset in the text decides the instant. Text without one is local time in
    `zone`, or in the session time zone when no zone is given.
    """
    parsed = F.try_to_timestamp(text)
    if zone is None:
        return parsed
    has_offset = text.rlike(r"([Zz]|[+-][0-9]{2}:?[0-9]{2})\s*$") & text.contains(":")
    local = F.convert_timezone(F.lit(zone), F.current_timezone(), text.try_cast("timestamp_ntz")).cast("timestamp")
    return F.when(has_offset, parsed).otherwise(local)
