"""Calendar dates from and to text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wall_clock_date(timestamp: Column | str) -> Column:
    """Date as written in a timestamp text, whatever its offset; NULL if unreadable."""
    timestamp = F.col(timestamp) if isinstance(timestamp, str) else timestamp
    return F.to_date(timestamp.try_cast("timestamp_ntz"))


def date_text(day: Column | str, pattern: str) -> Column:
    return F.date_format(day, pattern)


def http_date(day: Column | str) -> Column:
    """Midnight of ``day`` in the date format of HTTP headers."""
    return F.date_format(day, "EEE, dd MMM yyyy '00:00:00 GMT'")
