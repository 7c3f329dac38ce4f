"""Time column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Time patterns of the behaviors files, 12-hour tried first.
TIME_PATTERNS = ("M/d/yyyy h:mm:ss a", "M/d/yyyy H:mm:ss")


def parse_time(raw: Column) -> Column:
    """Raw time string to TIMESTAMP_NTZ, null where no pattern fits.

    The text is read as UTC and moved onto a zone-free epoch, so the session zone has no effect.
    """
    text = F.concat(raw, F.lit(" Z"))
    instant = F.coalesce(*[F.try_to_timestamp(text, F.lit(f"{p} XXX")) for p in TIME_PATTERNS])
    seconds = (F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1000000)).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def days(n: float) -> Column:
    """An interval of `n` days."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(n * 86400).cast("decimal(18,6)"))


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 of a zone-free timestamp, as double."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, ts) / F.lit(1e6)
