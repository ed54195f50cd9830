"""Time rules of the source tables.

Source text in ISO form is a true UTC instant. Source epoch milliseconds are a local
wall clock stored as if it were UTC. Days are calendar days of the local zone.
The session time zone must be UTC (see ``waybill.session``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "Asia/Shanghai"
# A UTC-aligned day window has to open at local midnight, which is 16:00 UTC.
DAY_START = "16 hours"


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def iso_instant(text) -> Column:
    """``2023-01-10T14:30:00Z`` (the Z may be missing) to a timestamp; bad text to null."""
    text = _col(text)
    return F.concat(F.rtrim(text, F.lit("Z")), F.lit("Z")).try_cast("timestamp")


def local_millis_instant(millis, zone: str = ZONE) -> Column:
    """Epoch milliseconds of a local wall clock (number or text) to a timestamp."""
    return F.to_utc_timestamp(F.timestamp_millis(_col(millis).try_cast("bigint")), zone)


def millis_instant(millis) -> Column:
    """True epoch milliseconds to a timestamp."""
    return F.timestamp_millis(_col(millis).try_cast("bigint"))


def to_millis(ts) -> Column:
    return F.unix_millis(_col(ts))


def local_text(ts, zone: str = ZONE) -> Column:
    """Instant to local ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(F.from_utc_timestamp(_col(ts), zone), "yyyy-MM-dd HH:mm:ss")


def local_date(ts, zone: str = ZONE) -> Column:
    """Instant to local ``yyyy-MM-dd``."""
    return F.date_format(F.from_utc_timestamp(_col(ts), zone), "yyyy-MM-dd")


def local_compact_date(ts, zone: str = ZONE) -> Column:
    """Instant to local ``yyyyMMdd``, the form used in partition names."""
    return F.date_format(F.from_utc_timestamp(_col(ts), zone), "yyyyMMdd")


def date_instant(text, zone: str = ZONE) -> Column:
    """Local ``yyyy-MM-dd`` (time optional) to the instant it starts."""
    return F.to_utc_timestamp(_col(text).try_cast("timestamp"), zone)


def day_window(ts="ts") -> Column:
    """Local calendar day as an event-time window, for batch and streaming alike."""
    return F.window(_col(ts), "1 day", startTime=DAY_START)


def duration_millis(start, end) -> Column:
    return F.unix_millis(_col(end)) - F.unix_millis(_col(start))


def processing_millis() -> Column:
    return F.unix_millis(F.current_timestamp())


def in_nanoseconds(ts) -> Column:
    """An event time that pandas can hold: earlier ones at its start, none for later ones."""
    ts = _col(ts)
    first, last = F.lit("1678-01-01T00:00:00Z").cast("timestamp"), F.lit("2262-01-01T00:00:00Z").cast("timestamp")
    return F.when(ts < last, F.greatest(ts, first))
