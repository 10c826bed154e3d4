"""Event-time helpers.

The reference keeps time as epoch milliseconds in a ``Long``.  Spark's
watermarks and windows need a ``TIMESTAMP`` column, so these helpers
convert both ways.  Parquet timestamps without a zone arrive as
``TIMESTAMP_NTZ``; they are cast to ``TIMESTAMP`` (session zone UTC) first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values from the reference: the watermark trails event time by
# 3000 ms; sliding windows are 2000 ms long and slide by 1000 ms; the
# pairing timeout is 10000 ms.
WATERMARK_LAG = "3 seconds"
WINDOW_SIZE = "2 seconds"
WINDOW_SLIDE = "1 second"
TIMEOUT_MS = 10000


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_timestamp(c) -> Column:
    """Any timestamp (NTZ or LTZ) as ``TIMESTAMP``."""
    return _col(c).cast("timestamp")


def epoch_us(c) -> Column:
    """Microseconds since the epoch of a timestamp column."""
    return F.unix_micros(as_timestamp(c))


def epoch_ms(c) -> Column:
    """Milliseconds since the epoch (floors, like integer division)."""
    return F.unix_millis(as_timestamp(c))


def from_epoch_ms(c) -> Column:
    """An epoch-ms ``Long`` field as an event-time timestamp."""
    return F.timestamp_millis(_col(c))


def with_event_time(df: DataFrame, millis_col: str, out: str = "event_time",
                    lag: str = WATERMARK_LAG) -> DataFrame:
    """Stamp rows with their own event time; watermark = max seen - lag."""
    return df.withColumn(out, from_epoch_ms(millis_col)).withWatermark(out, lag)


def with_arrival_time(df: DataFrame, out: str = "arrival_time",
                      lag: str = WATERMARK_LAG) -> DataFrame:
    """Stamp rows with the time they are processed.

    ``current_timestamp()`` is fixed per micro-batch, so all rows of one
    batch share a stamp; the watermark trails it by ``lag``.
    """
    return df.withColumn(out, F.current_timestamp()).withWatermark(out, lag)
