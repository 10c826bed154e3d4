"""Sliding event-time window assignment (T4) and the windowed join.

The reference joins two streams on a key inside sliding event-time
windows and emits each matching pair once per window the two rows share.
Windows are epoch-aligned and half-open, as Spark's ``window()``.

*Batch* (``pane_join``): rows aren't multiplied by their windows.  Two rows
share a window only if they are less than ``size`` apart, so both sides are
cut into coarse panes of ``COARSE`` sizes; the left row is in one, the right
one in those within reach (1.5 on average), and an equi-join on (key, pane)
meets each pair once.  How many windows a pair shares follows from its two
times, and each is a row of the result, after the join.  Rows of a hot key
spread over its panes; a hot (key, pane) is split by adaptive execution.

*Streams* (``salted_window_join``): an inner equi-join on (key, window),
whose state Spark drops once the watermark passes a window.  Adaptive
execution doesn't act on streams, so one side is dealt to salts and the other
repeated for each: a hot (key, window) is as many tasks as there are salts.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddy.functions.time import epoch_us

# Length of a coarse pane in window sizes.
COARSE = 4
# Tasks over which one key's window is spread in a stream.
STREAM_SALTS = 4


def assign_windows(df: DataFrame, time_col: str, size: str, slide: str,
                   out: str = "window") -> DataFrame:
    """T4: one row per (row, sliding window containing it)."""
    return df.withColumn(out, F.window(time_col, size, slide))


def window_start_us(window_col: str = "window"):
    return epoch_us(F.col(f"{window_col}.start"))


def _micros(interval: str) -> int:
    """Microseconds of an interval of fixed length (``2 hours``, ``1 second``)."""
    return int(pd.Timedelta(interval) // pd.Timedelta(microseconds=1))


def _floor_div(x: Column, width: int) -> Column:
    """floor(x / width) of whole numbers, below zero too."""
    w = F.lit(width)
    return F.call_function("div", x - F.pmod(x, w), w)


def pane_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
              left_us: str, right_us: str, size: str, slide: str, out: str = "window_start_us") -> DataFrame:
    """J1 in batch: pairs of a key in shared windows, one row for each shared window.

    Times are microseconds (``epoch_us``); a row without one is in no window.
    ``left`` and ``right`` are aliased ``l`` and ``r``; ``out`` is the
    window's start.
    """
    size_us, slide_us = _micros(size), _micros(slide)
    width = COARSE * size_us
    pane = _floor_div(F.col(left_us), width).alias("_pane")
    lw = left.select("*", pane).alias("l")
    panes = F.sequence(_floor_div(F.col(right_us) - size_us, width), _floor_div(F.col(right_us) + size_us, width))
    rw = right.where(F.col(right_us).isNotNull()).select("*", F.explode(panes).alias("_pane")).alias("r")
    lt, rt = F.col(f"l.{left_us}"), F.col(f"r.{right_us}")
    first = _floor_div(F.greatest(lt, rt) - size_us, slide_us) + 1
    last = _floor_div(F.least(lt, rt), slide_us)
    pairs = lw.join(rw, (F.col(f"l.{left_key}") == F.col(f"r.{right_key}"))
                    & (F.col("l._pane") == F.col("r._pane")) & (first <= last))
    return pairs.withColumn("_shared", F.explode(F.sequence(first, last))).withColumn(out, F.col("_shared") * F.lit(slide_us))


def salted_window_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                       left_time: str, right_time: str, size: str, slide: str,
                       deal_by: str, salts: int = STREAM_SALTS) -> DataFrame:
    """J1 on streams: inner join of ``left`` and ``right`` on key inside shared windows.

    The left rows are dealt to ``salts`` by a hash of ``deal_by``, the right
    ones repeated for each.  Both inputs are aliased ``l`` and ``r``; the result carries both
    windows' common value as ``l.window``.  Callers select what they need.
    """
    lw = assign_windows(left, left_time, size, slide) \
        .withColumn("_salt", F.pmod(F.xxhash64(deal_by), F.lit(salts)).cast("int")).alias("l")
    rw = assign_windows(right, right_time, size, slide) \
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).alias("r")
    cond = ((F.col(f"l.{left_key}") == F.col(f"r.{right_key}")) & (F.col("l._salt") == F.col("r._salt"))
            & (F.col("l.window") == F.col("r.window")))
    return lw.join(rw, cond, "inner")


def nav_holder_join(nav: DataFrame, own: DataFrame, size: str, slide: str,
                    nav_time: str = "ts", own_time: str = "ts", salts: int = STREAM_SALTS) -> DataFrame:
    """J1 as the reference wires it: NAV prices x holders of that NAV.

    Output per shared window: (nav_id, user_id, unit_value) - the
    reference's ``(nav._1, users._1, nav._2)`` - plus the window start and
    both sequence numbers so every output row is identifiable.  Prices are
    dealt to ``salts`` if the inputs are streams.
    """
    if nav.isStreaming or own.isStreaming:
        j = salted_window_join(nav, own, "nav_id", "nav_id", nav_time, own_time, size, slide, "seq", salts)
        start = window_start_us("l.window")
    else:
        prices = nav.select("nav_id", "unit_value", "seq", epoch_us(nav_time).alias("_us"))
        holders = own.select("nav_id", "user_id", "seq", epoch_us(own_time).alias("_us"))
        j = pane_join(prices, holders, "nav_id", "nav_id", "_us", "_us", size, slide)
        start = F.col("window_start_us")
    return j.select(F.col("l.nav_id").alias("nav_id"),
                    F.col("r.user_id").alias("user_id"),
                    F.col("l.unit_value").alias("unit_value"),
                    start.alias("window_start_us"),
                    F.col("l.seq").alias("nav_seq"),
                    F.col("r.seq").alias("own_seq"))
