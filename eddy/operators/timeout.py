"""Transactions whose partner does not arrive in time (J4), batch forms.

Input: one merged transaction stream with a key, an event time, a
tie-break id and a payload.  Arrival order is ``(time, id)``.  Three
readings of the reference's operator:

``toggle`` (as coded): per key, an arrival opens the key when it is
closed and closes it when it is open; every opening arms a timer at
``time + ttl`` that is never cancelled; a firing timer emits whatever is
open at that moment.  So for every opening arrival (odd arrival number
``n``) take the last arrival ``m`` at or before ``n.time + ttl``; emit ``m``
when ``m`` is itself an opening.

``clean`` (as intended): a match cancels the timer and an emit clears the
key.  Arrivals split into chains wherever the gap to the previous arrival
exceeds ``ttl``; an odd-length chain leaves its last arrival unmatched.

``sided``: an arrival is unmatched when no arrival *of the other side*
with the same key lies within ``ttl`` of it, before or after.

All three are prefix scans per key (``scan.py``) plus grouped aggregates;
no pairs are formed.  Blocks are cut at sampled ``(time, id)``, as an
expression of the plan; a key's burst, or rows of one time, spread over
blocks like any other rows.  ``blocks`` sets their number (by default it
follows from the number of rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddy.operators.scan import Prefix, by_splitters, order_sample, prefix_scan, splitters

MODES = ("toggle", "clean", "sided")


def timeout_toggle(tx: DataFrame, ttl: int, key: str = "trans_id", time_col: str = "ts_us",
                   id_col: str = "event_id", payload: tuple[str, ...] = ("amount",),
                   blocks: int | None = None) -> DataFrame:
    """J4 as coded (see module doc).  One output row per firing timer."""
    tx = tx.select(key, time_col, id_col, *payload)
    n_blocks, sample = order_sample(tx, [time_col, id_col], blocks)
    base = by_splitters(tx, [key], [time_col, id_col], bounds=splitters(sample, n_blocks))
    numbered = prefix_scan(base, [time_col, id_col], [Prefix("_n", F.lit(1).cast("bigint"))])
    # an arrival carries its record; an opening also gives a probe at its deadline
    rec = F.struct(F.col(time_col).alias("t"), F.col(id_col).alias("i"),
                   F.col("_n").alias("n"), *[F.col(p) for p in payload])
    none = F.when(F.lit(False), rec)
    arrival = F.struct(F.col(time_col).alias("at"), F.lit(0).alias("kind"), rec.alias("rec"))
    probe = F.struct((F.col(time_col) + F.lit(int(ttl))).alias("at"), F.lit(1).alias("kind"), none.alias("rec"))
    both = F.when(F.col("_n") % 2 == 1, F.array(arrival, probe)).otherwise(F.array(arrival))
    events = numbered.select(key, F.col(id_col).alias("_id"), F.explode(both).alias("e")) \
        .select(key, "_id", F.col("e.at").alias("_at"), F.col("e.kind").alias("_kind"), F.col("e.rec").alias("_rec"))
    order = ["_at", "_kind", "_id"]
    # arrivals and deadlines: the sample has both, as the rows do
    both_kinds = [(t, 0, i) for t, i in sample] + [(t if t is None else t + int(ttl), 1, i) for t, i in sample]
    scanned = prefix_scan(by_splitters(events, [key], order, bounds=splitters(both_kinds, n_blocks)), order,
                          [Prefix("_m", F.col("_rec"), op="max")])
    fired = scanned.where((F.col("_kind") == 1) & (F.col("_m.n") % 2 == 1))
    return fired.select(key, F.col("_m.t").alias(time_col), F.col("_m.i").alias(id_col),
                        *[F.col(f"_m.{p}").alias(p) for p in payload])


def timeout_clean(tx: DataFrame, ttl: int, key: str = "trans_id", time_col: str = "ts_us",
                  id_col: str = "event_id", payload: tuple[str, ...] = ("amount",),
                  blocks: int | None = None) -> DataFrame:
    """J4 as intended: the last arrival of every odd-length chain."""
    order = [time_col, id_col]
    base = by_splitters(tx.select(key, time_col, id_col, *payload), [key], order, blocks)
    prev = prefix_scan(base, order, [Prefix("_prev", F.col(time_col), op="max", inclusive=False)])
    gap = (F.col(time_col) - F.col("_prev") > F.lit(int(ttl))).cast("bigint")
    flagged = prev.withColumn("_g", F.coalesce(gap, F.lit(0).cast("bigint")))
    chained = prefix_scan(flagged, order, [Prefix("_c", F.col("_g"))])
    rec = F.struct(F.col(time_col).alias("t"), F.col(id_col).alias("i"),
                   *[F.col(p) for p in payload])
    chains = chained.groupBy(key, "_c").agg(F.count(F.lit(1)).alias("_k"),
                                           F.max(rec).alias("_last"))
    return chains.where(F.col("_k") % 2 == 1).select(
        key, F.col("_last.t").alias(time_col), F.col("_last.i").alias(id_col),
        *[F.col(f"_last.{p}").alias(p) for p in payload])


def timeout_sided(tx: DataFrame, ttl: int, side_col: str = "side", key: str = "trans_id",
                  time_col: str = "ts_us", id_col: str = "event_id",
                  payload: tuple[str, ...] = ("amount",), sides=("debit", "credit"),
                  blocks: int | None = None) -> DataFrame:
    """J4 by side: arrivals with no other-side partner within +-ttl."""
    a, b = sides
    order = [time_col, id_col]
    base = by_splitters(tx.select(key, time_col, id_col, side_col, *payload), [key], order, blocks)
    t = F.col(time_col)
    is_a, is_b = F.col(side_col) == a, F.col(side_col) == b
    fwd = prefix_scan(base, order, [Prefix("_pa", F.when(is_a, t), op="max"),
                                    Prefix("_pb", F.when(is_b, t), op="max")])
    bwd = prefix_scan(fwd, order, [Prefix("_na", F.when(is_a, t), op="min"),
                                   Prefix("_nb", F.when(is_b, t), op="min")], backward=True)
    prev_other = F.when(is_a, F.col("_pb")).otherwise(F.col("_pa"))
    next_other = F.when(is_a, F.col("_nb")).otherwise(F.col("_na"))
    ttl_c = F.lit(int(ttl))
    matched = (F.coalesce(t - prev_other <= ttl_c, F.lit(False))
               | F.coalesce(next_other - t <= ttl_c, F.lit(False)))
    return bwd.where(~matched).select(key, time_col, id_col, side_col, *payload)


def timeouts(tx: DataFrame, ttl: int, mode: str = "toggle", **kw) -> DataFrame:
    """Dispatch on ``mode`` (one of ``MODES``)."""
    if mode == "toggle":
        return timeout_toggle(tx, ttl, **kw)
    if mode == "clean":
        return timeout_clean(tx, ttl, **kw)
    if mode == "sided":
        return timeout_sided(tx, ttl, **kw)
    raise ValueError(f"mode must be one of {MODES}: {mode}")
