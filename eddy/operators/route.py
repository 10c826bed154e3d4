"""Routing by predicate (P6-P8) and one-source fan-out.

The reference filters one Kafka stream into two branches: even ids go
out as they are, odd ids go out keyed by ``id / 2``.  Each branch is a
filter plus a projection, so it fuses into the scan's codegen stage.

Null ids: ``null % 2`` is null, so a null id leaves *both* branches (the
reference's unboxing would have called it even).  ``dead_letters`` gives
those rows, and the routing job writes them to an output of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def _id(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_even(id_col) -> Column:
    return _id(id_col) % 2 == 0


def is_odd(id_col) -> Column:
    return _id(id_col) % 2 != 0


def route_even(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Records with an even id."""
    return df.where(is_even(id_col))


def route_odd_keyed(df: DataFrame, id_col: str = "id", key: str = "key",
                    nest: str | None = None) -> DataFrame:
    """P7 + P8: records with an odd id, keyed by ``id div 2`` (truncates to zero).

    ``nest`` packs the record into one struct column of that name (the
    reference's ``(key, record)`` tuple); otherwise the fields stay flat.
    """
    odd = df.where(is_odd(id_col))
    k = F.expr(f"`{id_col}` div 2").alias(key)
    if nest:
        return odd.select(k, F.struct(*[F.col(c) for c in df.columns]).alias(nest))
    return odd.select(k, *df.columns)


def dead_letters(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows neither branch takes (null id)."""
    return df.where(_id(id_col).isNull())


Writer = Callable[[DataFrame], None]

BRANCHES = ("even", "odd", "dead", "bad")


def classify(rows: DataFrame, id_col: str = "id") -> DataFrame:
    """``rows`` with the ``branch`` of each: even, odd, dead (no id) or bad (no ``record``).

    ``rows`` have the decoded ``record`` struct, null where there is none.
    """
    i = F.col(f"record.{id_col}")
    branch = F.when(F.col("record").isNull(), "bad").when(i.isNull(), "dead").when(is_even(i), "even").otherwise("odd")
    return rows.withColumn("branch", branch)


def write_branches(rows: DataFrame, writers: dict[str, Writer | None], id_col: str = "id",
                   storage: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> dict[str, int]:
    """U3 in one pass: classify a micro-batch once, write every branch from that copy.

    Even and dead records go out as they are, odd ones as (key, record), bad
    rows without their record.  A branch without a writer is left out.
    Returns the rows of the ``input`` and of each branch, counted by the same
    pass that classified them.
    """
    seen = Observation()
    counts = [F.count_if(F.col("branch") == b).alias(b) for b in BRANCHES]
    classified = classify(rows, id_col).observe(seen, F.count(F.lit(1)).alias("input"), *counts).persist(storage)
    try:
        def of(branch: str) -> DataFrame:
            mine = classified.where(F.col("branch") == branch)
            if branch == "bad":
                return mine.drop("record", "branch")
            if branch == "odd":
                return mine.select(F.expr(f"record.`{id_col}` div 2").alias("key"), "record")
            return mine.select("record.*")
        for branch, write in writers.items():
            if write is not None:
                write(of(branch))
        return {k: int(v) for k, v in seen.get.items()}
    finally:
        classified.unpersist()


def fan_out(batch: DataFrame, branches: dict[str, tuple[Callable[[DataFrame], DataFrame], Writer]],
            storage: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> list[str]:
    """Write several branches of one micro-batch, reading the source once.

    Meant for ``foreachBatch``: the micro-batch is bounded, so it is
    persisted (memory, spilling to disk), every branch is written from
    the persisted copy, and it is released.  Returns the branches written.
    """
    batch.persist(storage)
    try:
        for transform, write in branches.values():
            write(transform(batch))
        return list(branches)
    finally:
        batch.unpersist()
