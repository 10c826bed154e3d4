"""Merging differently typed streams.

The reference connects two typed streams and maps each side with its own
function to a common type.  In Spark that is two projections and a
``unionByName``: no shuffle, and a later ``groupBy(key)`` over the union
is a single exchange (the reference keys each side, then the merge, again).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The common transaction shape of the reference.
TRANSACTION_FIELDS = ("trans_id", "timestamp", "amount")


def to_transaction(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Narrow a debit or credit record to (trans_id, timestamp, amount)."""
    return df.select(*TRANSACTION_FIELDS, *extra)


def union_transactions(debit: DataFrame, credit: DataFrame,
                       extra: tuple[str, ...] = (), side_col: str | None = None) -> DataFrame:
    """Debit and credit records as one transaction stream.

    ``extra`` keeps more common columns (e.g. ``ts_us``, ``event_id``);
    ``side_col`` adds the origin ("debit"/"credit") as a column.
    """
    d = to_transaction(debit, extra)
    c = to_transaction(credit, extra)
    if side_col:
        d = d.withColumn(side_col, F.lit("debit"))
        c = c.withColumn(side_col, F.lit("credit"))
    return d.unionByName(c)


def tag_union(sides: dict[str, DataFrame], tag_col: str = "kind") -> DataFrame:
    """Several inputs with a column naming the input, for shared keyed state.

    Columns missing from a side are filled with nulls.
    """
    out = None
    for name, df in sides.items():
        t = df.withColumn(tag_col, F.lit(name))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out
