"""Keyed upserts (K5-K8) and the projections that feed them.

The reference inserts every record into a table keyed by ``(id, name)``;
a later insert of the same key replaces the row (last write wins).  Its
annotated-mapper variant skips null fields, so a null never overwrites a
stored value.  As batch plans:

* ``upsert_last_write``: ``max_by(column, order)`` per key and column, or
  the latest order per key and the rows it names;
* ``upsert_ignore_nulls``: per column, the latest *non-null* value.

Both are grouped aggregates with map-side partial aggregation, so a hot
key is reduced on every mapper before the one shuffle.

``UpsertLog`` is a streaming sink: each micro-batch appends its own
pre-reduced rows under ``log/_batch=<id>`` (overwriting that folder on a
replay, so a retried batch is idempotent), and the table is the upsert
over all batches.  A micro-batch never rewrites the whole table;
``compact`` reduces the batches so far into a base, from time to time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# The three table shapes of the reference's table-sink job.
TUPLE_ORDER = ("name", "id", "age", "title")
EMPLOYEE_FIELDS = {"id": "eId", "name": "eName", "title": "eTitle", "age": "eAge"}
TABLE_KEY = ("id", "name")
TABLE_VALUES = ("age", "title")


def bind_positional(df: DataFrame, source_order: Sequence[str],
                    target_order: Sequence[str]) -> DataFrame:
    """Bind fields by position, as ``INSERT .. (cols) VALUES (?, ..)``.

    ``source_order[i]`` fills ``target_order[i]``; a length mismatch raises,
    as an unbound placeholder would.
    """
    if len(source_order) != len(target_order):
        raise ValueError(f"{len(source_order)} values for {len(target_order)} columns")
    return df.select(*[F.col(s).alias(t) for s, t in zip(source_order, target_order)])


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """K7/P10: field -> column mapping (the column annotations of a bean)."""
    return df.select(*[F.col(s).alias(t) for s, t in mapping.items()])


def _order(order: Sequence[str] | str) -> Column:
    order = [order] if isinstance(order, str) else list(order)
    return F.struct(*[F.col(o) for o in order]) if len(order) > 1 else F.col(order[0])


# Types that a hash aggregate can keep in its buffer.
_FIXED = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz")


def upsert_last_write(df: DataFrame, keys: Sequence[str], order: Sequence[str] | str,
                      values: Sequence[str]) -> DataFrame:
    """K8: the latest row per key; ``order`` must not tie within a key.

    With a single order column and values of fixed width, one
    ``max_by(value, order)`` per column: a hash aggregate, as every buffer is
    of fixed width.  A text or nested value would force a sort aggregate of
    whole rows; then the order alone is aggregated per key, by hash, and the
    rows it names are fetched by a semi-join on (keys, order).  A row written
    twice (same key, order and values) is one row.
    """
    kinds = dict(df.dtypes)
    one = [order] if isinstance(order, str) else list(order)
    if len(one) == 1 and kinds[one[0]] in _FIXED and any(kinds[v] not in _FIXED for v in values):
        latest = df.groupBy(*keys).agg(F.max(one[0]).alias("_at"))
        latest = latest.select(*[F.col(k).alias(f"_key_{k}") for k in keys], "_at")
        same = F.col(one[0]) == F.col("_at")
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
        rows = df.select(*dict.fromkeys([*keys, *one, *values])).join(latest, same, "left_semi")
        return rows.distinct().select(*keys, *values)
    o = _order(order)
    agg = df.groupBy(*keys).agg(*[F.max_by(F.col(v), o).alias(v) for v in values])
    return agg.select(*keys, *values)


def upsert_ignore_nulls(df: DataFrame, keys: Sequence[str], order: Sequence[str] | str,
                        values: Sequence[str]) -> DataFrame:
    """K7: per key and column, the latest non-null value (null if none).

    ``max_by`` skips rows whose ordering is null, so ordering each column
    by ``order`` only where the column is set gives its latest non-null
    value.
    """
    o = _order(order)
    aggs = [F.max_by(F.col(v), F.when(F.col(v).isNotNull(), o)).alias(v) for v in values]
    return df.groupBy(*keys).agg(*aggs).select(*keys, *values)


class UpsertLog:
    """Streaming upsert sink as an append-only log of reduced micro-batches.

    Use ``log.write_batch`` as the ``foreachBatch`` function and
    ``log.read(spark)`` for the current table.  ``order`` (columns) must
    not tie between two writes of a key in one micro-batch.

    A column's latest write is kept with the place it has in the order
    (``_at_<column>``), so batches, and a base that ``compact`` made of
    them, reduce further in any grouping.
    """

    BATCH = "_batch"

    def __init__(self, path: str, keys: Sequence[str], order: Sequence[str] | str,
                 values: Sequence[str], ignore_nulls: bool = False):
        self.log, self.base = f"{path}/log", f"{path}/base"
        self.keys, self.values = list(keys), list(values)
        self.order = [order] if isinstance(order, str) else list(order)
        self.ignore_nulls = ignore_nulls

    def _reduce(self, df: DataFrame) -> DataFrame:
        """The latest value of each column, and its place ``_at_<column>``."""
        aggs = []
        for v in self.values:
            at = F.col(f"_at_{v}")
            at = F.when(F.col(v).isNotNull(), at) if self.ignore_nulls else at
            aggs += [F.max_by(F.col(v), at).alias(v), F.max(at).alias(f"_at_{v}")]
        return df.groupBy(*self.keys).agg(*aggs)

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        """Append micro-batch ``batch_id``, or write it anew."""
        place = F.struct(F.lit(int(batch_id)).cast("bigint").alias("batch"), *self.order)
        placed = df.select(*self.keys, *self.values, *[place.alias(f"_at_{v}") for v in self.values])
        (self._reduce(placed).withColumn(self.BATCH, F.lit(int(batch_id)).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(self.BATCH).parquet(self.log))

    def _bases(self, spark: SparkSession) -> tuple[DataFrame | None, int]:
        """The newest base and the last batch in it (-1: no base yet)."""
        try:
            bases = spark.read.parquet(self.base)
        except AnalysisException:            # nothing compacted so far
            return None, -1
        upto = bases.agg(F.max(self.BATCH).alias("b")).first()["b"]
        return bases.where(F.col(self.BATCH) == F.lit(upto)), int(upto)

    def _rows(self, spark: SparkSession, last: int | None = None) -> DataFrame:
        base, upto = self._bases(spark)
        log = spark.read.parquet(self.log).where(F.col(self.BATCH) > F.lit(upto))
        if last is not None:
            log = log.where(F.col(self.BATCH) <= F.lit(int(last)))
        return log if base is None else base.unionByName(log)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._reduce(self._rows(spark)).select(*self.keys, *self.values)

    def compact(self, spark: SparkSession, last: int) -> None:
        """Reduce the batches up to ``last`` (closed ones) into a new base.

        Readers take the newest base and only the batches after it; older
        bases and batches can be cleaned away by whoever keeps the folder.
        """
        (self._reduce(self._rows(spark, last)).withColumn(self.BATCH, F.lit(int(last)).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(self.BATCH).parquet(self.base))
