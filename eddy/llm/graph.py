"""Connected components in Spark; ``written`` tables cut the lineage between steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddy.session import discard
from eddy.session import materialize as written


# Edges in one file of a round's tables: many small files cost more than they spread.
FILE_EDGES = 4096


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for each node of an edge: root is the smallest node reachable.

    Alternates the large-star and small-star steps: every node's larger
    neighbours, then its smaller ones, are linked to its smallest
    neighbour.  The number of rounds grows with the logarithm of the
    longest path.  Each step is a grouped minimum (combined before the
    shuffle) and a join that adaptive execution can split at a hot node.
    Only the edges' count and checksum reach the driver.  Each round's tables
    are deleted when the next one's are written; the result reads the last.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = written(e, "edges")
    seen = None
    while True:
        mark = e.agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
        if (mark["n"], mark["x"]) == seen:
            break
        seen = (mark["n"], mark["x"])
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        files = 2 * mark["n"] // FILE_EDGES + 1
        large = written(large.distinct().coalesce(files), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                                               F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("s"))
        last, e = e, written(small.select("s.u", "s.v").where("u <> v").distinct().coalesce(files), "edges")
        discard(last, large)
    roots = e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
