"""Shards of near equal bytes by sampled splitters, with DataFrame functions only.

Records are ordered by a hash of the text, so equal texts (a group) are
neighbours, and the shards are stretches of near equal bytes in that order:

1. *Sample.*  A record is drawn with a chance in proportion to its size
   (by a hash of its doc_id, so a retry draws the same ones); about
   ``SAMPLE`` records whatever the input.
2. *Splitters.*  ``SPLITTERS`` quantiles of the sampled keys bound the
   ranges that the groups are dealt to.
3. *Overfull ranges.*  A range of more than ``BLOCK_ROWS`` groups is cut
   evenly by hash.  Groups are counted before they move, so a text in a
   third of all records is one row here.
4. *Places.*  Totals of the blocks before, and a running sum inside the
   block, give each group's exact place in bytes and rows.  The middle of
   a group decides its shard, so equal texts stay together, unless they
   hold more than ``GROUP_SHARE`` of a shard; such a group is cut by
   record.
5. *Slots.*  A record's slot is its row's place less its shard's first.
   The records of a group of more than ``BLOCK_ROWS`` are numbered in
   pieces dealt by doc_id hash, so no task numbers a hot group alone.

Defined cases: a null text counts as empty (16 bytes); equal rows are
neighbours in any order among themselves; rows with a null doc_id are
records like others (they sort first); an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eddy.llm.graph import written

SHARDS = 40
SAMPLE, SPLITTERS = 1 << 14, 255
BLOCK_ROWS = 1 << 11
GROUP_SHARE = 0.05
RECORD_BYTES = 16
GROUP = ["h", "text_crc32", "size"]     # what tells a text


def _range(key: Column, bounds: list[int]) -> Column:
    """How many bounds are at or below the key, by halving (eight compares of 255)."""
    def halve(a: int, b: int) -> Column:
        if a == b:
            return F.lit(a)
        m = (a + b) // 2
        return F.when(key < F.lit(bounds[m]), halve(a, m)).otherwise(halve(m + 1, b))
    return halve(0, len(bounds))


def _places(groups: DataFrame, bounds: list[int], block_rows: int) -> DataFrame:
    """Groups with the bytes and rows of all groups before (``b0``, ``r0``)."""
    dealt = groups.withColumn("range", _range(F.col("h"), bounds))
    spans = dealt.groupBy("range").agg(F.min("h").alias("h0"), F.max("h").alias("h1"),
                                       F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).alias("cuts"))
    share = (F.col("h").cast("double") - F.col("h0")) / (F.col("h1").cast("double") - F.col("h0") + 1)
    dealt = dealt.join(F.broadcast(spans), "range")      # SPLITTERS + 1 rows at most
    dealt = dealt.withColumn("cut", F.floor(share * F.col("cuts"))).drop("h0", "h1", "cuts")

    blocks = written(dealt.groupBy("range", "cut").agg(F.sum("bytes").alias("b"), F.sum("rows").alias("r")), "blocks")
    def before(of, window):
        return [F.coalesce(F.sum(c).over(window), F.lit(0)).alias(f"{c}0") for c in of]
    ranges = blocks.groupBy("range").agg(F.sum("b").alias("b"), F.sum("r").alias("r"))
    ranges = ranges.select(F.col("range").alias("of"), *before(("b", "r"), Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)))
    inside = Window.partitionBy("range").orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("range", "cut", *[c.alias(f"{n}1") for n, c in zip("br", before(("b", "r"), inside))])
    starts = blocks.join(F.broadcast(ranges), F.col("range") == F.col("of")).select(
        "range", "cut", (F.col("b0") + F.col("b1")).alias("b0"), (F.col("r0") + F.col("r1")).alias("r0"))

    order = Window.partitionBy("range", "cut").orderBy("h", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    dealt = dealt.withColumn("b2", F.coalesce(F.sum("bytes").over(order), F.lit(0))) \
        .withColumn("r2", F.coalesce(F.sum("rows").over(order), F.lit(0)))
    return dealt.join(starts, ["range", "cut"]).select(
        *GROUP, "bytes", "rows", (F.col("b0") + F.col("b2")).alias("b0"), (F.col("r0") + F.col("r2")).alias("r0"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each row."""
    text = F.coalesce("text", F.lit(""))
    records = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                          (F.octet_length(text) + F.lit(RECORD_BYTES)).cast("bigint").alias("size"),
                          F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h"))
    records = written(records, "records")
    total = records.agg(F.sum("size").alias("n")).first()["n"] or 0

    # a size-weighted sample: chance = size * SAMPLE / total
    draw = F.pmod(F.xxhash64(F.lit(11), "doc_id", "h"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    quantiles = [k / (SPLITTERS + 1) for k in range(1, SPLITTERS + 1)]
    drawn = records.where(draw < F.col("size") * F.lit(SAMPLE / max(1, total))) \
        .agg(F.percentile_approx("h", quantiles, 10_000).alias("q")).first()["q"]
    bounds = sorted(set(drawn or []))

    groups = records.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"))
    places = _places(written(groups, "groups"), bounds, block_rows)
    piece = F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("rows") / F.lit(block_rows)))
    placed = written(records.join(places, GROUP).withColumn("piece", piece), "placed")
    pieces = placed.where(F.col("rows") > block_rows).groupBy(*GROUP, "piece").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy(*GROUP).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(*GROUP, "piece", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))

    number = F.row_number().over(Window.partitionBy(*GROUP, "piece").orderBy("doc_id")) - 1
    numbered = placed.withColumn("number", number).join(pieces, [*GROUP, "piece"], "left") \
        .withColumn("number", F.col("number") + F.coalesce("ahead", F.lit(0)))
    whole = F.col("bytes") <= F.lit(GROUP_SHARE * total / shards)
    middle = F.col("b0") + F.when(whole, F.col("bytes") / 2).otherwise((F.col("number") + 0.5) * F.col("size"))
    shard = F.least(F.floor(middle * F.lit(shards / max(1, total))), F.lit(shards - 1)).cast("int")
    numbered = written(numbered.select("doc_id", "size", "text_crc32", shard.alias("shard"),
                                       (F.col("r0") + F.col("number")).alias("place")), "numbered")
    first = numbered.groupBy("shard").agg(F.min("place").alias("first"))        # a row for each shard
    return numbered.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("place") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
