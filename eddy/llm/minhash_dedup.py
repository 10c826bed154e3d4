"""Near-duplicate documents by HyperMinHash sketches.

A document is the set of its distinct 5-word shingles (lower-case words).
Two documents are linked when their sets' Jaccard similarity is 0.75 or
more; a class is what links reach.

1. *Sketch.*  Bucket ``b`` of a sketch keeps the smallest of the set's
   64-bit hashes under the bucket's own multiplier, compressed to a 16-bit
   register: the count of leading zeros and the ``MANTISSA`` bits after
   the leading one.  (Every bucket sees the whole set: buckets cut by a
   hash prefix stay empty in short documents, and equal emptiness says
   nothing.)  Equal minima give equal registers, so compression loses no
   candidate.
2. *Bands.*  ``ROWS`` registers packed into 64 bits make a band; documents
   that share one of the ``BANDS`` bands are candidates.  A pair at the
   threshold shares no band with probability (1-0.75^4)^40 = 2.5e-7.
   Equal sets enter once, under their smallest doc_id.
3. *Clusters.*  Each band links its documents to its smallest one (never
   all pairs); the components of these links hold every candidate pair.
   A cluster's documents meet in one task; a cluster over
   ``BLOCK_SHINGLES`` or ``BLOCK_DOCS`` is cut into blocks, and each pair
   of blocks is one task, so no task grows with a hot group.
4. *Estimate, then verify.*  Inside a task, pairs whose collision-corrected
   estimate is below the threshold less ``MARGIN`` are passed over (a pair
   at the threshold with probability 3.1e-8; with the bands' loss that is
   2.8e-7 at most), and so are pairs already in one class; the
   rest are confirmed on the full sets.  Only links that join two classes
   leave the task, fewer than its documents.
5. The classes are the components of the confirmed links, and of links
   between the sets that rows of one doc_id have.

Defined cases: a null, empty or blank text has an empty set and is linked
with nothing; a text of 1 to 4 words is its whole sequence as one shingle;
a null doc_id is its own class (component_id null, kept true); rows that
repeat a doc_id are in one class, whatever their texts (each text is compared
as a set of its own), and each gives a row; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddy.llm.graph import components, written
from eddy.llm.textarrays import mix, shingles, texts, tidy, tidy_batches

BANDS, ROWS = 40, 4
BUCKETS = BANDS * ROWS
MANTISSA = 10
SHINGLE_WORDS = 5
NUMERATOR, DENOMINATOR = 75, 100      # linked: DENOMINATOR * common >= NUMERATOR * union
MARGIN = 0.20
BLOCK_SHINGLES, BLOCK_DOCS = 1 << 21, 2048

_U = np.uint64
_MULTIPLIERS = np.random.Generator(np.random.PCG64(97)).integers(1, 1 << 63, BUCKETS, dtype=np.uint64) * _U(2) + _U(1)
_BAND_SALT = mix(np.arange(1, BANDS + 1, dtype=np.uint64))


def registers(shingle_set: np.ndarray) -> np.ndarray:
    """The 16-bit registers of a non-empty set: leading zeros, then mantissa."""
    least = np.full(BUCKETS, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(shingle_set), 1024):
        block = shingle_set[a:a + 1024]
        np.minimum(least, (block[None, :] * _MULTIPLIERS[:, None]).min(axis=1), out=least)
    top = least >> _U(11)                                   # 53 bits: exact as a double
    zeros = (53 - np.frexp(top.astype(np.float64))[1]).astype(np.uint64)
    mantissa = ((top << zeros) >> _U(52 - MANTISSA)) & _U((1 << MANTISSA) - 1)
    return (zeros << _U(MANTISSA) | mantissa).astype(np.uint16)


def bands(regs: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of registers."""
    return mix(np.ascontiguousarray(regs).view(np.uint64) ^ _BAND_SALT).view(np.int64)


def estimates(regs: np.ndarray, one: np.ndarray, sizes: np.ndarray, size: int) -> np.ndarray:
    """Jaccard estimates of sketches against one, corrected for chance collisions.

    Two unequal minima share a register with a probability of about
    ``0.17 * 2^-MANTISSA * 4x/(1+x)^2`` for sizes in ratio x; the expected
    number of these is taken off the matches.
    """
    ratio = sizes / size
    chance = 0.169919 * 2.0 ** -MANTISSA * 4 * ratio / (1 + ratio) ** 2
    same = (regs == one).mean(axis=1)
    return np.maximum(0.0, (same - chance) / (1 - chance))


_SIGNED = "doc_id bigint, n_shingles bigint, set_key binary, bands array<bigint>"


def _sign(batches):
    for batch in batches:
        n, keys, rows = [], [], []
        for _, words in texts(batch.column("text"), lower=True):
            s = shingles(words, SHINGLE_WORDS)
            n.append(len(s))
            keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            rows.append(bands(registers(s)) if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
             pa.array(rows, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "set_key", "bands"])


def _sets(batches):
    for batch in batches:
        sets, regs = [], []
        for _, words in texts(batch.column("text"), lower=True):
            s = shingles(words, SHINGLE_WORDS)
            sets.append(s.tobytes())
            regs.append(registers(s).tobytes() if len(s) else b"")
        keep = [batch.column(c) for c in ("doc_id", "root", "n_blocks", "block")]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(regs, pa.binary()), pa.array(sets, pa.binary())],
                                         names=["doc_id", "root", "n_blocks", "block", "regs", "shingles"])


def _common(sets: list[np.ndarray], one: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sorted sets with a sorted set."""
    flat = np.concatenate(sets)
    at = np.searchsorted(one, flat)
    hit = one[np.minimum(at, len(one) - 1)] == flat
    return np.add.reduceat(hit, np.cumsum([0, *map(len, sets[:-1])]))


def confirmed_links(doc_ids: np.ndarray, regs: np.ndarray, sets: list[np.ndarray], sides: np.ndarray | None = None):
    """Links (a, b) on the full sets that join the classes of these documents.

    With ``sides``, only documents of different sides are compared.
    """
    threshold = NUMERATOR / DENOMINATOR
    order = np.argsort([len(s) for s in sets], kind="stable")
    ids, regs, sets = doc_ids[order], regs[order], [sets[i] for i in order]
    sides = None if sides is None else sides[order]
    sizes = np.array([len(s) for s in sets])
    label = np.arange(len(ids))
    links = []
    for i in range(1, len(ids)):
        low = np.searchsorted(sizes[:i], threshold * sizes[i] - 1e-9)
        near = np.arange(low, i)
        near = near[label[low:i] != label[i]]
        if sides is not None:
            near = near[sides[near] != sides[i]]
        if not len(near):
            continue
        guess = estimates(regs[near], regs[i], sizes[near], sizes[i])
        near = near[guess >= threshold - MARGIN]
        for at in range(0, len(near), 512):
            part = near[at:at + 512]
            part = part[label[part] != label[i]]
            if not len(part):
                continue
            common = _common([sets[j] for j in part], sets[i])
            for j in part[DENOMINATOR * common >= NUMERATOR * (sizes[part] + sizes[i] - common)]:
                if label[j] != label[i]:
                    links.append((ids[i], ids[j]))
                    label[label == label[j]] = label[i]
    return links


def _verify(table: pa.Table) -> pa.Table:
    ids = table.column("doc_id").to_numpy()
    regs = np.stack([np.frombuffer(x, np.uint16) for x in table.column("regs").to_pylist()])
    sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
    side = table.column("block").to_numpy()
    across = table.column("i")[0].as_py() != table.column("j")[0].as_py()
    links = confirmed_links(ids, regs, sets, side if across else None)
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    signed = written(docs.mapInArrow(tidy_batches(_sign), _SIGNED), "signed")
    named = signed.where("set_key is not null and doc_id is not null")
    reps = named.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.any_value("n_shingles").alias("n"),
                                        F.any_value("bands").alias("bands"))
    rows = reps.select("rep", F.explode("bands").alias("band"))
    heads = rows.groupBy("band").agg(F.min("rep").alias("head"), F.count(F.lit(1)).alias("k")).where("k > 1")
    shared = rows.join(heads, "band").where("rep <> head").select(F.col("rep").alias("a"), F.col("head").alias("b"))
    clusters = components(shared)

    sizes = named.select("doc_id", "n_shingles").join(clusters, F.col("doc_id") == F.col("node")) \
        .groupBy("root").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_shingles").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("docs") / BLOCK_DOCS), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
    members = clusters.join(sizes.select("root", blocks.cast("int").alias("n_blocks")), "root").select(
        F.col("node").alias("doc_id"), "root", "n_blocks",
        F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int").alias("block"))
    sets = docs.join(members, "doc_id").select("doc_id", "root", "n_blocks", "block", "text").mapInArrow(
        tidy_batches(_sets), "doc_id bigint, root bigint, n_blocks int, block int, regs binary, shingles binary")
    other = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))
    tasks = sets.where("length(shingles) > 0").withColumn("other", other).select(
        "root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "doc_id", "block", "regs", "shingles")
    links = tasks.groupBy("root", "i", "j").applyInArrow(tidy(_verify), "a bigint, b bigint")
    # ids with different texts: their sets are linked through the id
    several = named.groupBy("doc_id").agg(F.min("set_key").alias("x"), F.max("set_key").alias("y"))
    empty = signed.where("set_key is null and doc_id is not null").select("doc_id").distinct()
    several = written(several.where("x <> y").select("doc_id").unionByName(empty.join(named, "doc_id", "left_semi")).distinct(), "several")
    own = named.join(several, "doc_id").join(reps.select("set_key", "rep"), "set_key").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    classes = components(links.unionByName(own))
    by_id = several.join(classes, F.col("doc_id") == F.col("node")).select("doc_id", F.col("root").alias("id_class"))

    to_class = named.groupBy("set_key").agg(F.min("doc_id").alias("rep")) \
        .join(classes, F.col("rep") == F.col("node"), "left") \
        .select("set_key", F.coalesce("root", "rep").alias("component"))
    out = signed.select("doc_id", "n_shingles", "set_key").join(to_class, "set_key", "left").join(by_id, "doc_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("id_class", "component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))
