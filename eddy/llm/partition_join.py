"""Documents with nearly equal word n-grams, by partitions of the n-gram universe.

A document is the set of its distinct 3-word shingles (lower-case words).
Two documents link when their sets' Jaccard similarity is 0.9 or more, which
bounds the shingles that only one of them has: sizes r and s may differ in
``most(r, s)`` at most.

1. *Segments.*  Sizes are cut into bands.  A band cuts the universe of
   shingles by hash into ``m`` segments, one more than linked sets can differ
   in.  By the pigeonhole principle linked sets are equal in a segment.  Every
   set is indexed by its segments in its own band, and asks as the larger one
   in its band and, if near enough, in the band below.
2. *Allocation.*  A set needs only as many units of difference as its own size
   allows: a segment looked up exactly is worth one, a segment looked up with
   its one-deletion neighbourhood two (then sets are found that differ in one
   shingle there), a segment not looked up none.  Costs are the exact
   numbers of sets in each signature, over all data: of those over ``COSTLY`` a
   set skips the dearest, as many as it has units to spare; if more are left, it
   looks up every ``NEAR_EVERY``-th segment (unless that is costly) with
   its neighbourhood and skips one more for each.  What is found stays complete.
3. *Parities.*  The parity of a set is a bit for each shingle, added modulo
   two.  It bounds the difference of two sets from below and passes over
   nearly all pairs that don't link (and none that do).  Pairs are compared by
   parities first; full sets go only where a pair is left that needs them.
4. *Heads.*  Sets of a signature are compared with its smallest doc_id first,
   never all pairs; signatures whose sets are then all in one class are done.
5. *Rest.*  The components of the remaining signatures are compared in tasks,
   cut into pairs of blocks above ``BLOCK_DOCS`` documents or
   ``BLOCK_SHINGLES`` shingles; pairs of one class are passed over.
6. The classes are the components of the links.

Equal sets enter once, under their smallest doc_id.

Defined cases: a null, empty or blank text has an empty set and links with
nothing; a text of one or two words is its whole sequence as one shingle; a
null doc_id is its own class (component_id null); rows that repeat a doc_id
are in one class, whatever their texts, and each gives a row; extra columns are
ignored.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eddy.llm.graph import components, discard, written
from eddy.llm.textarrays import mix, shingles, texts

SHINGLE_WORDS = 3
NUMERATOR, DENOMINATOR = 90, 100      # linked: DENOMINATOR * common >= NUMERATOR * union
BAND_RATIO = 1.5
COSTLY, NEAR_EVERY = 8, 16
HEAD_SHINGLES = 1 << 18               # compared with one head in one task
BLOCK_SHINGLES, BLOCK_DOCS = 1 << 23, 4096

_U = np.uint64


def most(r: int, s: int) -> int:
    """Shingles that two linked sets of these sizes may differ in."""
    return (DENOMINATOR - NUMERATOR) * (r + s) // (DENOMINATOR + NUMERATOR)


def _bands() -> list[int]:
    """Smallest sizes of the bands; sets below the first link only if equal."""
    first = 1
    while not most(first, first + 1):
        first += 1
    edges = [first]
    while edges[-1] < 1 << 40:
        edges.append(max(edges[-1] + 1, int(edges[-1] * BAND_RATIO)))
    return edges


EDGES = _bands()


def segments(band: int) -> int:
    """Segments of a band: one more than the largest pair asked there can differ in."""
    top = EDGES[band + 1] - 1
    return most(top, top * DENOMINATOR // NUMERATOR) + 1


def bands_of(size: int) -> list[tuple[int, int]]:
    """(band, units needed) where a set asks: its own band first, then the one below if sets there can link."""
    band = bisect_right(EDGES, size) - 1
    if band < 0:
        return []
    out = [(band, most(size, size) + 1)]
    if band and NUMERATOR * size <= DENOMINATOR * (EDGES[band] - 1):
        out.append((band - 1, most(EDGES[band] - 1, size) + 1))
    return out


def signatures(shingle_set: np.ndarray, band: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Hashes of a sorted set's segments, and of every ``NEAR_EVERY``-th one less one shingle."""
    m = segments(band)
    cut = np.searchsorted((shingle_set >> _U(32)) * _U(m) >> _U(32), np.arange(m + 1).astype(_U))
    x = mix(shingle_set ^ _U(0x9E6C63D0876A9A47))
    sums = np.append(_U(0), np.cumsum(x))
    total = sums[cut[1:]] - sums[cut[:-1]]
    salt = mix(_U(band + 1) << _U(40) | np.arange(m).astype(_U))
    near = [mix(total[j] - x[cut[j]:cut[j + 1]] + salt[j]) for j in range(0, m, NEAR_EVERY)]
    return mix(total + salt), near


_ASKS = "array<struct<band:int,spare:int,whole:array<bigint>,near:array<array<bigint>>>>"
_SIGNED = f"doc_id bigint, n_shingles bigint, set_key binary, asks {_ASKS}"
_ASKS_ARROW = pa.list_(pa.struct([("band", pa.int32()), ("spare", pa.int32()), ("whole", pa.list_(pa.int64())),
                                  ("near", pa.list_(pa.list_(pa.int64())))]))


def _asks(s: np.ndarray) -> list[dict]:
    out = []
    for band, need in bands_of(len(s)):
        whole, near = signatures(s, band)
        out.append({"band": band, "spare": len(whole) - need, "whole": whole.view(np.int64), "near": [x.view(np.int64) for x in near]})
    return out


def _sign(batches):
    for batch in batches:
        n, keys, asks, size = [], [], [], 0
        done = 0
        for row, words in texts(batch.column("text"), lower=True):
            s = shingles(words, SHINGLE_WORDS)
            n.append(len(s))
            keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            asks.append(_asks(s))
            size += len(s)
            if size >= 1 << 20:
                yield _signed(batch, done, n, keys, asks)
                n, keys, asks, size, done = [], [], [], 0, row + 1
        if n:
            yield _signed(batch, done, n, keys, asks)


def _signed(batch, at, n, keys, asks):
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id").slice(at, len(n)), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(asks, _ASKS_ARROW)],
        names=["doc_id", "n_shingles", "set_key", "asks"])


def _sets(batches):
    for batch in batches:
        sets = [shingles(words, SHINGLE_WORDS).tobytes() for _, words in texts(batch.column("text"), lower=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(s) // 8 for s in sets], pa.int64()), pa.array(sets, pa.binary())],
                                         names=["doc_id", "n", "shingles"])


def _common(sets: list[np.ndarray], one: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sorted sets with a sorted set (none is empty)."""
    flat = np.concatenate(sets)
    at = np.searchsorted(one, flat)
    hit = one[np.minimum(at, len(one) - 1)] == flat
    return np.add.reduceat(hit, np.cumsum([0, *map(len, sets[:-1])]), dtype=np.int64)


def _linked(common, r, s):
    return DENOMINATOR * common >= NUMERATOR * (r + s - common)


def _may_link(apart, r, s):
    """Whether sets of these sizes that differ in ``apart`` shingles or more can be linked."""
    return (DENOMINATOR + NUMERATOR) * apart <= (DENOMINATOR - NUMERATOR) * (r + s)


def _read(table: pa.Table) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    ids = table.column("doc_id").to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
    return ids, sets, np.array([len(s) for s in sets])


def _links(pairs: list[tuple]) -> pa.Table:
    return pa.table({"a": pa.array([int(x) for x, _ in pairs], pa.int64()), "b": pa.array([int(y) for _, y in pairs], pa.int64())})


def _with_head(table: pa.Table) -> pa.Table:
    """Links of the rows with the head of their group."""
    ids, sets, sizes = _read(table)
    head = table.column("head")[0].as_py()
    out = []
    for h in np.flatnonzero(ids == head):
        rest = np.flatnonzero(ids != head)
        for a in range(0, len(rest), 512):
            part = rest[a:a + 512]
            common = _common([sets[i] for i in part], sets[h])
            out += [(ids[i], head) for i in part[_linked(common, sizes[part], sizes[h])]]
    return _links(out)


def parity(shingle_set: np.ndarray) -> np.ndarray:
    """A bit for each shingle, added modulo two: two to four bits a shingle, in 64-bit words."""
    bits = 64 << (len(shingle_set) // 32).bit_length()
    odd = np.bincount((shingle_set & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(words: np.ndarray, size: int) -> np.ndarray:
    """The parity of the same set in fewer words."""
    while len(words) > size:
        words = words[:len(words) // 2] ^ words[len(words) // 2:]
    return words


def _smallest(sizes: np.ndarray, size: int) -> int:
    """The first of sorted sizes that may link with ``size``."""
    return int(np.searchsorted(sizes, -(-NUMERATOR * int(size) // DENOMINATOR)))


def near_pairs(ids: np.ndarray, words: list[np.ndarray], sizes: np.ndarray, label: np.ndarray, sides: np.ndarray | None = None):
    """Pairs of different classes that may link: all that do, and few others.

    The parities of two sets differ in at most as many bits as the sets do in
    shingles.  With ``sides``, only sets of different sides are paired.
    """
    order = np.argsort(sizes, kind="stable")
    ids, words, sizes = ids[order], [words[i] for i in order], sizes[order]
    label = np.unique(label, return_inverse=True)[1][order]
    sides = None if sides is None else sides[order]
    out, at = [], 0
    for i in range(1, len(ids)):
        if i >= at:                                     # parities of the next sets, in the words of the smallest
            base = _smallest(sizes, sizes[i])
            at = int(np.searchsorted(sizes, 2 * sizes[i], "right"))
            sums = np.stack([folded(w, len(words[base])) for w in words[base:at]])
        near = np.arange(_smallest(sizes, sizes[i]), i)
        near = near[label[near] != label[i]]
        if sides is not None:
            near = near[sides[near] != sides[i]]
        if not len(near):
            continue
        apart = np.bitwise_count(sums[near - base] ^ sums[i - base]).sum(axis=1, dtype=np.int64)
        near = near[_may_link(apart, sizes[near], sizes[i])]
        out += [(ids[i], ids[j]) for j in near]
    return out


def _words(table: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in table.column("parity").to_pylist()]


def _near_head(table: pa.Table) -> pa.Table:
    """Rows of a group that may link with its head: all that do, and few others."""
    ids, sizes, words = table.column("doc_id").to_numpy(), table.column("n").to_numpy(), _words(table)
    head = table.column("head")[0].as_py()
    keep = np.zeros(len(ids), bool)
    for h in np.flatnonzero(ids == head):
        for i in np.flatnonzero((ids != head) & ~keep):
            size = min(len(words[i]), len(words[h]))
            apart = np.bitwise_count(folded(words[i], size) ^ folded(words[h], size)).sum(dtype=np.int64)
            keep[i] = _may_link(apart, sizes[i], sizes[h])
    return table.filter(pa.array(keep)).select(["head", "doc_id", "n"]).rename_columns(["head", "rep", "n"])


def _among(table: pa.Table) -> pa.Table:
    """Pairs of a block, or of two, that may link."""
    words = _words(table)
    across = table.column("i")[0].as_py() != table.column("j")[0].as_py()
    return _links(near_pairs(table.column("doc_id").to_numpy(), words, table.column("n").to_numpy(), table.column("label").to_numpy(),
                             table.column("block").to_numpy() if across else None))


def _parities(batches):
    for batch in batches:
        words = [parity(np.frombuffer(x, np.uint64)).tobytes() for x in batch.column("shingles").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n"), pa.array(words, pa.binary())], names=["doc_id", "n", "parity"])


def _confirm(batches):
    """The pairs that link, on their full sets."""
    for batch in batches:
        one, two = ([np.frombuffer(x, np.uint64) for x in batch.column(c).to_pylist()] for c in ("one", "two"))
        keep = [bool(_linked(_common([y], x)[0], len(x), len(y))) for x, y in zip(one, two)]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _near(size_a: Column, size_b: Column) -> Column:
    return F.greatest(size_a, size_b) * NUMERATOR <= F.least(size_a, size_b) * DENOMINATOR


def candidates(reps: DataFrame) -> DataFrame:
    """(bucket, rep, n): sets that share a signature that at least one of them asks for.

    ``reps``: (rep, n, asks) of distinct sets.  All linked pairs share a bucket.
    Of all signatures only 64 bits, the set and the place in its array are shuffled.
    """
    asks = reps.select("rep", "n", F.posexplode("asks").alias("lower", "ask")).select(
        "rep", "n", "lower", "ask.*", F.size("ask.near").alias("all_near"))
    rows = asks.select("rep", "lower", F.posexplode("whole").alias("i", "sig")) \
        .select("sig", "rep", (2 * F.col("i") + F.col("lower")).alias("at"))
    busy = rows.groupBy("sig").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    met = rows.join(busy, "sig").select("rep", F.expr("at div 2").cast("int").alias("i"), (F.col("at") % 2).alias("lower"), "sig", "k")
    met = written(met.join(asks.select("rep", "lower", "n", "band", "spare", "all_near"), ["rep", "lower"]), "met")
    # allocation: the dearest signatures of each set and band first
    whose = ["rep", "n", "lower", "band"]
    mine = Window.partitionBy(*whose)
    near = (F.col("i") % NEAR_EVERY == 0).cast("int")
    dear = met.where(F.col("k") > COSTLY).select(
        "*", F.row_number().over(mine.orderBy(F.desc("k"), "i")).alias("place"), F.count(F.lit(1)).over(mine).alias("dear"),
        F.sum(near).over(mine).alias("dear_near"))
    wide = dear.where("dear > spare").groupBy(*whose).agg(F.collect_set(F.when(near == 1, F.col("i"))).alias("not_near"))
    wide = written(wide, "wide")                        # sets that look up neighbourhoods
    skipped = dear.where(F.col("place") <= F.col("spare") + F.when(F.col("dear") > F.col("spare"), F.col("all_near") - F.col("dear_near")).otherwise(0))

    def rows_of(df: DataFrame, space: int, column: str) -> DataFrame:
        return df.select("rep", "n", F.xxhash64(F.lit(space), column).alias("bucket"))
    # neighbourhoods: asked for first, then what is held of them
    parts = F.posexplode("near").alias("j", "hashes")
    wide_asks = asks.join(wide, whose).select("rep", "n", "band", "whole", "not_near", parts) \
        .where(~F.array_contains("not_near", F.col("j") * NEAR_EVERY)).select(
        "rep", "n", "band", "j", F.get("whole", F.col("j") * NEAR_EVERY).alias("sig"), "hashes")
    wide_asks = written(wide_asks, "wide-asks")
    asked = rows_of(wide_asks.select("rep", "n", F.explode("hashes").alias("hash")), 0, "hash") \
        .unionByName(rows_of(wide_asks, 1, "sig")).distinct()
    asked = written(asked, "asked")
    segment = asks.where("lower = 0").select("rep", "n", "band", "whole", parts) \
        .select("rep", "n", "band", "j", F.get("whole", F.col("j") * NEAR_EVERY).alias("sig"), "hashes")
    indexed = segment.join(wide_asks.select("band", "j").distinct(), ["band", "j"], "left_semi").select("rep", "n", "sig", "hashes")
    indexed = rows_of(indexed, 0, "sig").unionByName(rows_of(indexed.select("rep", "n", F.explode("hashes").alias("hash")), 1, "hash"))
    held = indexed.join(asked.select("bucket").distinct(), "bucket", "left_semi")
    # all signatures that two sets share and one asks for
    keys = [*whose, "i"]
    flagged = met.select(*keys, "sig").join(skipped.select(*keys, F.lit(True).alias("skip")), keys, "left") \
        .select("rep", "n", F.xxhash64(F.lit(0), "sig").alias("bucket"), F.col("skip").isNull().alias("asks"), (F.col("lower") == 0).alias("held"))

    def role(df: DataFrame, asks_: bool) -> DataFrame:
        return df.select("rep", "n", "bucket", F.lit(asks_).alias("asks"), F.lit(not asks_).alias("held"))
    found = written(flagged.where("asks or held").unionByName(role(asked, True)).unionByName(role(held, False)), "found")
    live = found.groupBy("bucket").agg(F.max("asks").alias("a"), F.max("held").alias("h"), F.min("rep").alias("x"), F.max("rep").alias("y")) \
        .where("a and h and x <> y").select("bucket")
    out = written(found.join(live, "bucket").select("bucket", "rep", "n").distinct(), "buckets")
    discard(met, wide, wide_asks, asked, found)
    return out


def _tasks(members: DataFrame, key: str, limit_docs: int, limit_shingles: int) -> DataFrame:
    """(key, blocks): how many blocks the members (key, n) of each key need."""
    size = members.groupBy(key).agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("docs") / limit_docs), F.ceil(F.col("shingles") / limit_shingles), F.lit(1))
    return size.select(key, blocks.cast("int").alias("blocks"))


def _with_heads(pairs: DataFrame, table: DataFrame) -> DataFrame:
    """The rows of ``table`` (doc_id, ..) for each pair (head, rep, n): by head in blocks, the head in each."""
    blocks = _tasks(pairs, "head", 1 << 30, HEAD_SHINGLES)
    members = pairs.join(blocks, "head").select("head", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("block"), F.col("rep").alias("doc_id"))
    members = members.unionByName(blocks.select("head", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                                                F.col("head").alias("doc_id")))
    return members.join(table, "doc_id")


def _of(sets: DataFrame, pairs: DataFrame, *columns: str) -> DataFrame:
    """The sets of the documents that pairs name."""
    return sets.join(pairs.select(F.explode(F.array(*columns)).alias("doc_id")).distinct(), "doc_id", "left_semi")


def links(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(a, b): links that connect all linked sets that share a bucket of ``found``, a written table."""
    involved = found.select(F.col("rep").alias("doc_id")).distinct()
    sets = written(docs.join(involved, "doc_id", "left_semi").select("doc_id", "text").mapInArrow(_sets, "doc_id bigint, n bigint, shingles binary")
                   .where("n > 0"), "sets")
    parities = written(sets.mapInArrow(_parities, "doc_id bigint, n bigint, parity binary"), "parities")
    # with the heads
    heads = found.groupBy("bucket").agg(F.min(F.struct("rep", "n")).alias("h"))
    pairs = found.join(heads, "bucket").where("rep <> h.rep").where(_near(F.col("n"), F.col("h.n"))) \
        .select(F.col("h.rep").alias("head"), "rep", "n").distinct()
    pairs = written(pairs, "heads")
    near = written(_with_heads(pairs, parities).groupBy("head", "block").applyInArrow(_near_head, "head bigint, rep bigint, n bigint").distinct(), "near-heads")
    first = _with_heads(near, _of(sets, near, "head", "rep")).select("head", "block", "doc_id", "shingles") \
        .groupBy("head", "block").applyInArrow(_with_head, "a bigint, b bigint")
    first = written(first.distinct(), "first-links")
    classes = written(components(first), "first-classes")
    # the rest: buckets with two classes
    label = F.coalesce("root", "rep").alias("label")
    rest = found.join(classes, F.col("rep") == F.col("node"), "left").select("bucket", "rep", "n", label)
    labelled = written(rest, "labelled")
    mixed = labelled.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.min("rep").alias("head")).where("x <> y")
    rest = labelled.join(mixed.select("bucket", "head"), "bucket")
    groups = components(rest.select(F.col("rep").alias("a"), F.col("head").alias("b")))
    members = rest.select(F.col("rep").alias("doc_id"), "label").distinct().join(groups, F.col("doc_id") == F.col("node")).select("doc_id", "label", "root")
    members = written(members.join(parities, "doc_id"), "rest")
    blocks = _tasks(members, "root", BLOCK_DOCS, BLOCK_SHINGLES)
    dealt = members.join(blocks, "root").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "doc_id", "n", "label", "block", "parity")
    near_rest = written(dealt.groupBy("root", "i", "j").applyInArrow(_among, "a bigint, b bigint").distinct(), "near-rest")
    few = _of(sets, near_rest, "a", "b")
    full = near_rest.join(few.select(F.col("doc_id").alias("a"), F.col("shingles").alias("one")), "a") \
        .join(few.select(F.col("doc_id").alias("b"), F.col("shingles").alias("two")), "b").select("a", "b", "one", "two")
    more = written(full.mapInArrow(_confirm, "a bigint, b bigint"), "more-links")
    discard(sets, parities, pairs, near, labelled, members, near_rest)
    return first.unionByName(more)


def join_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    signed = written(docs.mapInArrow(_sign, _SIGNED), "signed")
    named = signed.where("set_key is not null and doc_id is not null")
    reps = written(named.groupBy("set_key").agg(F.min("doc_id").alias("rep")), "reps")
    distinct = named.where(F.size("asks") > 0).groupBy("set_key").agg(
        F.min("doc_id").alias("rep"), F.any_value("n_shingles").alias("n"), F.any_value("asks").alias("asks"))
    distinct = written(distinct.drop("set_key"), "distinct")
    buckets = candidates(distinct)
    discard(distinct)
    found = links(docs, buckets)
    # ids with different texts: their sets are linked through the id
    several = signed.where("doc_id is not null").groupBy("doc_id").agg(
        F.min("set_key").alias("x"), F.max("set_key").alias("y"), F.count("set_key").alias("n"), F.count(F.lit(1)).alias("rows")) \
        .where("x <> y or (n > 0 and n < rows)").select("doc_id")
    several = written(several, "several")
    own = named.select("doc_id", "set_key").join(several, "doc_id").join(reps, "set_key").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    classes = written(components(found.unionByName(own)), "classes")
    by_id = several.join(classes, F.col("doc_id") == F.col("node")).select("doc_id", F.col("root").alias("id_class"))
    by_set = reps.join(classes, F.col("rep") == F.col("node"), "left") \
        .select("set_key", F.coalesce("root", "rep").alias("set_class"))
    out = signed.select("doc_id", "n_shingles", "set_key").join(by_set, "set_key", "left").join(by_id, "doc_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("id_class", "set_class", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"))
