"""Documents that contain benchmark items.

An item is contained in a document when 75 percent or more of its distinct
5-word shingles (lower-case words) are among the document's.

Jaccard sketches of a short item and a long document hardly ever agree, so
the search is for containment: items are partitioned by size, and from
each item of a partition with up to ``u`` shingles the ``u // 4 + 1``
smallest hashes are kept (a MinHash sketch of bottom values; all of them
if there are fewer).  A document that has three quarters of an item's
shingles can miss a quarter of them at most, so it has one of any
``u // 4 + 1``: looking up a document's shingles among the sketches finds
every containing document, long or short.  Each document so found is then
verified by counting the item's shingles in it exactly.

Items are a stated query set: they are searched in blocks of at most
``BLOCK_BYTES`` of text, each shipped to the tasks that scan the
documents; the documents are never shuffled.

Defined cases: an item of 1 to 4 words is contained where its word
sequence occurs; an item without words (or null) is contained nowhere;
null texts contain nothing; rows with a null doc_id or item_id are left
out of the pairs; repeated rows give one pair; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddy.llm.textarrays import grams, texts

SHINGLE_WORDS = 5
NUMERATOR, DENOMINATOR = 3, 4
BLOCK_BYTES = 8 << 20


def partition_limit(n: int) -> int:
    """Upper size of the partition of items with n shingles: a power of two."""
    return 1 << max(0, int(n - 1).bit_length())


def sketch(shingle_set: np.ndarray) -> np.ndarray:
    """The bottom hashes of an item that no containing document can all lack."""
    return shingle_set[:partition_limit(len(shingle_set)) // DENOMINATOR + 1]


@dataclass(frozen=True)
class Index:
    """Sketches of a block of items: hash -> items, sorted by hash."""
    item_ids: np.ndarray
    sets: list[np.ndarray]
    keys: np.ndarray
    items: np.ndarray
    widths: list[int]           # lengths of the shingles in use

    @staticmethod
    def of(item_ids: list[int], items: pa.Array) -> Index:
        ids, sets, widths = [], [], set()
        for i, words in texts(items, lower=True):
            if len(words):
                widths.add(min(SHINGLE_WORDS, len(words)))
                ids.append(item_ids[i])
                sets.append(np.unique(grams(words, min(SHINGLE_WORDS, len(words)))))
        parts = [sketch(s) for s in sets]
        keys = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        which = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        order = np.argsort(keys, kind="stable")
        return Index(np.array(ids, np.int64), sets, keys[order], which[order], sorted(widths))

    def contained(self, words: np.ndarray) -> list[tuple[int, int, int]]:
        """(item number, its shingles, those in the text) for contained items."""
        if not len(self.keys) or not len(words):
            return []
        own = np.concatenate([grams(words, w) for w in self.widths])
        at = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
        hits = own[self.keys[at] == own]
        if not len(hits):
            return []
        own, hits = np.unique(own), np.unique(hits)
        a, b = np.searchsorted(self.keys, hits), np.searchsorted(self.keys, hits, "right")
        found = []
        for item in np.unique(np.concatenate([self.items[x:y] for x, y in zip(a, b)])):
            s = self.sets[item]
            at = np.minimum(np.searchsorted(own, s), len(own) - 1)
            common = int((own[at] == s).sum())
            if DENOMINATOR * common >= NUMERATOR * len(s):
                found.append((int(item), len(s), common))
        return found


_PAIRS = "doc_id bigint, item_id bigint, item_shingles bigint, common bigint"


def _search(shared):
    def run(batches):
        index = shared.value
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            rows = [(ids[i], int(index.item_ids[item]), n, common)
                    for i, words in texts(batch.column("text"), lower=True) for item, n, common in index.contained(words)]
            columns = zip(*rows) if rows else ([],) * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                             names=["doc_id", "item_id", "item_shingles", "common"])
    return run


def contaminated(docs: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, item_shingles, common): each pair of a document and an item in it."""
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("item_id is not null and text is not null").distinct()
    # block numbers from a running size, so each block has a bounded size
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-int(size) * 2 // block_bytes))
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id is not null")
    found = None
    for block in range(blocks):
        part = items.where(F.col("block") == block).select("item_id", "text").toArrow()
        index = Index.of(part.column("item_id").to_pylist(), part.column("text"))
        pairs = rows.mapInArrow(_search(spark.sparkContext.broadcast(index)), _PAIRS)
        found = pairs if found is None else found.unionByName(pairs)
    # few rows: only pairs that hold
    return found.groupBy("doc_id", "item_id").agg(F.max("item_shingles").alias("item_shingles"), F.max("common").alias("common"))
