"""Repeated 50-byte passages removed by distributed two-stage suffix sorting.

A byte of a document goes when some ``WINDOW``-byte string over it also
starts in a document with a smaller doc_id.  The steps keep every task's
input bounded and move little more than the text itself:

1. *Keys.*  The key of a 50-byte string is the smallest hash among its
   16-byte pieces, so equal strings have equal keys, and about one place
   in twenty starts a new key.  Tasks send each key once (with one of its
   documents) to the key's bucket, which tells the senders the keys found
   in two or more documents.
2. *Passages.*  The stretches under such a shared key, with the bytes that
   their last strings need, go to buckets by key.  All occurrences of any
   repeated string meet in one bucket.  A sender has each distinct passage
   once, under its smallest document: its copies in the sender's other
   documents go wholly, whatever the answer is.
3. *Suffix arrays.*  Each bucket sorts the suffixes of its distinct
   passages by two-stage sorting (``suffixes.py``) and takes runs of
   adjacent common prefixes of 50 bytes or more as the classes of equal
   strings.  A string whose class has a smaller document goes.
4. The spans go back to the documents, which are cut.

Buckets and senders are sized from the total of text bytes, so a task
holds as much at any size.  A passage found in a third of all documents
reaches its bucket once from each sender, not once from each document.

Passages at the edge of such a line carry the neighbouring text and differ
in every document.  Senders of keys so count the bytes under each, and the
passages of a key over ``HOT_KEY_BYTES`` go out string by string instead:
the 128-bit hash of each 50-byte string goes to the hash's bucket, once
from each sender, under its smallest document.  Equal strings meet there.
Only the list of hot keys passes the driver (8 bytes for each
``HOT_KEY_BYTES`` under one key).

Defined cases: a null text is empty; texts under 50 bytes keep all; a row
with a null doc_id has no smaller or larger document and keeps all; rows
that share a doc_id don't repeat each other (neither is smaller), and each
is judged on its own text; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddy.llm.graph import written
from eddy.llm.suffixes import common_prefixes, sort_suffixes
from eddy.llm.textarrays import mix, tidy, tidy_batches, tidy_pair, utf8

WINDOW, PIECE = 50, 16
STEP_BYTES = 1 << 20          # of one text looked at together
SEND_BYTES = 16 << 20         # of text in one sender
KEY_BUCKET_BYTES, SORT_BUCKET_BYTES, PART_BYTES = 24 << 20, 3 << 20, 8 << 20
HOT_KEY_BYTES = 12 << 20      # of passages under one key
HOT_STRINGS = 1 << 20         # of hot keys, looked at together
LEAST_BUCKETS = 24

_U = np.uint64
_LOW = _U(0xFFFFFFFF)
_SIZE_UNIT = 64               # sizes under keys are sent in these, rounded up


def window_keys(text: np.ndarray, buckets: int) -> np.ndarray:
    """The key of each 50-byte string: its bucket above 32 bits of a hash."""
    if len(text) < WINDOW:
        return np.empty(0, np.uint64)
    h = text.astype(np.uint64) * _U(0x9E3779B97F4A7C15)
    h ^= h >> _U(29)
    n = 1
    while n < PIECE:
        h = h[:-n] * _U(0xD6E8FEB86659FD93) + (h[n:] ^ (h[n:] >> _U(32))) * _U(0xBF58476D1CE4E5B9)
        n *= 2
    h = mix(h)
    n, span = 1, WINDOW - PIECE + 1
    while n < span:
        step = min(n, span - n)
        h = np.minimum(h[:-step], h[step:])
        n += step
    # the smallest hash is not evenly spread: mix it anew
    h = mix(h ^ _U(0x5851F42D4C957F2D))
    return ((h >> _U(32)) * _U(buckets) >> _U(32)) << _U(32) | (h & _LOW)


def key_runs(text: np.ndarray, buckets: int):
    """``(keys, from, to)`` of the runs of strings with one key, piece by piece."""
    for a in range(0, max(0, len(text) - WINDOW + 1), STEP_BYTES):
        keys = window_keys(text[a:a + STEP_BYTES + WINDOW - 1], buckets)
        cut = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        yield keys[cut], a + cut, a + np.append(cut[1:], len(keys))


def _pack(x: np.ndarray | bytes) -> bytes:
    """Array bytes compressed for the shuffle, with their size in front."""
    raw = x if isinstance(x, bytes) else np.ascontiguousarray(x).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(x: bytes) -> bytes:
    return pa.decompress(x[8:], decompressed_size=int.from_bytes(x[:8], "little"), codec="zstd", asbytes=True)


def _groups(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_values):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    start = np.flatnonzero(np.append(True, sorted_values[1:] != sorted_values[:-1]))
    return start, np.append(start[1:], len(sorted_values))


# -- 1: keys in two or more documents ----------------------------------------

_ASK = "bucket int, docs binary, keys binary, many binary, sizes binary"


def _ask(buckets: int):
    def send(docs, keys, sizes):
        docs, keys, sizes = np.repeat(docs, [len(k) for k in keys]), np.concatenate(keys), np.concatenate(sizes)
        order = np.lexsort((docs, keys))
        docs, keys = docs[order], keys[order]
        a, b = _groups(keys)
        units = np.minimum(-(-np.add.reduceat(sizes[order], a) // _SIZE_UNIT), int(_LOW)).astype(np.uint32)
        many = docs[a] != docs[b - 1]
        rows = []
        one, flag, doc = keys[a], many, docs[a]
        for x, y in zip(*_groups(one >> _U(32))):       # each key once, to its bucket
            at = x + np.argsort(doc[x:y], kind="stable")
            rows.append((int(one[x] >> _U(32)), _pack(doc[at]), _pack((one[at] & _LOW).astype(np.uint32)), _pack(flag[at].astype(np.uint8)),
                         _pack(units[at])))
        told = np.repeat(many, b - a)                   # known here to be shared
        if told.any():
            d, k = docs[told], keys[told]
            order = np.argsort(d, kind="stable")
            rows.append((-1 - int(k[0] % _U(buckets)), _pack(d[order]), _pack(k[order]), _pack(b""), _pack(b"")))
        bucket, *blobs = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), *(pa.array(x, pa.binary()) for x in blobs)],
                                          names=["bucket", "docs", "keys", "many", "sizes"])

    def run(batches):
        docs, keys, sizes, size = [], [], [], 0
        for batch in batches:
            data, off = utf8(batch.column("text"))
            for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                if doc is None:
                    continue
                for k, x, y in key_runs(data[off[i]:off[i + 1]], buckets):
                    one, at = np.unique(k, return_inverse=True)
                    docs.append(doc)
                    keys.append(one)
                    sizes.append(np.bincount(at, y - x + (WINDOW - 1)).astype(np.int64))
                size += int(off[i + 1] - off[i])
                if size >= SEND_BYTES and docs:
                    yield send(docs, keys, sizes)
                    docs, keys, sizes, size = [], [], [], 0
        if docs:
            yield send(docs, keys, sizes)
    return run


def _column(table: pa.Table, name: str, kind) -> np.ndarray:
    parts = [np.frombuffer(_unpack(x), kind) for x in table.column(name).to_pylist()]
    return np.concatenate(parts) if parts else np.empty(0, kind)


def _shared(parts: int):
    """Answers by part of the documents: which keys of which documents are shared.

    Part -1 holds the hot keys, with their bytes in place of documents.
    """
    def run(table: pa.Table) -> pa.Table:
        hot = None
        docs, bucket = _column(table, "docs", np.int64), table.column("bucket")[0].as_py()
        if bucket < 0:
            keys = _column(table, "keys", np.uint64)
        else:
            keys = _column(table, "keys", np.uint32) | _U(bucket) << _U(32)
            many = _column(table, "many", np.uint8)
            order = np.lexsort((docs, keys))
            docs, keys, many = docs[order], keys[order], many[order]
            a, b = _groups(keys)
            size = np.add.reduceat(_column(table, "sizes", np.uint32)[order].astype(np.int64), a) * _SIZE_UNIT
            shared = (docs[a] != docs[b - 1]) | (np.maximum.reduceat(many, a) > 0)
            hot = shared & (size > HOT_KEY_BYTES)
            hot = pa.table({"part": pa.array([-1], pa.int64()), "docs": pa.array([_pack(size[hot])], pa.binary()),
                            "keys": pa.array([_pack(keys[a[hot]])], pa.binary())}) if hot.any() else None
            keep = np.repeat(shared, b - a) & (many == 0)   # senders know theirs
            docs, keys = docs[keep], keys[keep]
        answers = _by_part(parts, docs, keys=keys)
        return answers if hot is None else pa.concat_tables([answers, hot])
    return run


def _by_part(parts: int, docs: np.ndarray, **columns: np.ndarray) -> pa.Table:
    part = docs % parts
    order = np.argsort(part, kind="stable")
    docs, part = docs[order], part[order]
    columns = {k: v[order] for k, v in columns.items()}
    rows = list(zip(*_groups(part)))
    out = {"part": pa.array([int(part[a]) for a, _ in rows], pa.int64()),
           "docs": pa.array([_pack(docs[a:b]) for a, b in rows], pa.binary())}
    return pa.table(out | {k: pa.array([_pack(v[a:b]) for a, b in rows], pa.binary()) for k, v in columns.items()})


# -- 2: passages under shared keys -------------------------------------------

_PASSAGES = "bucket int, docs binary, copies binary, places binary, lengths binary, back binary, text binary"


def _in_order(ids: list, data: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int]]:
    """(doc_id, copy, row) by doc_id; copy numbers the texts that share a doc_id."""
    rows = defaultdict(list)
    for i, doc in enumerate(ids):
        if doc is not None:
            rows[doc].append(i)
    out = []
    for doc in sorted(rows):
        texts = [_digest(data[off[i]:off[i + 1]]) for i in rows[doc]] if len(rows[doc]) > 1 else [b""]
        number = {t: k for k, t in enumerate(sorted(set(texts)))}
        out += [(doc, number[t], i) for t, i in zip(texts, rows[doc])]
    return out


def _digest(text: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(text.tobytes())


#: Kinds of a passage's numbers; a text is under 4 GB.  With ``back``, a
#: string goes only if the equal one so far back in its text goes.
_KINDS = {"docs": np.int64, "copies": np.uint32, "places": np.uint32, "lengths": np.uint32, "back": np.uint32}


def _numbers(*columns) -> list[bytes]:
    return [_pack(np.array(x, kind)) for x, kind in zip(columns, _KINDS.values())]


def _read_numbers(table: pa.Table) -> list[np.ndarray]:
    return [_column(table, c, kind).astype(np.int64) for c, kind in _KINDS.items()]


def _strings(found: list, sort_buckets: int, string_buckets: int):
    """Rows that ask for the hot strings found, and the numbers of what is
    told: strings of a smaller document here, and repeats in one text."""
    hashes, docs, copies, places = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((places, copies, docs, hashes[:, 1], hashes[:, 0]))
    hashes, docs, copies, places = hashes[order], docs[order], copies[order], places[order]
    new = np.append(True, (hashes[1:] != hashes[:-1]).any(axis=1))
    least = docs[np.flatnonzero(new)][np.cumsum(new) - 1]
    later = docs > least
    head = new | np.append(True, (docs[1:] != docs[:-1]) | (copies[1:] != copies[:-1]))
    back = places - places[np.flatnonzero(head)][np.cumsum(head) - 1]
    ask, again = head & ~later, ~head & ~later
    told = [(docs[again], copies[again], places[again], np.full(again.sum(), WINDOW), back[again])]
    at = np.flatnonzero(later)
    at = at[np.lexsort((places[at], copies[at], docs[at]))]
    if len(at):                                         # neighbours as one span
        d, c, p = docs[at], copies[at], places[at]
        a, b = _groups(np.cumsum(np.append(True, (d[1:] != d[:-1]) | (c[1:] != c[:-1]) | (p[1:] != p[:-1] + 1))))
        told.append((d[a], c[a], p[a], b - a + (WINDOW - 1), np.zeros(len(a), np.int64)))
    hashes, docs, copies, places = hashes[ask], docs[ask], copies[ask], places[ask]
    to = sort_buckets + (hashes[:, 0] % _U(string_buckets)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    to, rows = to[order], []
    for a, b in zip(*_groups(to)):
        x = order[a:b]
        rows.append((int(to[a]), *_numbers(docs[x], copies[x], places[x], np.full(b - a, WINDOW), np.zeros(b - a)), _pack(hashes[x])))
    return rows, told


def _passages(buckets: int, sort_buckets: int, hot: np.ndarray, string_buckets: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        docs, keys = _column(right, "docs", np.int64), _column(right, "keys", np.uint64)
        order = np.lexsort((keys, docs))
        docs, keys = docs[order], keys[order]
        ids = left.column("doc_id").to_pylist()
        data, off = utf8(left.column("text"))
        view = memoryview(np.ascontiguousarray(data))
        # the passages found: arrays of places in the texts, and 128-bit hashes
        runs, digests, rows = [], bytearray(), []
        found, n_found = [], 0

        def strings():
            asked, known = _strings(found, sort_buckets, string_buckets)
            rows.extend(asked)
            rows.extend((-1 - int(left.column("part")[0].as_py()), *_numbers(*x), _pack(b"")) for x in known if len(x[0]))
        # a passage's smallest document first
        for doc, copy, i in _in_order(ids, data, off):
            a, b = np.searchsorted(docs, [doc, doc + 1])
            if a == b:
                continue
            mine, text = keys[a:b], data[off[i]:off[i + 1]]
            for k, x, y in key_runs(text, buckets):
                at = np.minimum(np.searchsorted(mine, k), len(mine) - 1)
                hit = np.flatnonzero(mine[at] == k)
                if not len(hit):
                    continue
                start, end = x[hit] + int(off[i]), y[hit] + (WINDOW - 1) + int(off[i])
                for p, q in zip(start.tolist(), end.tolist()):
                    digests += xxhash.xxh3_128_digest(view[p:q])
                to = ((k[hit] & _LOW) * _U(sort_buckets) >> _U(32)).astype(np.int64)
                if len(hot):
                    to[np.isin(k[hit], hot)] = -1
                runs.append((to, np.full(len(hit), doc, np.int64), np.full(len(hit), copy, np.uint32), start - int(off[i]), start, end - start))
        if runs:
            to, doc, copy, place, start, length = map(np.concatenate, zip(*runs))
            runs.clear()
            digest = np.frombuffer(digests, np.uint64).reshape(-1, 2)
            order = np.lexsort((digest[:, 1], digest[:, 0]))            # stable: equal passages stay by document
            new = np.append(True, (digest[order[1:]] != digest[order[:-1]]).any(axis=1))
            least = np.empty(len(order), np.int64)
            least[order] = doc[order[np.flatnonzero(new)]][np.cumsum(new) - 1]
            again = doc != least                                        # whole in a smaller document here
            if again.any():
                rows.append((-1 - int(left.column("part")[0].as_py()),
                             *_numbers(doc[again], copy[again], place[again], length[again], np.zeros(again.sum())), _pack(b"")))
            for j in np.flatnonzero(~again & (to < 0)):                 # of hot keys: string by string
                for f in range(0, int(length[j]) - (WINDOW - 1), HOT_STRINGS):
                    n, p = min(HOT_STRINGS, int(length[j]) - (WINDOW - 1) - f), int(start[j]) + f
                    hashes = b"".join(xxhash.xxh3_128_digest(view[p + e:p + e + WINDOW]) for e in range(n))
                    found.append((np.frombuffer(hashes, np.uint64).reshape(-1, 2), np.full(n, doc[j], np.int64),
                                  np.full(n, copy[j], np.int64), int(place[j]) + f + np.arange(n)))
                    n_found += n
                    if n_found >= HOT_STRINGS:
                        strings()
                        found, n_found = [], 0
            if found:
                strings()
            sent = np.flatnonzero(~again & (to >= 0))
            sent = sent[np.argsort(to[sent], kind="stable")]
            for a, b in zip(*_groups(to[sent])):
                x = sent[a:b]
                text = b"".join([view[p:p + n] for p, n in zip(start[x].tolist(), length[x].tolist())])
                rows.append((int(to[x[0]]), *_numbers(doc[x], copy[x], place[x], length[x], np.zeros(b - a)), _pack(text)))
        bucket, *blobs = zip(*rows) if rows else ([],) * 7
        return pa.table([pa.array(bucket, pa.int32()), *(pa.array(x, pa.binary()) for x in blobs)],
                        names=["bucket", *_KINDS, "text"])
    return run


# -- 3: classes of equal strings from suffix arrays --------------------------

def repeats(passages: list[bytes], least: np.ndarray) -> list[np.ndarray]:
    """For each distinct passage, with its smallest document: which of its
    50-byte strings are also in a passage with a smaller document."""
    text = np.frombuffer(b"".join(passages), np.uint8)
    lengths = np.array([len(p) for p in passages])
    bounds = np.append(0, np.cumsum(lengths))
    wanted = lengths - (WINDOW - 1)
    order = sort_suffixes(text, bounds, wanted, WINDOW)
    start, _ = _groups(np.cumsum(common_prefixes(text, order, WINDOW) < WINDOW))
    doc = np.repeat(least, lengths)
    smallest = np.repeat(np.minimum.reduceat(doc[order], start), np.diff(np.append(start, len(order))))
    gone = np.zeros(len(text), bool)
    gone[order] = smallest < doc[order]
    return [gone[a:a + n] for a, n in zip(bounds, wanted)]


def _spans(parts: int, sort_buckets: int):
    def run(table: pa.Table) -> pa.Table:
        docs, copies, places, lengths, back = _read_numbers(table)
        bucket = table.column("bucket")[0].as_py()
        if bucket < 0:
            return _spans_by_part(parts, docs, copies, places, lengths, back)
        if bucket >= sort_buckets:                      # hashes of hot strings
            hashes = _column(table, "text", np.uint64).reshape(-1, 2)
            order = np.lexsort((docs, hashes[:, 1], hashes[:, 0]))
            new = np.append(True, (hashes[order[1:]] != hashes[order[:-1]]).any(axis=1))
            later = order[docs[order] > docs[order[np.flatnonzero(new)]][np.cumsum(new) - 1]]
            return _spans_by_part(parts, *(x[later] for x in (docs, copies, places, lengths, back)))
        text = b"".join(map(_unpack, table.column("text").to_pylist()))
        ends = np.cumsum(lengths).tolist()
        number: dict[bytes, int] = {}
        which = np.array([number.setdefault(text[b - n:b], len(number)) for b, n in zip(ends, lengths.tolist())])
        least = np.full(len(number), np.iinfo(np.int64).max)
        np.minimum.at(least, which, docs)
        gone = repeats(list(number), least)
        whole = docs > least[which]                     # the passage itself is in a smaller document
        out = [np.stack([docs[whole], copies[whole], places[whole], lengths[whole]])]
        runs = {}
        for i in np.flatnonzero(~whole):
            w = which[i]
            if w not in runs:
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone[w], [0]]).astype(np.int8)))
                runs[w] = edge[::2], edge[1::2] - edge[::2] + (WINDOW - 1)
            a, n = runs[w]
            if len(a):
                out.append(np.stack([np.full(len(a), docs[i]), np.full(len(a), copies[i]), places[i] + a, n]))
        out = np.concatenate(out, axis=1)
        return _spans_by_part(parts, *out, np.zeros(out.shape[1], np.int64))
    return run


def _spans_by_part(parts: int, docs, *numbers) -> pa.Table:
    return _by_part(parts, docs, **{c: x.astype(_KINDS[c]) for c, x in zip(list(_KINDS)[1:], numbers)})


# -- 4: cutting ---------------------------------------------------------------

_CUT = {"n_bytes": (pa.int64(), "bigint"), "n_removed": (pa.int64(), "bigint"), "n_spans": (pa.int64(), "bigint"),
        "kept_sha256": (pa.string(), "string"), "kept": (pa.binary(), "binary"), "kept_text": (pa.string(), "string")}


def _cut(outputs: list[str]):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        docs, copies, places, lengths, back = _read_numbers(right)
        order = np.lexsort((places, docs))
        docs, copies, places, lengths, back = (x[order] for x in (docs, copies, places, lengths, back))
        data, off = utf8(left.column("text"))
        ids = left.column("doc_id").to_pylist()
        copy_of = {i: copy for _, copy, i in _in_order(ids, data, off)}
        rows: dict[str, list] = {c: [] for c in _CUT}
        for i, doc in enumerate(ids):
            text = data[off[i]:off[i + 1]]
            edges = np.zeros(len(text) + 1, np.int64)
            if doc is not None:
                a, b = np.searchsorted(docs, [doc, doc + 1])
                own = a + np.flatnonzero(copies[a:b] == copy_of[i])
                if back[own].any():
                    first = own[(back[own] == 0) & (lengths[own] == WINDOW)]
                    own = own[(back[own] == 0) | np.isin(places[own] - back[own], places[first])]
                np.add.at(edges, places[own], 1)
                np.add.at(edges, places[own] + lengths[own], -1)
            gone = np.cumsum(edges)[:-1] > 0
            kept = text[~gone].tobytes()
            rows["n_bytes"].append(len(text))
            rows["n_removed"].append(int(gone.sum()))
            rows["n_spans"].append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
            rows["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            if "kept" in outputs:
                rows["kept"].append(kept)
            if "kept_text" in outputs:
                rows["kept_text"].append(kept.decode("utf-8", "ignore"))
        carried = {c: left.column(c) for c in left.column_names if c not in ("doc_id", "text", "part")}
        return pa.table({"doc_id": left.column("doc_id")} | {c: pa.array(rows[c], _CUT[c][0]) for c in outputs} | carried)
    return run


def _prime(n: int) -> int:
    """The smallest prime from n on (ids in steps then still spread)."""
    while any(n % k == 0 for k in range(2, int(n ** 0.5) + 1)):
        n += 1
    return n


def remove_repeats(docs: DataFrame, keep: str | None = "kept", carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) for each row.

    ``kept`` holds the remaining bytes; with ``keep="kept_text"`` a column
    of this name has them as text, without characters that were cut apart,
    and ``keep=None`` gives neither.  ``carry`` names other columns of
    ``docs`` to take along.
    """
    carried = [F.col(c).alias(f"carried_{c}") for c in carry]
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *carried)
    total = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = LEAST_BUCKETS + int(total) // KEY_BUCKET_BYTES
    sort_buckets = LEAST_BUCKETS + int(total) // SORT_BUCKET_BYTES
    parts = _prime(LEAST_BUCKETS + int(total) // PART_BYTES)

    asked = docs.select("doc_id", "text").mapInArrow(tidy_batches(_ask(buckets)), _ASK)
    shared = written(asked.groupBy("bucket").applyInArrow(tidy(_shared(parts)), "part bigint, docs binary, keys binary"), "shared")
    over = [(_unpack(r["docs"]), _unpack(r["keys"])) for r in shared.where("part = -1").select("docs", "keys").collect()]
    hot = np.sort(np.frombuffer(b"".join(k for _, k in over), np.uint64))
    hot_bytes = int(np.frombuffer(b"".join(n for n, _ in over), np.int64).sum())
    # about eight bytes of hashes and numbers for one of a passage
    string_buckets = min(sort_buckets, LEAST_BUCKETS + 8 * hot_bytes // KEY_BUCKET_BYTES)
    # rows without a doc_id repeat nothing: dealt out by their text
    part = F.coalesce(F.pmod("doc_id", F.lit(parts)), F.pmod(F.xxhash64("text"), F.lit(parts)))
    # one exchange of the texts serves both uses
    dealt = docs.withColumn("part", part.cast("bigint"))
    passages = dealt.groupBy("part").cogroup(shared.where("part >= 0").groupBy("part")).applyInArrow(
        tidy_pair(_passages(buckets, sort_buckets, hot, string_buckets)), _PASSAGES)
    spans = passages.groupBy("bucket").applyInArrow(
        tidy(_spans(parts, sort_buckets)), "part bigint, docs binary, copies binary, places binary, lengths binary, back binary")
    outputs = [c for c in _CUT if c not in ("kept", "kept_text") or c == keep]
    kinds = "".join(f", {f.name} {f.dataType.simpleString()}" for f in dealt.schema if f.name.startswith("carried_"))
    schema = "doc_id bigint" + "".join(f", {c} {_CUT[c][1]}" for c in outputs) + kinds
    cut = dealt.groupBy("part").cogroup(spans.groupBy("part")).applyInArrow(tidy_pair(_cut(outputs)), schema)
    return cut.select("doc_id", *outputs, *[F.col(f"carried_{c}").alias(c) for c in carry])
