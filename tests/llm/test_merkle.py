"""The Merkle manifest against a sequential version and its SQL."""
import hashlib
import tempfile
import zlib

import duckdb
import pytest

from eddy.llm import merkle_manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, tree int, seg binary"   # clashing names


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest(*last[i:i + 2]) for i in range(0, len(last), 2)])
    return levels


def way(levels, i):
    for level in levels[:-1]:
        yield i % 2, level[i ^ 1] if i ^ 1 < len(level) else ""
        i //= 2


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r[:5])
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    for x in langs:
        by[x].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r)))
    trees = [levels_of([leaf_of(*r) for r in by[x]]) for x in langs]
    top = levels_of([t[-1][0] for t in trees])
    for k, x in enumerate(langs):
        for i, r in enumerate(by[x]):
            path = [*way(trees[k], i), *way(top, k)]
            at = leaf_of(*r)
            if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                at = leaf_of(*r[:4], r[4] + 1)
            for right, sibling in path:
                at = digest(sibling, at) if right else digest(at, sibling)
            yield r[0], leaf_of(*r), trees[k][-1][0], top[-1][0], digest(*(s for _, s in path)), at, at == top[-1][0]


def rows(n):
    some = [(i, f"té {i}" * (i % 5), ["en", "de", "fr", None, ""][min(i % 7, 4)], f"s{i % 3}" if i % 11 else None, i if i % 13 else None) for i in range(n)]
    some += [(5, "x", "zz", None, 2), (None, "a", "en", "b", 2 ** 63 - 1), (None,) * 5, (7, "r", "en", "s", 1), (7, "r", "en", "s", 1),
             (7, "q", "en", "s", 1), (7, "y" * 2_000_000, "en", "s", 2 ** 63 - 1)]
    return [(*r, "x", 1, b"") for r in some]


@pytest.mark.parametrize("n", [600])
def test_proofs_equal_a_sequential_manifest(spark, n):
    df = spark.createDataFrame(rows(n), SCHEMA)
    got = sorted(map(tuple, merkle_manifest.verify(df).collect()), key=str)
    assert got == sorted(brute(rows(n)), key=str)
    assert 0 < sum(not r[-1] for r in got) < len(got) / 3


def test_sql_equals_a_sequential_manifest(spark):
    path = tempfile.mkdtemp(prefix="eddy-test-", dir="/tmp")
    spark.createDataFrame(rows(400), SCHEMA).write.parquet(f"{path}/documents")
    db = duckdb.connect()
    db.sql(f"create view documents as select * from read_parquet('{path}/documents/*.parquet')")
    assert sorted(db.sql(merkle_manifest.verify_sql()).fetchall(), key=str) == sorted(brute(rows(400)), key=str)


@pytest.mark.parametrize("langs", [[], [None], ["a", "b", "c", "c"]])
def test_small_trees(spark, langs):
    some = [(i, f"t{i}", x, "s", 1) for i, x in enumerate(langs)]
    df = spark.createDataFrame(some, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(map(tuple, merkle_manifest.verify(df).collect()), key=str) == sorted(brute(some), key=str)


def test_more_leaves_than_a_jump_joins_at_once(spark, monkeypatch):
    """With blocks of four, ancestors 8 levels up are repeated for each block of their nodes."""
    monkeypatch.setattr(merkle_manifest, "BLOCK_LEVELS", 2)
    some = [(i, f"t{i}", "en" if i % 9 else "de", "s", 1) for i in range(1100)]
    df = spark.createDataFrame(some, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(map(tuple, merkle_manifest.verify(df).collect()), key=str) == sorted(brute(some), key=str)
