"""The n-gram Jaccard join against brute force."""
import random

import numpy as np
import pyarrow as pa
import pytest
from test_text_and_dedup import rows, sets_of, SCHEMA

from eddy.llm import partition_join as J
from eddy.llm.textarrays import mix


def edited(rng, words, k):
    out = list(words)
    for i in rng.sample(range(len(out)), k):
        out[i] = f"new{rng.random():.6f}"
    return " ".join(out)


def corpus():
    rng = random.Random(11)
    docs = []
    for n, size in ((60, 120), (25, 400), (25, 35), (20, 14), (6, 3000)):      # near copies around the threshold
        base = [f"w{rng.randrange(5000)}" for _ in range(size)]
        for i in range(n):
            docs.append((len(docs), edited(rng, base, rng.randrange(0, max(2, size // 14)))))
    passage = " ".join(f"p{rng.randrange(999)}" for _ in range(90))
    docs += [(1000 + i, passage + " " + " ".join(f"q{rng.randrange(9999)}" for _ in range(rng.randrange(30)))) for i in range(60)]
    tail = [f"t{rng.randrange(999)}" for _ in range(200)]
    docs += [(2000 + i, " ".join(tail[:150 + i])) for i in range(50)]              # prefixes: sizes drift over a band's edge
    docs += [(3000, None), (3001, ""), (3002, " \t\n"), (3003, "one two"), (3004, "One TWO"), (3005, "one two three"), (3006, "one"),
             (3007, "la " * 4000), (3008, "la " * 3000), (3009, "x" * 5000), (3010, "ÄÖ ü " * 50), (3011, "äö ü " * 50),
             (None, passage), (None, None), (3012, passage), (3012, passage), (3012, "other text of this id here"), (3013, "other text of this id here"),
             (3014, " ".join(f"l{i}" for i in range(60_000))), (3015, " ".join(f"l{i}" for i in range(500, 60_000)))]
    return docs


def brute(docs):
    sets = [sets_of(t, 3) for _, t in docs]
    root = {d: d for d, _ in docs if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, (a, _) in enumerate(docs):
        for j in range(i):
            b, x, y = docs[j][0], sets[i], sets[j]
            if a is None or b is None or not x or not y or min(len(x), len(y)) * 100 < max(len(x), len(y)) * 90:
                continue
            common = len(x & y)
            if 100 * common >= 90 * (len(x) + len(y) - common):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return sorted(((d, len(s), d if d is None else find(d)) for (d, _), s in zip(docs, sets)), key=str)


@pytest.fixture(scope="module")
def expected():
    docs = corpus()
    return docs, brute(docs)


@pytest.mark.parametrize("limits", [{}, {"COSTLY": 1, "NEAR_EVERY": 2, "HEAD_SHINGLES": 500, "BLOCK_DOCS": 7, "BLOCK_SHINGLES": 4000}])
def test_classes_equal_brute_force(spark, monkeypatch, expected, limits):
    for k, v in limits.items():
        monkeypatch.setattr(J, k, v)
    docs, want = expected
    got = sorted(map(tuple, J.join_classes(spark.createDataFrame(rows(docs), SCHEMA)).collect()), key=str)
    assert got == want
    assert len({c for _, _, c in want}) > 100


def test_empty_table(spark):
    assert J.join_classes(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_linked_pair_is_lost_by_any_allocation():
    """Sets that differ as much as they may share a signature, whatever segments are skipped."""
    rng = np.random.Generator(np.random.PCG64(3))
    for _ in range(300):
        s = int(rng.integers(10, 900))
        r = int(rng.integers(-(-9 * s // 10), s + 1))
        d = J.most(r, s)
        d -= (d - (s - r)) % 2
        only_s = (d + s - r) // 2
        pool = np.unique(mix(rng.integers(0, 1 << 62, 3000, dtype=np.uint64)))
        rng.shuffle(pool)
        big, small = np.sort(pool[:s]), np.sort(pool[only_s:only_s + r])
        assert J._linked(np.intersect1d(big, small).size, r, s)
        band = J.bands_of(r)[0][0] if J.bands_of(r) else None
        if band is None:
            continue
        need = dict(J.bands_of(s))[band]
        mine, near = J.signatures(big, band)
        theirs, their_near = J.signatures(small, band)
        wide = int(rng.integers(0, len(near) + 1))      # neighbourhoods that the larger set looks up
        units = np.ones(len(mine), int)
        units[:wide * J.NEAR_EVERY:J.NEAR_EVERY] = 2
        single = rng.permutation(np.flatnonzero(units == 1))
        units[single[:max(0, units.sum() - need)]] = 0
        assert units.sum() >= need
        assert any(mine[i] == theirs[i] for i in np.flatnonzero(units)) or any(
            theirs[j * J.NEAR_EVERY] in near[j] or mine[j * J.NEAR_EVERY] in their_near[j] for j in range(wide))


def test_parities_never_pass_over_a_linked_pair():
    rng = np.random.Generator(np.random.PCG64(4))
    for size in (10, 70, 700, 9000):
        base = rng.integers(0, 1 << 63, 2 * size, dtype=np.uint64)
        sets = [np.unique(np.append(base[:size], rng.integers(0, 1 << 63, int(k), dtype=np.uint64))) for k in rng.integers(0, size // 8 + 2, 30)]
        ids, sizes = np.arange(30), np.array([len(s) for s in sets])
        want = {(i, j) for i in ids for j in ids if i < j and J._linked(np.intersect1d(sets[i], sets[j]).size, sizes[i], sizes[j])}
        words = [J.parity(s) for s in sets]
        got = {(min(p), max(p)) for p in J.near_pairs(ids, words, sizes, np.arange(30))}
        assert want <= got and len(got) <= 1.2 * len(want) + 5
        assert not J.near_pairs(ids, words, sizes, np.zeros(30, int))
        across = {(min(p), max(p)) for p in J.near_pairs(ids, words, sizes, np.arange(30), ids % 2)}
        assert across == {p for p in got if p[0] % 2 != p[1] % 2}
    assert (J.folded(J.parity(sets[0]), 4) == J.folded(J.folded(J.parity(sets[0]), 64), 4)).all()


def test_full_sets_meet_only_heads_they_may_link_with(spark, monkeypatch):
    """Sets that share a signature with its head, but are far from it, are passed over by parities."""
    rng = random.Random(5)
    base = [f"b{rng.randrange(5000)}" for _ in range(300)]
    docs = [(i, edited(rng, base, 1 if i % 10 == 0 else 25)) for i in range(60)]
    size, write = {}, J.written

    def counted(df, name="table", *partition_by):
        table = write(df, name, *partition_by)
        size[name] = table.count()
        return table
    monkeypatch.setattr(J, "written", counted)
    got = sorted(map(tuple, J.join_classes(spark.createDataFrame(rows(docs), SCHEMA)).collect()), key=str)
    assert got == brute(docs)
    assert size["first-links"] >= 5
    assert size["first-links"] <= size["near-heads"] <= size["heads"] / 3


def test_parities_keep_all_links_with_a_head():
    rng = np.random.Generator(np.random.PCG64(8))
    for size in (10, 70, 700, 9000):
        base = rng.integers(0, 1 << 63, 2 * size, dtype=np.uint64)
        sets = [np.unique(np.append(base[:size], rng.integers(0, 1 << 63, int(k), dtype=np.uint64))) for k in rng.integers(0, size // 4 + 2, 40)]
        ids = [0, 0, *range(1, 39)]                       # the head's id has two texts
        near = J._near_head(pa.table({"head": [0] * 40, "doc_id": ids, "n": [len(s) for s in sets], "parity": [J.parity(s).tobytes() for s in sets]}))
        want = {ids[i] for i in range(2, 40) for h in (0, 1) if J._linked(np.intersect1d(sets[h], sets[i]).size, len(sets[h]), len(sets[i]))}
        assert want <= set(near.column("rep").to_pylist()) <= set(ids[2:])
        assert near.num_rows <= 1.2 * len(want) + 5
