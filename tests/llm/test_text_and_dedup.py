"""Words, near-duplicates, repeated passages and leaks against brute force."""
import hashlib
import math
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMOKE
from pyspark.sql import functions as F

from eddy.llm import decontamination, minhash_dedup, suffix_dedup
from eddy.llm.graph import components
from eddy.llm.suffixes import common_prefixes, sort_suffixes
from eddy.llm.textarrays import grams, shingles, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, root long, n_shingles string, part int, set_key int"     # clashing names


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def sets_of(t, n=5):
    w = WORD.findall(lower(t))
    if not w:
        return set()
    n = min(n, len(w))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def rows(pairs):
    return [(d, t, 1, "x", 2, 3) for d, t in pairs]


def edited(rng, words, k):
    out = list(words)
    for i in rng.sample(range(len(out)), k):
        out[i] = f"new{rng.random():.6f}"
    return " ".join(out)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    base = [f"w{rng.randrange(3000)}" for _ in range(400)]
    docs = [(100 + i, edited(rng, base, k % 30)) for i, k in enumerate(range(40))]
    passage = " ".join(f"p{rng.randrange(999)}" for _ in range(60))
    docs += [(200 + i, " ".join(f"q{rng.randrange(9999)}" for _ in range(30)) + " " + passage) for i in range(5)]
    docs += [(300, None), (301, ""), (302, " \t\n"), (303, "one two"), (304, "One TWO"), (305, "one two three four five"),
             (306, "la " * 4000), (307, "la " * 3000), (308, "ÄÖ ü " * 50), (309, "äö ü " * 50),
             (None, " ".join(base)), (310, " ".join(base)), (310, " ".join(base)), (311, "x" * 5000), (312, "x" * 4000)]
    return docs


def test_words_and_shingles_match_plain_python(corpus):
    col = pa.array([t for _, t in corpus] + ["\x0b a\x0cb\r\n", "é\u00a0è \u2003x", "a" * 3_000_000 + " b"])
    seen = {}
    for i, h in texts(col, lower=True):
        words = WORD.findall(lower(col[i].as_py()))
        assert len(h) == len(words)
        for w, x in zip(words, h.tolist()):
            assert seen.setdefault(w, x) == x
        assert len(shingles(h)) == len(sets_of(col[i].as_py()))
    assert len(set(seen.values())) == len(seen)
    assert len(grams(np.arange(3, dtype=np.uint64), 5)) == 0
    data = pa.array(["skip me", "keep this", None])[1:]                  # a slice of a column
    assert [len(h) for _, h in texts(data)] == [2, 0]


def brute_classes(docs):
    by_id = defaultdict(set)
    groups = [(d, sets_of(t)) for d, t in docs]
    parent = {d: d for d, _ in docs if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, (a, s) in enumerate(groups):
        for b, u in groups[:i]:
            if a is None or b is None or not s or not u:
                continue
            both = len(s & u)
            if 100 * both >= 75 * (len(s) + len(u) - both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return sorted(((d, len(s), None if d is None else find(d), d is None or find(d) == d) for d, s in groups), key=str)


def test_near_duplicates_match_brute_force(spark, corpus):
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows(corpus), SCHEMA).repartition(4))
    assert sorted(map(tuple, got.collect()), key=str) == brute_classes(corpus)


def test_near_duplicates_of_a_cluster_cut_into_blocks(spark, corpus, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BLOCK_DOCS", 7)
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows(corpus), SCHEMA))
    assert sorted(map(tuple, got.collect()), key=str) == brute_classes(corpus)


def test_near_duplicates_of_ids_with_several_texts(spark):
    rng = random.Random(3)
    a, b, c, d = (" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(80)) for _ in range(4))
    docs = [(5, a), (9, a), (9, b), (9, c), (3, c + " z"), (12, b + " y"), (20, ""), (20, a + " v"), (20, None),
            (30, d), (30, d + " x"), (31, d), (40, "one two"), (40, ""), (41, "three"), (41, "four"), (None, a), (None, d)]
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows(docs), SCHEMA).repartition(3))
    assert sorted(map(tuple, got.collect()), key=str) == brute_classes(docs)


def test_near_duplicates_of_documents(spark):
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    got = minhash_dedup.near_duplicates(docs)
    assert sorted(map(tuple, got.collect()), key=str) == brute_classes([(r.doc_id, r.text) for r in docs.collect()])


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert minhash_dedup.near_duplicates(docs).count() == 0
    assert suffix_dedup.remove_repeats(docs).count() == 0
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contaminated(docs, items).count() == 0


def test_registers_keep_zeros_and_mantissa():
    one = np.array([1 << 40], np.uint64)
    minima = (one[None, :] * minhash_dedup._MULTIPLIERS[:, None]).min(axis=1)
    for r, v in zip(minhash_dedup.registers(one).tolist(), minima.tolist()):
        zeros = 64 - v.bit_length()
        assert r >> 10 == zeros
        assert r & 1023 == (v << zeros >> 53) & 1023


def test_estimates_are_close_and_collision_corrected():
    rng = np.random.default_rng(8)
    for shared in (0, 500, 900):
        a = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
        b = np.concatenate([a[:shared], rng.integers(0, 1 << 63, 1000 - shared, dtype=np.uint64)])
        ra, rb = minhash_dedup.registers(np.sort(a)), minhash_dedup.registers(np.sort(b))
        got = minhash_dedup.estimates(ra[None, :], rb, np.array([1000]), 1000)[0]
        assert abs(got - shared / (2000 - shared)) < 0.15


def test_estimates_lose_fewer_pairs_than_bands():
    n, t = minhash_dedup.BUCKETS, 0.75
    one = np.arange(n, dtype=np.uint16)
    passed = []
    for k in range(n + 1):
        other = np.where(np.arange(n) < k, one, one + 1000).astype(np.uint16)
        passed.append(minhash_dedup.estimates(other[None], one, np.array([700]), 700)[0] < t - minhash_dedup.MARGIN)
    lost = sum(math.comb(n, k) * t ** k * (1 - t) ** (n - k) for k in range(n + 1) if passed[k])
    assert lost < (1 - t ** minhash_dedup.ROWS) ** minhash_dedup.BANDS
    # a pair at 600 / 800 with few equal registers is still judged on the sets
    other = np.where(np.arange(n) < 92, one, one + 1000).astype(np.uint16)
    sets = [np.arange(a, a + 700, dtype=np.uint64) for a in (0, 100)]
    assert len(minhash_dedup.confirmed_links(np.array([1, 2]), np.stack([one, other]), sets)) == 1


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(1, 60)] + [(1000, x) for x in range(1001, 1100)] + [(5000, 5000)]
    edges += [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}


@pytest.mark.parametrize("seed", range(40))
def test_suffix_sorting(seed):
    rng = random.Random(seed)
    depth, k = rng.choice([3, 9, 50]), rng.randint(1, 6)
    letters = rng.choice([b"a", b"ab", b"abc", bytes(range(256))])
    strings = [bytes(rng.choice(letters) for _ in range(rng.randint(depth, depth + 60))) for _ in range(k)]
    strings[-1] = strings[0]
    wanted = np.array([rng.randint(1, len(s) - depth + 1) for s in strings])
    text, bounds = np.frombuffer(b"".join(strings), np.uint8), np.append(0, np.cumsum([len(s) for s in strings]))
    order = sort_suffixes(text, bounds, wanted, depth)
    assert sorted(order.tolist()) == [int(b) + j for b, n in zip(bounds, wanted) for j in range(n)]
    found = [text.tobytes()[p:p + depth] for p in order]
    assert found == sorted(found)
    for a, b, n in zip(found, found[1:], common_prefixes(text, order, depth)[1:]):
        assert a[:n] == b[:n] and (n == depth or a[n] != b[n])


def brute_repeats(docs):
    first, out = {}, []
    raw = [(d, (t or "").encode()) for d, t in docs]
    for d, b in raw:
        for i in range(len(b) - 49) if d is not None else ():
            first[b[i:i + 50]] = min(d, first.get(b[i:i + 50], d))
    for d, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - 49) if d is not None else ():
            if first[b[i:i + 50]] < d:
                gone[i:i + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out, key=str)


def check_repeats(spark, docs, df):
    got = sorted((tuple(r[:5]) + (bytes(r[5]),) for r in suffix_dedup.remove_repeats(df).collect()), key=str)
    assert got == brute_repeats(docs)


def test_repeats_match_brute_force(spark, corpus):
    odd = [(1, "abc " * 300), (1, "abc " * 300 + "x"), (2, "abc " * 300), (7, "b" * 99 + "ü" * 60), (8, "ü" * 80), (8, "ü" * 80)]
    check_repeats(spark, corpus + odd, spark.createDataFrame(rows(corpus + odd), SCHEMA).repartition(5))


def test_repeats_in_many_small_senders(spark, corpus, monkeypatch):
    for name, value in (("SEND_BYTES", 2000), ("STEP_BYTES", 300), ("PART_BYTES", 3000)):
        monkeypatch.setattr(suffix_dedup, name, value)
    check_repeats(spark, corpus, spark.createDataFrame(rows(corpus), SCHEMA).repartition(3))


def test_repeats_of_a_line_in_every_document(spark, monkeypatch):
    rng = random.Random(6)
    line, other = ("".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (90, 600))
    docs = [(rng.randrange(10 ** 6), "".join(rng.choice("klmnopqr ") for _ in range(rng.randint(50, 90))) + line
             + "".join(rng.choice("klmnopqr ") for _ in range(60)) + "-" * (i % 200)) for i in range(300)]
    docs += [(docs[0][0], line + line + "x"), (docs[1][0], "ab" * 150 + line), (docs[2][0], "ab" * 100), (2 * 10 ** 6, other)]
    for name, value in (("HOT_KEY_BYTES", 1500), ("SORT_BUCKET_BYTES", 500), ("KEY_BUCKET_BYTES", 500), ("PART_BYTES", 9000), ("SEND_BYTES", 9000)):
        monkeypatch.setattr(suffix_dedup, name, value, raising=False)
    spans = suffix_dedup._spans

    def bounded(*sizes):
        run = spans(*sizes)

        def checked(table):
            held = sum(int.from_bytes(x[:8], "little") for x in table.column("text").to_pylist())
            assert table.column("bucket")[0].as_py() < 0 or held < 10_000, held
            return run(table)
        return checked
    monkeypatch.setattr(suffix_dedup, "_spans", bounded)
    check_repeats(spark, docs, spark.createDataFrame(rows(docs), SCHEMA).repartition(4))


def test_repeats_with_every_key_hot(spark, corpus, monkeypatch):
    for name, value in (("HOT_KEY_BYTES", 0), ("HOT_STRINGS", 200), ("PART_BYTES", 3000)):
        monkeypatch.setattr(suffix_dedup, name, value, raising=False)
    odd = [(1, "abc " * 300), (1, "abc " * 300 + "x"), (2, "abc " * 300), (7, "b" * 99 + "ü" * 60), (8, "ü" * 80), (8, "ü" * 80)]
    check_repeats(spark, corpus + odd, spark.createDataFrame(rows(corpus + odd), SCHEMA).repartition(5))


def test_repeats_of_documents(spark):
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    check_repeats(spark, [(r.doc_id, r.text) for r in docs.collect()], docs)


def test_repeats_carry_other_columns_and_cut_text(spark):
    docs = spark.createDataFrame([(1, "ü" * 40, "de", 5), (2, "x" + "ü" * 40, None, 6)], "doc_id long, text string, lang string, part int")
    got = sorted(map(tuple, suffix_dedup.remove_repeats(docs, keep="kept_text", carry=("lang", "part")).select("doc_id", "kept_text", "lang", "part").collect()))
    assert got == [(1, "ü" * 40, "de", 5), (2, "x", None, 6)]


def test_contaminated_matches_brute_force(spark, corpus):
    rng = random.Random(9)
    long_words = [f"z{rng.randrange(10 ** 6)}" for _ in range(5000)]
    items = [(1, " ".join(long_words[700:730])), (2, "  ".join(long_words[100:140]).upper()), (3, edited(rng, long_words[2000:2060], 2)),
             (4, edited(rng, long_words[3000:3040], 8)), (5, "la la la"), (6, "one"), (7, ""), (8, None), (9, "ÄÖ ü"), (9, "ÄÖ ü"),
             (None, "one two"), (10, " ".join(long_words[10:20] + long_words[4000:4010]))]
    docs = corpus + [(900, " ".join(long_words))]
    got = decontamination.contaminated(spark.createDataFrame(rows(docs), SCHEMA),
                                       spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string"))
    want = set()
    for d, t in docs:
        words = WORD.findall(lower(t))
        for i, item in items:
            s = sets_of(item)
            if d is None or i is None or not s:
                continue
            n = len(next(iter(s)))
            own = {tuple(words[k:k + n]) for k in range(len(words) - n + 1)}
            if 4 * len(s & own) >= 3 * len(s):
                want.add((d, i, len(s), len(s & own)))
    assert set(map(tuple, got.collect())) == want and got.count() == len(want)
    blocks = decontamination.contaminated(spark.createDataFrame(rows(docs), SCHEMA),
                                          spark.createDataFrame(items, "item_id long, text string"), block_bytes=200)
    assert set(map(tuple, blocks.collect())) == want
