import random

from eddy.operators import timeout
import sim

TX = "trans_id long, ts_us long, event_id long, amount string"
SIDED = "trans_id long, ts_us long, event_id long, amount string, side string"


def random_tx(seed, n=250):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if rnd.random() < 0.35 else rnd.randint(1, 8)
        ts = rnd.randint(0, 400) * 5                     # many equal timestamps
        rows.append((key, ts, i, f"{i}.00", rnd.choice(["debit", "credit"])))
    return rows


def test_hand_case_sided(spark):
    rows = [(1, 0, 0, "a", "debit"), (2, 0, 1, "b", "debit"),
            (1, 3, 2, "c", "credit"), (9, 4, 3, "d", "credit")]
    df = spark.createDataFrame(rows, SIDED)
    got = sorted(r["trans_id"] for r in timeout.timeout_sided(df, 10).collect())
    assert got == [2, 9]


def test_toggle_vs_sequential(spark):
    for seed, ttl in ((1, 50), (2, 0), (3, 7)):
        rows = random_tx(seed)
        df = spark.createDataFrame([r[:4] for r in rows], TX)
        exp = sim.toggle([(k, t, i) for k, t, i, _, _ in rows], ttl)
        for blocks in (None, 7):
            got = sorted((r[0], r[1], r[2]) for r in
                         timeout.timeout_toggle(df, ttl, blocks=blocks).collect())
            assert got == exp, (seed, ttl, blocks)


def test_clean_vs_sequential(spark):
    for seed, ttl in ((4, 50), (5, 0), (6, 13)):
        rows = random_tx(seed)
        df = spark.createDataFrame([r[:4] for r in rows], TX)
        exp = sim.clean([(k, t, i) for k, t, i, _, _ in rows], ttl)
        for blocks in (None, 6):
            got = sorted((r[0], r[1], r[2]) for r in
                         timeout.timeout_clean(df, ttl, blocks=blocks).collect())
            assert got == exp, (seed, ttl, blocks)


def test_sided_vs_brute_force(spark):
    for seed, ttl in ((7, 20), (8, 0)):
        rows = random_tx(seed)
        df = spark.createDataFrame(rows, SIDED)
        exp = sim.sided([(k, t, i, s) for k, t, i, _, s in rows], ttl)
        for blocks in (None, 5):
            got = sorted((r["trans_id"], r["ts_us"], r["event_id"], r["side"]) for r in
                         timeout.timeout_sided(df, ttl, blocks=blocks).collect())
            assert got == exp, (seed, ttl, blocks)


def test_hand_case_all_modes(spark):
    """Debit ids 1, 2; credit ids 1, 9: only 2 and 9 time out, in every mode."""
    rows = [(1, 0, 0, "a", "debit"), (2, 0, 1, "b", "debit"),
            (1, 3, 2, "c", "credit"), (9, 4, 3, "d", "credit")]
    df = spark.createDataFrame(rows, SIDED)
    for fn in (timeout.timeout_toggle, timeout.timeout_clean, timeout.timeout_sided):
        assert sorted(r["trans_id"] for r in fn(df, 10).collect()) == [2, 9], fn.__name__
