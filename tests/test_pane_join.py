"""The batch window join by panes against windows written out row by row."""
import random

import pytest
from pyspark.sql import functions as F

from eddy.operators.windowjoin import nav_holder_join, salted_window_join, window_start_us

SECOND = 1_000_000


def brute(nav, own, size, slide):
    out = []
    for n, v, s, t in nav:
        for m, u, q, r in own:
            if n == m and n is not None and t is not None and r is not None:
                first, last = (max(t, r) - size) // slide + 1, min(t, r) // slide
                out += [(n, u, v, w * slide, s, q) for w in range(first, last + 1)]
    return sorted(out)


def sides(seed, span):
    rng = random.Random(seed)

    def time():
        return None if rng.random() < 0.03 else rng.choice([rng.randrange(-span, span), rng.randrange(-3, 4) * SECOND, rng.randrange(50)])
    nav = [(rng.choice([1, 1, 1, 2, None]), i, i, time()) for i in range(80)]
    own = [(rng.choice([1, 1, 1, 2, 3]), i % 9, i, time()) for i in range(70)]
    return nav, own


def frames(spark, nav, own):
    n = spark.createDataFrame(nav, "nav_id long, unit_value long, seq long, us long")
    o = spark.createDataFrame(own, "nav_id long, user_id long, seq long, us long")
    return [x.withColumn("ts", F.timestamp_micros("us")).drop("us") for x in (n, o)]


@pytest.mark.parametrize("size,slide", [(60, 1), (2, 1), (5, 2), (3, 3), (1, 4)])
def test_pane_join_equals_windows_written_out(spark, size, slide):
    nav, own = sides(size, 40 * SECOND)
    got = nav_holder_join(*frames(spark, nav, own), f"{size} seconds", f"{slide} seconds")
    want = brute(nav, own, size * SECOND, slide * SECOND)
    assert sorted(map(tuple, got.collect())) == want and want


def test_rows_are_not_multiplied_before_the_join(spark):
    """At 60 windows a row, the join reads each left row once and a right row at most twice."""
    nav, own = frames(spark, *sides(9, 4000 * SECOND))
    plan = nav_holder_join(nav, own, "60 seconds", "1 second")._jdf.queryExecution()
    text = plan.optimizedPlan().toString()
    assert "Expand" not in text
    below = text[text.index("Join Inner"):]
    assert below.count("Generate") == 1 and "_pane" in below


def test_salted_join_equals_panes(spark):
    nav, own = frames(spark, *sides(4, 20 * SECOND))
    j = salted_window_join(nav, own, "nav_id", "nav_id", "ts", "ts", "6 seconds", "2 seconds", "seq", 3)
    got = j.select("l.nav_id", "r.user_id", "l.unit_value", window_start_us("l.window"), "l.seq", "r.seq")
    want = nav_holder_join(nav, own, "6 seconds", "2 seconds")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
