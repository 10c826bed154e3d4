"""Property tests: blocked scans and timeouts equal the sequential rules for
random inputs, skews, ttls and blocks (few examples: each runs Spark)."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eddy.operators import timeout
from eddy.operators.scan import Prefix, by_splitters, prefix_scan
import sim

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture,
                                           HealthCheck.too_slow])

arrival = st.tuples(st.integers(0, 3), st.integers(0, 60), st.sampled_from(["debit", "credit"]))


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 2), st.integers(-5, 5)), min_size=1, max_size=60),
       width=st.integers(1, 20))
def test_prefix_scan_property(spark, rows, width):
    data = [(k, i, v) for i, (k, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k long, seq long, v long")
    got = {r["seq"]: (r["s"], r["m"]) for r in prefix_scan(
        by_splitters(df, ["k"], ["seq"], block_rows=width), ["seq"],
        [Prefix("s", F.col("v")), Prefix("m", F.col("v"), op="min")]).collect()}
    acc, mn, exp = {}, {}, {}
    for k, i, v in data:
        acc[k] = acc.get(k, 0) + v
        mn[k] = min(mn.get(k, v), v)
        exp[i] = (acc[k], mn[k])
    assert got == exp


@SETTINGS
@given(rows=st.lists(arrival, min_size=1, max_size=50), ttl=st.integers(0, 20),
       blocks=st.one_of(st.none(), st.integers(1, 9)))
def test_timeouts_property(spark, rows, ttl, blocks):
    data = [(k, t, i, f"{i}", s) for i, (k, t, s) in enumerate(rows)]
    df = spark.createDataFrame(data, "trans_id long, ts_us long, event_id long, amount string, "
                                     "side string")
    triples = [(k, t, i) for k, t, i, _, _ in data]
    got = sorted(tuple(r)[:3] for r in timeout.timeout_toggle(df, ttl, blocks=blocks).collect())
    assert got == sim.toggle(triples, ttl)
    got = sorted(tuple(r)[:3] for r in timeout.timeout_clean(df, ttl, blocks=blocks).collect())
    assert got == sim.clean(triples, ttl)
    got = sorted(tuple(r)[:4] for r in timeout.timeout_sided(df, ttl, blocks=blocks).collect())
    assert got == sim.sided([(k, t, i, s) for k, t, i, _, s in data], ttl)
