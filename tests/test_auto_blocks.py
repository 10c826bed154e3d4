"""Small blocks: every operator gives the sequential result across block edges."""
import sim
from eddy.operators import holdings, timeout
from test_holdings import frames, random_streams
from test_timeout import SIDED, random_tx


def test_small_blocks_of_holdings(spark):
    own, nav = random_streams(11)
    o, n = frames(spark, own, nav)
    got = {(r["nav_id"], r["user_id"], r["seq"]): r["holding"]
           for r in holdings.running_holdings(o, block_rows=16).collect()}
    assert got == sim.running_holdings(own)
    assert sorted(tuple(r) for r in holdings.portfolio_valuation(o, n, block_rows=16, price_chunk=3).collect()) == \
        sim.portfolio(own, nav)
    assert sorted(tuple(r) for r in holdings.lot_valuation(o, n, block_rows=16, chunk=5, price_chunk=4).collect()) == \
        sim.lots(own, nav)


def test_many_ranges_of_timeouts(spark):
    rows = random_tx(12)
    df = spark.createDataFrame(rows, SIDED)
    triples = [(k, t, i) for k, t, i, _, _ in rows]
    for blocks in (1, 13):
        got = sorted(tuple(r)[:3] for r in timeout.timeout_toggle(df, 30, blocks=blocks).collect())
        assert got == sim.toggle(triples, 30)
        got = sorted(tuple(r)[:3] for r in timeout.timeout_clean(df, 30, blocks=blocks).collect())
        assert got == sim.clean(triples, 30)
        got = sorted((r[0], r[1], r[2], r[3]) for r in timeout.timeout_sided(df, 30, blocks=blocks).collect())
        assert got == sim.sided([(k, t, i, s) for k, t, i, _, s in rows], 30)
