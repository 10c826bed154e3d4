"""Text sources (S1, S2), arrival/event-time stamps (T1, T2), console (K1, K2), state."""
import os
import time
from collections import Counter

from pyspark.sql import functions as F

from eddy.functions import parse
from eddy.functions.time import with_event_time
from eddy.sinks.console import line, sync_label, to_console
from eddy.sources.text import read_lines, stream_lines
from eddy.streaming import jobs, runtime
from test_fixture_join import NAV_LINES, USER_LINES


def write_text(path, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.txt"), "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_read_lines_batch(spark, scratch):
    p = write_text(os.path.join(scratch, "nav"), NAV_LINES)
    df = read_lines(spark, p).select(parse.parse_nav_update("value").alias("p")).select("p.*")
    assert df.count() == 10 and df.agg(F.sum("unit_value")).first()[0] == 2653


def test_fixture_join_on_arrival_time_stream(spark, scratch):
    """Both files arrive in one micro-batch, so every row gets the same stamp."""
    nav_p = write_text(os.path.join(scratch, "nav"), NAV_LINES)
    user_p = write_text(os.path.join(scratch, "user"), USER_LINES)
    out = jobs.nav_user_join_job(stream_lines(spark, nav_p), stream_lines(spark, user_p))
    q = (out.writeStream.format("memory").queryName("fixture_t1")
         .option("checkpointLocation", os.path.join(scratch, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.table("fixture_t1").collect()
    assert len(got) == 36
    assert Counter(r["nav_id"] for r in got) == {123: 24, 345: 6, 678: 4, 910: 2}


def test_event_time_stamp(spark):
    df = spark.createDataFrame([(1, 1_700_000_000_123)], "trans_id long, timestamp long")
    out = with_event_time(df, "timestamp")
    assert out.schema["event_time"].dataType.simpleString() == "timestamp"
    assert out.select(F.unix_millis("event_time")).first()[0] == 1_700_000_000_123


def test_printed_lines():
    from pyspark.sql import Row
    assert line(Row(a=1, b=None, c="x")) == "(1,null,x)"
    assert line(Row(a=1), "sync_5") == "sync_5> (1)"


def test_printing_reaches_every_row(spark, scratch):
    """1,000 rows of one micro-batch all pass the writer (the CLI test reads the output)."""
    p = write_text(os.path.join(scratch, "x"), [str(i) for i in range(1000)])
    q = to_console(stream_lines(spark, p), label=sync_label(), checkpoint=os.path.join(scratch, "ck"))
    q.processAllAvailable()
    q.stop()
    assert q.exception() is None and sum(x["numInputRows"] for x in q.recentProgress) == 1000


def test_console_sink_and_state_reader(spark, scratch):
    p = write_text(os.path.join(scratch, "own"), ["123, 1, 10", "123, 2, 5", "123, 1, -3"])
    own = (stream_lines(spark, p)
           .select(parse.parse_ownership("value").alias("p"))
           .select(F.col("p.nav_id").alias("nav_id"), F.col("p.owning.user_id").alias("user_id"),
                   F.col("p.owning.share").alias("share")))
    label = sync_label()
    assert label.startswith("sync_")
    ck = os.path.join(scratch, "ck")
    q = (jobs.current_holdings(own).writeStream.format("console").outputMode("update")
         .queryName(label).option("checkpointLocation", ck)
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert q.name == label
    rep = runtime.state_report(q)
    assert rep and rep[0]["rows"] == 2
    state = runtime.read_state(spark, ck).collect()
    assert len(state) == 2


def test_to_console_helper_starts(spark, scratch):
    p = write_text(os.path.join(scratch, "x"), ["1, 2"])
    q = to_console(stream_lines(spark, p), label="k1",
                   checkpoint=os.path.join(scratch, "ck"))
    q.processAllAvailable()
    q.stop()
    assert q.lastProgress["numInputRows"] == 1


def test_portfolio_lines_job(spark, scratch):
    """D2 from lines: holdings arrive first, prices in a later micro-batch."""
    own_p = write_text(os.path.join(scratch, "own"), ["123, 1, 10", "123, 2, 5", "123, 1, -3"])
    nav_dir = os.path.join(scratch, "nav")
    os.makedirs(nav_dir)
    q = (jobs.portfolio_lines_job(stream_lines(spark, own_p), stream_lines(spark, nav_dir))
         .writeStream.format("memory").queryName("d2").option("checkpointLocation",
                                                             os.path.join(scratch, "ck"))
         .start())
    q.processAllAvailable()
    write_text(nav_dir, ["123, 101", "345, 7"])
    q.processAllAvailable()
    q.stop()
    got = sorted((r["user_id"], r["nav_id"], r["unit_value"], r["new_valuation"])
                 for r in spark.table("d2").collect())
    assert got == [(1, 123, 101, 707), (2, 123, 101, 505)]


def test_holdings_and_timeout_lines_jobs(spark, scratch):
    own_p = write_text(os.path.join(scratch, "own"), ["7, 1, 5", "7, 1, 2", "7, 2, 4"])
    q = (jobs.holdings_lines_job(stream_lines(spark, own_p)).writeStream.format("memory")
         .queryName("d3").option("checkpointLocation", os.path.join(scratch, "ck3"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    final = {}
    for r in spark.table("d3").collect():
        final[(r["nav_id"], r["user_id"])] = max(final.get((r["nav_id"], r["user_id"]), -99),
                                                 r["holding"])
    assert final == {(7, 1): 7, (7, 2): 4}
    deb = write_text(os.path.join(scratch, "deb"), ["1,1000,acct-1,5.00", "2,1000,acct-2,6.00"])
    cre = write_text(os.path.join(scratch, "cre"), ["1,1001,card-1,Ann,5.00",
                                                    "9,1001,card-9,Bob,7.00"])
    q = (jobs.timeout_lines_job(stream_lines(spark, deb), stream_lines(spark, cre), ttl_ms=300)
         .writeStream.format("memory").queryName("d4")
         .option("checkpointLocation", os.path.join(scratch, "ck4"))
         .trigger(processingTime="200 milliseconds").start())
    deadline = time.time() + 60
    while time.time() < deadline and spark.table("d4").count() < 2:
        time.sleep(0.5)
    q.stop()
    assert sorted(r["trans_id"] for r in spark.table("d4").collect()) == [2, 9]
