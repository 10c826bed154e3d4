"""Streaming forms equal the batch forms when fed the same rows in order."""
import os
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from eddy.operators import holdings, route, timeout
from eddy.operators.upsert import UpsertLog
from eddy.operators.windowjoin import nav_holder_join
from eddy.sources import tables as T
from eddy.streaming import jobs, runtime
from conftest import SF_SMOKE


def write_chunks(df, order_col, n, path):
    """Append ``df`` to ``path`` as ``n`` files, in ``order_col`` ranges."""
    lo, hi = df.agg(F.min(order_col), F.max(order_col)).first()
    step = (hi - lo) // n + 1
    for i in range(n):
        part = df.where((F.col(order_col) >= lo + i * step) & (F.col(order_col) < lo + (i + 1) * step))
        part.coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)      # distinct modification times keep the file order
    return df.schema


def stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def run_to_memory(df, name, scratch, mode="append"):
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", os.path.join(scratch, "ck-" + name))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert q.exception() is None, q.exception()
    return q


def rows(spark, table):
    return sorted(tuple(r) for r in spark.table(table).collect())


def test_stream_windowed_join(spark, scratch):
    own, nav = T.own(spark, SF_SMOKE), T.nav(spark, SF_SMOKE)
    s_own = write_chunks(own, "seq", 3, os.path.join(scratch, "own"))
    s_nav = write_chunks(nav, "seq", 3, os.path.join(scratch, "nav"))
    out = jobs.windowed_join(stream(spark, os.path.join(scratch, "nav"), s_nav),
                             stream(spark, os.path.join(scratch, "own"), s_own),
                             "2 hours", "1 hour", lag="3 hours")
    run_to_memory(out, "wj", scratch)
    exp = sorted(tuple(r) for r in nav_holder_join(nav, own, "2 hours", "1 hour").collect())
    assert rows(spark, "wj") == exp and len(exp) > 0


def test_stream_holdings_portfolio_lots(spark, scratch):
    own, nav = T.own(spark, SF_SMOKE), T.nav(spark, SF_SMOKE)
    s_own = write_chunks(own, "seq", 4, os.path.join(scratch, "own"))
    s_nav = write_chunks(nav, "seq", 4, os.path.join(scratch, "nav"))
    so = lambda: stream(spark, os.path.join(scratch, "own"), s_own)
    sn = lambda: stream(spark, os.path.join(scratch, "nav"), s_nav)

    q = run_to_memory(jobs.running_holdings(so()), "rh", scratch)
    exp = sorted(tuple(r) for r in holdings.running_holdings(own).collect())
    assert rows(spark, "rh") == exp
    assert runtime.state_report(q)[0]["rows"] > 0

    # the two inputs are separate sources; feed them as one tagged stream
    # whose batches follow seq order, like the reference's single arrival order
    both = os.path.join(scratch, "both")
    tagged = (own.select("nav_id", "user_id", "seq", "share",
                         F.lit(None).cast("bigint").alias("unit_value"))
              .unionByName(nav.select("nav_id", F.lit(None).cast("bigint").alias("user_id"),
                                      "seq", F.lit(None).cast("bigint").alias("share"),
                                      "unit_value")))
    s_both = write_chunks(tagged, "seq", 4, both)
    sb = stream(spark, both, s_both)
    own_s = sb.where(F.col("user_id").isNotNull())
    nav_s = sb.where(F.col("user_id").isNull())
    run_to_memory(jobs.portfolio_valuation(own_s, nav_s), "pv", scratch)
    exp = sorted(tuple(r) for r in holdings.portfolio_valuation(own, nav).collect())
    assert rows(spark, "pv") == exp
    run_to_memory(jobs.lot_valuation(own_s, nav_s), "lv", scratch)
    exp = sorted(tuple(r) for r in holdings.lot_valuation(own, nav).collect())
    assert rows(spark, "lv") == exp
    run_to_memory(jobs.lot_valuation_keyed(own_s, nav_s), "lvk", scratch)
    assert rows(spark, "lvk") == exp


def test_stream_clean_timeout(spark, scratch):
    tx = (T.debit(spark, SF_SMOKE).select("trans_id", "timestamp", "event_id", "amount")
          .unionByName(T.credit(spark, SF_SMOKE).select("trans_id", "timestamp", "event_id",
                                                        "amount")))
    ttl_ms = 86_400_000
    # a closing record far in the future moves the watermark past every deadline
    closing = spark.createDataFrame([(-1, 10 ** 13, 10 ** 9, "end")], tx.schema)
    path = os.path.join(scratch, "tx")
    schema = write_chunks(tx, "timestamp", 4, path)
    closing.coalesce(1).write.mode("append").parquet(path)
    run_to_memory(jobs.timeout_clean(stream(spark, path, schema), ttl_ms, lag="1 hour"),
                  "tc", scratch)
    batch = timeout.timeout_clean(tx, ttl_ms, time_col="timestamp",
                                  payload=("amount",)).select("trans_id", "timestamp",
                                                              "event_id", "amount")
    got = [r for r in rows(spark, "tc") if r[0] != -1]
    assert got == sorted(tuple(r) for r in batch.collect()) and len(got) > 0


def test_stream_toggle_timeout_single_pairs(spark, scratch):
    # debit ids 1, 2; credit ids 1, 9 -> only 2 and 9 time out
    rows_ = [(1, 0, 0, "d1"), (2, 0, 1, "d2"), (1, 1, 2, "c1"), (9, 1, 3, "c9")]
    path = os.path.join(scratch, "tx")
    spark.createDataFrame(rows_, "trans_id long, timestamp long, event_id long, amount string") \
        .coalesce(1).write.parquet(path)
    schema = spark.read.parquet(path).schema
    q = (jobs.timeout_toggle(spark.readStream.schema(schema).parquet(path), 300)
         .writeStream.format("memory").queryName("tt").outputMode("append")
         .option("checkpointLocation", os.path.join(scratch, "ck"))
         .trigger(processingTime="200 milliseconds").start())
    deadline = time.time() + 60
    while time.time() < deadline and spark.table("tt").count() < 2:
        time.sleep(0.5)
    q.stop()
    assert sorted(r["trans_id"] for r in spark.table("tt").collect()) == [2, 9]


def test_restart_after_poison(spark, scratch):
    # (1,5) ; then (3,1) (1,2) where user 3 is poison; restart without the guard
    path = os.path.join(scratch, "own")
    schema = "nav_id long, user_id long, seq long, share long"
    spark.createDataFrame([(7, 1, 0, 5)], schema).coalesce(1).write.mode("append").parquet(path)
    spark.createDataFrame([(7, 3, 1, 1), (7, 1, 2, 2)], schema).coalesce(1) \
        .write.mode("append").parquet(path)
    ck = os.path.join(scratch, "ck")
    out = os.path.join(scratch, "out")

    def start(guard):
        src = stream(spark, path, spark.read.parquet(path).schema)
        if guard:
            src = runtime.fail_on(src, F.col("user_id") == 3, "poison record")
        return (jobs.running_holdings(src).writeStream.format("parquet")
                .option("path", out).option("checkpointLocation", ck)
                .trigger(availableNow=True).start())

    q = start(True)
    with pytest.raises(PySparkException):
        q.awaitTermination(120)
    q = runtime.run_with_restart(lambda: start(False), attempts=1, delay_ms=100, timeout_s=120)
    final = (spark.read.parquet(out).groupBy("user_id")
             .agg(F.max_by("holding", "seq").alias("h")).collect())
    assert {r["user_id"]: r["h"] for r in final} == {1: 7, 3: 1}


def test_upsert_log_is_idempotent_on_replay(spark, scratch):
    schema = "id long, name string, title string, age int, off long"
    batches = [[(1, "Ann", "Dev", 30, 0), (2, "Bob", "Ops", 40, 1)],
               [(1, "Ann", "Lead", 31, 2)]]
    log = UpsertLog(os.path.join(scratch, "t"), ["id", "name"], "off", ["title", "age"])
    for i, b in enumerate(batches):
        log.write_batch(spark.createDataFrame(b, schema), i)
    log.write_batch(spark.createDataFrame(batches[1], schema), 1)     # replayed batch
    got = sorted(tuple(r) for r in log.read(spark).collect())
    assert got == [(1, "Ann", "Lead", 31), (2, "Bob", "Ops", 40)]


def test_fan_out_in_foreach_batch(spark, scratch):
    ev = T.events(spark, SF_SMOKE).select("event_id", "user_id", "value")
    path = os.path.join(scratch, "ev")
    schema = write_chunks(ev, "event_id", 2, path)
    even, odd = os.path.join(scratch, "even"), os.path.join(scratch, "odd")

    def each(batch, batch_id):
        route.fan_out(batch, {
            "even": (lambda d: route.route_even(d, "event_id"),
                     lambda d: d.write.mode("append").parquet(even)),
            "odd": (lambda d: route.route_odd_keyed(d, "event_id"),
                    lambda d: d.write.mode("append").parquet(odd)),
        })

    q = (stream(spark, path, schema).writeStream.foreachBatch(each)
         .option("checkpointLocation", os.path.join(scratch, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    n = ev.count()
    assert spark.read.parquet(even).count() + spark.read.parquet(odd).count() == n
    assert spark.read.parquet(odd).where("key * 2 + 1 != event_id").count() == 0


def test_stream_sided_timeout(spark, scratch):
    tx = (T.debit(spark, SF_SMOKE).select("trans_id", "timestamp", "event_id", "amount",
                                          F.lit("debit").alias("side"))
          .unionByName(T.credit(spark, SF_SMOKE).select("trans_id", "timestamp", "event_id",
                                                        "amount", F.lit("credit").alias("side"))))
    ttl_ms = 86_400_000
    closing = spark.createDataFrame([(-1, 10 ** 13, 10 ** 9, "end", "debit")], tx.schema)
    path = os.path.join(scratch, "tx")
    schema = write_chunks(tx, "timestamp", 4, path)
    closing.coalesce(1).write.mode("append").parquet(path)
    run_to_memory(jobs.timeout_sided(stream(spark, path, schema), ttl_ms, lag="1 hour"),
                  "ts_sided", scratch)
    batch = timeout.timeout_sided(tx, ttl_ms, time_col="timestamp").select(
        "trans_id", "timestamp", "event_id", "amount", "side")
    got = [r for r in rows(spark, "ts_sided") if r[0] != -1]
    assert got == sorted(tuple(r) for r in batch.collect()) and len(got) > 0


def _wait_rows(spark, table, n, timeout_s=120):
    deadline = time.time() + timeout_s
    while time.time() < deadline and spark.table(table).count() < n:
        time.sleep(0.3)


def test_state_ttl_expires_holdings(spark, scratch):
    """With a state TTL, a holding untouched for longer than it starts again from 0."""
    path = os.path.join(scratch, "own")
    schema = "nav_id long, user_id long, seq long, share long"
    spark.createDataFrame([(7, 1, 0, 5)], schema).coalesce(1).write.mode("append").parquet(path)
    src = stream(spark, path, spark.read.parquet(path).schema)
    q = (jobs.running_holdings(src, state_ttl_ms=500).writeStream.format("memory")
         .queryName("ttl_rh").option("checkpointLocation", os.path.join(scratch, "ck"))
         .trigger(processingTime="200 milliseconds").start())
    # processAllAvailable does not return for a processing-time query with TTL; poll
    _wait_rows(spark, "ttl_rh", 1)
    time.sleep(2)
    spark.createDataFrame([(7, 1, 1, 2)], schema).coalesce(1).write.mode("append").parquet(path)
    _wait_rows(spark, "ttl_rh", 2)
    q.stop()
    got = sorted((r["seq"], r["holding"]) for r in spark.table("ttl_rh").collect())
    assert got == [(0, 5), (1, 2)]


def test_route_job(spark, scratch):
    """Even, odd, dead and undecodable rows together are the input."""
    recs = T.events(spark, SF_SMOKE).select(
        F.when(F.col("event_id") % 7 != 0, F.col("event_id")).alias("id"), "user_id", F.col("event_id").alias("n"))
    text = recs.select("n", F.when(F.col("n") % 11 != 0, F.to_json(F.struct("id", "user_id"))).cast("binary").alias("value"))
    path = os.path.join(scratch, "recs")
    schema = write_chunks(text, "n", 2, path)
    out = {k: os.path.join(scratch, k) for k in ("even", "odd", "dead", "bad")}
    write = {k: (lambda d, p=p: d.write.mode("append").parquet(p)) for k, p in out.items()}

    decoded = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counting(value):
        decoded.add(1)
        return bytes(value).decode() if value is not None else None

    def decode(batch):
        return batch.withColumn("record", F.from_json(counting("value"), "id bigint, user_id bigint"))

    counts = {}
    q = jobs.route_job(stream(spark, path, schema), write["even"], write["odd"], write["dead"],
                       os.path.join(scratch, "ck"), decode=decode, write_bad=write["bad"], on_counts=counts.__setitem__)
    q.processAllAvailable()
    q.stop()
    assert decoded.value == recs.count()                 # each value once, whatever the branches
    assert len(counts) == 2 and all(c["input"] == sum(c[b] for b in route.BRANCHES) for c in counts.values())
    assert sum(c["input"] for c in counts.values()) == recs.count()
    got = {k: spark.read.parquet(p) for k, p in out.items()}
    assert got["even"].where("id % 2 != 0").count() == 0
    assert got["odd"].where("key * 2 + 1 != record.id").count() == 0
    assert got["dead"].where("id is not null").count() == 0 and got["dead"].count() > 0
    assert got["bad"].count() > 0
    assert sum(d.count() for d in got.values()) == recs.count()
    assert {k: d.count() for k, d in got.items()} == {k: sum(c[k] for c in counts.values()) for k in route.BRANCHES}


def test_undecodable_frames(spark):
    from eddy.sources.avro import undecodable
    frames = [None, b"", b"\x00", bytes.fromhex("000000000154"), bytes.fromhex("000000000254"), bytes.fromhex("010000000154")]
    df = spark.createDataFrame([(v,) for v in frames], "value binary")
    bad = [None if r["value"] is None else bytes(r["value"]) for r in undecodable(df, {1: "s"}).collect()]
    assert sorted(bad, key=str) == sorted((v for v in frames if v != frames[3]), key=str)


RECORD = "id long, name string, age int, title string, timestamp timestamp, partition int, offset long"


def run_tables(spark, path, scratch, name):
    logs = jobs.upsert_logs(*(os.path.join(scratch, name, t) for t in ("tuple", "employee", "bean")))
    src = stream(spark, path, spark.read.parquet(path).schema)
    q = jobs.table_sink_job(src, *(x.write_batch for x in logs.values()), os.path.join(scratch, name, "ck"))
    q.processAllAvailable()
    q.stop()
    return logs


def test_table_sink_compacts(spark, scratch):
    """Every second micro-batch leaves a base; the table reads the same."""
    from datetime import datetime
    path = os.path.join(scratch, "recs")
    for i in range(5):
        spark.createDataFrame([(i % 2, "Ann", i, None if i % 3 else f"t{i}", datetime(2024, 1, 1), 0, i)], RECORD) \
            .coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    logs = jobs.upsert_logs(*(os.path.join(scratch, "c", t) for t in ("tuple", "employee", "bean")))
    src = stream(spark, path, spark.read.parquet(path).schema)
    q = jobs.table_sink_job(src, *(x.write_batch for x in logs.values()), os.path.join(scratch, "c", "ck"),
                            compact=list(logs.values()), every=2)
    q.processAllAvailable()
    q.stop()
    for name, log in logs.items():
        assert sorted(r["_batch"] for r in spark.read.parquet(log.base).select("_batch").distinct().collect()) == [1, 3]
    assert table_rows(spark, logs["tuple"]) == [(0, "Ann", 4, None), (1, "Ann", 3, "t3")]
    assert table_rows(spark, logs["bean"]) == [(0, "Ann", 4, "t0"), (1, "Ann", 3, "t3")]


def table_rows(spark, log):
    return sorted((tuple(r) for r in log.read(spark).collect()), key=str)


def test_table_sink_job(spark, scratch):
    from datetime import datetime
    t = datetime(2024, 1, 1)
    path = os.path.join(scratch, "recs")
    spark.createDataFrame([(1, "Ann", 30, "Dev", t, 0, 0), (2, "Bob", 40, "Ops", t, 0, 1)], RECORD) \
        .coalesce(1).write.mode("append").parquet(path)
    spark.createDataFrame([(1, "Ann", 31, None, t, 0, 2)], RECORD) \
        .coalesce(1).write.mode("append").parquet(path)
    logs = run_tables(spark, path, scratch, "a")
    last = table_rows(spark, logs["tuple"])
    assert last == [(1, "Ann", 31, None), (2, "Bob", 40, "Ops")]
    assert table_rows(spark, logs["employee"]) == last
    bean = [(1, "Ann", 31, "Dev"), (2, "Bob", 40, "Ops")]
    assert table_rows(spark, logs["bean"]) == bean
    # compaction keeps what is read, before and after more batches
    for log in logs.values():
        log.compact(spark, 0)
    assert table_rows(spark, logs["tuple"]) == last and table_rows(spark, logs["bean"]) == bean
    extra = spark.createDataFrame([(2, "Bob", None, "Boss", t, 0, 3)], RECORD)
    for log in logs.values():
        log.compact(spark, 1)
        log.write_batch(extra, 2)
        log.write_batch(extra, 2)
    assert table_rows(spark, logs["tuple"]) == [(1, "Ann", 31, None), (2, "Bob", None, "Boss")]
    assert table_rows(spark, logs["bean"]) == [(1, "Ann", 31, "Dev"), (2, "Bob", 40, "Boss")]
    logs["bean"].compact(spark, 2)
    assert table_rows(spark, logs["bean"]) == [(1, "Ann", 31, "Dev"), (2, "Bob", 40, "Boss")]


def test_table_sink_replay_with_tied_offsets(spark, scratch):
    """Offsets repeat across partitions: the order of rows in a file changes nothing."""
    import random
    from datetime import datetime, timedelta
    rng = random.Random(3)
    t = datetime(2024, 1, 1)
    recs = [(i % 4, f"n{i % 2}", i, f"t{i}" if i % 3 else None, t + timedelta(seconds=rng.randrange(3)), p, i)
            for i in range(30) for p in range(3)]
    found = []
    for name in ("one", "two"):
        rng.shuffle(recs)
        path = os.path.join(scratch, f"in-{name}")
        spark.createDataFrame(recs, RECORD).repartition(3).write.parquet(path)
        src = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
        logs = jobs.upsert_logs(*(os.path.join(scratch, name, x) for x in ("tuple", "employee", "bean")))
        q = jobs.table_sink_job(src, *(x.write_batch for x in logs.values()), os.path.join(scratch, name, "ck"))
        q.processAllAvailable()
        q.stop()
        found.append([table_rows(spark, log) for log in logs.values()])
    assert found[0] == found[1]


def test_first_start_fails_second_finishes(spark, scratch):
    """The poisoned first start stops; the restart resumes its checkpoint."""
    path, out = os.path.join(scratch, "own"), os.path.join(scratch, "out")
    schema = "nav_id long, user_id long, seq long, share long"
    for part in ([(7, 1, 0, 5)], [(7, 3, 1, 1), (7, 1, 2, 2)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    starts = []

    def start():
        src = stream(spark, path, spark.read.parquet(path).schema)
        if not starts:
            src = runtime.fail_on(src, F.col("user_id") == 3, "poison record")
        starts.append(1)
        return runtime.start(jobs.running_holdings(src), spark, "restarted", path=out, once=True,
                             checkpoint=os.path.join(scratch, "ck"))

    t0 = time.time()
    q = runtime.run_with_restart(start, attempts=1, delay_ms=100, timeout_s=120)
    assert len(starts) == 2 and q.exception() is None and time.time() - t0 >= 0.1
    got = {(r["user_id"], r["seq"]): r["holding"] for r in spark.read.parquet(out).collect()}
    assert got == {(1, 0): 5, (3, 1): 1, (1, 2): 7}         # the holding of batch 0 survived
    assert spark.read.parquet(out).count() == 3


def test_start_paces_batches(spark, scratch):
    """Micro-batches, and so commits of state and offsets, come one per interval."""
    from datetime import datetime
    path, out = os.path.join(scratch, "own"), os.path.join(scratch, "out")
    rows_ = spark.createDataFrame([(7, 1, 0, 5)], "nav_id long, user_id long, seq long, share long")
    for _ in range(3):
        rows_.coalesce(1).write.mode("append").parquet(path)
    src = stream(spark, path, spark.read.parquet(path).schema)
    q = runtime.start(jobs.running_holdings(src), spark, "paced", path=out, interval="4 seconds",
                      checkpoint=os.path.join(scratch, "ck"))
    q.processAllAvailable()
    q.stop()
    began = [datetime.fromisoformat(p["timestamp"].replace("Z", "+00:00")) for p in q.recentProgress if p["numInputRows"]]
    # triggers fire at whole multiples of the interval: no two batches share one
    assert len({t.timestamp() // 4 for t in began}) == len(began) == 3
    assert runtime.CHECKPOINT_INTERVAL == "20 seconds"


def test_stream_portfolio_two_sources(spark, scratch):
    """Two separate inputs sharing one keyed state, batches in seq order."""
    own, nav = T.own(spark, SF_SMOKE), T.nav(spark, SF_SMOKE)
    lo, hi = spark.read.parquet(os.path.join(SF_SMOKE, "events.parquet")) \
        .agg(F.min("event_id"), F.max("event_id")).first()
    step = (hi - lo) // 3 + 1
    for name, df in (("own", own), ("nav", nav)):
        for i in range(3):
            df.where((F.col("seq") >= lo + i * step) & (F.col("seq") < lo + (i + 1) * step)) \
                .coalesce(1).write.mode("append").parquet(os.path.join(scratch, name))
            time.sleep(0.05)
    so = stream(spark, os.path.join(scratch, "own"), own.schema)
    sn = stream(spark, os.path.join(scratch, "nav"), nav.schema)
    run_to_memory(jobs.portfolio_valuation(so, sn), "pv2", scratch)
    exp = sorted(tuple(r) for r in holdings.portfolio_valuation(own, nav).collect())
    assert rows(spark, "pv2") == exp and len(exp) > 0


def test_portfolio_state_survives_restart(spark, scratch):
    """own(123,u1,10) nav(123,100) own(123,u2,5) own(123,u1,-3) nav(345,7); stop;
    restart on the same checkpoint; nav(123,101) revalues both holders."""
    path = os.path.join(scratch, "in")
    schema = "nav_id long, user_id long, seq long, share long, unit_value long"
    first = [(123, 1, 0, 10, None), (123, None, 1, None, 100), (123, 2, 2, 5, None),
             (123, 1, 3, -3, None), (345, None, 4, None, 7)]
    spark.createDataFrame(first, schema).coalesce(1).write.mode("append").parquet(path)
    ck = os.path.join(scratch, "ck")
    out = os.path.join(scratch, "out")

    def start():
        src = stream(spark, path, spark.read.parquet(path).schema)
        own_s = src.where(F.col("user_id").isNotNull())
        nav_s = src.where(F.col("user_id").isNull())
        return (jobs.portfolio_valuation(own_s, nav_s).writeStream.format("parquet")
                .option("path", out).option("checkpointLocation", ck)
                .trigger(availableNow=True).start())

    q = start()
    q.awaitTermination(300)
    before = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert before == [(1, 123, 100, 1000, 1)]
    spark.createDataFrame([(123, None, 5, None, 101)], schema).coalesce(1) \
        .write.mode("append").parquet(path)
    q = start()
    q.awaitTermination(300)
    after = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert after == [(1, 123, 100, 1000, 1), (1, 123, 101, 707, 5), (2, 123, 101, 505, 5)]


def _tasks_of(df, scratch, name):
    """(rows of the result, rows by partition) of a stream."""
    run_to_memory(df.withColumn("part", F.spark_partition_id()), name, scratch)
    got = spark_rows = df.sparkSession.table(name)
    return sorted(tuple(r) for r in got.drop("part").collect()), {r["part"]: r["count"] for r in spark_rows.groupBy("part").count().collect()}


def test_hot_nav_is_many_tasks(spark, scratch):
    """One nav holds most of the rows: its holders' buckets are in several tasks, the rows as in batch."""
    rows_ = [(0 if i % 3 else i % 5, i % 40 if i % 2 else None, i, i % 7 if i % 2 else None, None if i % 2 else i % 11) for i in range(900)]
    both = spark.createDataFrame(rows_, "nav_id long, user_id long, seq long, share long, unit_value long")
    path = os.path.join(scratch, "both")
    src = stream(spark, path, write_chunks(both, "seq", 3, path))
    own, nav = (both.where(c).select(*cols) for c, cols in (("user_id is not null", ["nav_id", "user_id", "seq", "share"]),
                                                            ("user_id is null", ["nav_id", "seq", "unit_value"])))
    exp = sorted(tuple(r) for r in holdings.portfolio_valuation(own, nav).collect())
    out = jobs.portfolio_valuation(src.where("user_id is not null"), src.where("user_id is null"))
    got, parts = _tasks_of(out.where("nav_id = 0"), scratch, "hot_pv")
    assert got == [r for r in exp if r[1] == 0]
    assert len(parts) >= 3 and max(parts.values()) < 0.6 * len(got)


def test_portfolio_in_small_pieces(spark, scratch, monkeypatch):
    """Grids and pieces of a few cells give the same rows."""
    from eddy.streaming import processors
    own, nav = T.own(spark, SF_SMOKE), T.nav(spark, SF_SMOKE)
    both = own.select("nav_id", "user_id", "seq", "share", F.lit(None).cast("bigint").alias("unit_value")).unionByName(
        nav.select("nav_id", F.lit(None).cast("bigint").alias("user_id"), "seq", F.lit(None).cast("bigint").alias("share"), "unit_value"))
    path = os.path.join(scratch, "both")
    src = stream(spark, path, write_chunks(both, "seq", 3, path))
    tagged = jobs._tagged(src.where("user_id is not null"), src.where("user_id is null"), 2)
    out = tagged.groupBy("nav_id", "bucket").transformWithStateInPandas(processors.Portfolio(cells=7), processors.PORTFOLIO_SCHEMA, "append", "None")
    run_to_memory(out, "pv_small", scratch)
    assert rows(spark, "pv_small") == sorted(tuple(r) for r in holdings.portfolio_valuation(own, nav).collect())


def test_hot_window_is_many_tasks(spark, scratch):
    """All rows of one nav in one window: prices are dealt to salts, the rows as in batch."""
    nav = spark.range(60).selectExpr("1L as nav_id", "id as unit_value", "id as seq", "timestamp_millis(1000000 + id) as ts")
    own = spark.range(40).selectExpr("1L as nav_id", "id % 7 as user_id", "id as seq", "timestamp_millis(1000000 + id) as ts")
    src = []
    for name, df in (("nav", nav), ("own", own)):
        path = os.path.join(scratch, name)
        src.append(stream(spark, path, write_chunks(df, "seq", 2, path)))
    exp = sorted(tuple(r) for r in nav_holder_join(nav, own, "2 hours", "1 hour").collect())
    got, parts = _tasks_of(jobs.windowed_join(*src, "2 hours", "1 hour", lag="3 hours", salts=6), scratch, "hot_wj")
    assert got == exp and len(exp) == 60 * 40 * 2
    assert len(parts) >= 3


class FakeState:
    """Map and value state in memory that tells which entries were read or written."""

    def __init__(self):
        self.data, self.touched = {}, []

    def getValue(self, key):
        self.touched.append(key)
        return self.data.get(key)

    def updateValue(self, key, value):
        self.touched.append(key)
        self.data[key] = value

    def removeKey(self, key):
        self.data.pop(key, None)

    def exists(self):
        return "one" in self.data

    def get(self):
        return self.data.get("one")

    def update(self, value):
        self.data["one"] = value

    def clear(self):
        self.data.pop("one", None)


class FakeHandle:
    def __init__(self):
        self.states = {}

    def getMapState(self, name, *_):
        return self.states.setdefault(name, FakeState())

    getValueState = getMapState

    def registerTimer(self, _):
        pass

    deleteTimer = registerTimer


class FakeTime:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


@pytest.mark.parametrize("kind", ["clean", "sided"])
def test_a_call_touches_due_buckets_only(kind):
    """1,000 rows wait in 100 buckets; a watermark over 3 of them reads those 3."""
    import pandas as pd

    from eddy.streaming import processors as P
    frame = pd.DataFrame({"timestamp": range(0, 100_000, 100), "event_id": range(1000), "amount": "1",
                          "side": ["debit", "credit"] * 500})
    proc = (P.CleanTimeout if kind == "clean" else P.SidedTimeout)(50, bucket_ms=1000)
    handle = FakeHandle()
    proc.init(handle)
    assert list(proc.handleInputRows((7,), iter([frame]), FakeTime(0))) == []
    buffer = handle.states["buffer"]
    assert len(buffer.data) == 100
    buffer.touched.clear()
    late = pd.DataFrame({"timestamp": [99_950], "event_id": [5000], "amount": ["1"], "side": ["debit"]})
    out = pd.concat(proc.handleInputRows((7,), iter([late]), FakeTime(2_950)))
    assert {k for k, in buffer.touched} == {0, 1, 2, 99} and len(buffer.data) == 97
    assert sorted(out["event_id"]) == list(range(29))
