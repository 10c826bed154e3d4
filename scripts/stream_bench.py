"""Time the streaming forms over one scale factor's events.

    python scripts/stream_bench.py [sf_dir] [files] [shuffle_partitions]

The inputs are split into ``files`` files per stream (in order) under a
fresh scratch folder; each job then runs with ``availableNow`` to the end,
one file per micro-batch, into the ``noop`` sink.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from eddy.session import build_session  # noqa: E402
from eddy.sources import tables as T  # noqa: E402
from eddy.streaming import jobs, runtime  # noqa: E402

TTL_MS = 86_400_000


def split_files(df: DataFrame, col: str, n: int, path: str):
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    step = (hi - lo) // n + 1
    for i in range(n):
        part = df.where((F.col(col) >= lo + i * step) & (F.col(col) < lo + (i + 1) * step))
        part.coalesce(1).write.mode("append").parquet(path)
    return df.schema


def prepare(spark: SparkSession, sf_dir: str, n: int, base: str) -> dict:
    own, nav = T.own(spark, sf_dir), T.nav(spark, sf_dir)
    tx = (T.debit(spark, sf_dir).select("trans_id", "timestamp", "event_id", "amount",
                                        F.lit("debit").alias("side"))
          .unionByName(T.credit(spark, sf_dir).select("trans_id", "timestamp", "event_id",
                                                      "amount", F.lit("credit").alias("side"))))
    schemas = {"own": split_files(own, "seq", n, f"{base}/own"),
               "nav": split_files(nav, "seq", n, f"{base}/nav"),
               "tx": split_files(tx, "timestamp", n, f"{base}/tx")}
    # a closing record moves the event-time watermark past every deadline
    spark.createDataFrame([(-1, 10 ** 13, 10 ** 9, "end", "debit")], tx.schema) \
        .coalesce(1).write.mode("append").parquet(f"{base}/tx")
    return schemas


def run(spark: SparkSession, sf_dir: str, n: int = 4, state: dict | None = None) -> tuple[dict, dict]:
    """Time each streaming job; returns (seconds, input rows) per job.

    ``state`` gets each job's state size after every micro-batch: [input rows,
    rows held, bytes of RocksDB files].
    """
    base = tempfile.mkdtemp(prefix="eddy-stream-bench-", dir="/tmp")
    s = prepare(spark, sf_dir, n, base)

    def src(name):
        return (spark.readStream.schema(s[name]).option("maxFilesPerTrigger", 1)
                .parquet(f"{base}/{name}"))

    cases = {
        "windowed_join": lambda: jobs.windowed_join(src("nav"), src("own"), "2 hours",
                                                    "1 hour", lag="3 hours"),
        "running_holdings": lambda: jobs.running_holdings(src("own")),
        "lot_valuation": lambda: jobs.lot_valuation(src("own"), src("nav")),
        "portfolio_valuation": lambda: jobs.portfolio_valuation(src("own"), src("nav")),
        "timeout_clean": lambda: jobs.timeout_clean(src("tx"), TTL_MS, lag="1 hour"),
        "timeout_sided": lambda: jobs.timeout_sided(src("tx"), TTL_MS, lag="1 hour"),
    }
    times, rows = {}, {}
    for name, make in cases.items():
        t0 = time.perf_counter()
        q = (make().writeStream.format("noop")
             .option("checkpointLocation", f"{base}/ck-{name}")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        times[name] = round(time.perf_counter() - t0, 3)
        rows[name] = sum(p["numInputRows"] for p in q.recentProgress)
        if state is not None:
            sizes = runtime.state_history(q, spark).groupBy("batch_id").agg(
                F.max("input_rows"), F.sum("rows"), F.sum("sst_bytes")).orderBy("batch_id").collect()
            state[name] = [list(r)[1:] for r in sizes]
    return times, rows


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    n = int(sys.argv[2]) if len(sys.argv) > 2 else 4
    parts = int(sys.argv[3]) if len(sys.argv) > 3 else 8
    spark = build_session("local[8]", parts, app_name="eddy-stream-bench")
    state: dict = {}
    times, rows = run(spark, sf_dir, n, state)
    spark.stop()
    print(json.dumps({"metric": "stream_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "streams": times, "input_rows": rows,
                      "state": state, "files_per_stream": n, "state_partitions": parts}))


if __name__ == "__main__":
    main()
