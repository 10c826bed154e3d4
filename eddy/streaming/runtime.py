"""Running streaming queries: checkpoints, restart, poison records, state size.

T9  periodic checkpoint: every micro-batch commits offsets and state to
    ``checkpointLocation``; ``trigger(processingTime=..)`` sets the pace.
T10 RocksDB state with changelog checkpointing (session settings).
T11 resume: start again with the same ``checkpointLocation``.
T12 fixed-delay restart: ``run_with_restart``.
T13 poison record: ``fail_on`` raises inside the plan (JVM side).
T14 state size: ``state_report`` from the query's progress; the
    ``statestore`` reader for the rows themselves.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from eddy.session import checkpoint_dir

# Fixed value from the reference: checkpoint every 20 seconds.
CHECKPOINT_INTERVAL = "20 seconds"


def checkpoint_location(spark: SparkSession, job: str) -> str:
    """``<spark.checkpoint.dir>/streams/<job>``: stable across restarts."""
    return os.path.join(checkpoint_dir(spark), "streams", job)


def fail_on(df: DataFrame, cond: Column, message: str) -> DataFrame:
    """Rows matching ``cond`` stop the query with ``message``.

    The guard is a filter that can never be pruned: true for good rows,
    an error for poison ones.
    """
    return df.where(F.when(cond, F.raise_error(F.lit(message))).otherwise(F.lit(True)))


def run_with_restart(start: Callable[[], StreamingQuery], attempts: int = 1,
                     delay_ms: int = 100, timeout_s: float | None = None,
                     until: Callable[[StreamingQuery], bool] | None = None) -> StreamingQuery:
    """Run a query; on failure wait ``delay_ms`` and start it again.

    ``start`` must start the query with a fixed checkpoint location, so a
    restart resumes from the last committed batch with its state.  Gives
    up after ``attempts`` restarts and re-raises the last error.
    ``until`` (e.g. "all input processed") stops a healthy query.
    """
    restarts = 0
    while True:
        q = start()
        try:
            if until is not None:
                q.processAllAvailable()
                if until(q):
                    q.stop()
                    return q
            q.awaitTermination(timeout_s)
            if q.exception() is None:
                return q
            raise q.exception()
        except Exception:
            try:
                q.stop()
            except Exception:
                pass
            if restarts >= attempts:
                raise
            restarts += 1
            time.sleep(delay_ms / 1000.0)


STATE_HISTORY = ("batch_id bigint, timestamp string, input_rows bigint, operator string, rows bigint, rows_updated bigint, "
                 "memory_bytes bigint, sst_bytes bigint")


def _state_rows(progress: dict) -> list[dict]:
    out = []
    for op in progress.get("stateOperators", []):
        metrics = op.get("customMetrics", {})
        out.append({
            "operator": op.get("operatorName"),
            "rows": op.get("numRowsTotal"),
            "memory_bytes": op.get("memoryUsedBytes"),
            "sst_bytes": metrics.get("rocksdbSstFileSize"),
            "rows_updated": op.get("numRowsUpdated"),
        })
    return out


def state_report(query: StreamingQuery) -> list[dict]:
    """Per stateful operator, rows held and bytes used, from the last batch."""
    return _state_rows(query.lastProgress or {})


def state_history(query: StreamingQuery, spark: SparkSession) -> DataFrame:
    """T14 over time: the same of each recent micro-batch, as a table.

    Answers how much space the state takes as the input grows.  Spark keeps the
    last ``spark.sql.streaming.numRecentProgressUpdates`` micro-batches.
    """
    names = [c.split()[0] for c in STATE_HISTORY.split(", ")]
    rows = [{"batch_id": p["batchId"], "timestamp": p["timestamp"], "input_rows": p["numInputRows"], **r}
            for p in query.recentProgress for r in _state_rows(p)]
    return spark.createDataFrame([tuple(r[c] for c in names) for r in rows], STATE_HISTORY)


def read_state(spark: SparkSession, checkpoint: str, operator_id: int = 0,
               state_var: str | None = None) -> DataFrame:
    """The rows of a query's state store, as a DataFrame (batch read)."""
    spark.streams.active   # the reader needs the streaming endpoints up
    r = spark.read.format("statestore").option("path", checkpoint) \
        .option("operatorId", str(operator_id))
    if state_var:
        r = r.option("stateVarName", state_var)
    return r.load()


def start(out: DataFrame | DataStreamWriter, spark: SparkSession, job: str,
          path: str | None = None, interval: str | None = CHECKPOINT_INTERVAL,
          once: bool = False, checkpoint: str | None = None) -> StreamingQuery:
    """Start a stream with a stable checkpoint under the shared folder.

    ``out``: a stream writer (e.g. ``console.printing``), or a streaming
    DataFrame, which is appended to Parquet in ``path``.  Starting again
    with the same ``job`` (or ``checkpoint`` folder) resumes from the last
    committed micro-batch with its state.  ``interval`` paces micro-batches
    (the reference checkpoints every 20 s); ``None`` runs them back to back,
    and ``once`` takes the input there is and ends.
    """
    w = out.writeStream.format("parquet").option("path", path) if isinstance(out, DataFrame) else out
    w = w.queryName(job).option("checkpointLocation", checkpoint or checkpoint_location(spark, job))
    if once:
        w = w.trigger(availableNow=True)
    elif interval:
        w = w.trigger(processingTime=interval)
    return w.start()


# ---------------------------------------------------------------------------
# T11 with another T15: a checkpoint fixes the number of state partitions, so
# a job that is to go on with more (or fewer) starts on a new checkpoint, with
# the old one's state as its initial state and without the old one's input.

def last_committed(spark: SparkSession, checkpoint: str) -> tuple[int, list[dict]]:
    """The last micro-batch that a stopped query finished, and its sources' offsets.

    A Kafka source's offsets are what its ``startingOffsets`` option takes (as JSON).
    """
    done = spark.read.format("binaryFile").load(os.path.join(checkpoint, "commits")) \
        .select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name")).where(F.col("name").rlike(r"^\d+$"))
    batch = done.agg(F.max(F.col("name").cast("bigint")).alias("b")).first()["b"]
    if batch is None:
        raise ValueError(f"no micro-batch is committed in {checkpoint}")
    log = spark.read.text(os.path.join(checkpoint, "offsets", str(batch)), wholetext=True).first()["value"]
    return batch, [json.loads(line) if line.startswith("{") else None for line in log.strip().split("\n")[2:]]


def _plain(path: Column) -> Column:
    """A path without the empty authority that some of Spark's logs write (``file:///x``)."""
    return F.regexp_replace(path, r"^(\w+):/+(?=/)", "$1:")


def seen_files(spark: SparkSession, checkpoint: str, source: int = 0) -> DataFrame:
    """The files of a file source that the committed micro-batches of a query have read."""
    _, offsets = last_committed(spark, checkpoint)
    upto = offsets[source]["logOffset"]
    lines = spark.read.text(os.path.join(checkpoint, "sources", str(source)))
    entry = F.from_json("value", "path string, batchId bigint")
    return lines.where(F.col("value").startswith("{")).select(entry.alias("e")) \
        .where(F.col("e.batchId") <= F.lit(upto)).select(_plain(F.col("e.path")).alias("path")).distinct()


def skip_files(stream: DataFrame, seen: DataFrame) -> DataFrame:
    """A file stream without the rows of ``seen`` files (``seen_files`` of the query it follows)."""
    marked = stream.withColumn("_seen_path", _plain(F.col("_metadata.file_path")))
    return marked.join(seen.select(F.col("path").alias("_seen_path")), "_seen_path", "left_anti").drop("_seen_path")
