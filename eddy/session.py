"""Session construction and the shared checkpoint folder.

On a cluster the session is handed to us already configured; we only read
``spark.checkpoint.dir`` from it, and refuse to write intermediates when
nothing names a shared folder.  Local sessions (tests, bench) get a fresh
scratch folder under ``/tmp``.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Settings every eddy session wants.  AQE re-plans joins at runtime: it turns
# a sort-merge join into a broadcast join only when the measured shuffle
# output of one side is under the threshold (a checked size), and splits
# skewed partitions of a join.  ANSI makes bad input raise instead of
# silently becoming null, as the reference's parsers do.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove RDD checkpoints once unreachable (tables of ``materialize``: see ``discard``)
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # keyed state for transformWithState lives in RocksDB, checkpointed as
    # a changelog (incremental), like the reference's incremental backend
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # the Python state channel uses a unix socket, not a TCP port
    "spark.python.unix.domain.socket.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "eddy", extra: dict | None = None) -> SparkSession:
    """Return a session with eddy's settings.

    ``master``/``shuffle_partitions`` are only set when given, so a cluster
    launcher's own values win.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where it lies.

    A cluster that installs it, or ships it with ``--py-files``, needs no path.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and lineage-cutting tables.

    ``spark.checkpoint.dir``, else the folder given to
    ``SparkContext.setCheckpointDir``.  Only a local session (tests, bench)
    gets a scratch folder of its own when neither is set; elsewhere that
    folder would not be shared, so this raises.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        return d
    master = spark.sparkContext.master
    if not re.match(r"local(\[|$)", master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share "
                           f"(master {master})")
    d = tempfile.mkdtemp(prefix="eddy-ckpt-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df: DataFrame, name: str = "table", partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and continue from the copy.

    The rows live in ``spark.checkpoint.dir`` (never a ``localCheckpoint``),
    so losing an executor later re-reads them instead of recomputing the
    plan that produced them, and a DataFrame read twice downstream is
    computed once.  Readers of the copy get pruned columns, pushed filters
    and statistics; ``partition_by`` lets them skip whole files.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete copies that ``materialize`` wrote, once nothing reads them any more.

    Only for tables whose every reader has run: what was written from them
    stands on its own files, but a plan that still reads them would fail.
    """
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.written_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
