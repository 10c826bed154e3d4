import os

import pytest

from eddy import session
from eddy.session import checkpoint_dir, materialize, scratch_path


def test_materialize_writes_parquet_to_the_shared_folder(spark):
    d = checkpoint_dir(spark)
    df = materialize(spark.range(100).selectExpr("id", "id * 2 AS v", "id % 2 AS kind"), "t", ["kind"])
    one = df.where("kind = 1 and v > 10").select("v")
    assert one.count() == 47 and df.columns == ["id", "v", "kind"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(kind" in plan and "GreaterThan(v,10)" in plan
    assert "ReadSchema: struct<v:bigint>" in plan
    root = d.replace("file:", "")
    assert os.path.isdir(root) and any(os.scandir(root))


def test_scratch_paths_are_fresh(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


class _Spark:
    """A session's settings, as far as checkpoint_dir looks at them."""

    def __init__(self, master, conf=None, folder=None):
        self.conf = conf or {}
        self.sparkContext = self
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, d):
        self.folder = d


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Spark("spark://host:7077"))
    with pytest.raises(RuntimeError):
        checkpoint_dir(_Spark("local-cluster[2,1,1024]"))
    assert checkpoint_dir(_Spark("yarn", {"spark.checkpoint.dir": "hdfs:///c"})) == "hdfs:///c"
    assert checkpoint_dir(_Spark("yarn", folder="hdfs:///set")) == "hdfs:///set"
    local = _Spark("local[2]")
    assert checkpoint_dir(local) == checkpoint_dir(local)


def test_workers_can_import_the_package(spark):
    assert os.path.dirname(os.path.dirname(session.__file__)) in spark.sparkContext.environment["PYTHONPATH"]


def test_discard_deletes_a_written_table(spark, scratch):
    import os

    from eddy.session import discard, materialize
    kept, gone = materialize(spark.range(5).toDF("x"), "kept"), materialize(spark.range(5).selectExpr("id as x", "id % 2 as y"), "gone", ["y"])
    copy = materialize(gone.where("x > 1"), "copy")
    paths = [t.written_at.removeprefix("file:") for t in (kept, gone, copy)]
    assert all(map(os.path.exists, paths))
    discard(gone)
    assert [os.path.exists(p) for p in paths] == [True, False, True]
    assert copy.count() == 3 and kept.count() == 5
