"""The reference's NAV and USER files through the windowed join, in one pane."""
from collections import Counter
from datetime import datetime

from pyspark.sql import functions as F

from eddy.functions import parse
from eddy.operators.windowjoin import nav_holder_join

# The reference's two text fixtures, line by line.
NAV_LINES = ["123, 100", "345, 200", "678, 150", "123, 102", "101, 1000", "345, 197",
             "123, 101", "123, 102", "345, 201", "910, 500"]
USER_LINES = ["1, 123", "1, 345", "1, 678", "2, 123", "3, 123", "2, 678", "3, 910"]


def test_golden_nav_user_join(spark):
    stamp = datetime(2024, 1, 1, 0, 0, 0, 500000)
    nav = (spark.createDataFrame([(i, l) for i, l in enumerate(NAV_LINES)], "seq long, value string")
           .select("seq", parse.parse_nav_update("value").alias("p"), F.lit(stamp).alias("ts"))
           .select("seq", "p.*", "ts"))
    user = (spark.createDataFrame([(i, l) for i, l in enumerate(USER_LINES)], "seq long, value string")
            .select("seq", parse.parse_pair("value", "user_id", "nav_id").alias("p"),
                    F.lit(stamp).alias("ts"))
            .select("seq", "p.*", "ts"))
    out = nav_holder_join(nav, user, "2 seconds", "1 second").collect()
    assert len(out) == 36
    assert Counter(r["nav_id"] for r in out) == {123: 24, 345: 6, 678: 4, 910: 2}
    assert Counter((r["nav_id"], r["user_id"], r["unit_value"]) for r in out)[(123, 1, 102)] == 4


def test_pairs_counted_once_per_shared_window(spark):
    # panes 0 and 1 share one 2 s window; panes 0 and 2 share none
    rows = [(1, 10, 0, datetime(2024, 1, 1, 0, 0, 0, 100000))]
    nav = spark.createDataFrame(rows, "nav_id long, unit_value long, seq long, ts timestamp")
    own = spark.createDataFrame(
        [(1, 7, 1, datetime(2024, 1, 1, 0, 0, 0, 900000)),
         (1, 8, 2, datetime(2024, 1, 1, 0, 0, 1, 500000)),
         (1, 9, 3, datetime(2024, 1, 1, 0, 0, 2, 100000))],
        "nav_id long, user_id long, seq long, ts timestamp")
    got = Counter(r["user_id"] for r in nav_holder_join(nav, own, "2 seconds", "1 second").collect())
    assert got == {7: 2, 8: 1}
