"""The driver contract: entry runs, every query has an oracle, plans stay JVM-side."""
import __spark_entry__ as E
from conftest import SF_SMOKE
from eddy.plans.queries import QUERIES


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["nav_id", "user_id", "unit_value", "window_start_us", "nav_seq",
                          "own_seq"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_batch_plans_have_no_python(spark):
    for name in QUERIES:
        plan = E.queries()[name](spark, SF_SMOKE)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "ArrowEval" not in plan, name


def test_scans_are_pruned_and_filtered(spark):
    q = E.queries()
    plan = q["parse_pair"](spark, SF_SMOKE)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    plan = q["windowed_join"](spark, SF_SMOKE)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,view)" in plan and "EqualTo(event_type,purchase)" in plan


def test_union_then_key_is_one_exchange(spark):
    from pyspark.sql import functions as F
    from eddy.operators.merge import union_transactions
    from eddy.sources import tables as T
    tx = union_transactions(T.debit(spark, SF_SMOKE), T.credit(spark, SF_SMOKE))
    plan = tx.groupBy("trans_id").agg(F.count("*")).\
        _jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
