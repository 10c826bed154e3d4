import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from eddy.functions import parse


def one(spark, line, col):
    return spark.createDataFrame([(line,)], "value string").select(col.alias("r")).first()["r"]


def test_pair_trims_and_ignores_extra_fields(spark):
    r = one(spark, " 123 ,\t100 , 7", parse.parse_pair("value", "nav_id", "unit_value"))
    assert (r["nav_id"], r["unit_value"]) == (123, 100)


def test_jtrim_strips_control_chars(spark):
    assert one(spark, "\t\x01 ab c \n", parse.jtrim("value")) == "ab c"


def test_strict_rejects_bad_long(spark):
    with pytest.raises(PySparkException):
        one(spark, "12.0, 3", parse.parse_pair("value"))


def test_strict_rejects_missing_field(spark):
    with pytest.raises(PySparkException):
        one(spark, "12", parse.parse_pair("value"))


def test_trailing_empty_field_is_dropped_like_jvm_split(spark):
    # "1,2,acct," has three fields once the trailing empty one is dropped
    with pytest.raises(PySparkException):
        one(spark, "1,2,acct,", parse.parse_debit("value"))
    r = one(spark, "1,2,acct,", parse.parse_debit("value", strict=False))
    assert r["amount"] is None and r["account_id"] == "acct"


def test_lenient_gives_nulls(spark):
    r = one(spark, "x, 5", parse.parse_pair("value", strict=False))
    assert r["first"] is None and r["second"] == 5


def test_ownership_nests(spark):
    r = one(spark, "123, 1, 10", parse.parse_ownership("value"))
    assert r["nav_id"] == 123 and r["owning"]["user_id"] == 1 and r["owning"]["share"] == 10


def test_credit_five_fields(spark):
    r = one(spark, "9, 1000, card, Ann Lee, 12.50", parse.parse_credit("value"))
    assert r.asDict() == {"trans_id": 9, "timestamp": 1000, "credit_card_id": "card",
                          "holder_name": "Ann Lee", "amount": "12.50"}


def test_parsers_stay_in_the_jvm(spark):
    df = spark.createDataFrame([("1, 2",)], "value string")
    plan = df.select(parse.parse_pair("value")).select(F.col("*"))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "Python" not in plan


def test_signs_and_inner_spaces(spark):
    r = one(spark, "+12,-7", parse.parse_pair("value"))
    assert (r["first"], r["second"]) == (12, -7)
    with pytest.raises(PySparkException):
        one(spark, "1 2, 3", parse.parse_pair("value"))      # inner space is not trimmed


def test_empty_middle_field_kept(spark):
    # JVM split keeps empty fields in the middle: "1,,x,y" has 4 fields
    r = one(spark, "1,,x,y", parse.parse_debit("value", strict=False))
    assert r["timestamp"] is None and r["account_id"] == "x" and r["amount"] == "y"
