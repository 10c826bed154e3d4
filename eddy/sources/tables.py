"""The test tables and the event views the operators run on.

``events`` stands in for the reference's input streams: purchases are
ownership changes, views are NAV price updates, and purchases / clicks
are the debit / credit sides of a transaction.  Every view is a lazy
projection of the parquet scan, so Catalyst prunes the unused columns
and pushes the ``event_type`` predicate into the reader.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eddy.functions.time import epoch_ms, epoch_us

# How the event table is mapped onto the reference's domain.
NAV_COUNT = 20          # nav_id = k % 20
HOLDER_COUNT = 10       # user_id % 10 owns
OWN_TYPE = "purchase"
NAV_TYPE = "view"
DEBIT_TYPE = "purchase"
CREDIT_TYPE = "click"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def prop_k() -> Column:
    """The numeric ``k`` carried in the ``props`` JSON text."""
    return F.get_json_object("props", "$.k").cast("bigint")


def amount_text(c: str = "value") -> Column:
    """An amount as text with two decimals (the reference never parses it)."""
    return F.col(c).cast("decimal(12,2)").cast("string")


def own(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ownership changes: (nav_id, user_id, share, seq, ts)."""
    return (events(spark, sf_dir)
            .where(F.col("event_type") == OWN_TYPE)
            .select((prop_k() % NAV_COUNT).alias("nav_id"),
                    (F.col("user_id") % HOLDER_COUNT).alias("user_id"),
                    F.floor("value").alias("share"),
                    F.col("event_id").alias("seq"),
                    F.col("ts").cast("timestamp").alias("ts")))


def nav(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NAV price updates: (nav_id, unit_value, seq, ts)."""
    return (events(spark, sf_dir)
            .where(F.col("event_type") == NAV_TYPE)
            .select((prop_k() % NAV_COUNT).alias("nav_id"),
                    F.floor("value").alias("unit_value"),
                    F.col("event_id").alias("seq"),
                    F.col("ts").cast("timestamp").alias("ts")))


def _trans(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return (events(spark, sf_dir)
            .where(F.col("event_type") == kind)
            .select(F.col("user_id").alias("trans_id"),
                    epoch_ms("ts").alias("timestamp"),
                    epoch_us("ts").alias("ts_us"),
                    F.col("event_id"),
                    amount_text().alias("amount")))


def debit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Debit side: (trans_id, timestamp ms, ts_us, event_id, amount, account_id)."""
    return _trans(spark, sf_dir, DEBIT_TYPE).withColumn(
        "account_id", F.concat(F.lit("acct-"), F.col("trans_id").cast("string")))


def credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credit side: (.., credit_card_id, holder_name)."""
    return (_trans(spark, sf_dir, CREDIT_TYPE)
            .withColumn("credit_card_id",
                        F.concat(F.lit("card-"), F.col("trans_id").cast("string")))
            .withColumn("holder_name",
                        F.concat(F.lit("holder-"), F.col("trans_id").cast("string"))))


def debit_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Debit records as text lines ``id,ts_ms,account,amount``, with event_id."""
    d = debit(spark, sf_dir)
    return d.select("event_id", F.concat_ws(",", "trans_id", "timestamp", "account_id",
                                            "amount").alias("value"))


def credit_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credit records as text lines ``id,ts_ms,card,holder,amount``, with event_id."""
    c = credit(spark, sf_dir)
    return c.select("event_id", F.concat_ws(",", "trans_id", "timestamp", "credit_card_id",
                                            "holder_name", "amount").alias("value"))


def ownership_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ownership records as text lines ``nav, user, share``, with seq."""
    o = own(spark, sf_dir)
    return o.select("seq", F.concat_ws(", ", "nav_id", "user_id", "share").alias("value"))


def order_pair_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``o_orderkey, o_custkey`` lines from the orders table."""
    return table(spark, sf_dir, "orders").select(
        F.concat_ws(", ", "o_orderkey", "o_custkey").alias("value"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Debit and credit sides as one stream, read in a single scan.

    Both sides live in ``events``; one scan with ``event_type IN (..)``
    reads the columns once, where a union of two filtered scans would read
    them twice (row-group statistics rarely prune on the event type).
    Columns: trans_id, timestamp, ts_us, event_id, amount, side.
    """
    kind = F.col("event_type")
    return (events(spark, sf_dir)
            .where(kind.isin(DEBIT_TYPE, CREDIT_TYPE))
            .select(F.col("user_id").alias("trans_id"),
                    epoch_ms("ts").alias("timestamp"),
                    epoch_us("ts").alias("ts_us"),
                    F.col("event_id"),
                    amount_text().alias("amount"),
                    F.when(kind == DEBIT_TYPE, F.lit("debit")).otherwise(F.lit("credit"))
                    .alias("side")))


def holdings_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ownership changes and NAV prices tagged in one scan (``is_lot`` 1/0).

    Columns: nav_id, seq, user_id, share (lots), unit_value (prices), is_lot.
    """
    kind = F.col("event_type")
    own_row = kind == OWN_TYPE
    return (events(spark, sf_dir)
            .where(kind.isin(OWN_TYPE, NAV_TYPE))
            .select((prop_k() % NAV_COUNT).alias("nav_id"),
                    F.col("event_id").alias("seq"),
                    F.when(own_row, F.col("user_id") % HOLDER_COUNT).alias("user_id"),
                    F.when(own_row, F.floor("value")).alias("share"),
                    F.when(~own_row, F.floor("value")).alias("unit_value"),
                    F.when(own_row, F.lit(1)).otherwise(F.lit(0)).alias("is_lot")))
