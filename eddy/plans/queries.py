"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads whole tables from ``sf_dir``.  No rows are collected, but
some queries run jobs while they are built: those that cut their input into
ranges (the timeouts) or read it several times (portfolio and lot
valuation) write it to the shared folder first.  Column names match the
DuckDB oracle in ``eddy.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddy.functions import parse
from eddy.functions.time import epoch_us
from eddy.operators import holdings, merge, route, timeout, upsert, windowjoin
from eddy.sources import tables as T

# The test tables' events are minutes apart, so the
# reference's 2 s / 1 s windows become 2 h / 1 h here.
Q_WINDOW_SIZE = "2 hours"
Q_WINDOW_SLIDE = "1 hour"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


@register("windowed_join")
def windowed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NAV prices x holders in shared 2 h / 1 h windows."""
    return windowjoin.nav_holder_join(T.nav(spark, sf_dir), T.own(spark, sf_dir),
                                      Q_WINDOW_SIZE, Q_WINDOW_SLIDE)


@register("window_assign")
def window_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: every event in each sliding window that contains it."""
    ev = T.events(spark, sf_dir).select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    w = windowjoin.assign_windows(ev, "ts", Q_WINDOW_SIZE, Q_WINDOW_SLIDE)
    return w.select("event_id",
                    windowjoin.window_start_us().alias("window_start_us"),
                    F.unix_micros(F.col("window.end")).alias("window_end_us"))


@register("running_holdings")
def running_holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: holding after every ownership change."""
    return holdings.running_holdings(T.own(spark, sf_dir))


@register("current_holdings")
def current_holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: holding per (nav, user) over all changes."""
    return holdings.current_holdings(T.own(spark, sf_dir))


@register("portfolio_valuation")
def portfolio_valuation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each NAV price revalues every holder of that NAV."""
    # changes and prices come from one scan of events, parsed once
    return holdings.portfolio_valuation_tagged(T.holdings_events(spark, sf_dir))


@register("lot_valuation")
def lot_valuation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each NAV price revalues every earlier lot of that NAV."""
    # lots and prices come from one scan of events
    return holdings.lot_valuation_tagged(T.holdings_events(spark, sf_dir))


# Fixed value: the pairing timeout over the test tables (24 h in microseconds).
Q_TTL_US = 86_400_000_000


def _transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged transaction stream for the timeouts, from one scan."""
    return T.transactions(spark, sf_dir)


@register("union_transactions")
def union_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Debit and credit narrowed to one transaction shape."""
    return merge.union_transactions(T.debit(spark, sf_dir), T.credit(spark, sf_dir),
                                    extra=("event_id",))


@register("timeout_toggle")
def timeout_toggle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 as coded: timers never cancelled, state never cleared."""
    return timeout.timeout_toggle(_transactions(spark, sf_dir), Q_TTL_US)


@register("timeout_clean")
def timeout_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 as intended: unmatched last arrival of each odd chain."""
    return timeout.timeout_clean(_transactions(spark, sf_dir), Q_TTL_US)


@register("timeout_sided")
def timeout_sided(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 by side: no partner of the other side within +-ttl."""
    return timeout.timeout_sided(_transactions(spark, sf_dir), Q_TTL_US)


def _event_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event as a flat record, time as epoch microseconds."""
    return T.events(spark, sf_dir).select(
        "event_id", epoch_us("ts").alias("ts_us"), "user_id", "event_type", "value", "props")


@register("route_even")
def route_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with an even id, unchanged."""
    return route.route_even(_event_record(spark, sf_dir), "event_id")


@register("route_odd_keyed")
def route_odd_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7 + P8: events with an odd id, keyed by id div 2."""
    return route.route_odd_keyed(_event_record(spark, sf_dir), "event_id")


@register("upsert_last_write")
def upsert_last_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: last write per (user_id, event_type) in event_id order."""
    ev = _event_record(spark, sf_dir)
    return upsert.upsert_last_write(ev, ["user_id", "event_type"], "event_id",
                                    ["event_id", "ts_us", "value"])


# The event types; each event updates only its own type's
# field, and one of any other type the field ``other_value``.
EVENT_TYPES = ("view", "click", "purchase", "signup", "error")


@register("upsert_ignore_nulls")
def upsert_ignore_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: partial records per user (one field per event type); nulls never overwrite."""
    ev = _event_record(spark, sf_dir)
    fields = [F.when(F.col("event_type") == t, F.col("value")).alias(f"{t}_value")
              for t in EVENT_TYPES]
    known = F.coalesce(F.col("event_type").isin(*EVENT_TYPES), F.lit(False))
    fields.append(F.when(~known, F.col("value")).alias("other_value"))
    partial = ev.select("user_id", "event_id", *fields)
    return upsert.upsert_ignore_nulls(partial, ["user_id"], "event_id",
                                      ["event_id"] + [f"{t}_value" for t in EVENT_TYPES]
                                      + ["other_value"])


def _table_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the records of the table-sink job: id, name, age, title, in event order."""
    return T.events(spark, sf_dir).select(
        "event_id", F.col("user_id").alias("id"), F.col("event_type").alias("name"),
        F.floor("value").cast("int").alias("age"), F.col("props").alias("title"))


@register("table_bind_tuple")
def table_bind_tuple(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as (name, id, age, title) tuples, bound by place, last write wins."""
    order = (*upsert.TUPLE_ORDER, "event_id")
    bound = upsert.bind_positional(_table_records(spark, sf_dir).select(*order), order, order)
    return upsert.upsert_last_write(bound, upsert.TABLE_KEY, "event_id", upsert.TABLE_VALUES)


@register("table_rename_employee")
def table_rename_employee(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6, P10: records as employees, mapped to columns by name, last write wins."""
    keep = {"event_id": "event_id"}
    employee = upsert.rename(_table_records(spark, sf_dir), {**upsert.EMPLOYEE_FIELDS, **keep})
    rows = upsert.rename(employee, {**{v: k for k, v in upsert.EMPLOYEE_FIELDS.items()}, **keep})
    return upsert.upsert_last_write(rows, upsert.TABLE_KEY, "event_id", upsert.TABLE_VALUES)


@register("parse_pair")
def parse_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``"a, b"`` lines to two longs."""
    lines = T.order_pair_lines(spark, sf_dir)
    p = lines.select(parse.parse_pair("value", "o_orderkey", "o_custkey").alias("p"))
    return p.select("p.*")


@register("parse_nav_update")
def parse_nav_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NAV update lines ``nav, unit_value``."""
    nv = T.nav(spark, sf_dir)
    lines = nv.select("seq", F.concat_ws(", ", "nav_id", "unit_value").alias("value"))
    return lines.select("seq", parse.parse_nav_update("value").alias("p")).select("seq", "p.*")


@register("parse_ownership")
def parse_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``nav, user, share`` lines to (nav_id, owning(user_id, share))."""
    p = T.ownership_lines(spark, sf_dir).select("seq", parse.parse_ownership("value").alias("p"))
    return p.select("seq", F.col("p.nav_id").alias("nav_id"),
                    F.col("p.owning.user_id").alias("user_id"),
                    F.col("p.owning.share").alias("share"))


@register("parse_debit")
def parse_debit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Debit lines, four fields."""
    return (T.debit_lines(spark, sf_dir)
            .select("event_id", parse.parse_debit("value").alias("p")).select("event_id", "p.*"))


@register("parse_credit")
def parse_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: credit lines, five fields."""
    return (T.credit_lines(spark, sf_dir)
            .select("event_id", parse.parse_credit("value").alias("p")).select("event_id", "p.*"))
