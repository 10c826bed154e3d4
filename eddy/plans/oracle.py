"""DuckDB SQL that computes the same result as each registered query.

The tables ``events``, ``orders``, ... are views over the same parquet
files.  These strings are the correctness oracle; they are written the
obvious way (plain window functions, joins), not the way the Spark plans
are built.
"""

from __future__ import annotations

# Views shared by the oracles, mirroring eddy.sources.tables.
_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
OWN = f"""own AS (
  SELECT {_K} % 20 AS nav_id, user_id % 10 AS user_id,
         CAST(floor(value) AS BIGINT) AS share, event_id AS seq, ts
  FROM events WHERE event_type = 'purchase')"""
NAV = f"""nav AS (
  SELECT {_K} % 20 AS nav_id, CAST(floor(value) AS BIGINT) AS unit_value,
         event_id AS seq, ts
  FROM events WHERE event_type = 'view')"""
_AMOUNT = "CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR)"
DEBIT = f"""debit AS (
  SELECT user_id AS trans_id, epoch_us(ts) // 1000 AS timestamp, epoch_us(ts) AS ts_us,
         event_id, {_AMOUNT} AS amount, 'acct-' || CAST(user_id AS VARCHAR) AS account_id
  FROM events WHERE event_type = 'purchase')"""
CREDIT = f"""credit AS (
  SELECT user_id AS trans_id, epoch_us(ts) // 1000 AS timestamp, epoch_us(ts) AS ts_us,
         event_id, {_AMOUNT} AS amount, 'card-' || CAST(user_id AS VARCHAR) AS credit_card_id,
         'holder-' || CAST(user_id AS VARCHAR) AS holder_name
  FROM events WHERE event_type = 'click')"""


def _windows(name: str, src: str) -> str:
    return f"""{name} AS (
  SELECT *, unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS ws
  FROM {src})"""


ORACLE: dict[str, str] = {}

ORACLE["windowed_join"] = f"""
WITH {OWN}, {NAV}, {_windows('ow', 'own')}, {_windows('nw', 'nav')}
SELECT n.nav_id, o.user_id, n.unit_value, epoch_us(n.ws) AS window_start_us,
       n.seq AS nav_seq, o.seq AS own_seq
FROM nw n JOIN ow o ON n.nav_id = o.nav_id AND n.ws = o.ws
"""

ORACLE["window_assign"] = """
SELECT event_id, epoch_us(ws) AS window_start_us, epoch_us(ws + INTERVAL 2 HOUR) AS window_end_us
FROM (SELECT event_id,
             unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS ws
      FROM events)
"""

ORACLE["running_holdings"] = f"""
WITH {OWN}
SELECT nav_id, user_id, seq, share,
       CAST(sum(share) OVER (PARTITION BY nav_id, user_id ORDER BY seq
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS holding
FROM own
"""

ORACLE["current_holdings"] = f"""
WITH {OWN}
SELECT nav_id, user_id, CAST(sum(share) AS BIGINT) AS holding FROM own GROUP BY nav_id, user_id
"""

ORACLE["portfolio_valuation"] = f"""
WITH {OWN}, {NAV},
h AS (SELECT nav_id, user_id, min(seq) AS first_seq FROM own GROUP BY nav_id, user_id)
SELECT h.user_id, n.nav_id, n.unit_value,
       n.unit_value * CAST((SELECT sum(o.share) FROM own o
                            WHERE o.nav_id = n.nav_id AND o.user_id = h.user_id
                              AND o.seq < n.seq) AS BIGINT) AS new_valuation,
       n.seq
FROM nav n JOIN h ON h.nav_id = n.nav_id AND h.first_seq < n.seq
"""

ORACLE["lot_valuation"] = f"""
WITH {OWN}, {NAV}
SELECT n.nav_id, o.user_id, o.share, n.unit_value, n.unit_value * o.share AS new_valuation,
       n.seq AS nav_seq, o.seq AS lot_seq
FROM nav n JOIN own o ON o.nav_id = n.nav_id AND o.seq < n.seq
"""

TTL_US = 86_400_000_000
_TX = f"""{DEBIT}, {CREDIT},
t AS (SELECT trans_id, ts_us, event_id, amount, 'debit' AS side FROM debit
      UNION ALL SELECT trans_id, ts_us, event_id, amount, 'credit' AS side FROM credit)"""

ORACLE["union_transactions"] = f"""
WITH {DEBIT}, {CREDIT}
SELECT trans_id, timestamp, amount, event_id FROM debit
UNION ALL SELECT trans_id, timestamp, amount, event_id FROM credit
"""

ORACLE["timeout_toggle"] = f"""
WITH {_TX}
SELECT trans_id, m.ts_us AS ts_us, m.event_id AS event_id, m.amount AS amount
FROM (SELECT trans_id, n,
             max({{'ts_us': ts_us, 'event_id': event_id, 'n': n, 'amount': amount}}) OVER (
               PARTITION BY trans_id ORDER BY ts_us
               RANGE BETWEEN CURRENT ROW AND {TTL_US} FOLLOWING) AS m
      FROM (SELECT *, row_number() OVER (PARTITION BY trans_id ORDER BY ts_us, event_id) AS n
            FROM t))
WHERE n % 2 = 1 AND m.n % 2 = 1
"""

ORACLE["timeout_clean"] = f"""
WITH {_TX}
SELECT trans_id, ts_us, event_id, amount FROM (
  SELECT *, count(*) OVER (PARTITION BY trans_id, c) AS k,
         row_number() OVER (PARTITION BY trans_id, c ORDER BY ts_us DESC, event_id DESC) AS r
  FROM (SELECT *, sum(g) OVER (PARTITION BY trans_id ORDER BY ts_us, event_id) AS c
        FROM (SELECT *, CASE WHEN ts_us - lag(ts_us) OVER (PARTITION BY trans_id
                                                           ORDER BY ts_us, event_id)
                             > {TTL_US} THEN 1 ELSE 0 END AS g FROM t)))
WHERE r = 1 AND k % 2 = 1
"""

ORACLE["timeout_sided"] = f"""
WITH {_TX}
SELECT trans_id, ts_us, event_id, side, amount FROM t a
WHERE NOT EXISTS (SELECT 1 FROM t b WHERE b.trans_id = a.trans_id AND b.side <> a.side
                  AND b.ts_us BETWEEN a.ts_us - {TTL_US} AND a.ts_us + {TTL_US})
"""

_EV = "event_id, epoch_us(ts) AS ts_us, user_id, event_type, value, props"

ORACLE["route_even"] = f"SELECT {_EV} FROM events WHERE event_id % 2 = 0"

ORACLE["route_odd_keyed"] = f"""
SELECT CAST(trunc(event_id / 2) AS BIGINT) AS key, {_EV} FROM events WHERE event_id % 2 <> 0
"""

ORACLE["upsert_last_write"] = """
SELECT user_id, event_type, max(event_id) AS event_id,
       arg_max(epoch_us(ts), event_id) AS ts_us, arg_max(value, event_id) AS value
FROM events GROUP BY user_id, event_type
"""

_TYPES = ("view", "click", "purchase", "signup", "error")
ORACLE["upsert_ignore_nulls"] = "SELECT user_id, max(event_id) AS event_id, " + ", ".join(
    f"arg_max(value, event_id) FILTER (WHERE event_type = '{t}') AS {t}_value" for t in _TYPES
) + """, arg_max(value, event_id) FILTER (WHERE event_type NOT IN ('view', 'click', 'purchase', 'signup', 'error')
       OR event_type IS NULL) AS other_value FROM events GROUP BY user_id"""

for _name in ("table_bind_tuple", "table_rename_employee"):
    ORACLE[_name] = """
SELECT user_id AS id, event_type AS name, arg_max(floor(value)::int, event_id) AS age,
       arg_max(props, event_id) AS title
FROM events GROUP BY user_id, event_type
"""

ORACLE["parse_pair"] = "SELECT o_orderkey, o_custkey FROM orders"

ORACLE["parse_nav_update"] = f"WITH {NAV} SELECT seq, nav_id, unit_value FROM nav"

ORACLE["parse_ownership"] = f"WITH {OWN} SELECT seq, nav_id, user_id, share FROM own"

ORACLE["parse_debit"] = f"""
WITH {DEBIT} SELECT event_id, trans_id, timestamp, account_id, amount FROM debit
"""

ORACLE["parse_credit"] = f"""
WITH {CREDIT}
SELECT event_id, trans_id, timestamp, credit_card_id, holder_name, amount FROM credit
"""
