"""Independent SQL for every query, run by another engine on the same tables."""

from __future__ import annotations

_TICK_ORDER = "l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity"
_TICK_DESC = ", ".join(f"{c.strip()} DESC" for c in _TICK_ORDER.split(","))

_TICKS = f"""ticks AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS coin_id, CAST(l_shipdate AS DATE) AS date,
         l_extendedprice AS price, l_extendedprice * l_quantity AS market_cap,
         l_quantity AS volume, {_TICK_ORDER}, l_partkey AS part, l_returnflag, l_linestatus
  FROM lineitem)"""

_DAILY = f"""{_TICKS}, daily AS (
  SELECT coin_id, date, price, market_cap, volume FROM (
    SELECT *, row_number() OVER (PARTITION BY coin_id, date ORDER BY {_TICK_DESC}) AS rn
    FROM ticks) WHERE rn = 1)"""

_BAD = f"""{_TICKS}, bad AS (
  SELECT coin_id, date,
         CASE WHEN l_orderkey % 97 = 0 THEN -price
              WHEN l_orderkey % 101 = 0 THEN NULL ELSE price END AS price,
         CASE WHEN l_orderkey % 103 = 0 THEN -1.0
              WHEN l_orderkey % 107 = 0 THEN NULL ELSE market_cap END AS market_cap,
         volume, {_TICK_ORDER}
  FROM ticks)"""

_JUDGED = f"""{_BAD}, judged AS (
  SELECT *, CASE WHEN price IS NULL THEN 'not_nullable'
                 WHEN price <= 0 THEN 'greater_than(0)'
                 WHEN market_cap < 0 THEN 'greater_than_or_equal_to(0)' END AS failed
  FROM bad), survived AS (
  SELECT *, lag(price) OVER (PARTITION BY coin_id ORDER BY date, {_TICK_ORDER}) AS prev
  FROM judged WHERE failed IS NULL), flagged AS (
  SELECT coin_id, date, price, market_cap, volume,
         CASE WHEN abs(price / prev - 1) > 0.5 THEN 'Day-over-day price change > 50%' END AS reason
  FROM survived UNION ALL
  SELECT coin_id, date, price, market_cap, volume, 'Schema validation failed: ' || failed
  FROM judged WHERE failed IS NOT NULL)"""

_EVENTS = """ticks AS (
  SELECT CAST(user_id AS VARCHAR) AS coin_id, CAST(ts AS DATE) AS date, ts,
         value AS price, event_type FROM events), daily AS (
  SELECT coin_id, date, last(price ORDER BY ts) AS price FROM ticks GROUP BY coin_id, date)"""

_DIM = """dim AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS coin_id, 's' || s_suppkey AS symbol, s_name AS name
  FROM supplier)"""

_CUSTOMERS = """dim AS (
  SELECT CAST(c_custkey AS VARCHAR) AS coin_id, c_mktsegment AS symbol, c_name AS name
  FROM customer)"""

_MARKS = f"""{_EVENTS}, {_CUSTOMERS}, marks AS (
  SELECT dim.coin_id, m.high_water_mark FROM dim LEFT JOIN (
    SELECT coin_id, max(date) AS high_water_mark FROM ticks
    WHERE event_type = 'purchase' GROUP BY coin_id) m USING (coin_id))"""

_BY_DAY = "PARTITION BY coin_id ORDER BY date"


def _calendar(rows: str) -> str:
    """Missing days by the textbook route: the whole calendar less the days seen."""
    return f"""
      SELECT c.coin_id, c.day AS missing_date FROM (
        SELECT coin_id, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS day
        FROM {rows} GROUP BY coin_id) c
      ANTI JOIN {rows} s ON c.coin_id = s.coin_id AND c.day = s.date"""


_RETURNS = f"""returns AS (
  SELECT coin_id, date, price,
         (price - lag(price) OVER ({_BY_DAY})) / nullif(lag(price) OVER ({_BY_DAY}), 0) AS daily_return
  FROM daily)"""

_VOLATILITY = f"""{_DAILY}, {_RETURNS}, volatility AS (
  SELECT *, round(stddev_samp(daily_return) OVER (
    {_BY_DAY} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 5) AS volatility_30d FROM returns)"""

_PEAKS = f"""{_DAILY}, peaks AS (
  SELECT coin_id, date, price, max(price) OVER (
    {_BY_DAY} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_peak FROM daily)"""

_MONTHLY = f"""{_DAILY}, monthly AS (
  SELECT *, price / nullif(price_30d_ago, 0) - 1 AS return_30d FROM (
    SELECT coin_id, date, price, lag(price, 30) OVER ({_BY_DAY}) AS price_30d_ago FROM daily))"""

_NEWEST = f"""{_VOLATILITY}, newest AS (
  SELECT coin_id, date, price, daily_return, volatility_30d FROM (
    SELECT *, row_number() OVER (PARTITION BY coin_id ORDER BY date DESC) AS rn FROM volatility)
  WHERE rn = 1)"""

_FIVE = "coin_id, date, price, round(market_cap, 6) AS market_cap, volume"

_MERGED = f"""{_TICKS}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY coin_id, date
            ORDER BY l_linestatus DESC, {_TICK_DESC}) AS rn FROM ticks)"""

_PIPELINE = f"""{_EVENTS}, snap AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE c_acctbal + 1000 > 0) AS ok FROM customer), judged AS (
  SELECT *, price > 0 AS good FROM daily), moved AS (
  SELECT *, lag(price) OVER ({_BY_DAY}) AS prev FROM judged WHERE good), found AS ({_calendar("moved")})"""


def _checks(source: str, failed: str) -> str:
    return f"""
      SELECT coin_id, CAST(len(checks) AS BIGINT) AS failed_checks,
             coalesce(checks[1], '') AS first_check, count(*) AS row_count
      FROM (SELECT coin_id, list_filter([{failed}], lambda c: c IS NOT NULL) AS checks FROM {source})
      GROUP BY ALL"""


_CHECK_LIST = """
  CASE WHEN price IS NULL THEN 'price:not_nullable' END,
  CASE WHEN price <= 0 THEN 'price:greater_than(0)' END,
  CASE WHEN volume < 0 THEN 'volume:greater_than_or_equal_to(0)' END,
  CASE WHEN market_cap < 0 THEN 'market_cap:greater_than_or_equal_to(0)' END"""

_BY_TICK = f"PARTITION BY coin_id ORDER BY date, {_TICK_ORDER}"


def _two_landings(judged_by: str) -> str:
    """Stored facts of all events and customers, days compared within ``judged_by``."""
    return f"""WITH points AS (
        SELECT CAST(user_id AS VARCHAR) AS coin_id, CAST(ts AS DATE) AS date, ts, value, event_type,
               CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events), days AS (
        SELECT coin_id, date, last(value ORDER BY ts) AS price,
               last(value * k ORDER BY ts) FILTER (WHERE event_type = 'purchase') AS market_cap,
               last(k ORDER BY ts) AS volume
        FROM points GROUP BY coin_id, date), good AS (
        SELECT *, lag(price) OVER (PARTITION BY {judged_by} ORDER BY date) AS prev
        FROM days WHERE price > 0 AND (market_cap IS NULL OR market_cap >= 0) AND (volume IS NULL OR volume >= 0))
      SELECT {_FIVE} FROM good WHERE prev IS NULL OR NOT abs(price / prev - 1) > 0.5
      UNION ALL SELECT CAST(c_custkey AS VARCHAR), DATE '2023-12-31', c_acctbal + 1000, NULL, NULL
      FROM customer WHERE c_acctbal + 1000 > 0"""


_MART_CHECK = f"""WITH {_VOLATILITY}, peaks AS (
        SELECT price, max(price) OVER ({_BY_DAY} ROWS UNBOUNDED PRECEDING) AS peak FROM daily), averages AS (
        SELECT avg(price) OVER ({_BY_DAY} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
               + avg(price) OVER ({_BY_DAY} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS avgs FROM daily), monthly AS (
        SELECT price / nullif(lag(price, 30) OVER ({_BY_DAY}), 0) - 1 AS change FROM daily), ranked AS (
        SELECT rank() OVER (ORDER BY volatility_30d DESC NULLS FIRST) AS place FROM (
          SELECT *, row_number() OVER (PARTITION BY coin_id ORDER BY date DESC) AS rn FROM volatility) WHERE rn = 1)
      SELECT 'daily_return' AS view_name, count(*) AS row_count, count(daily_return) AS filled,
             round(sum(daily_return), 4) AS total FROM volatility
      UNION ALL SELECT 'moving_averages', count(*), count(avgs), round(sum(avgs), 2) FROM averages
      UNION ALL SELECT 'rolling_volatility', count(*), count(volatility_30d), round(sum(volatility_30d), 3) FROM volatility
      UNION ALL SELECT 'max_drawdown', count(*), count(peak + (price - peak) / nullif(peak, 0)),
             round(sum(peak + (price - peak) / nullif(peak, 0)), 2) FROM peaks
      UNION ALL SELECT 'volatility_ranking', count(*), count(place), round(sum(CAST(place AS DOUBLE)), 0) FROM ranked
      UNION ALL SELECT 'return_30d', count(*), count(change), round(sum(change), 4) FROM monthly"""

_LOADED = f"""{_MERGED}, daily AS (SELECT coin_id, date, price FROM ranked WHERE rn = 1), {_RETURNS}"""


_LANDED = """
  SELECT 'snapshot_markets' AS dataset, '20240201_100000' AS ingest_ts, count(*) AS row_count,
         round(sum(l_extendedprice), 2) AS value_sum FROM lineitem
  UNION ALL SELECT 'history', '20240201_100000', count(*), round(sum(value + k +
    CASE WHEN event_type = 'purchase' THEN value * k ELSE 0 END), 2)
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)"""

ORACLE: dict[str, str] = {
    "daily_last": f"""WITH {_BAD}
      SELECT coin_id, date,
             last(price ORDER BY {_TICK_ORDER}) FILTER (WHERE price IS NOT NULL) AS price,
             round(last(market_cap ORDER BY {_TICK_ORDER}) FILTER (WHERE market_cap IS NOT NULL), 6) AS market_cap,
             last(volume ORDER BY {_TICK_ORDER}) AS volume
      FROM bad GROUP BY coin_id, date""",
    "series_align": f"""WITH {_EVENTS}, hourly AS (
        SELECT coin_id, CAST(date - DATE '1970-01-01' AS BIGINT) * 24 + hour(ts) AS timestamp,
               CASE WHEN event_type IN ('view', 'error') THEN 'p'
                    WHEN event_type IN ('purchase', 'signup') THEN 'm' ELSE 'v' END AS kind,
               last(price ORDER BY ts) AS value
        FROM ticks GROUP BY ALL)
      SELECT coin_id, timestamp, p.value AS price, m.value AS market_cap, v.value AS volume
      FROM (SELECT * FROM hourly WHERE kind = 'p') p
      LEFT JOIN (SELECT * FROM hourly WHERE kind = 'm') m USING (coin_id, timestamp)
      LEFT JOIN (SELECT * FROM hourly WHERE kind = 'v') v USING (coin_id, timestamp)""",
    "duplicates": f"""WITH {_TICKS}
      SELECT {_FIVE}, {_TICK_ORDER} FROM (
        SELECT *, count(*) OVER (PARTITION BY coin_id, date) AS n FROM ticks) WHERE n > 1""",
    "high_water_mark": f"""WITH {_EVENTS}, {_CUSTOMERS}
      SELECT dim.coin_id, max(daily.date) AS high_water_mark
      FROM dim LEFT JOIN daily USING (coin_id) GROUP BY dim.coin_id""",
    "incremental_batch": f"""WITH {_MARKS}
      SELECT coin_id, date, last(price ORDER BY ts) AS price
      FROM ticks LEFT JOIN marks USING (coin_id)
      WHERE high_water_mark IS NULL OR date > high_water_mark GROUP BY coin_id, date""",
    "fetch_plan": f"""WITH {_MARKS}, days AS (
        SELECT *, CAST(coalesce(DATE '2024-02-01' - high_water_mark, 365) AS INTEGER) AS history_days
        FROM marks)
      SELECT * FROM days WHERE history_days > 0""",
    "tracked_filter": f"""WITH {_EVENTS}, {_DIM}
      SELECT * FROM daily WHERE coin_id IN (SELECT coin_id FROM dim)""",
    "gaps": f"WITH {_EVENTS} {_calendar('daily')}",
    "gaps_supplier": f"WITH {_DAILY} {_calendar('daily')}",
    "anomalies": f"""WITH {_EVENTS}
      SELECT coin_id, date, price, 'Day-over-day price change > 50%' AS reason FROM (
        SELECT *, lag(price) OVER ({_BY_DAY}) AS prev FROM daily)
      WHERE abs(price / nullif(prev, 0) - 1) > 0.5""",
    "anomalies_with_history": f"""WITH {_DAILY}
      SELECT coin_id, date, price, 'Day-over-day price change > 50%' AS reason FROM (
        SELECT *, lag(price) OVER ({_BY_DAY}) AS prev FROM daily)
      WHERE abs(price / prev - 1) > 0.5 AND date >= DATE '1998-01-01'""",
    "daily_return": f"""WITH {_DAILY}, {_RETURNS}
      SELECT coin_id, date, price, round(daily_return, 6) AS daily_return FROM returns""",
    "pct_change": f"""WITH {_DAILY}
      SELECT {_FIVE}, round(price / nullif(lag(price) OVER ({_BY_DAY}), 0) - 1, 6) AS "return"
      FROM daily""",
    "moving_averages": f"""WITH {_DAILY}
      SELECT coin_id, date, price,
             round(avg(price) OVER ({_BY_DAY} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS moving_avg_7d,
             round(avg(price) OVER ({_BY_DAY} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 6) AS moving_avg_30d
      FROM daily""",
    "moving_average_strict": f"""WITH {_DAILY}
      SELECT {_FIVE},
             round(CASE WHEN row_number() OVER ({_BY_DAY}) >= 7 THEN
               avg(price) OVER ({_BY_DAY} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) END, 6) AS moving_average
      FROM daily""",
    "rolling_volatility": f"""WITH {_VOLATILITY}
      SELECT coin_id, date, price, round(daily_return, 6) AS daily_return, volatility_30d FROM volatility""",
    "running_peak": f"WITH {_PEAKS} SELECT * FROM peaks",
    "max_drawdown": f"""WITH {_PEAKS}
      SELECT *, round((price - running_peak) / nullif(running_peak, 0), 6) AS drawdown FROM peaks""",
    "worst_drawdown": f"""WITH {_PEAKS}, falls AS (
        SELECT coin_id, date, (price - running_peak) / nullif(running_peak, 0) AS drawdown FROM peaks)
      SELECT coin_id, round(drawdown, 6) AS worst_drawdown, date AS worst_date FROM (
        SELECT *, row_number() OVER (PARTITION BY coin_id ORDER BY drawdown, date) AS rn FROM falls)
      WHERE rn = 1""",
    "latest_per_coin": f"""WITH {_NEWEST}
      SELECT coin_id, date, price, round(daily_return, 6) AS daily_return, volatility_30d FROM newest""",
    "volatility_ranking": f"""WITH {_NEWEST}
      SELECT coin_id, date, price AS latest_price, round(daily_return, 6) AS latest_return, volatility_30d,
             rank() OVER (ORDER BY volatility_30d DESC NULLS FIRST) AS volatility_rank
      FROM newest ORDER BY volatility_30d DESC NULLS FIRST""",
    "return_30d": f"""WITH {_MONTHLY}
      SELECT coin_id, date, price, price_30d_ago, round(return_30d, 6) AS return_30d FROM monthly""",
    "best_return_30d": f"""WITH {_MONTHLY}
      SELECT coin_id, date, price, price_30d_ago, round(return_30d, 6) AS return_30d FROM (
        SELECT * FROM monthly WHERE return_30d IS NOT NULL
        ORDER BY monthly.return_30d DESC, coin_id, date LIMIT 10)""",
    "worst_return_30d": f"""WITH {_MONTHLY}
      SELECT coin_id, date, price, price_30d_ago, round(return_30d, 6) AS return_30d FROM (
        SELECT * FROM monthly WHERE return_30d IS NOT NULL
        ORDER BY monthly.return_30d ASC, coin_id, date LIMIT 10)""",
    "coverage": f"""WITH {_DAILY}
      SELECT coin_id, min(date) AS min_date, max(date) AS max_date, count(*) AS row_count
      FROM daily GROUP BY coin_id ORDER BY coin_id""",
    "coin_history": f"WITH {_DAILY} SELECT {_FIVE} FROM daily WHERE coin_id = '7' ORDER BY date DESC",
    "schema_check_current": f"""WITH {_BAD}, {_DIM}, joined AS (SELECT * FROM bad LEFT JOIN dim USING (coin_id)),
      rows_in AS (
        SELECT CASE WHEN l_orderkey % 67 <> 0 THEN coin_id END AS coin_id,
               l_orderkey % 71 = 0 AND price IS NOT NULL AS unread, price,
               CASE WHEN l_orderkey % 89 <> 0 THEN symbol END AS symbol,
               CASE WHEN l_orderkey % 73 <> 0 THEN date END AS date,
               CASE WHEN l_orderkey % 79 = 0 THEN -volume ELSE volume END AS volume, market_cap,
               CASE WHEN l_orderkey % 83 <> 0 THEN name END AS name
        FROM joined)"""
    + _checks(
        "rows_in",
        """
  CASE WHEN coin_id IS NULL THEN 'coin_id:not_nullable' END,
  CASE WHEN unread THEN 'price:coerce_dtype(''double'')' END,
  CASE WHEN price IS NULL THEN 'price:not_nullable' END,
  CASE WHEN price <= 0 AND NOT unread THEN 'price:greater_than(0)' END,
  CASE WHEN symbol IS NULL THEN 'symbol:not_nullable' END,
  CASE WHEN date IS NULL THEN 'date:not_nullable' END,
  CASE WHEN volume < 0 THEN 'volume:greater_than_or_equal_to(0)' END,
  CASE WHEN market_cap < 0 THEN 'market_cap:greater_than_or_equal_to(0)' END,
  CASE WHEN name IS NULL THEN 'name:not_nullable' END""",
    ),
    "schema_check_history": f"WITH {_BAD}" + _checks("bad", _CHECK_LIST),
    "failure_cases": f"""WITH {_BAD}
      SELECT coin_id, CAST(date AS VARCHAR) AS date, {_TICK_ORDER}, c."column", c."check",
             round(c.value, 6) AS value
      FROM (SELECT *, unnest([
          {{'column': 'price', 'check': 'not_nullable', 'value': price, 'hit': price IS NULL}},
          {{'column': 'price', 'check': 'greater_than(0)', 'value': price, 'hit': price <= 0}},
          {{'column': 'market_cap', 'check': 'greater_than_or_equal_to(0)', 'value': market_cap,
            'hit': market_cap < 0}}]) AS c FROM bad)
      WHERE c.hit""",
    "valid_rows": f"WITH {_JUDGED} SELECT {_FIVE} FROM flagged WHERE reason IS NULL",
    "quarantine_rows": f"WITH {_JUDGED} SELECT {_FIVE}, reason FROM flagged WHERE reason IS NOT NULL",
    "quarantine_batch_reason": f"""WITH {_JUDGED}, first AS (
        SELECT CASE WHEN bool_or(price IS NULL) THEN 'not_nullable'
                    WHEN bool_or(price <= 0) THEN 'greater_than(0)'
                    ELSE 'greater_than_or_equal_to(0)' END AS failed
        FROM judged WHERE failed IS NOT NULL)
      SELECT CASE WHEN reason LIKE 'Schema%' THEN
               'Schema validation failed: ' || (SELECT failed FROM first) ELSE reason END AS reason,
             count(*) AS row_count
      FROM flagged WHERE reason IS NOT NULL GROUP BY 1""",
    "dq_report": f"""WITH {_JUDGED}, found AS ({_calendar("survived")})
      SELECT (SELECT count(*) FROM flagged) AS rows_received,
             (SELECT count(*) FROM flagged WHERE reason IS NULL) AS rows_passed,
             (SELECT count(*) FROM flagged WHERE reason IS NOT NULL) AS rows_quarantined,
             (SELECT count(*) FROM found) AS gaps_found,
             (SELECT CAST(sum(n) AS BIGINT) FROM (
                SELECT count(*) AS n FROM survived GROUP BY coin_id, date HAVING count(*) > 1)) AS duplicates_found""",
    "upsert_fact": f"WITH {_MERGED} SELECT {_FIVE} FROM ranked WHERE rn = 1",
    "upsert_dim": f"""WITH {_TICKS}, {_CUSTOMERS}, batch AS (
        SELECT coin_id, lower(l_returnflag) AS symbol, 'Part ' || part AS name FROM (
          SELECT *, row_number() OVER (PARTITION BY coin_id ORDER BY date DESC, {_TICK_DESC}) AS rn FROM ticks)
        WHERE rn = 1)
      SELECT coin_id, coalesce(batch.symbol, dim.symbol) AS symbol, coalesce(batch.name, dim.name) AS name
      FROM dim FULL JOIN batch USING (coin_id)""",
    "load_snapshot": f"""WITH {_MERGED}, batch AS (
        SELECT coin_id, lower(l_returnflag) AS symbol, 'Part ' || part AS name FROM (
          SELECT *, row_number() OVER (PARTITION BY coin_id ORDER BY date DESC, {_TICK_DESC}) AS last
          FROM ticks WHERE l_linestatus = 'O') WHERE last = 1)
      SELECT {_FIVE}, symbol, name FROM ranked LEFT JOIN batch USING (coin_id) WHERE rn = 1""",
    "orphan_facts": f"""WITH {_EVENTS}, {_DIM}
      SELECT * FROM daily WHERE coin_id NOT IN (SELECT coin_id FROM dim)""",
    "constraint_audit": f"""WITH {_EVENTS}, {_DIM}
      SELECT 'dim_coin_key_not_null' AS constraint_name, count(*) AS violations FROM dim WHERE coin_id IS NULL
      UNION ALL SELECT 'dim_coin_key_unique', count(*) - count(DISTINCT coin_id) FROM dim
      UNION ALL SELECT 'dim_coin_key_length', count(*) FROM dim WHERE length(coin_id) > 50
      UNION ALL SELECT 'dim_coin_symbol_length', count(*) FROM dim WHERE length(symbol) > 50
      UNION ALL SELECT 'dim_coin_name_length', count(*) FROM dim WHERE length(name) > 100
      UNION ALL SELECT 'fact_price_coin_length', count(*) FROM ticks WHERE length(coin_id) > 50
      UNION ALL SELECT 'fact_price_coin_not_null', count(*) FROM ticks WHERE coin_id IS NULL
      UNION ALL SELECT 'fact_price_date_not_null', count(*) FROM ticks WHERE date IS NULL
      UNION ALL SELECT 'fact_price_key_unique', count(*) FROM (
        SELECT 1 FROM ticks GROUP BY coin_id, date HAVING count(*) > 1)
      UNION ALL SELECT 'fact_price_coin_in_dim', count(*) FROM ticks
        WHERE coin_id NOT IN (SELECT coin_id FROM dim)""",
    "table_counts": f"""WITH {_JUDGED}
      SELECT 'dim_coin' AS table_name, count(*) AS row_count FROM supplier
      UNION ALL SELECT 'fact_price', count(*) FROM (SELECT DISTINCT coin_id, date FROM ticks)
      UNION ALL SELECT 'quarantine', count(*) FROM flagged WHERE reason IS NOT NULL""",
    "scan_snapshot": f"""WITH {_TICKS}
      SELECT {_FIVE}, lower(l_returnflag) AS symbol, 'Part ' || part AS name FROM ticks""",
    "history_flatten": """WITH points AS (
        SELECT CAST(user_id AS VARCHAR) AS coin_id, CAST(ts AS DATE) AS date, ts, value, event_type,
               CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)
      SELECT coin_id, date, last(value ORDER BY ts) AS price,
             round(last(value * k ORDER BY ts) FILTER (WHERE event_type = 'purchase'), 6) AS market_cap,
             last(k ORDER BY ts) AS volume
      FROM points GROUP BY coin_id, date""",
    "raw_landing": _LANDED,
    "compacted_landing": _LANDED,
    "unreadable_payloads": """WITH texts AS (
        SELECT CASE WHEN event_id % 13 = 0 THEN '{"coin_id":"' || user_id || '","prices":[[1700000000000.0,'
                    WHEN event_id % 17 = 0 THEN 'no prices' END AS rejected FROM events)
      SELECT rejected, CASE WHEN rejected IS NOT NULL THEN 'Unreadable payload' END AS reason,
             CASE WHEN rejected IS NULL THEN 'read' ELSE 'failed' END AS status, count(*) AS row_count
      FROM texts GROUP BY ALL""",
    "mart_check": _MART_CHECK,
    "mart_check_catalogue": _MART_CHECK,
    "load_history": f"WITH {_MERGED} SELECT {_FIVE} FROM ranked WHERE rn = 1",
    "pipeline_second_run": _two_landings("coin_id, date < DATE '2024-01-16'"),
    "stream_load": _two_landings("coin_id, date < DATE '2024-01-16'"),
    "pipeline_after_failure": _two_landings("coin_id"),
    "volatility_bucketed": f"""WITH {_LOADED}
      SELECT coin_id, date, price, round(daily_return, 6) AS daily_return, round(stddev_samp(daily_return) OVER (
        {_BY_DAY} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 5) AS volatility_30d FROM returns""",
    "marts_incremental": f"""WITH {_LOADED}, moved AS (
        SELECT coin_id, date, price, daily_return,
               avg(price) OVER ({_BY_DAY} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS week,
               avg(price) OVER ({_BY_DAY} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS days,
               max(price) OVER ({_BY_DAY} ROWS UNBOUNDED PRECEDING) AS running_peak,
               lag(price, 30) OVER ({_BY_DAY}) AS price_30d_ago,
               round(stddev_samp(daily_return) OVER ({_BY_DAY} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 5) AS volatility_30d
        FROM returns)
      SELECT coin_id, date, price, round(daily_return, 6) AS daily_return, round(week, 6) AS moving_avg_7d,
             round(days, 6) AS moving_avg_30d, volatility_30d, running_peak,
             round((price - running_peak) / nullif(running_peak, 0), 6) AS drawdown, price_30d_ago,
             round(price / nullif(price_30d_ago, 0) - 1, 6) AS return_30d
      FROM moved""",
    "coin_lookup": f"WITH {_DAILY} SELECT {_FIVE} FROM daily WHERE coin_id = '7' ORDER BY date DESC",
    "run_metrics": f"""WITH {_PIPELINE}, jumps AS (
        SELECT count(*) FILTER (WHERE prev IS NULL OR NOT abs(price / prev - 1) > 0.5) AS passed,
               count(*) FILTER (WHERE abs(price / prev - 1) > 0.5) AS jumped FROM moved),
      bad AS (SELECT count(*) AS n, count(price) AS given FROM judged WHERE good IS NOT TRUE)
      SELECT 'first' AS run_id, unnest(['batch', 'batch', 'batch', 'batch', 'batch', 'batch', 'fact_price',
               'quarantine', 'quarantine', 'gaps']) AS step,
             unnest(['current_valid', 'current_anomaly', 'current_failed', 'historical_valid', 'historical_anomaly',
               'historical_failed', 'rows', 'rows', 'rows_with_rejected_value', 'rows']) AS metric,
             unnest([snap.ok, 0, snap.n - snap.ok, jumps.passed, jumps.jumped, bad.n, snap.ok + jumps.passed,
               snap.n - snap.ok + bad.n + jumps.jumped, snap.n - snap.ok + bad.given,
               (SELECT count(*) FROM found)]) AS value
      FROM snap, jumps, bad""",
    "running_peak_ticks": f"""WITH {_TICKS}, peaks AS (
        SELECT coin_id, date, price, {_TICK_ORDER}, max(price) OVER ({_BY_TICK} ROWS UNBOUNDED PRECEDING) AS running_peak
        FROM ticks)
      SELECT *, round((price - running_peak) / nullif(running_peak, 0), 6) AS drawdown FROM peaks""",
    "moving_averages_ticks": f"""WITH {_TICKS}, moved AS (
        SELECT coin_id, date, price, {_TICK_ORDER},
               round(avg(price) OVER ({_BY_TICK} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS moving_avg_7d,
               round(avg(price) OVER ({_BY_TICK} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 6) AS moving_avg_30d,
               (price - lag(price) OVER ({_BY_TICK})) / nullif(lag(price) OVER ({_BY_TICK}), 0) AS change,
               lag(price, 30) OVER ({_BY_TICK}) AS price_30d_ago
        FROM ticks)
      SELECT coin_id, date, price, {_TICK_ORDER}, moving_avg_7d, moving_avg_30d, price_30d_ago,
             round(change, 6) AS daily_return, round(price / nullif(price_30d_ago, 0) - 1, 6) AS return_30d,
             round(stddev_samp(change) OVER ({_BY_TICK} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 5) AS volatility_30d
      FROM moved""",
    "pipeline_run": f"""WITH {_PIPELINE}
      SELECT snap.n + (SELECT count(*) FROM judged) AS rows_received,
             snap.ok + (SELECT count(*) FROM moved
                        WHERE prev IS NULL OR NOT abs(price / prev - 1) > 0.5) AS rows_passed,
             snap.n - snap.ok + (SELECT count(*) FROM judged WHERE NOT good)
               + (SELECT count(*) FROM moved WHERE abs(price / prev - 1) > 0.5) AS rows_quarantined,
             (SELECT count(*) FROM found) AS gaps_found,
             CAST(0 AS BIGINT) AS duplicates_found
      FROM snap""",
}
