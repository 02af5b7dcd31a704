"""The driver queries as plain SQL over the same tables, for comparison with another engine."""

from __future__ import annotations

_TIE = ("l_orderkey DESC, l_partkey DESC, l_suppkey DESC, l_linenumber DESC, l_quantity DESC, "
        "l_extendedprice DESC, l_discount DESC, l_tax DESC")

_PASSENGERS = """
passengers AS (
  SELECT to_base(o_custkey, 36, 6) AS passenger_id, c_name AS first_name, o_orderpriority AS last_name,
         o_orderstatus AS gender, l_linenumber AS age, h.n_name AS nationality, s_name AS airport_name,
         'C' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS airport_country_code, a.n_name AS country_name,
         substr(r_name, 1, 3) AS airport_continent, r_name AS continents, CAST(l_shipdate AS DATE) AS departure_date,
         'A' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS arrival_airport,
         CASE WHEN l_linestatus = 'F' THEN '  ' || upper(s_name) || ' ' ELSE s_name END AS pilot_name,
         l_returnflag AS flight_status, l_linestatus AS ticket_type, o_orderstatus AS passenger_status,
         md5(trim(lower(s_name)) || l_returnflag || strftime(l_shipdate, '%Y-%m-%d')
             || 'A' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0')) AS flight_id,
         l.*
  FROM lineitem l
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation a ON s_nationkey = a.n_nationkey
  JOIN region ON a.n_regionkey = r_regionkey
  JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation h ON c_nationkey = h.n_nationkey
)"""


def _dimension(surrogate: str, key: str, columns: str, direction: str) -> str:
    return f"""
  SELECT CAST(row_number() OVER (ORDER BY {key}) AS BIGINT) AS {surrogate}, * FROM (
    SELECT {columns} FROM passengers
    QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY departure_date {direction}, {_TIE}) = 1
  )"""


_DIM_PASSENGER = _dimension(
    "passenger_sk", "passenger_id", "passenger_id, first_name, last_name, gender, age, nationality", "DESC")
_DIM_AIRPORT = _dimension(
    "airport_sk", "airport_code",
    "arrival_airport AS airport_code, airport_name, airport_country_code AS country_code, country_name, "
    "airport_continent AS continent_code, continents AS continent_name", "DESC")
_DIM_FLIGHT = _dimension("flight_sk", "flight_id", "flight_id, pilot_name, flight_status", "ASC")
_DIM_DATE = """
  SELECT CAST(row_number() OVER (ORDER BY date) AS BIGINT) AS date_sk, date,
         CAST(dayofweek(date) AS INTEGER) AS day_of_week, CAST(month(date) AS INTEGER) AS month,
         CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter
  FROM (SELECT DISTINCT departure_date AS date FROM passengers)"""

_STAR = f"""WITH {_PASSENGERS},
dim_passenger AS ({_DIM_PASSENGER}), dim_airport AS ({_DIM_AIRPORT}),
dim_flight AS ({_DIM_FLIGHT}), dim_date AS ({_DIM_DATE}),
fact AS (
  SELECT md5(p.passenger_id || '|' || CAST(f.flight_sk AS VARCHAR) || '|' || strftime(p.departure_date, '%Y%m%d')) AS id,
         d.passenger_sk, f.flight_sk, a.airport_sk, t.date_sk, p.passenger_status, p.ticket_type
  FROM passengers p
  LEFT JOIN dim_passenger d ON p.passenger_id = d.passenger_id
  LEFT JOIN dim_flight f ON p.flight_id = f.flight_id
  LEFT JOIN dim_airport a ON p.arrival_airport = a.airport_code
  LEFT JOIN dim_date t ON p.departure_date = t.date
)"""

_EVENTS = """
ev AS (
  SELECT event_id, user_id, event_type, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS amount, ts FROM events
)"""


def _users(where: str) -> str:
    return f"""
  SELECT user_id, event_id, event_type, amount FROM ev WHERE {where}
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""


def _state(where: str) -> str:
    return f"SELECT * FROM ({_users(where)}) WHERE event_type <> 'error'"


_FIRST = "TIMESTAMP '2024-01-15 00:00:00'"
_SECOND = "TIMESTAMP '2024-01-25 00:00:00'"
_CUT = "TIMESTAMP '2024-01-02 00:00:00'"
_MIDDLE = "TIMESTAMP '2024-01-16 00:00:00'"

_USER_MERGE = f"""WITH {_EVENTS},
t AS ({_state(f"ts < {_CUT}")}),
s AS ({_users(f"ts >= {_CUT}")})"""

_CORE_MERGE = f"""WITH {_EVENTS},
t AS (SELECT event_id, user_id, event_type, amount FROM ev WHERE ts < {_MIDDLE}),
s AS (
  SELECT event_id, CASE WHEN event_type = 'purchase' THEN user_id + 1000 ELSE user_id END AS user_id, event_type,
         CASE WHEN event_type = 'purchase' THEN amount || '+' ELSE amount END AS amount
  FROM ev
),
pairs AS (
  SELECT t.event_id IS NOT NULL AS known, s.event_type AS kind, t.event_id AS t_id, t.user_id AS t_user,
         t.event_type AS t_type, t.amount AS t_amount, s.event_id AS s_id, s.user_id AS s_user,
         s.event_type AS s_type, s.amount AS s_amount
  FROM t FULL JOIN s ON t.event_id = s.event_id
)"""

_FACTS = """
facts AS (
  SELECT md5(CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_partkey AS VARCHAR) || '|' || strftime(l_shipdate, '%Y%m%d')) AS id,
         l_orderkey AS passenger_sk, l_partkey AS flight_sk, l_suppkey AS airport_sk,
         CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) AS date_sk,
         l_linestatus AS passenger_status, l_returnflag AS ticket_type
  FROM lineitem
)"""

_NET = f"""WITH {_EVENTS},
a AS ({_state(f"ts <= {_FIRST}")}), b AS ({_state(f"ts <= {_SECOND}")}),
net AS (
  SELECT coalesce(a.user_id, b.user_id) AS user_id,
         CASE WHEN a.user_id IS NULL THEN 'INSERT' WHEN b.user_id IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS change,
         a.event_id AS old_event, b.event_id AS new_event, a.event_type AS old_type, b.event_type AS new_type,
         b.amount AS amount
  FROM a FULL JOIN b ON a.user_id = b.user_id
  WHERE a.event_id IS DISTINCT FROM b.event_id
)"""


def _unique(table: str, keys: str, name: str) -> str:
    return f"""
  SELECT '{name}:unique({name and keys.replace(", ", ",")})' AS "constraint", count(*) AS "values",
         CAST(coalesce(sum(n), 0) AS BIGINT) AS "rows"
  FROM (SELECT count(*) AS n FROM {table} GROUP BY {keys} HAVING count(*) > 1)"""


def _reference(table: str, column: str, parent: str, key: str) -> str:
    return f"""
  SELECT '{table}:reference({column})' AS "constraint", count(DISTINCT {column}) AS "values", count(*) AS "rows"
  FROM {table} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {parent})"""


_METRICS_CORE = """
  SELECT count(*) FILTER (WHERE NOT known) AS inserted,
         count(*) FILTER (WHERE known AND kind = 'purchase') AS updated,
         count(*) FILTER (WHERE known AND kind = 'error') AS deleted
  FROM pairs"""

ORACLES: dict[str, str] = {
    "raw_null_tokens": """
SELECT o_orderkey, CASE WHEN o_orderstatus NOT IN ('P', '') THEN o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderpriority NOT IN ('P', '') THEN o_orderpriority END AS o_orderpriority
FROM orders""",
    "csv_load": """
SELECT CAST(o_orderkey AS VARCHAR) AS order_key,
       CASE WHEN o_orderpriority <> '2-HIGH' THEN CAST(o_custkey AS VARCHAR) END AS cust_key,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status,
       replace(o_orderpriority, '-', ',"') AS priority
FROM orders
WHERE NOT (o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '5-LOW'))""",
    "load_history": """
SELECT event_type, CASE WHEN min(value) > 20 THEN 'Load failed' WHEN max(value) > 20 THEN 'Partially loaded' ELSE 'Loaded' END AS status,
       count(*) AS rows_parsed, count(*) FILTER (WHERE value <= 20) AS rows_loaded,
       count(*) FILTER (WHERE value > 20) AS error_rows, min(place) FILTER (WHERE value > 20) AS first_error_line_number,
       CASE WHEN max(value) > 20 THEN 'row has 4 cells, table has 3 columns' END AS first_error_message
FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) + 1 AS place FROM events) GROUP BY event_type""",
    "csv_quoted_breaks": """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, source, CAST(length(text) - length(replace(text, chr(10), '')) AS BIGINT) AS n_breaks,
       md5(text) AS text_md5
FROM (SELECT doc_id, source, CASE WHEN text NOT IN ('', 'NULL') THEN text END AS text FROM documents)""",
    "load_once": f"""
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type
FROM events WHERE ts >= {_MIDDLE}""",
    "staging_refill": f"""WITH {_EVENTS}
SELECT event_id, user_id, event_type, amount FROM ev WHERE ts >= {_MIDDLE} OR event_type = 'error'""",
    "recent_load_window": """
SELECT event_id, user_id, event_type FROM events
WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
    "typed_core": """
SELECT CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(10,0)) AS BIGINT) AS index_col,
       CAST(l_orderkey AS VARCHAR) AS order_key, CAST(l_partkey AS VARCHAR) AS part_key,
       CASE WHEN l_returnflag <> 'R' THEN CAST(CAST(l_quantity AS DECIMAL(4,0)) AS INTEGER) END AS age,
       CASE WHEN l_linestatus <> 'F' THEN CAST(l_shipdate AS DATE) END AS departure_date
FROM lineitem""",
    "scalar_functions": """
SELECT l_orderkey, l_partkey, l_linenumber,
       md5(trim(lower(CASE WHEN l_returnflag <> 'N' THEN ' ' || upper(s_name) || '  ' END)) || l_linestatus
           || strftime(l_shipdate, '%Y-%m-%d') || CAST(l_suppkey AS VARCHAR)) AS flight_id,
       md5(CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_partkey AS VARCHAR) || '|' || strftime(l_shipdate, '%Y%m%d')) AS fact_id,
       CAST(dayofweek(l_shipdate) AS INTEGER) AS day_of_week, CAST(month(l_shipdate) AS INTEGER) AS month,
       CAST(year(l_shipdate) AS INTEGER) AS year, CAST(quarter(l_shipdate) AS INTEGER) AS quarter,
       strftime(l_shipdate - INTERVAL 1 HOUR, '%Y-%m-%d %H:%M') AS hour_before,
       strftime(l_shipdate, '%Y%m%d') AS day_text, l_returnflag IS NOT NULL AS has_flag
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "quarantine": """
SELECT o_orderkey, concat_ws(',',
         CASE WHEN o_orderstatus = 'P' THEN 'o_orderstatus:not_null' END,
         CASE WHEN length(o_orderpriority) > 8 THEN 'o_orderpriority:width' END,
         CASE WHEN o_totalprice > 300000 THEN 'o_totalprice:limit' END) AS violations
FROM orders
WHERE o_orderstatus = 'P' OR length(o_orderpriority) > 8 OR o_totalprice > 300000""",
    "dim_passenger": f"WITH {_PASSENGERS} {_DIM_PASSENGER}",
    "dim_airport": f"WITH {_PASSENGERS} {_DIM_AIRPORT}",
    "dim_flight": f"WITH {_PASSENGERS} {_DIM_FLIGHT}",
    "dim_date": f"WITH {_PASSENGERS} {_DIM_DATE}",
    "surrogate_keys": """
SELECT CAST(row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS customer_sk, c_custkey, c_name FROM customer""",
    "hot_key_lookup": """
SELECT o_orderkey, o_orderpriority, priority_sk FROM orders LEFT JOIN (
  SELECT o_orderpriority, CAST(row_number() OVER (ORDER BY o_orderpriority) AS BIGINT) AS priority_sk
  FROM (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority <> '3-MEDIUM')
) USING (o_orderpriority)""",
    "fact_build": f"{_STAR} SELECT * FROM fact",
    "mart_daily": f"""{_STAR}
SELECT date, year, quarter, month, day_of_week, count(*) AS n_facts, count(DISTINCT passenger_sk) AS n_passengers,
       count(DISTINCT flight_sk) AS n_flights
FROM fact JOIN dim_date USING (date_sk) GROUP BY date, year, quarter, month, day_of_week""",
    "mart_region": f"""{_STAR}
SELECT continent_name, year, count(*) AS n_facts
FROM fact JOIN dim_airport USING (airport_sk) JOIN dim_date USING (date_sk) GROUP BY continent_name, year""",
    "merge_core": f"""{_CORE_MERGE}
SELECT coalesce(t_id, s_id) AS event_id, CASE WHEN known THEN t_user ELSE s_user END AS user_id,
       coalesce(t_type, s_type) AS event_type,
       CASE WHEN known AND kind <> 'purchase' THEN t_amount ELSE s_amount END AS amount
FROM pairs WHERE NOT (known AND kind = 'error')""",
    "merge_core_changes": f"""{_CORE_MERGE}
SELECT s_id AS event_id, s_user AS user_id, s_type AS event_type, s_amount AS amount, 'INSERT' AS _action, FALSE AS _is_update
FROM pairs WHERE NOT known
UNION ALL SELECT t_id, t_user, t_type, t_amount, 'DELETE', kind = 'purchase' FROM pairs WHERE known AND kind IN ('error', 'purchase')
UNION ALL SELECT t_id, t_user, t_type, s_amount, 'INSERT', TRUE FROM pairs WHERE known AND kind = 'purchase'""",
    "merge_scd1": f"""{_USER_MERGE}
SELECT coalesce(s.user_id, t.user_id) AS user_id, coalesce(s.event_id, t.event_id) AS event_id,
       coalesce(s.event_type, t.event_type) AS event_type, coalesce(s.amount, t.amount) AS amount
FROM t FULL JOIN s ON t.user_id = s.user_id WHERE s.event_type IS DISTINCT FROM 'error'""",
    "merge_literal": f"""{_USER_MERGE}
SELECT coalesce(t.user_id, s.user_id) AS user_id, coalesce(t.event_id, s.event_id) AS event_id,
       coalesce(t.event_type, s.event_type) AS event_type, coalesce(t.amount, s.amount) AS amount
FROM t FULL JOIN s ON t.user_id = s.user_id WHERE s.event_type IS DISTINCT FROM 'error'""",
    "merge_fact": f"""WITH {_FACTS}, t AS (SELECT * FROM facts WHERE date_sk < 19980101)
SELECT * FROM t UNION ALL SELECT * FROM facts f WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.id = f.id)""",
    "merge_metrics": f"""{_CORE_MERGE}
SELECT *, inserted + updated + deleted AS rows_affected FROM ({_METRICS_CORE})""",
    "cdc_net_changes": f"{_NET} SELECT user_id, change, old_event, new_event FROM net",
    "cdc_snapshot_diff": f"{_NET} SELECT user_id, change, amount FROM net",
    "cdc_pairs": f"""{_NET}
SELECT user_id, event_id, event_type, _action, _is_update, sha256('{{"user_id":' || CAST(user_id AS VARCHAR) || '}}') AS _row_id
FROM (
  SELECT user_id, old_event AS event_id, old_type AS event_type, 'DELETE' AS _action, change = 'UPDATE' AS _is_update
  FROM net WHERE change <> 'INSERT'
  UNION ALL
  SELECT user_id, new_event, new_type, 'INSERT', change = 'UPDATE' FROM net WHERE change <> 'DELETE'
)""",
    "stream_has_data": f"{_NET} SELECT count(*) > 0 AS has_data FROM net",
    "as_of_timestamp": f"WITH {_EVENTS} {_state(f'ts <= {_FIRST}')}",
    "before_statement": f"WITH {_EVENTS} {_state(f'ts <= {_FIRST}')}",
    "clone_as_of": f"WITH {_EVENTS} {_state(f'ts <= {_FIRST}')}",
    "table_after_changes": f"WITH {_EVENTS} {_state(f'ts <= {_SECOND}')}",
    "undrop": """
SELECT user_id, event_type AS last_event, event_type <> 'error' AS live FROM events
WHERE event_type IN ('error', 'signup')
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "secure_view": """
SELECT * FROM (
  SELECT md5(CAST(o_orderkey AS VARCHAR)) AS id, o_custkey AS passenger_sk, o_orderkey AS flight_sk,
         CAST(o_orderdate AS DATE) AS date_sk, n_name AS airport_name, substr(n_name, 8, 2) AS airport_code,
         n_name AS country_name, r_name AS continent_name
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  ORDER BY id LIMIT 100
) WHERE continent_name = 'EUROPE'""",
    "constraint_report": " UNION ALL ".join([
        _unique("lineitem", "l_orderkey, l_linenumber", "lineitem"),
        _unique("orders", "o_orderkey", "orders"),
        _reference("lineitem", "l_orderkey", "orders", "o_orderkey"),
        _reference("lineitem", "l_partkey", "part", "p_partkey"),
        _reference("lineitem", "l_suppkey", "supplier", "s_suppkey"),
        _reference("orders", "o_custkey", "customer", "c_custkey"),
    ]),
    "stream_incremental": f"WITH {_EVENTS} {_state('TRUE')}",
    "warehouse_incremental": f"""WITH {_PASSENGERS}
SELECT continents AS continent_name, CAST(year(departure_date) AS INTEGER) AS year,
       count(DISTINCT (passenger_id, flight_id, departure_date)) AS n_facts
FROM passengers GROUP BY continents, year(departure_date)""",
}
