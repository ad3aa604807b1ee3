"""DuckDB SQL used by the correctness gate.

``MAPPING`` re-states ``lotwise.sources.driver_tables`` as CTEs named ``m_*``
over the driver's pre-registered views; each oracle query is
``WITH <MAPPING>, <query CTEs> <final SELECT>``.  Oracle hygiene: DOUBLE
literals, BIGINT counts, unique tie-breaks, explicit NULLS LAST.
"""
from __future__ import annotations

from lotwise.contracts import BODY_TYPES
from lotwise.sources.driver_tables import AGE_BANDS, CHANNELS, FUEL_TYPES, SOURCES, TYPE_TO_BODY


def _case(values, expr: str) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"(CASE {expr} {arms} END)"


_BODY = "(CASE p.p_type " + " ".join(f"WHEN '{t}' THEN '{b}'" for t, b in TYPE_TO_BODY) + " END)"
_SRC = tuple(s for s, _ in SOURCES)
_MED = tuple(m for _, m in SOURCES)

MAPPING = f"""
m_users AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS user_id,
         DATE '2023-10-01' + CAST(c.c_custkey % 90 AS INTEGER) AS signup_date,
         n.n_name AS home_city,
         {_case(AGE_BANDS, 'c.c_custkey % 4')} AS age_band,
         c.c_mktsegment AS income_band,
         CAST(CAST(800000 + (c.c_custkey * 37 % 1300) * 1000 AS DOUBLE) AS DOUBLE) AS maximum_budget,
         CAST(800000 + (c.c_custkey * 37 % 1300) * 1000 AS DOUBLE) * CAST(0.8 AS DOUBLE) AS ideal_budget,
         {_case(BODY_TYPES, 'c.c_custkey % 5')} AS preferred_body_types,
         'Brand#' || CAST(c.c_custkey % 25 + 1 AS VARCHAR) AS preferred_makes,
         CAST(c.c_custkey % 10 AS DOUBLE) / 10.0 AS first_time_buyer_probability,
         CAST(c.c_custkey % 7 AS DOUBLE) / 7.0 AS quality_sensitivity,
         CAST(c.c_custkey % 11 AS DOUBLE) / 11.0 AS price_sensitivity,
         CAST(c.c_custkey % 13 AS DOUBLE) / 13.0 AS brand_loyalty,
         CAST(c.c_custkey % 17 AS DOUBLE) / 17.0 AS exploration_tendency,
         CAST(c.c_custkey % 19 AS DOUBLE) / 19.0 AS finance_interest,
         CAST(c.c_custkey % 23 AS DOUBLE) / 23.0 AS purchase_urgency
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
m_cars AS (
  SELECT CAST(p.p_partkey AS VARCHAR) AS car_id,
         p.p_brand AS make, p.p_type AS model, p.p_name AS variant,
         {_BODY} AS body_type,
         {_case(FUEL_TYPES, 'p.p_partkey % 3')} AS fuel_type,
         CASE WHEN p.p_size % 3 = 0 THEN 'Automatic' ELSE 'Manual' END AS transmission,
         CAST(2010 + p.p_size % 14 AS INTEGER) AS manufacturing_year,
         CAST(2010 + p.p_size % 14 + p.p_partkey % 2 AS INTEGER) AS registration_year,
         CAST(p.p_size * 1500 + (p.p_partkey % 1000) * 10 AS DOUBLE) AS kilometres_driven,
         CAST(p.p_partkey % 3 + 1 AS INTEGER) AS owner_count,
         n.n_name AS city,
         'STATE_' || CAST(n.n_regionkey AS VARCHAR) AS state,
         CAST(1000 + p.p_size * 20 AS DOUBLE) AS engine_cc,
         CAST(12 + p.p_size % 10 AS DOUBLE) AS claimed_mileage_kmpl,
         p.p_partkey % 4 <> 0 AS insurance_valid,
         p.p_partkey % 3 <> 0 AS service_history_available,
         p.p_partkey % 11 = 0 AS accident_history,
         CAST(50 + p.p_size AS DOUBLE) AS exterior_score,
         CAST(50 + p.p_size AS DOUBLE) - 1.0 AS interior_score,
         CAST(50 + p.p_size AS DOUBLE) - 2.0 AS engine_score,
         CAST(50 + p.p_size AS DOUBLE) - 3.0 AS tyre_score,
         p.p_partkey % 2 = 0 AS delivery_available,
         p.p_partkey % 3 <> 1 AS finance_available,
         CAST(p.p_size % 10 AS DOUBLE) / 10.0 AS model_popularity,
         CAST(50 + p.p_size AS DOUBLE) AS inspection_score,
         CAST(p.p_size % 20 + 5 AS INTEGER) AS number_of_features,
         p.p_retailprice * CAST(1000.0 AS DOUBLE) * CAST(0.85 AS DOUBLE) AS acquisition_price,
         p.p_retailprice * CAST(1000.0 AS DOUBLE) AS listed_price,
         DATE '2023-11-01' + CAST(p.p_partkey % 75 AS INTEGER) AS inventory_entry_date,
         CASE WHEN p.p_partkey % 5 < 3
              THEN DATE '2023-11-01' + CAST(p.p_partkey % 75 AS INTEGER) + CAST(p.p_size * 4 AS INTEGER)
         END AS inventory_exit_date,
         (p.p_partkey % 5 < 3) AS sold_flag,
         CASE WHEN p.p_partkey % 5 < 3
              THEN p.p_retailprice * CAST(1000.0 AS DOUBLE) * (CAST(93 + p.p_partkey % 8 AS DOUBLE) / CAST(100.0 AS DOUBLE))
         END AS transaction_price,
         CAST(p.p_size * 4 AS INTEGER) AS days_in_inventory
  FROM part p LEFT JOIN nation n ON p.p_partkey % 5 = n.n_nationkey
),
m_campaigns AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS campaign_id, s_name AS campaign_name,
         {_case(CHANNELS, 's_suppkey % 4')} AS channel,
         DATE '2024-01-01' AS start_date, DATE '2024-01-30' AS end_date,
         CAST(3000 + s_suppkey * 100 AS DOUBLE) AS daily_budget,
         CAST(5 + (s_suppkey % 5) * 4 AS DOUBLE) AS cost_per_click
  FROM supplier
),
m_events_raw AS (
  SELECT e.*, dayofyear(e.ts) AS doy, n.n_name AS nation_name,
         CASE e.event_type
           WHEN 'view' THEN {_case(('view_search_results', 'view_item', 'view_gallery'), 'e.event_id % 3')}
           WHEN 'click' THEN {_case(('select_item', 'view_inspection_report', 'calculate_emi', 'add_to_wishlist'), 'e.event_id % 4')}
           WHEN 'signup' THEN {_case(('apply_filter', 'request_callback', 'book_test_drive'), 'e.event_id % 3')}
           WHEN 'purchase' THEN CASE WHEN e.event_id % 4 = 0 THEN 'purchase' ELSE 'booking_complete' END
           WHEN 'error' THEN CASE WHEN e.event_id % 2 = 0 THEN 'search' ELSE 'view_item' END
           ELSE 'view_home' END AS ename,
         (e.event_type IN ('click', 'purchase')
          OR (e.event_type = 'view' AND e.event_id % 3 > 0)
          OR (e.event_type = 'signup' AND e.event_id % 3 > 0)
          OR (e.event_type = 'error' AND e.event_id % 2 = 1)) AS carries_car
  FROM events e LEFT JOIN nation n ON e.user_id % 25 = n.n_nationkey
),
m_events AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         ts AS event_timestamp,
         CAST(ts AS DATE) AS event_date,
         CAST(user_id AS VARCHAR) AS user_id,
         CAST(user_id * 1000 + doy AS VARCHAR) AS session_id,
         ename AS event_name,
         CASE WHEN carries_car THEN CAST(event_id * 7919 % (SELECT count(*) FROM part) AS VARCHAR) END AS car_id,
         CASE WHEN ename IN ('view_search_results', 'select_item') THEN CAST(event_id % 10 + 1 AS INTEGER) END AS list_position,
         CASE WHEN ename = 'apply_filter' THEN
           {_case(('body_type', 'transmission', 'max_price', 'fuel_type'), 'event_id % 4')} END AS filter_name,
         CASE WHEN ename = 'apply_filter' THEN
           CASE event_id % 4
             WHEN 0 THEN {_case(BODY_TYPES, 'event_id % 5')}
             WHEN 1 THEN CASE WHEN event_id % 5 < 2 THEN 'Automatic' ELSE 'Manual' END
             WHEN 2 THEN CAST(800000 + (event_id % 13) * 100000 AS VARCHAR)
             ELSE {_case(FUEL_TYPES, 'event_id % 7 % 3')} END
         END AS filter_value,
         value AS engagement_time_seconds,
         {_case(_SRC, 'user_id % 4')} AS source,
         {_case(_MED, 'user_id % 4')} AS medium,
         CAST((user_id + doy) % (SELECT count(*) FROM supplier) AS VARCHAR) AS campaign_id,
         {_case(('mobile', 'desktop', 'tablet'), 'user_id % 3')} AS device_category,
         nation_name AS city
  FROM m_events_raw
),
m_sessions_agg AS (
  SELECT session_id, MIN(user_id) AS user_id,
         MIN(event_timestamp) AS session_start, MAX(event_timestamp) AS session_end,
         MIN(campaign_id) AS campaign_id, MIN(source) AS source, MIN(medium) AS medium,
         MIN(device_category) AS device_category, MIN(city) AS city
  FROM m_events GROUP BY session_id
),
m_sessions AS (
  SELECT *,
         CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY session_start, session_id) AS INTEGER)
           AS session_sequence_number,
         ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY session_start, session_id) > 1 AS is_returning_user
  FROM m_sessions_agg
),
m_impressions AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) AS session_id,
         CAST(o.o_custkey AS VARCHAR) AS user_id,
         CAST(l.l_partkey AS VARCHAR) AS car_id,
         CAST(l.l_linenumber AS INTEGER) AS list_position,
         l.l_quantity >= 10 AS examined, l.l_quantity >= 25 AS clicked,
         l.l_quantity >= 30 AS viewed_gallery, l.l_quantity >= 33 AS viewed_inspection,
         l.l_quantity >= 35 AS compared, l.l_quantity >= 37 AS emi_calculated,
         l.l_quantity >= 40 AS wishlisted, l.l_quantity >= 42 AS callback,
         l.l_quantity >= 45 AS booked,
         (l.l_quantity >= 48 AND l.l_returnflag = 'R') AS purchased,
         o.o_orderdate AS event_timestamp,
         CAST(l.l_orderkey % (SELECT count(*) FROM supplier) AS VARCHAR) AS campaign_id
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""


def with_mapping(query_ctes: str, final_select: str) -> str:
    """Compose the mapping CTEs, the query's own CTEs and its final SELECT."""
    ctes = MAPPING + (",\n" + query_ctes.strip().rstrip(",") if query_ctes.strip() else "")
    return f"WITH {ctes}\n{final_select.strip()}"
