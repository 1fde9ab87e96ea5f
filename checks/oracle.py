"""Independent SQL for every registered query, for DuckDB over the same tables."""

from __future__ import annotations

_POINTS = """
  SELECT DISTINCT c_mktsegment AS grp, c_acctbal AS x, c_nationkey AS y,
         round(c_acctbal, -2) AS cx
  FROM customer
"""

_NAMED_ORDERS = """
  SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'Express' WHEN '5-LOW' THEN 'Local'
              ELSE o_orderpriority END AS operator_name,
         CAST(o_orderdate AS DATE) AS day,
         CAST(trunc(o_totalprice / 700) AS BIGINT) AS num_trips
  FROM orders
"""

_DAILY_NAMED = f"""
  SELECT operator_name, day, CAST(sum(num_trips) AS BIGINT) AS total,
         CASE WHEN isodow(day) >= 6 THEN 'weekend' ELSE 'weekday' END AS day_type
  FROM ({_NAMED_ORDERS}) GROUP BY operator_name, day
"""

# Stops: text coordinates are the numbers themselves; three nations have unreadable ones.
# Cells are counted in whole cents of balance, so that no binary rounding is involved.
_STOPS = """
  SELECT feed, cents, nation, round(cents / 1000.0) AS cell FROM (
    SELECT c_mktsegment AS feed, CAST(round(c_acctbal * 100) AS BIGINT) AS cents,
           c_nationkey AS nation FROM customer
    UNION
    SELECT 'SUPPLIER', CAST(round(s_acctbal * 100) AS BIGINT), s_nationkey FROM supplier)
  WHERE nation NOT IN (7, 8, 9)
"""

_STOP_SECONDS = """
  SELECT l_orderkey AS trip, l_returnflag = 'R' AS late_snapshot,
         (l_partkey % 1500) * 60 + l_linenumber * 7 AS secs
  FROM lineitem WHERE CAST(l_quantity AS INTEGER) NOT IN (1, 2, 3) AND l_orderkey % 9 NOT IN (4, 5)
"""

_TRAIN_TRIPS = """
  SELECT o_orderkey AS trip, c_nationkey AS route, nullif(o_orderstatus, 'P') AS direction
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 9 <> 4
"""

# Row-wise form: every departure is kept and zero gaps are dropped after the lag.
_TRAIN_GAPS = f"""
  SELECT route, direction, trip, secs, gap FROM (
    SELECT route, direction, trip, secs,
           secs - lag(secs) OVER (PARTITION BY route, direction ORDER BY secs, trip) AS gap
    FROM ({_TRAIN_TRIPS}) JOIN (
      SELECT trip, min(secs) AS secs FROM ({_STOP_SECONDS}) GROUP BY trip) USING (trip))
  WHERE gap <> 0
"""

_LINE = "'Line ' || CAST(n_regionkey AS VARCHAR) || ' ' || right(n_name, 1)"

_SERVICE = """
  SELECT CASE o_orderpriority
           WHEN '1-URGENT' THEN CASE o_orderstatus WHEN 'O' THEN 'LRT Ampang Line'
                                                   WHEN 'F' THEN 'ZZZ' ELSE 'AB' END
           WHEN '2-HIGH' THEN 'Rapid Bus KL' ELSE o_orderpriority END AS operator_name,
         CASE WHEN o_custkey % 50 <> 0 AND NOT (o_orderpriority = '5-LOW' AND isodow(o_orderdate) >= 6)
              THEN CAST(o_orderdate AS DATE) END AS day,
         CASE WHEN o_custkey % 50 <> 1 THEN o_custkey % 20 * 60 END AS headway,
         CASE WHEN o_custkey % 50 = 2 THEN NULL
              WHEN o_custkey % 50 = 3 THEN 4 * 3600
              ELSE (9 + CAST(floor(o_totalprice) AS BIGINT) % 17) * 3600 + 15 * 60 + 20 END
           - (5 + o_custkey % 4) * 3600 - 30 * 60 AS duration
  FROM orders
"""

#: The same with the last character of the trip id.
_SERVICE_ENDS = _SERVICE.replace(
    "FROM orders", ", CASE WHEN o_orderstatus IN ('O', 'F') THEN right(CAST(o_orderkey AS VARCHAR), 1) ELSE 'B' END AS cut FROM orders"
)

_REASON = """
  CASE WHEN day IS NULL THEN 'bad_date' WHEN duration IS NULL THEN 'bad_time'
       WHEN headway IS NULL THEN 'bad_headway' WHEN headway = 0 THEN 'zero_headway' END
"""

_SERVICE_DAILY = f"""
  SELECT operator_name, day, CASE WHEN isodow(day) >= 6 THEN 'weekend' ELSE 'weekday' END AS day_type,
         CAST(sum(CAST(trunc(duration / headway) AS BIGINT)) AS BIGINT) AS total
  FROM ({_SERVICE}) WHERE {_REASON} IS NULL GROUP BY operator_name, day
"""

_LAG = """
  SELECT user_id, event_id,
         lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_event_id
  FROM events
"""


def _wait(gap: str) -> str:
    return f"""
  round(min({gap}) / 60) AS minimum_waiting_time,
  round(CAST(sum({gap}) AS DOUBLE) / (60 * count(*))) AS average_waiting_time,
  round(max({gap}) / 60) AS maximum_waiting_time"""


ORACLE: dict[str, str] = {
    "distinct_per_group": """
        SELECT p_brand, count(DISTINCT p_type) AS type_count FROM part
        WHERE p_brand NOT IN ('Brand#1', 'Brand#2') GROUP BY p_brand
    """,
    "isolated_owner": f"""
        SELECT grp AS c_mktsegment, count(*) AS points FROM (
          SELECT grp, cx, y FROM (
            SELECT min(grp) AS grp, x, y, any_value(cx) AS cx FROM ({_POINTS}) GROUP BY x, y)
          GROUP BY grp, cx, y HAVING count(*) = 1)
        GROUP BY grp
    """,
    "isolated_exclusive": f"""
        WITH alone AS (
          SELECT grp, cx, y FROM ({_POINTS}) GROUP BY grp, cx, y HAVING count(*) = 1)
        SELECT grp AS c_mktsegment, count(*) AS points FROM alone a
        WHERE NOT EXISTS (
          SELECT 1 FROM alone b WHERE b.cx = a.cx AND b.y = a.y AND b.grp <> a.grp)
        GROUP BY grp
    """,
    "isolated_each": f"""
        SELECT grp AS c_mktsegment, count(*) AS points FROM (
          SELECT grp FROM ({_POINTS}) GROUP BY grp, cx, y HAVING count(*) = 1)
        GROUP BY grp
    """,
    "window_unique": """
        SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year,
               CAST(month(o_orderdate) AS INTEGER) AS month, o_orderpriority
        FROM orders
        QUALIFY count(*) OVER (PARTITION BY o_custkey, year(o_orderdate), month(o_orderdate)) = 1
    """,
    "dedup_group_values": """
        SELECT l_partkey, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY l_partkey
    """,
    "first_per_key": """
        SELECT o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderkey, o_orderpriority
        FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1
    """,
    "latest_per_key": """
        SELECT user_id, event_id, event_type FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    """,
    "lag_per_group": _LAG,
    "lag_per_group_cut": _LAG,
    "lag_per_group_sampled": _LAG,
    "headway_stats": f"""
        WITH trips AS (
          SELECT c_nationkey AS route, o_orderstatus AS direction, o_orderkey AS trip
          FROM orders JOIN customer ON o_custkey = c_custkey),
        first AS (
          SELECT l_orderkey AS trip, min(l_shipdate) AS departure FROM lineitem GROUP BY l_orderkey),
        gaps AS (
          SELECT route, date_diff('second', lag(departure) OVER (
                   PARTITION BY route, direction ORDER BY departure, trip), departure) AS gap
          FROM trips JOIN first USING (trip))
        SELECT replace(n_name, ' ', '-') AS n_name, {_wait('gap')}
        FROM gaps JOIN nation ON route = n_nationkey WHERE gap <> 0 GROUP BY n_name
    """,
    "prefix_relabel": """
        SELECT replace(CASE label WHEN 'ECO' THEN 'Economy line' WHEN 'PRO' THEN 'Promo line'
                       WHEN 'Brand#2' THEN 'Second brand' ELSE label END, ' ', '-') AS operator,
               count(*) AS parts
        FROM (SELECT CASE WHEN p_brand = 'Brand#1' THEN left(p_type, 3) ELSE p_brand END AS label
              FROM part)
        GROUP BY 1
    """,
    "relabel_by_table": """
        SELECT c_custkey, coalesce(n_name, CAST(c_nationkey AS VARCHAR)) AS operator
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey <> 0
    """,
    "clock_to_seconds": """
        SELECT event_id,
               CASE WHEN event_type IN ('click', 'view', 'error') THEN
                 CAST(hour(ts) * 3600 + minute(ts) * 60 + floor(second(ts))
                      + CASE event_type WHEN 'error' THEN 86400 ELSE 0 END AS BIGINT)
               END AS clock_seconds
        FROM events
    """,
    "reject_counts": """
        SELECT count(*) AS "rows",
               count(*) FILTER (event_type = 'signup') AS blank,
               count(*) FILTER (event_type = 'error') AS not_a_number,
               count(*) FILTER (event_type NOT IN ('signup', 'error') AND value < 5) AS small,
               count(*) FILTER (event_type NOT IN ('signup', 'error') AND value > 100) AS large,
               count(*) FILTER (event_type NOT IN ('signup', 'error') AND value >= 5) AS accepted
        FROM events
    """,
    "split_rejects": """
        SELECT o_orderstatus,
               CASE WHEN o_totalprice < 20000 THEN 'cheap' WHEN o_orderstatus = 'O' THEN 'open'
                    ELSE 'accepted' END AS reject_reason,
               count(*) AS orders
        FROM orders GROUP BY ALL
    """,
    "daily_sum": """
        SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS day,
               CAST(sum(CAST(trunc(o_totalprice / 700) AS BIGINT)) AS BIGINT) AS total_trips
        FROM orders GROUP BY 1, 2
    """,
    "avg_by_day_type": f"""
        SELECT operator_name, day_type, CAST(trunc(avg(total)) AS BIGINT) AS avg_daily_trips
        FROM ({_DAILY_NAMED}) GROUP BY operator_name, day_type
    """,
    "avg_by_day_type_rounded": f"""
        SELECT operator_name, day_type, CAST(floor(avg(total) + 0.5) AS BIGINT) AS avg_daily_trips
        FROM ({_DAILY_NAMED}) GROUP BY operator_name, day_type
    """,
    "day_type_pivot": f"""
        SELECT operator_name,
               CAST(trunc(avg(total) FILTER (day_type = 'weekday')) AS BIGINT)
                 AS weekday_avg_daily_trips,
               CAST(trunc(avg(total) FILTER (day_type = 'weekend')) AS BIGINT)
                 AS weekend_avg_daily_trips
        FROM ({_DAILY_NAMED}) GROUP BY operator_name
    """,
    "merge_snapshots": """
        WITH rows AS (
          SELECT *, CASE WHEN event_type IN ('purchase', 'signup') THEN 'shop' ELSE 'site' END
                      AS feed_id,
                 CAST(CAST(ts AS DATE) AS VARCHAR) AS subdir,
                 ts >= TIMESTAMP '2024-01-16' AS later
          FROM events)
        SELECT feed_id, subdir, count(*) AS events,
               count(*) FILTER (later) AS with_value,
               count(*) FILTER (feed_id = 'site' AND NOT later) AS with_props,
               CAST(sum(user_id) AS BIGINT) AS user_sum,
               count(DISTINCT event_type) AS event_types,
               max(value) FILTER (later) AS max_value,
               max(length(props)) FILTER (feed_id = 'site' AND NOT later) AS longest_props
        FROM rows GROUP BY feed_id, subdir
    """,
    "merge_feeds": """
        SELECT 'customers' AS feed_id, c_custkey AS id, c_name AS name,
               CAST(NULL AS INTEGER) AS nation, c_mktsegment AS segment,
               'customers__' || CAST(c_custkey AS VARCHAR) || '__' || c_mktsegment AS key
        FROM customer
        UNION ALL
        SELECT 'suppliers', s_suppkey, s_name, s_nationkey, NULL,
               'suppliers__' || CAST(s_suppkey AS VARCHAR)
        FROM supplier
    """,
    "csv_scan_inferred": """
        SELECT p_type || ', ' || p_name AS note, count(*) AS parts,
               CAST(sum(p_partkey) AS BIGINT) AS key_sum, CAST(max(p_size) AS BIGINT) AS largest,
               max(p_retailprice) AS dearest
        FROM part GROUP BY 1
    """,
    "csv_short_rows": """
        SELECT p_brand, count(*) AS parts, count(*) FILTER (p_size % 4 <> 0) AS with_type,
               count(*) FILTER (p_size % 4 NOT IN (0, 1)) AS with_price,
               max(p_retailprice) FILTER (p_size % 4 NOT IN (0, 1)) AS dearest
        FROM part GROUP BY p_brand
    """,
    "csv_field_guard": """
        SELECT p_brand, CASE WHEN p_size % 4 < 2 THEN 'short_row' WHEN p_size % 4 = 3 THEN 'long_row' ELSE 'accepted' END AS reject_reason,
               count(*) AS "rows", count(*) FILTER (p_size % 4 > 0) AS with_type, max(p_retailprice) FILTER (p_size % 4 > 1) AS dearest
        FROM part GROUP BY 1, 2
    """,
    "merge_inferred": """
        WITH e AS (SELECT *, CASE WHEN event_id % 2 = 0 THEN 'near' ELSE 'far' END AS feed_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS subdir FROM events)
        SELECT feed_id, subdir, 'double,string,date,' || CASE WHEN (SELECT max(event_id) FROM events) > 2147483647 THEN 'bigint' ELSE 'int' END AS kinds,
               count(*) AS "rows", CAST(sum(event_id) AS BIGINT) AS ids, max(CASE WHEN feed_id = 'near' THEN trunc(value) ELSE value END) AS most,
               max(length(CASE WHEN feed_id = 'near' THEN CAST(user_id AS VARCHAR) ELSE event_type END)) AS longest,
               count(*) FILTER (feed_id = 'near') AS same_day
        FROM e GROUP BY 1, 2
    """,
    "csv_one_file": """
        SELECT n_regionkey AS region, count(*) AS nations, min(n_name) AS first, 1 AS files
        FROM nation GROUP BY n_regionkey
    """,
    "table_if_database": """
        SELECT p_brand, count(*) AS parts, CAST(sum(p_size) AS BIGINT) AS sizes, TRUE AS saved, FALSE AS elsewhere
        FROM part GROUP BY p_brand
    """,
    "publish_report": """
        SELECT p_brand AS feed_id, count(DISTINCT p_type) AS types, 1 AS files FROM part GROUP BY p_brand
    """,
    "merge_tables": """
        WITH files AS (
          SELECT 'routes' AS kind, CASE WHEN p_size % 2 = 0 THEN 'north' ELSE 'south' END AS feed_id,
                 CASE WHEN p_size % 3 = 0 THEN '2024-10-01' WHEN p_size % 3 = 1 THEN '2024-10-02'
                      ELSE '2024-10-05' END AS subdir,
                 p_partkey AS id, length(p_name) AS size FROM part
          UNION ALL
          SELECT 'stops', CASE WHEN c_nationkey % 2 = 0 THEN 'north' ELSE 'south' END,
                 CASE WHEN c_nationkey % 3 = 0 THEN '2024-10-01' WHEN c_nationkey % 3 = 1 THEN '2024-10-02'
                      ELSE '2024-10-05' END,
                 c_custkey, length(c_name) FROM customer)
        SELECT kind, feed_id, subdir, CAST(subdir AS DATE) AS snapshot_date, count(*) AS "rows",
               CAST(sum(id) AS BIGINT) AS ids, CAST(sum(size) FILTER (subdir <> '2024-10-01') AS BIGINT) AS sizes,
               CASE kind WHEN 'routes' THEN 'subdir,color,route_id,route_name' ELSE 'subdir,stop_id,stop_name' END AS columns
        FROM files WHERE subdir < '2024-10-05' GROUP BY ALL
    """,
    "bus_routes_per_feed": """
        SELECT p_brand AS feed_id,
               count(DISTINCT CASE WHEN p_size > 1 THEN p_name || ' ' || p_type END) AS route_count
        FROM part WHERE p_brand NOT IN ('Brand#1', 'Brand#2', 'Brand#3') GROUP BY p_brand
    """,
    "disconnected_stops": f"""
        WITH points AS (
          SELECT min(feed) AS feed, any_value(cell) AS cell, cents, nation
          FROM ({_STOPS}) GROUP BY cents, nation)
        SELECT feed AS feed_id, count(*) AS stop_count FROM (
          SELECT feed FROM points GROUP BY feed, cell, nation HAVING count(*) = 1)
        GROUP BY feed
    """,
    "disconnected_stops_exclusive": f"""
        WITH alone AS (
          SELECT feed, cell, nation FROM ({_STOPS}) GROUP BY feed, cell, nation
          HAVING count(*) = 1)
        SELECT feed AS feed_id, count(*) AS stop_count FROM (
          SELECT feed, count(*) OVER (PARTITION BY cell, nation) AS feeds FROM alone)
        WHERE feeds = 1 GROUP BY feed
    """,
    "waiting_time": f"""
        SELECT replace({_LINE}, ' ', '-') AS route_short_name, {_wait('gap')}
        FROM ({_TRAIN_GAPS}) JOIN nation ON route = n_nationkey
        WHERE n_regionkey <> 0 GROUP BY 1
    """,
    "waiting_time_by_snapshot": f"""
        WITH first AS (
          SELECT trip, late_snapshot, min(secs) AS secs FROM ({_STOP_SECONDS})
          GROUP BY trip, late_snapshot),
        gaps AS (
          SELECT route, late_snapshot, secs - lag(secs) OVER (
                   PARTITION BY route, direction, late_snapshot ORDER BY secs, trip) AS gap
          FROM ({_TRAIN_TRIPS}) JOIN first USING (trip))
        SELECT CASE WHEN late_snapshot THEN {_LINE} ELSE 'old ' || n_name END AS route_short_name,
               CASE WHEN late_snapshot THEN '2024-10-02' ELSE '2024-10-01' END AS subdir,
               {_wait('gap')}
        FROM gaps JOIN nation ON route = n_nationkey
        WHERE gap <> 0 AND n_regionkey <> 0 GROUP BY 1, 2
    """,
    "departure_intervals": f"""
        SELECT concat_ws('__', CAST(route AS VARCHAR), min(CAST(trip AS VARCHAR)), direction)
                 AS route_trip_direction_id,
               concat_ws('__', CAST(route AS VARCHAR), direction) AS route_direction_id,
               {_LINE} AS route_short_name, secs AS departure,
               max(gap) / 60 AS interval_in_minutes
        FROM (
          SELECT route, direction, trip, secs,
                 secs - lag(secs) OVER (PARTITION BY route, direction ORDER BY secs, trip) AS gap
          FROM ({_TRAIN_TRIPS}) JOIN (
            SELECT trip, min(secs) AS secs FROM ({_STOP_SECONDS}) GROUP BY trip) USING (trip))
        JOIN nation ON route = n_nationkey
        WHERE n_regionkey <> 0
        GROUP BY route, direction, secs, n_regionkey, n_name
        HAVING max(gap) > 0
    """,
    "average_trips": f"""
        SELECT operator_name, day_type, CAST(trunc(avg(total)) AS BIGINT) AS avg_daily_trips
        FROM ({_SERVICE_DAILY}) GROUP BY operator_name, day_type
    """,
    "average_trips_wide": f"""
        SELECT operator_name,
               coalesce(CAST(floor(avg(total) FILTER (day_type = 'weekday') + 0.5) AS BIGINT), 0)
                 AS weekday_avg_daily_trips,
               coalesce(CAST(floor(avg(total) FILTER (day_type = 'weekend') + 0.5) AS BIGINT), 0)
                 AS weekend_avg_daily_trips
        FROM ({_SERVICE_DAILY}) GROUP BY operator_name
    """,
    "service_quality": f"""
        SELECT count(*) AS "rows",
               count(*) FILTER (reason = 'bad_date') AS bad_date,
               count(*) FILTER (reason = 'bad_time') AS bad_time,
               count(*) FILTER (reason = 'bad_headway') AS bad_headway,
               count(*) FILTER (reason = 'zero_headway') AS zero_headway,
               count(*) FILTER (duration < 0) AS negative_duration,
               count(*) FILTER (reason IS NULL) AS accepted
        FROM (SELECT *, {_REASON} AS reason FROM ({_SERVICE}))
    """,
    "service_quality_of_files": f"""
        SELECT count(*) AS "rows", count(*) FILTER (reason = 'short_row') AS short_row,
               count(*) FILTER (reason = 'bad_date') AS bad_date,
               count(*) FILTER (reason = 'bad_time') AS bad_time,
               count(*) FILTER (reason = 'bad_headway') AS bad_headway,
               count(*) FILTER (reason = 'zero_headway') AS zero_headway,
               count(*) FILTER (cut = '8') AS long_row,
               count(*) FILTER (duration < 0 AND cut <> '7') AS negative_duration,
               count(*) FILTER (reason IS NULL) AS accepted
        FROM (SELECT *, CASE WHEN cut = '7' THEN 'short_row' ELSE {_REASON} END AS reason
              FROM ({_SERVICE_ENDS}))
    """,
    "service_saved_rows": f"""
        SELECT operator_name, coalesce(reason, 'accepted') AS reject_reason, count(*) AS "rows",
               CAST(sum(CASE WHEN headway <> 0 THEN CAST(trunc(duration / headway) AS BIGINT) END) AS BIGINT) AS trips
        FROM (SELECT *, {_REASON} AS reason FROM ({_SERVICE})) GROUP BY 1, 2
    """,
    "rejected_service": f"""
        SELECT operator_name, {_REASON} AS reject_reason, count(*) AS "rows"
        FROM ({_SERVICE}) WHERE {_REASON} IS NOT NULL GROUP BY 1, 2
    """,
}
ORACLE["service_committed"] = ORACLE["service_quality"]
