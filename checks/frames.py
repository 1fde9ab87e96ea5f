"""Schedule-shaped tables that Spark derives from the whole star-schema tables.

They carry the dirt a schedule archive has: unreadable times and coordinates, missing
directions, repeated snapshots, routes that change their name.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def star(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder that the session names."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared}/stoploom/{name}-{uuid.uuid4().hex}"


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bus and rail routes: brands are feeds, part names are route names."""
    return star(spark, sf_dir, "part").selectExpr(
        """CASE p_brand WHEN 'Brand#1' THEN 'KTMB' WHEN 'Brand#2' THEN 'Prasarana_RapidRailKL'
             WHEN 'Brand#3' THEN NULL ELSE p_brand END AS feed_id""",
        "CASE WHEN p_size > 1 THEN concat_ws(' ', p_name, p_type) END AS route_long_name",
    )


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stops with text coordinates: customers by segment, suppliers as one more feed."""
    lon = """CASE {nation} WHEN 7 THEN 'abc' WHEN 8 THEN '' WHEN 9 THEN ' NaN '
               ELSE concat(' ', CAST({nation} AS STRING), '.0') END AS stop_lon"""
    customers = star(spark, sf_dir, "customer").selectExpr(
        "c_mktsegment AS feed_id",
        "CAST(c_acctbal / 1000 AS STRING) AS stop_lat",
        lon.format(nation="c_nationkey"),
    )
    suppliers = star(spark, sf_dir, "supplier").selectExpr(
        "'SUPPLIER' AS feed_id",
        "CAST(s_acctbal / 1000 AS STRING) AS stop_lat",
        lon.format(nation="s_nationkey"),
    )
    return customers.unionByName(suppliers)


def train_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as routes, in two snapshots; the newer one renames every route."""
    nation = star(spark, sf_dir, "nation")
    feed = "CASE WHEN n_regionkey = 0 THEN 'OTHER' ELSE 'KTMB' END AS feed_id"
    route = "CAST(n_nationkey AS STRING) AS route_id"
    older = nation.selectExpr(
        feed, "'2024-10-01' AS subdir", route, "concat('old ', n_name) AS route_short_name"
    )
    newer = nation.selectExpr(
        feed,
        "'2024-10-02' AS subdir",
        route,
        "concat('Line ', CAST(n_regionkey AS STRING), ' ', substring(n_name, -1, 1)) AS route_short_name",
    )
    return older.unionByName(newer)


def train_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as trips on the route of the customer's nation, repeated in a second snapshot."""
    orders = star(spark, sf_dir, "orders")
    customer = star(spark, sf_dir, "customer")
    trips = orders.join(customer, orders.o_custkey == customer.c_custkey).selectExpr(
        "CASE WHEN o_orderkey % 9 = 4 THEN 'OTHER' ELSE 'KTMB' END AS feed_id",
        "explode(array('2024-10-01', '2024-10-02')) AS subdir",
        "CAST(c_nationkey AS STRING) AS route_id",
        "CAST(o_orderkey AS STRING) AS trip_id",
        "CASE o_orderstatus WHEN 'P' THEN NULL ELSE o_orderstatus END AS direction_id",
    )
    return trips


def train_stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as stops of a trip; minutes of the part key give times up to 25 hours."""
    minutes = "(l_partkey % 1500)"
    return star(spark, sf_dir, "lineitem").selectExpr(
        "CASE WHEN l_orderkey % 9 IN (4, 5) THEN 'OTHER' ELSE 'KTMB' END AS feed_id",
        "CASE WHEN l_returnflag = 'R' THEN '2024-10-02' ELSE '2024-10-01' END AS subdir",
        "CAST(l_orderkey AS STRING) AS trip_id",
        f"""CASE CAST(l_quantity AS INT) WHEN 1 THEN 'late' WHEN 2 THEN '' WHEN 3 THEN '7:61:00'
              ELSE concat(CAST({minutes} DIV 60 AS STRING), ':',
                          lpad(CAST({minutes} % 60 AS STRING), 2, '0'), ':',
                          lpad(CAST(l_linenumber * 7 AS STRING), 2, '0')) END AS departure_time""",
    )


def frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as service windows of a feed on the order date."""
    return star(spark, sf_dir, "orders").selectExpr(
        """CASE o_orderpriority WHEN '1-URGENT' THEN 'Prasarana_RapidRailKL'
             WHEN '2-HIGH' THEN 'Prasarana_RapidBusKL' ELSE o_orderpriority END AS feed_id""",
        """CASE WHEN o_custkey % 50 = 0 THEN 'no date'
             WHEN o_orderpriority = '5-LOW' AND weekday(o_orderdate) >= 5 THEN 'weekend'
             ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS subdir""",
        """CASE o_orderstatus WHEN 'O' THEN concat('AGL_', CAST(o_orderkey AS STRING))
             WHEN 'F' THEN concat('ZZZ_', CAST(o_orderkey AS STRING)) ELSE 'AB' END AS trip_id""",
        """CASE WHEN o_custkey % 50 = 1 THEN 'x'
             ELSE CAST(o_custkey % 20 * 60 AS STRING) END AS headway_secs""",
        "concat(CAST(5 + o_custkey % 4 AS STRING), ':30:00') AS start_time",
        """CASE WHEN o_custkey % 50 = 2 THEN '' WHEN o_custkey % 50 = 3 THEN '4:00:00'
             ELSE concat(CAST(9 + CAST(o_totalprice AS BIGINT) % 17 AS STRING), ':15:20')
           END AS end_time""",
    )
