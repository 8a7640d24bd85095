"""Fixture views: the reference's data products derived from the driver tables.

The reference ships no data, so its four tables are mapped onto the driver's
TPC-H-ish tables (see FIXTURES.md). Each view exists twice: as a Spark
DataFrame built with the DataFrame API (what the library runs) and as DuckDB
SQL text (what the independent oracle runs). Both give equal rows.

At scale these views are plain projections, joins and one partial
aggregation; AQE picks broadcast only for sides whose runtime size is under
``spark.sql.autoBroadcastJoinThreshold``, otherwise a sort-merge join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# fixed values: route ends used by the calendar, itinerary and track views
ORIGIN_EVEN, ORIGIN_ODD = "LHR", "MAN"
DESTINATIONS = ("SGN", "HAN", "BKK")
TRANSIT_HUBS = ("DXB", "SIN", "HKG")


def _div(col, n: int):
    """Integer division of a non-negative integral column (SQL ``div``)."""
    return F.floor(col / n)


def _origin(key):
    return F.when(key % 2 == 0, F.lit(ORIGIN_EVEN)).otherwise(F.lit(ORIGIN_ODD))


def _destination(key):
    k = _div(key, 2) % 3
    return (F.when(k == 0, F.lit(DESTINATIONS[0]))
            .when(k == 1, F.lit(DESTINATIONS[1]))
            .otherwise(F.lit(DESTINATIONS[2])))


def market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticket-sample fact table (one row per market coupon). Customers join the orders first, so that the coupons, by
    far the larger rows, are shuffled for the orders and the parts and not for the customers too."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                    "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                    "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    sup = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    ords = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_brand")
    buyers = ords.join(cust, ords.o_custkey == cust.c_custkey).select("o_orderkey", "c_nationkey")
    j = (li.join(sup, li.l_suppkey == sup.s_suppkey)
         .join(buyers, li.l_orderkey == buyers.o_orderkey)
         .join(part, li.l_partkey == part.p_partkey))
    dist = ((F.col("l_partkey") * 37) % 6000).cast("double")
    return j.select(
        F.col("l_orderkey").alias("ItinID"),
        F.concat_ws("-", *[F.col(c).cast("string") for c in
                           ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")]).alias("MktID"),
        (1 + F.col("l_linenumber") % 3).cast("int").alias("MktCoupons"),
        F.year("l_shipdate").cast("int").alias("Year"),
        F.quarter("l_shipdate").cast("int").alias("Quarter"),
        F.concat(F.lit("N"), F.lpad(F.col("s_nationkey").cast("string"), 2, "0")).alias("Origin"),
        F.concat(F.lit("N"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias("Dest"),
        F.col("p_brand").alias("RPCarrier"),
        F.concat(F.lit("Brand#"), (1 + F.col("l_suppkey") % 25).cast("string")).alias("TkCarrier"),
        F.concat(F.lit("Brand#"), (1 + F.col("l_partkey") % 25).cast("string")).alias("OpCarrier"),
        F.when(F.col("l_returnflag") == "R", F.lit(1.0)).otherwise(F.lit(0.0)).alias("BulkFare"),
        (F.col("l_quantity") - 1).alias("Passengers"),
        (F.floor(F.col("l_extendedprice") * F.col("l_tax") * 100) / 100).alias("MktFare"),
        dist.alias("MktDistance"),
        (1 + _div(F.col("l_partkey") * 37 % 6000, 500)).cast("int").alias("MktDistanceGroup"),
        (dist * (1 + F.col("l_discount") * 25)).alias("MktMilesFlown"),
        dist.alias("NonStopMiles"),
        F.when(F.col("l_linestatus") == "F", F.lit(2)).otherwise(F.lit(1)).alias("MktGeoType"),
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily price-calendar snapshots: one row per (route, departure, collection day)."""
    ev = read_table(spark, sf_dir, "events", "ts", "user_id", "value")
    return (ev.groupBy(
        _origin(F.col("user_id")).alias("origin"),
        _destination(F.col("user_id")).alias("destination"),
        F.date_add(F.lit("2024-01-20").cast("date"), _div(F.col("user_id"), 6).cast("int")).alias("departure_date"),
        F.col("ts").cast("date").alias("collected_date"))
        .agg(F.min("ts").alias("collected_at"), (300 + F.min("value")).alias("price")))


def itineraries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat itinerary search results (one row per itinerary)."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                    "l_linenumber", "l_quantity", "l_extendedprice")
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_type")
    j = li.join(part, li.l_partkey == part.p_partkey)
    stops = F.col("l_linenumber") % 4
    org, dst = _origin(F.col("l_suppkey")), _destination(F.col("l_suppkey"))
    hubs = [F.when(stops >= i + 1, F.lit(h)) for i, h in enumerate(TRANSIT_HUBS)]
    return j.select(
        F.concat_ws("-", *[F.col(c).cast("string") for c in
                           ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")]).alias("itinerary_id"),
        F.date_add(F.lit("2024-02-01").cast("date"), F.col("l_quantity").cast("int") % 3).alias("collected_at"),
        F.date_add(F.lit("2024-03-01").cast("date"), (F.col("l_partkey") % 14).cast("int")).alias("search_date"),
        org.alias("origin_code"),
        dst.alias("dest_code"),
        (200 + F.floor("l_extendedprice") / 100).alias("price_raw"),
        (600 + F.col("l_partkey") * 13 % 1200).cast("int").alias("duration_minutes"),
        stops.cast("int").alias("stop_count"),
        F.concat(F.col("p_brand"), F.lit(", "), F.col("p_type")).alias("carrier_names"),
        F.concat_ws(" -> ", org, *hubs, dst).alias("segment_route"),
    )


def track_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Track/untrack requests in arrival order ``seq``."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
                   "o_totalprice")
    return o.select(
        F.col("o_orderkey").alias("seq"),
        (F.col("o_custkey") % 200).alias("user_id"),
        _origin(F.col("o_orderkey")).alias("origin"),
        _destination(F.col("o_orderkey")).alias("destination"),
        F.date_add(F.lit("2024-01-20").cast("date"),
                   (_div(F.col("o_orderkey"), 6) % 25).cast("int")).alias("departure_date"),
        F.when(F.col("o_orderstatus") == "P", F.lit("untrack")).otherwise(F.lit("track")).alias("op"),
        (300 + F.floor(F.col("o_totalprice") / 20) / 100).alias("baseline_price"),
    )


# --- stored views ------------------------------------------------------------

# partition layout of each stored view (the reference keeps one file per
# quarter for the market table and one file per day for collected data)
STORED_LAYOUT = {"market": ("Year", "Quarter"), "calendar": ("collected_date",),
                 "itineraries": ("collected_at",)}


def stored_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Write the view once as Parquet partitioned by its layout; return the path."""
    from .landing import land_parquet
    build = {"market": market, "calendar": calendar, "itineraries": itineraries}[name]
    return land_parquet(spark, sf_dir, f"view_{name}", lambda: build(spark, sf_dir),
                        partition_by=STORED_LAYOUT[name])


def stored(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view as stored files: later queries scan it (with partition and
    column pruning) instead of recomputing its joins and aggregation."""
    build = {"market": market, "calendar": calendar, "itineraries": itineraries}[name]
    schema = build(spark, sf_dir).schema  # analysis only, nothing runs
    path = stored_path(spark, sf_dir, name)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


# --- DuckDB text of the same views (the oracle side) -------------------------

DUCKDB_VIEWS = {
    "market": """select l_orderkey as ItinID, concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) as MktID, cast(1 + l_linenumber % 3 as int) as MktCoupons, cast(year(l_shipdate) as int) as Year, cast(quarter(l_shipdate) as int) as Quarter, concat('N', lpad(cast(s_nationkey as varchar), 2, '0')) as Origin, concat('N', lpad(cast(c_nationkey as varchar), 2, '0')) as Dest, p_brand as RPCarrier, concat('Brand#', 1 + l_suppkey % 25) as TkCarrier, concat('Brand#', 1 + l_partkey % 25) as OpCarrier, case when l_returnflag = 'R' then 1.0e0 else 0.0e0 end as BulkFare, l_quantity - 1 as Passengers, floor(l_extendedprice * l_tax * 100) / 100 as MktFare, cast(l_partkey * 37 % 6000 as double) as MktDistance, cast(1 + (l_partkey * 37 % 6000) // 500 as int) as MktDistanceGroup, cast(l_partkey * 37 % 6000 as double) * (1 + l_discount * 25) as MktMilesFlown, cast(l_partkey * 37 % 6000 as double) as NonStopMiles, case when l_linestatus = 'F' then 2 else 1 end as MktGeoType
from lineitem join supplier on l_suppkey = s_suppkey join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join part on l_partkey = p_partkey""",
    "calendar": """select case when user_id % 2 = 0 then 'LHR' else 'MAN' end as origin, case (user_id // 2) % 3 when 0 then 'SGN' when 1 then 'HAN' else 'BKK' end as destination, date '2024-01-20' + cast(user_id // 6 as int) as departure_date, cast(ts as date) as collected_date, min(ts) as collected_at, 300 + min(value) as price
from events group by 1, 2, 3, 4""",
    "itineraries": """select concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) as itinerary_id, date '2024-02-01' + cast(l_quantity as int) % 3 as collected_at, date '2024-03-01' + cast(l_partkey % 14 as int) as search_date, case when l_suppkey % 2 = 0 then 'LHR' else 'MAN' end as origin_code, case (l_suppkey // 2) % 3 when 0 then 'SGN' when 1 then 'HAN' else 'BKK' end as dest_code, 200 + floor(l_extendedprice) / 100 as price_raw, cast(600 + l_partkey * 13 % 1200 as int) as duration_minutes, cast(l_linenumber % 4 as int) as stop_count, concat(p_brand, ', ', p_type) as carrier_names,
concat_ws(' -> ', case when l_suppkey % 2 = 0 then 'LHR' else 'MAN' end, case when l_linenumber % 4 >= 1 then 'DXB' end, case when l_linenumber % 4 >= 2 then 'SIN' end, case when l_linenumber % 4 >= 3 then 'HKG' end, case (l_suppkey // 2) % 3 when 0 then 'SGN' when 1 then 'HAN' else 'BKK' end) as segment_route
from lineitem join part on l_partkey = p_partkey""",
    "track_events": """select o_orderkey as seq, o_custkey % 200 as user_id, case when o_orderkey % 2 = 0 then 'LHR' else 'MAN' end as origin, case (o_orderkey // 2) % 3 when 0 then 'SGN' when 1 then 'HAN' else 'BKK' end as destination, date '2024-01-20' + cast((o_orderkey // 6) % 25 as int) as departure_date, case when o_orderstatus = 'P' then 'untrack' else 'track' end as op, 300 + floor(o_totalprice / 20) / 100 as baseline_price
from orders""",
}


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the DuckDB CTEs of the fixture views it names."""
    if not names:
        return sql
    ctes = ",\n".join(f"{n} as (\n{DUCKDB_VIEWS[n]}\n)" for n in names)
    head = sql.lstrip()
    if head[:15].lower() == "with recursive ":
        return f"with recursive {ctes},\n{head[15:]}"
    if head[:5].lower() == "with " or head[:5].lower() == "with\n":
        return f"with {ctes},\n{head[5:]}"
    return f"with {ctes}\n{sql}"


def _register_dims() -> None:
    from .dims import DUCKDB_AIRPORTS, DUCKDB_ROUTES
    DUCKDB_VIEWS["airports"] = DUCKDB_AIRPORTS
    DUCKDB_VIEWS["routes_dim"] = DUCKDB_ROUTES


_register_dims()
