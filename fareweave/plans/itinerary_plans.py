"""Itineraries: JSON responses, journeys, skyline, deals and message text."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import arrays as AR
from ..functions import text as TX
from ..functions.numeric import r4
from ..operators import itinerary as IT
from ..operators import skyline as SK
from ..sources import dims
from ..sources import fixtures as fx
from ..sources import responses as RS
from ..sources.landing import land_once, land_parquet, write_json
from .registry import register


def _r4sql(e: str) -> str:
    return f"floor(({e}) * 10000 + 0.5) / 10000"


def itins(spark: SparkSession, sf: str) -> DataFrame:
    return fx.stored(spark, sf, "itineraries")


def search_docs(spark: SparkSession, sf: str) -> DataFrame:
    """One-way responses, built as they are read: kept as text they would hold some fifty times the bytes of their rows."""
    return RS.itinerary_documents(fx.itineraries(spark, sf))


def roundtrip_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Round-trip responses, built as they are read."""
    return RS.roundtrip_documents(fx.itineraries(spark, sf))


def _case(code: str, table: dict) -> str:
    arms = " ".join(f"when {code} = '{k}' then '{v}'" for k, v in table.items())
    return f"case {arms} end"


# DuckDB: the values a parser must recover from the derived JSON documents
fx.DUCKDB_VIEWS["itin_x"] = f"""select *, string_split(segment_route, ' -> ') as ap,
len(string_split(segment_route, ' -> ')) - 1 as nseg,
epoch(cast(search_date as timestamp)) + 36000 as dep0,
{_case('origin_code', RS.CITY)} as origin_city, {_case('dest_code', RS.CITY)} as dest_city,
split_part(carrier_names, ', ', 1) as carrier0,
upper(substr(split_part(carrier_names, ', ', 1), 1, 2)) as code0
from itineraries"""
IX = ("itineraries", "itin_x")


def _iso_sql(epoch: str) -> str:
    return f"strftime(to_timestamp({epoch}) at time zone 'UTC', '%Y-%m-%dT%H:%M:%S')"


@register("src_itinerary_json", f"""select collected_at, search_date, itinerary_id, price_raw, printf('£%.2f', price_raw) as price_formatted,
stop_count < 2 as is_change_allowed, stop_count = 0 as is_cancel_allowed, stop_count = 3 as is_self_transfer,
concat_ws(', ', case when stop_count = 0 then 'direct' end, case when price_raw < 300 then 'cheap' end) as tags,
origin_code, origin_city, dest_code, dest_city, {_iso_sql('dep0')} as departure,
{_iso_sql('dep0 + duration_minutes * 60')} as arrival, duration_minutes,
cast(date_diff('day', cast(to_timestamp(dep0) at time zone 'UTC' as date), cast(to_timestamp(dep0 + duration_minutes * 60) at time zone 'UTC' as date)) as int) as time_delta_days,
stop_count, stop_count = 0 as is_direct, cast(nseg as int) as num_segments, carrier_names,
array_to_string(list_transform(string_split(carrier_names, ', '), lambda x: upper(substr(x, 1, 2))), ', ') as carrier_codes,
'partially_operated' as operation_type, segment_route from itin_x""", views=IX)
def src_itinerary_json(spark, sf):
    """Flatten one-way response: itinerary × leg rows (see 2.2 for columns)."""
    docs = search_docs(spark, sf)
    flat = RS.flat_itineraries(RS.parse_search(docs, keep=("collected_at", "search_date")),
                               keep=("collected_at", "search_date"))
    return flat.select("collected_at", "search_date", "itinerary_id", "price_raw", "price_formatted",
                       "is_change_allowed", "is_cancel_allowed", "is_self_transfer", "tags", "origin_code",
                       "origin_city", "dest_code", "dest_city", "departure", "arrival", "duration_minutes",
                       "time_delta_days", "stop_count", "is_direct", "num_segments", "carrier_names",
                       "carrier_codes", "operation_type", "segment_route")


def _lay_sql(i: int) -> str:
    return f"(30 + 12 * {i} + 6 * (duration_minutes % 10))"


def _seg_sql(i: int) -> str:
    step = "floor(duration_minutes / nseg)"
    dep = f"dep0 + {i} * {step} * 60"
    arr = f"dep0 + (({i} + 1) * {step} - case when {i} < nseg - 1 then {_lay_sql(i)} else 0 end) * 60"
    fno = f"cast(100 + (duration_minutes + 37 * {i}) % 900 as varchar)"
    values = {"origin": f"ap[{i + 1}]", "dest": f"ap[{i + 2}]", "flight_number": fno,
              "duration": f"cast((({arr}) - ({dep})) / 60 as int)", "departure": _iso_sql(dep), "arrival": _iso_sql(arr),
              "marketing_carrier": "carrier0", "marketing_code": "code0", "operating_carrier": "carrier0",
              "operating_code": "code0", "flight": f"concat(code0, {fno})"}
    return ", ".join(f"case when {i} < nseg then {values[f]} end as seg{i}_{f}" for f in SEG_FIELDS)


SEG_FIELDS = [*RS.SEGMENT_FIELDS, "flight"]
_SEG_OUT = [f"seg{i}_{f}" for i in range(RS.MAX_SEGMENTS) for f in SEG_FIELDS]


@register("fn_segment_columns", "select itinerary_id, " + ", ".join(_seg_sql(i) for i in range(RS.MAX_SEGMENTS))
          + " from itin_x", views=IX)
def fn_segment_columns(spark, sf):
    """First 4 segments → seg{i}_* columns (10 fields + flight code)."""
    docs = search_docs(spark, sf)
    return RS.parse_flat(docs, ["itinerary_id", *_SEG_OUT])


@register("fn_segment_path", """select itinerary_id, segment_route as path, stop_count + 1 as n from itineraries""",
          views=("itineraries",))
def fn_segment_path(spark, sf):
    """A -> B -> C from segments, empty string if none."""
    legs = RS.parse_search(search_docs(spark, sf))
    return legs.select(F.col("it.id").alias("itinerary_id"), RS.segment_path(F.col("leg.segments")).alias("path"),
                       F.size("leg.segments").alias("n"))


@register("fn_join_list", """select itinerary_id, carrier_names,
array_to_string(list_transform(string_split(carrier_names, ', '), lambda x: upper(substr(x, 1, 2))), ', ') as carrier_codes,
concat_ws(', ', case when stop_count = 0 then 'direct' end, case when price_raw < 300 then 'cheap' end) as tags
from itineraries""", views=("itineraries",))
def fn_join_list(spark, sf):
    """List → ', ' string (tags, carrier names, carrier codes)."""
    legs = RS.parse_search(search_docs(spark, sf))
    mk = F.col("leg.carriers.marketing")
    return legs.select(F.col("it.id").alias("itinerary_id"),
                       RS.join_list(F.transform(mk, lambda c: c["name"])).alias("carrier_names"),
                       RS.join_list(F.transform(mk, lambda c: c["alternateId"])).alias("carrier_codes"),
                       RS.join_list(F.col("it.tags")).alias("tags"))


# --- round trips ----------------------------------------------------------------------

fx.DUCKDB_VIEWS["rt_x"] = f"""select itinerary_id as flight_id, price_raw as price_gbp, ap, nseg, duration_minutes as d,
dep0, dep0 + (7 + duration_minutes % 14) * 86400 + 3600 as ret0, carrier_names,
list_reverse(ap) as rap, array_to_string(list_reverse(string_split(carrier_names, ', ')), ', ') as ret_airline,
upper(substr(split_part(carrier_names, ', ', 1), 1, 2)) as code0,
upper(substr(split_part(carrier_names, ', ', 2), 1, 2)) as code1
from itin_x"""
RT = IX + ("rt_x",)


@register("src_roundtrip_json", f"""select flight_id, price_gbp, ap[1] as out_origin, ap[-1] as out_destination,
{_iso_sql('dep0')} as out_departure, {_iso_sql('dep0 + d * 60')} as out_arrival, d as out_duration_min,
cast(nseg - 1 as int) as out_stops, carrier_names as out_airline,
rap[1] as ret_origin, rap[-1] as ret_destination, {_iso_sql('ret0')} as ret_departure,
{_iso_sql('ret0 + (d + 45) * 60')} as ret_arrival, d + 45 as ret_duration_min, cast(nseg - 1 as int) as ret_stops,
ret_airline, d + d + 45 as total_duration_min, cast(2 * (nseg - 1) as int) as total_stops,
cast(to_timestamp(dep0) at time zone 'UTC' as date) as out_departure_date,
cast(to_timestamp(ret0) at time zone 'UTC' as date) as ret_departure_date,
cast(7 + d % 14 as int) as trip_length_days from rt_x""", views=RT)
def src_roundtrip_json(spark, sf):
    """Flatten round-trip response: one row per itinerary, leg 0 = outbound, leg 1 = return, rows that fail are …."""
    rt = RS.parse_roundtrip(roundtrip_docs(spark, sf))
    return rt.select("flight_id", "price_gbp", "out_origin", "out_destination", "out_departure", "out_arrival",
                     "out_duration_min", "out_stops", "out_airline", "ret_origin", "ret_destination",
                     "ret_departure", "ret_arrival", "ret_duration_min", "ret_stops", "ret_airline",
                     "total_duration_min", "total_stops", "out_departure_date", "ret_departure_date",
                     "trip_length_days")


def _country_sql(code: str) -> str:
    return f"coalesce({_case(code, RS.COUNTRY)}, 'UNKNOWN')"


@register("fn_transits_layovers", f"""select flight_id,
array_to_string(ap[2:nseg], ',') as out_transit_airports,
array_to_string(list_transform(ap[2:nseg], lambda x: {_country_sql('x')}), ',') as out_transit_countries,
array_to_string(list_transform(range(0, cast(nseg - 1 as bigint)), lambda i: cast(round_even((30 + 12 * i + 6 * (d % 10)) * 60 / 3600.0 * 10, 0) / 10 as double)), ',') as out_layover_hours,
array_to_string(rap[2:nseg], ',') as ret_transit_airports,
array_to_string(list_transform(range(0, cast(nseg - 1 as bigint)), lambda i: cast(round_even((30 + 12 * i + 6 * ((d + 45) % 10)) * 60 / 3600.0 * 10, 0) / 10 as double)), ',') as ret_layover_hours
from rt_x""", views=RT)
def fn_transits_layovers(spark, sf):
    """Transit airports, countries (default UNKNOWN), layover hours rounded to 1 dp between consecutive segments; …."""
    rt = deals(spark, sf, "transit_airports", "transit_countries", "layover_hours")
    j = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return rt.select("flight_id", j("out_transit_airports").alias("out_transit_airports"),
                     j("out_transit_countries").alias("out_transit_countries"),
                     j("out_layover_hours").alias("out_layover_hours"),
                     j("ret_transit_airports").alias("ret_transit_airports"),
                     j("ret_layover_hours").alias("ret_layover_hours"))


@register("fn_flight_numbers", """select flight_id,
array_to_string(list_transform(range(0, cast(nseg as bigint)), lambda i: concat(code0, cast(100 + (d + 37 * i) % 900 as varchar))), ',') as out_flight_numbers,
array_to_string(list_transform(range(0, cast(nseg as bigint)), lambda i: concat(code1, cast(100 + (d + 45 + 37 * i) % 900 as varchar))), ',') as ret_flight_numbers
from rt_x""", views=RT)
def fn_flight_numbers(spark, sf):
    """Per segment code+number, only if both present."""
    rt = deals(spark, sf, "flight_numbers")
    return rt.select("flight_id", F.array_join("out_flight_numbers", ",").alias("out_flight_numbers"),
                     F.array_join("ret_flight_numbers", ",").alias("ret_flight_numbers"))


@register("fn_trip_totals", """select flight_id, d + d + 45 as total_duration_min, cast(2 * (nseg - 1) as int) as total_stops,
cast(to_timestamp(dep0) at time zone 'UTC' as date) as out_departure_date,
cast(to_timestamp(ret0) at time zone 'UTC' as date) as ret_departure_date, cast(7 + d % 14 as int) as trip_length_days
from rt_x""", views=RT)
def fn_trip_totals(spark, sf):
    """Total duration, total stops, departure dates, trip length days."""
    rt = deals(spark, sf, *RS.ALWAYS)
    return rt.select("flight_id", "total_duration_min", "total_stops", "out_departure_date",
                     "ret_departure_date", "trip_length_days")


def deals(spark, sf, *legs: str) -> DataFrame:
    """Parsed round trips, with the leg columns named besides the fixed ones (all, if none is)."""
    return RS.parse_roundtrip(roundtrip_docs(spark, sf), legs=legs or None)


@register("topk_deals", """select flight_id, price_gbp, ap[1] as out_origin, ap[-1] as out_destination
from rt_x order by price_gbp, flight_id limit 5""", views=RT)
def topk_deals(spark, sf):
    """N cheapest."""
    return IT.top_n(deals(spark, sf, "origin", "destination").select("flight_id", "price_gbp", "out_origin", "out_destination"), 5,
                    [F.col("price_gbp"), F.col("flight_id")])


@register("agg_deals_summary", f"""select ap[1] as out_origin, ap[-1] as out_destination, count(*) as count,
min(price_gbp) as cheapest, max(price_gbp) as most_expensive, {_r4sql('avg(price_gbp)')} as average,
array_to_string(list_transform(list_sort(list({{'p': price_gbp, 'i': flight_id}}))[1:5], lambda x: concat(printf('%.2f', x.p), ' ', x.i)), ', ')
as cheapest_five from rt_x group by 1, 2""", views=RT)
def agg_deals_summary(spark, sf):
    """Count, min, max, mean, cheapest 5 (price and flight)."""
    # two passes over four columns, kept so that the responses are parsed once
    d = spark.read.parquet(land_parquet(spark, sf, "deal_prices", lambda: deals(
        spark, sf, "origin", "destination").select("out_origin", "out_destination", "price_gbp", "flight_id")))
    s = IT.deals_summary(d, by=["out_origin", "out_destination"])
    top = IT.cheapest_list(d, 5, by=["out_origin", "out_destination"])
    return s.join(top, ["out_origin", "out_destination"]).select(
        "out_origin", "out_destination", "count", "cheapest", "most_expensive", r4("average").alias("average"), "cheapest_five")


@register("fn_deal_line", f"""select out_origin, out_destination, rank, printf('%d. %6s | %-12s | %-10s | %-11s | %d stop(s) | via %s',
rank, concat('£', printf('%.0f', round_even(price_gbp, 0))), substr(split_part(carrier_names, ',', 1), 1, 12),
concat(out_origin, '->', out_destination), strftime(to_timestamp(dep0) at time zone 'UTC', '%d/%m %H:%M'),
total_stops, case when nseg - 1 = 0 then 'Direct' else concat(array_to_string(ap[2:least(nseg, 3)], ','),
case when nseg - 1 > 2 then '...' else '' end) end) as line
from (select *, ap[1] as out_origin, ap[-1] as out_destination, cast(2 * (nseg - 1) as int) as total_stops,
row_number() over (partition by ap[1], ap[-1] order by price_gbp, flight_id) as rank from rt_x) where rank <= 5""",
          views=RT)
def fn_deal_line(spark, sf):
    """Summary line of the 5 cheapest deals per route."""
    # all rows of a task are sorted: they hold what the line is made of
    d = deals(spark, sf, "origin", "destination", "airline", "transit_airports").select(
        "flight_id", "price_gbp", "out_airline", "out_origin", "out_destination", "out_departure", "total_stops", "out_transit_airports")
    top = IT.top_n(d, 5, [F.col("price_gbp"), F.col("flight_id")], by=["out_origin", "out_destination"])
    from pyspark.sql import Window
    top = top.withColumn("rank", F.row_number().over(
        Window.partitionBy("out_origin", "out_destination").orderBy("price_gbp", "flight_id")))
    line = TX.deal_line(F.col("rank"), "price_gbp", "out_airline", "out_origin", "out_destination",
                        "out_departure", "total_stops", "out_transit_airports")
    return top.select("out_origin", "out_destination", F.col("rank").cast("bigint").alias("rank"), line.alias("line"))


@register("fn_parse_list_text", """select flight_id, array_to_string(ap[2:nseg], '|') as parsed, len(ap[2:nseg]) as n
from rt_x""", views=RT)
def fn_parse_list_text(spark, sf):
    """Transit lists written as Python list text (as the reference stores
    them) and parsed back; junk text parses to an empty list."""
    d = deals(spark, sf, "transit_airports")
    text = F.concat(F.lit("["), F.array_join(F.transform("out_transit_airports",
                                                         lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "),
                    F.lit("]"))
    arr = AR.parse_list_text(text)
    return d.select("flight_id", F.array_join(arr, "|").alias("parsed"), F.size(arr).cast("bigint").alias("n"))


# --- calendar responses -----------------------------------------------------------------

@register("src_calendar_json", """select strftime(min(collected_at) over (partition by origin, destination, cast(collected_at as date),
date_trunc('month', departure_date)), '%Y-%m-%dT%H:%M:%S.%f') as collected_at, origin, destination, 'GBP' as currency,
strftime(departure_date, '%Y-%m-%d') as departure_date, price,
case when price < 310 then 'low' when price < 320 then 'medium' else 'high' end as "group"
from calendar qualify departure_date >= cast(collected_at as date)""", views=("calendar",))
def src_calendar_json(spark, sf):
    """Flatten price-calendar response; drop days without price; stamp collected_at, route, currency."""
    docs = RS.landed_documents(spark, sf, "calendar", lambda: RS.calendar_documents(fx.stored(spark, sf, "calendar")))
    return RS.parse_calendar(docs)


# --- journeys, hops, map ------------------------------------------------------------------

@register("src_itineraries", """select collected_at, search_date, origin_code, dest_code, price_raw, duration_minutes,
stop_count, carrier_names, segment_route from itineraries""", views=("itineraries",))
def src_itineraries(spark, sf):
    """Union all daily itinerary files with column list."""
    return itins(spark, sf).select("collected_at", "search_date", "origin_code", "dest_code", "price_raw",
                                   "duration_minutes", "stop_count", "carrier_names", "segment_route")


@register("fn_extract_codes", """select distinct segment_route, array_to_string(regexp_extract_all(upper(segment_route), '\\b[A-Z]{3}\\b'), ',') as codes
from itineraries""", views=("itineraries",))
def fn_extract_codes(spark, sf):
    """All 3-letter upper-case tokens of a path."""
    i = itins(spark, sf).select("segment_route").distinct()
    return i.select("segment_route", F.array_join(AR.extract_codes("segment_route"), ",").alias("codes"))


fx.DUCKDB_VIEWS["paths"] = """select distinct segment_route from itineraries"""
fx.DUCKDB_VIEWS["hops_sql"] = """select segment_route, cast(i - 1 as int) as hop_index, c[i] as "from", c[i + 1] as "to"
from (select segment_route, regexp_extract_all(upper(segment_route), '\\b[A-Z]{3}\\b') as c from paths),
lateral (select unnest(range(1, len(c))) as i)"""


@register("fn_hops", """select * from hops_sql""", views=("itineraries", "paths", "hops_sql"))
def fn_hops(spark, sf):
    """Consecutive airport pairs of a journey."""
    p = itins(spark, sf).select("segment_route").distinct()
    return IT.journey_hops(p, keep=["segment_route"])


@register("join_airports", """select h.segment_route, h.hop_index, h."from", h."to", a.lat as source_lat, a.lon as source_lon,
b.lat as dest_lat, b.lon as dest_lon from hops_sql h join airports a on h."from" = a.code join airports b on h."to" = b.code""",
          views=("itineraries", "paths", "hops_sql", "airports"))
def join_airports(spark, sf):
    """Hop ends → coordinates, hop kept only if both known (inner ×2)."""
    p = itins(spark, sf).select("segment_route").distinct()
    return IT.hops_with_coordinates(IT.journey_hops(p, keep=["segment_route"]), dims.airports(spark)).select(
        "segment_route", "hop_index", "from", "to", "source_lat", "source_lon", "dest_lat", "dest_lon")


@register("agg_map_view", f"""with arcs as (select h.*, a.lat as source_lat, a.lon as source_lon, b.lat as dest_lat, b.lon as dest_lon
from (select distinct i.origin_code, i.dest_code, h.* from itineraries i join hops_sql h on i.segment_route = h.segment_route) h
join airports a on h."from" = a.code join airports b on h."to" = b.code),
ends as (select origin_code, dest_code, source_lat as lat, source_lon as lon from arcs union all
select origin_code, dest_code, dest_lat, dest_lon from arcs),
g as (select origin_code, dest_code, avg(lat) as center_lat, avg(lon) as center_lon, max(lat) - min(lat) as lat_span,
max(lon) - min(lon) as lon_span from ends group by 1, 2)
select origin_code, dest_code, {_r4sql('center_lat')} as center_lat, {_r4sql('center_lon')} as center_lon,
{_r4sql('lat_span')} as lat_span, {_r4sql('lon_span')} as lon_span,
case when greatest(lat_span, lon_span) < 5 then 6 when greatest(lat_span, lon_span) < 20 then 4
when greatest(lat_span, lon_span) < 60 then 3 else 2 end as zoom from g""",
          views=("itineraries", "paths", "hops_sql", "airports"))
def agg_map_view(spark, sf):
    """Map centre/zoom per route over the hops of its distinct journeys."""
    i = itins(spark, sf).select("origin_code", "dest_code", "segment_route").distinct()
    arcs = IT.hops_with_coordinates(IT.journey_hops(i, keep=["origin_code", "dest_code", "segment_route"]),
                                    dims.airports(spark))
    v = IT.map_view(arcs, by=["origin_code", "dest_code"])
    return v.select("origin_code", "dest_code", *[r4(c).alias(c) for c in
                                                  ("center_lat", "center_lon", "lat_span", "lon_span")],
                    F.col("zoom").cast("int").alias("zoom"))


@register("win_cheapest_per_path", """select * from (select origin_code, dest_code, segment_route, itinerary_id, price_raw,
row_number() over (partition by origin_code, dest_code order by price_raw, itinerary_id) as journey_rank
from (select * from (select *, row_number() over (partition by origin_code, dest_code, segment_route order by price_raw, itinerary_id) as rn
from itineraries) where rn = 1)) where journey_rank <= 8""", views=("itineraries",))
def win_cheapest_per_path(spark, sf):
    """Cheapest row per segment path, then first n."""
    i = itins(spark, sf).select("origin_code", "dest_code", "segment_route", "itinerary_id", "price_raw")
    b = IT.cheapest_per_path(i, ["origin_code", "dest_code"], n=8)
    return b.select("origin_code", "dest_code", "segment_route", "itinerary_id", "price_raw",
                    F.col("journey_rank").cast("bigint").alias("journey_rank"))


# --- filters over itineraries --------------------------------------------------------------

fx.DUCKDB_VIEWS["itin_trim"] = """select i.* from itineraries i join (select origin_code, dest_code, search_date, collected_at,
quantile_cont(price_raw, 0.95) as qp, quantile_cont(duration_minutes, 0.95) as qm from itineraries group by all) q
using (origin_code, dest_code, search_date, collected_at)
where i.price_raw <= q.qp and i.duration_minutes <= q.qm and i.stop_count <= 2"""
GRP = ["origin_code", "dest_code", "search_date", "collected_at"]
STOPS = (0, 1, 2)  # what the trim leaves


def trimmed(spark: SparkSession, sf: str) -> DataFrame:
    """The trimmed candidates, landed once: the skylines read them several times."""
    path = land_parquet(spark, sf, "itin_trim", lambda: IT.quantile_trim(itins(spark, sf), GRP))
    return spark.read.parquet(path)


@register("flt_quantile_trim", "select itinerary_id from itin_trim", views=("itineraries", "itin_trim"))
def flt_quantile_trim(spark, sf):
    """Price ≤ p95, duration ≤ p95, stops ≤ 2 — both quantiles over the *unfiltered* group."""
    return IT.quantile_trim(itins(spark, sf), GRP).select("itinerary_id")


@register("flt_latest_snapshot", """select itinerary_id, collected_at from itineraries i
where collected_at = (select max(collected_at) from itineraries j where j.origin_code = i.origin_code
and j.dest_code = i.dest_code and j.search_date = i.search_date)""", views=("itineraries",))
def flt_latest_snapshot(spark, sf):
    """Rows of route+date whose collected_at is the maximum (present but uncalled in the reference)."""
    return IT.latest_snapshot(itins(spark, sf)).select("itinerary_id", "collected_at")


@register("flt_max_transits", "select itinerary_id, stop_count from itineraries where stop_count <= 1",
          views=("itineraries",))
def flt_max_transits(spark, sf):
    """Stops ≤ n."""
    return itins(spark, sf).filter(F.col("stop_count") <= 1).select("itinerary_id", "stop_count")


_DOM = """q.price_raw <= p.price_raw and q.duration_minutes <= p.duration_minutes and q.stop_count <= p.stop_count
and (q.price_raw < p.price_raw or q.duration_minutes < p.duration_minutes or q.stop_count < p.stop_count)
and q.origin_code = p.origin_code and q.dest_code = p.dest_code and q.search_date = p.search_date and q.collected_at = p.collected_at"""


@register("sky_pareto", f"""select origin_code, dest_code, search_date, collected_at, price_raw,
cast(round_even(duration_minutes / 60 * 10, 0) / 10 as double) as duration_hrs, stop_count, carrier_names, segment_route, itinerary_id
from (select p.*, row_number() over (partition by origin_code, dest_code, search_date, collected_at order by price_raw, itinerary_id) as rn
from itin_trim p where not exists (select 1 from itin_trim q where {_DOM})) where rn <= 5""",
          views=("itineraries", "itin_trim"))
def sky_pareto(spark, sf):
    """Trim, first non-dominated front per search, cheapest 5, hours column."""
    front = SK.pareto_front(trimmed(spark, sf), GRP, levels=STOPS)
    top = IT.top_n(front, 5, [F.col("price_raw"), F.col("itinerary_id")], by=GRP)
    hrs = F.bround(F.col("duration_minutes") / 60 * 10, 0) / 10
    return top.select(*GRP, "price_raw", hrs.alias("duration_hrs"), "stop_count", "carrier_names",
                      "segment_route", "itinerary_id")


@register("sky_fronts", f"""with recursive points as (select distinct origin_code, dest_code, search_date, collected_at, price_raw,
duration_minutes, stop_count from itin_trim),
n as (select *, row_number() over () as id from points),
e as (select q.id as a, p.id as b from n p join n q on {_DOM}),
r(id, front) as (select id, 0 from n union select e.b, r.front + 1 from r join e on e.a = r.id),
m as (select id, cast(max(front) as int) as front from r group by id)
select i.itinerary_id, m.front from itin_trim i
join n using (origin_code, dest_code, search_date, collected_at, price_raw, duration_minutes, stop_count) join m using (id)""", views=("itineraries", "itin_trim"))
def sky_fronts(spark, sf):
    """The front number of every trimmed itinerary (the library call returns all fronts)."""
    return SK.front_numbers(trimmed(spark, sf), GRP).select("itinerary_id", "front")


@register("sky_pareto_objectives", """select itinerary_id from itin_trim p where not exists (select 1 from itin_trim q
where q.price_raw <= p.price_raw and q.duration_minutes <= p.duration_minutes and q.stop_count <= p.stop_count
and q.search_date >= p.search_date and (q.price_raw < p.price_raw or q.duration_minutes < p.duration_minutes
or q.stop_count < p.stop_count or q.search_date > p.search_date)
and q.origin_code = p.origin_code and q.dest_code = p.dest_code and q.collected_at = p.collected_at)""",
          views=("itineraries", "itin_trim"))
def sky_pareto_objectives(spark, sf):
    """Four objectives over all dates of a route's snapshot: price, duration and stops small, departure late."""
    def landed(front: DataFrame) -> DataFrame:
        return spark.read.schema(front.schema).parquet(land_parquet(spark, sf, "sky_objectives", lambda: front))
    return SK.skyline(trimmed(spark, sf), ["origin_code", "dest_code", "collected_at"],
                      ["price_raw", "duration_minutes", "stop_count", "search_date"],
                      maximise=["search_date"], keep=landed).select("itinerary_id")


# --- sets, projections, links, text ----------------------------------------------------------

@register("set_union", """select itinerary_id, collected_at, price_raw, null::int as stop_count from itineraries where collected_at = date '2024-02-01'
union all select itinerary_id, collected_at, price_raw, stop_count from itineraries where collected_at = date '2024-02-02'
union all select itinerary_id, collected_at, price_raw, stop_count from itineraries where collected_at = date '2024-02-03'""",
          views=("itineraries",))
def set_union(spark, sf):
    """Daily files whose columns drifted (day 1 lacks ``stop_count``) unioned by name."""
    i = itins(spark, sf)
    days = [i.filter(F.col("collected_at") == F.lit(d).cast("date")) for d in ("2024-02-01", "2024-02-02", "2024-02-03")]
    first = days[0].select("itinerary_id", "collected_at", "price_raw")
    out = first
    for d in days[1:]:
        out = out.unionByName(d.select("itinerary_id", "collected_at", "price_raw", "stop_count"),
                              allowMissingColumns=True)
    return out


@register("set_distinct", """select distinct segment_route from itineraries""", views=("itineraries",))
def set_distinct(spark, sf):
    """Sorted distinct routes; dedup by key."""
    return itins(spark, sf).select("segment_route").distinct()


KEEP = ["itinerary_id", "origin_code", "dest_code", "price_raw", "score", "is_direct", "stop_count"]


@register("snk_keep_columns", "select itinerary_id, origin_code, dest_code, price_raw, stop_count from itineraries",
          views=("itineraries",))
def snk_keep_columns(spark, sf):
    """Allow-list projection: names absent from the frame are ignored."""
    i = itins(spark, sf)
    return i.select(*[c for c in KEEP if c in i.columns])


@register("fn_search_link", """select itinerary_id, concat('https://www.skyscanner.net/transport/flights/', lower(origin_code), '/',
lower(dest_code), '/', strftime(search_date, '%y%m%d'), '/', 'config/', itinerary_id, '?adultsv2=1&cabinclass=economy') as link,
concat('https://www.skyscanner.net/transport/flights/', lower(origin_code), '/', lower(dest_code), '/',
strftime(search_date, '%y%m%d'), '/', strftime(search_date + 7, '%y%m%d'), '/', '?adultsv2=1&cabinclass=economy') as roundtrip_link
from itineraries""", views=("itineraries",))
def fn_search_link(spark, sf):
    """Deep link from route, yymmdd, optional itinerary id; round-trip variant."""
    i = itins(spark, sf)
    return i.select("itinerary_id", TX.search_link("origin_code", "dest_code", "search_date", "itinerary_id").alias("link"),
                    TX.roundtrip_link("origin_code", "dest_code", "search_date",
                                      F.date_add("search_date", 7)).alias("roundtrip_link"))


@register("fn_fmt_duration", """select itinerary_id,
case when duration_minutes is null or duration_minutes = 0 then 'N/A' when duration_minutes // 60 > 0 and duration_minutes % 60 > 0
then printf('%dh %dm', duration_minutes // 60, duration_minutes % 60) when duration_minutes // 60 > 0 then printf('%dh', duration_minutes // 60)
else printf('%dm', duration_minutes % 60) end as duration_text,
case when cast(round_even((duration_minutes / 60.0 - cast(trunc(duration_minutes / 60.0) as bigint)) * 60, 0) as bigint) <> 0
then printf('%dh %dm', cast(trunc(duration_minutes / 60.0) as bigint), cast(round_even((duration_minutes / 60.0 - cast(trunc(duration_minutes / 60.0) as bigint)) * 60, 0) as bigint))
else printf('%dh', cast(trunc(duration_minutes / 60.0) as bigint)) end as hours_text from itineraries""", views=("itineraries",))
def fn_fmt_duration(spark, sf):
    """Minutes→Xh Ym; decimal hours→Xh Ym (round minutes); null/0→N/A in the first form."""
    i = itins(spark, sf)
    return i.select("itinerary_id", TX.fmt_minutes("duration_minutes").alias("duration_text"),
                    TX.fmt_hours(F.col("duration_minutes") / 60.0).alias("hours_text"))


@register("fn_fmt_time", f"""select itinerary_id, strftime(to_timestamp(dep0) at time zone 'UTC', '%d/%m %H:%M') as short_time,
strftime(to_timestamp(dep0) at time zone 'UTC', '%d/%m/%Y') as day_text,
strftime(to_timestamp(dep0) at time zone 'UTC', '%d/%m/%Y %H:%M:%S') as full_text from itin_x""", views=IX)
def fn_fmt_time(spark, sf):
    """ISO → dd/MM HH:mm, dd/MM/yyyy[ HH:mm:ss], invalid → N/A / original / unknown."""
    flat = RS.parse_flat(search_docs(spark, sf), ["itinerary_id", "departure"])
    return flat.select("itinerary_id", TX.fmt_time("departure").alias("short_time"),
                       TX.fmt_time("departure", "dd/MM/yyyy", None).alias("day_text"),
                       TX.fmt_time("departure", "dd/MM/yyyy HH:mm:ss", "unknown").alias("full_text"))


@register("fn_round_hours", """select itinerary_id, cast(round_even(duration_minutes / 60 * 10, 0) / 10 as double) as duration_hrs
from itineraries""", views=("itineraries",))
def fn_round_hours(spark, sf):
    """Minutes/60 to 1 dp, half-even."""
    i = itins(spark, sf)
    return i.select("itinerary_id", (F.bround(F.col("duration_minutes") / 60 * 10, 0) / 10).alias("duration_hrs"))


@register("fn_deal_card")
def fn_deal_card(spark, sf):
    """Full message card of the 5 cheapest deals per route (rows-only check;
    pytest checks the card text of the reference's sample deal)."""
    from pyspark.sql import Window
    d = deals(spark, sf, *[c for c in RS.LEG_FIELDS if c != "transit_countries"])
    w = Window.partitionBy("out_origin", "out_destination").orderBy("price_gbp", "flight_id")
    top = IT.top_n(d, 5, [F.col("price_gbp"), F.col("flight_id")], by=["out_origin", "out_destination"])
    top = top.withColumn("rank", F.row_number().over(w))
    card = TX.deal_card(F.col("rank"), F.col("out_origin"), F.col("out_destination"),
                        F.col("out_departure_date"), F.col("ret_departure_date"))
    return top.select("flight_id", "rank", card.alias("card"))


@register("join_skyline", f"""select p.itinerary_id from itin_trim p where exists (select 1 from itin_trim q where {_DOM})""",
          views=("itineraries", "itin_trim"))
def join_skyline(spark, sf):
    """Dominated itineraries (the theta self-join's answer) without the
    quadratic join: everything not on the first front of its search."""
    t = trimmed(spark, sf)
    return t.join(SK.pareto_front(t, GRP, levels=STOPS), ["itinerary_id"], "left_anti").select("itinerary_id")


@register("snk_deals_json", """select flight_id, price_gbp, ap[1] as out_origin, ap[-1] as out_destination,
cast(7 + d % 14 as int) as trip_length_days from rt_x""", views=RT)
def snk_deals_json(spark, sf):
    """Deals written as JSON lines (with their metadata block next to them)
    and read back with an explicit schema."""
    path, schema = written_deals(spark, sf)
    back = spark.read.schema(schema).json(os.path.join(path, "flights"))
    return back.select("flight_id", "price_gbp", "out_origin", "out_destination", "trip_length_days")


def written_deals(spark: SparkSession, sf: str) -> tuple[str, T.StructType]:
    """Where the deals are written, all their columns in ``flights`` and a block for each route in ``metadata``, and the
    schema of the flights."""
    d = deals(spark, sf)

    def write(path: str) -> None:
        flights = os.path.join(path, "flights")
        write_json(d, flights)
        # from the file, so that the responses are parsed once
        f = spark.read.schema("out_origin string, out_destination string, price_gbp double").json(flights)
        write_json(f.groupBy("out_origin", "out_destination").agg(
            F.count(F.lit(1)).alias("count"), F.min("price_gbp").alias("cheapest"),
            F.avg("price_gbp").alias("average"), F.lit("2024-02-01T00:00:00").alias("saved_at")), os.path.join(path, "metadata"))

    return land_once(spark, sf, "deals_json", write), d.schema
