"""Fare-market analytics: operators bound to the ``market`` fixture view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalar as S
from ..functions.numeric import r4, r4_ieee
from ..operators import aggregate as A
from ..operators import clean as C
from ..operators import distribution as D
from ..operators import regression as RG
from ..operators import timeseries as TS
from ..operators import partials as PA
from ..operators.sample import POPULATION, RANK, exact_sample, load_sample, store_sample
from ..sources.landing import land_once, land_parquet
from ..sources import files as FL
from ..sources import fixtures as fx
from .registry import register

fx.DUCKDB_VIEWS["market_clean"] = """select *, MktFare / greatest(MktDistance, 1) as FarePerMile,
concat_ws('-', Origin, Dest) as Route, MktCoupons = 1 as IsDirect
from market where MktFare > 0 and Passengers > 0"""
MC = ("market", "market_clean")


def market(spark: SparkSession, sf: str) -> DataFrame:
    return fx.stored(spark, sf, "market")


def market_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Basic-cleaned market rows with the computed analysis columns (string
    trimming belongs to ingest — see ``snk_market_parquet`` — not to every
    analysis query)."""
    return (C.basic_clean(market(spark, sf), trim=False)
            .withColumn("FarePerMile", S.fare_per_mile("MktFare", "MktDistance"))
            .withColumn("Route", S.route_key("Origin", "Dest"))
            .withColumn("IsDirect", S.is_direct_coupons("MktCoupons")))


def _r4sql(e: str) -> str:
    return f"floor(({e}) * 10000 + 0.5) / 10000"


# --- 2.1 sources over the market table ----------------------------------------

def market_quarters(spark: SparkSession, sf: str) -> DataFrame:
    """The typed quarter files (Parquet partitioned by ``Year``/``Quarter``)
    converted from the CSV export; quarter predicates prune directories."""
    from .source_plans import quarter_pipeline
    return spark.read.parquet(quarter_pipeline(spark, sf).parquet)


@register("src_market_quarters", """select MktID, Year, Quarter, MktFare from market
where ItinID % 997 <> 0 and MktFare > 0 and Passengers > 0 and Year between 1996 and 1998 and Year * 4 + Quarter - 1 between 1996 * 4 + 1 and 1998 * 4 + 2""",
          views=("market",))
def src_market_quarters(spark, sf):
    """One scan over a quarter range: ``PartitionFilters`` on Year/Quarter."""
    m = A.quarter_range(market_quarters(spark, sf), (1996, 2), (1998, 3))
    return m.select("MktID", "Year", "Quarter", "MktFare")


@register("src_project_filter", """select MktID, Origin, Dest, MktFare from market
where MktFare > 100.0 and Origin in ('N01', 'N02', 'N03') and Dest not in ('N04')""",
          views=("market",))
def src_project_filter(spark, sf):
    """Load with column list and pushed filters (col, op, value) incl."""
    return A.project_filter(
        market(spark, sf), ["MktID", "Origin", "Dest", "MktFare", "NoSuchColumn"],
        [("MktFare", ">", 100.0), ("Origin", "in", ["N01", "N02", "N03"]),
         ("Dest", "not in", ["N04"]), ("NoSuchColumn", "=", 1)])


@register("src_route_extract", """select MktID, Origin, Dest, Year, Quarter, MktFare from market
where ItinID % 997 <> 0 and MktFare > 0 and Passengers > 0 and Origin in ('N05', 'N07') and Dest in ('N10', 'N11', 'N12')
and Year * 4 + Quarter - 1 between 1994 * 4 and 1997 * 4 + 3 and Year between 1994 and 1997""",
          views=("market",))
def src_route_extract(spark, sf):
    """Routes across quarters from the quarter files: partition pruning plus
    ``In`` filters pushed into the Parquet scan."""
    m = A.quarter_range(market_quarters(spark, sf), (1994, 1), (1997, 4))
    return (m.filter(F.col("Origin").isin("N05", "N07") & F.col("Dest").isin("N10", "N11", "N12"))
            .select("MktID", "Origin", "Dest", "Year", "Quarter", "MktFare"))


WIDE_COLUMNS = ["ItinID", "MktID", "MktCoupons", "Year", "Quarter", "Origin", "Dest",
                "TkCarrier", "OpCarrier", "RPCarrier", "Passengers", "MktFare", "MktDistance",
                "MktDistanceGroup", "MktMilesFlown", "NonStopMiles"]


@register("src_wide_parquet", f"select {', '.join(WIDE_COLUMNS)} from market", views=("market",))
def src_wide_parquet(spark, sf):
    """Project 16 of many columns from a monthly ticket file."""
    return market(spark, sf).select(*WIDE_COLUMNS)


# --- 2.2 scalar functions ------------------------------------------------------

@register("fn_trim_strings", """select MktID, Origin, RPCarrier,
trim(RPCarrier) as padded from market where MktFare > 0 and Passengers > 0""", views=("market",))
def fn_trim_strings(spark, sf):
    """Strip all string columns."""
    m = market(spark, sf).filter((F.col("MktFare") > 0) & (F.col("Passengers") > 0))
    padded = F.concat(F.lit(" \t"), F.col("RPCarrier"), F.lit(" \n "))
    return C.trim_strings(m.select("MktID", "Origin", "RPCarrier", padded.alias("padded")))


@register("fn_route_key", """select MktID, concat_ws('-', Origin, Dest) as route_dash,
concat_ws('_', Origin, Dest) as route_underscore, concat_ws(' -> ', Origin, Dest) as route_arrow
from market""", views=("market",))
def fn_route_key(spark, sf):
    """Origin-dest, also _ and  ->  forms."""
    return market(spark, sf).select(
        "MktID", S.route_key("Origin", "Dest").alias("route_dash"),
        S.route_key("Origin", "Dest", "_").alias("route_underscore"),
        S.route_key("Origin", "Dest", " -> ").alias("route_arrow"))


@register("fn_fare_per_mile", """select MktID, MktFare / greatest(MktDistance, 1) as fare_per_mile
from market""", views=("market",))
def fn_fare_per_mile(spark, sf):
    """Fare / max(distance,1)."""
    return market(spark, sf).select("MktID", S.fare_per_mile("MktFare", "MktDistance").alias("fare_per_mile"))


@register("fn_routing_ratio", """select MktID, MktMilesFlown / greatest(NonStopMiles, 1) as routing_ratio
from market where MktMilesFlown / greatest(NonStopMiles, 1) between 0.9 and 3.0""", views=("market",))
def fn_routing_ratio(spark, sf):
    """Miles flown / max(non-stop,1), keep 0.9–3.0."""
    rr = S.routing_ratio("MktMilesFlown", "NonStopMiles")
    return market(spark, sf).select("MktID", rr.alias("routing_ratio")).filter(
        F.col("routing_ratio").between(0.9, 3.0))


@register("fn_direct_flag", """select MktID, MktCoupons = 1 as is_direct,
cast(MktCoupons > 1 as int) as is_connecting,
coalesce(case when MktCoupons > 1 then MktCoupons - 1 end, 0) = 0 as no_stops from market""",
          views=("market",))
def fn_direct_flag(spark, sf):
    """Coupons==1 / >1, stops==0 (missing stops count as 0)."""
    stops = F.when(F.col("MktCoupons") > 1, F.col("MktCoupons") - 1)
    return market(spark, sf).select(
        "MktID", S.is_direct_coupons("MktCoupons").alias("is_direct"),
        S.is_connecting("MktCoupons").alias("is_connecting"),
        S.is_direct_stops(stops).alias("no_stops"))


@register("fn_quarter_label", """select distinct concat(cast(Year as varchar), ' Q', cast(Quarter as varchar)) as YearQuarter
from market""", views=("market",))
def fn_quarter_label(spark, sf):
    """YYYY Qn."""
    return market(spark, sf).select(S.quarter_label("Year", "Quarter").alias("YearQuarter")).distinct()


def _cut_sql(x: str, edges, labels) -> str:
    parts = " ".join(f"when {x} > {lo} and {x} <= {hi} then '{lab}'"
                     for lo, hi, lab in zip(edges[:-1], edges[1:], labels))
    return f"case {parts} end"


@register("fn_cut_labels", f"""select MktID,
{_cut_sql('MktDistance', *S.DISTANCE_BANDS)} as distance_band,
{_cut_sql('MktDistance', *S.PREMIUM_BANDS)} as premium_band,
{_cut_sql('MktDistance', *S.DISTANCE_CATEGORIES)} as distance_category from market""", views=("market",))
def fn_cut_labels(spark, sf):
    """Bin into labelled right-closed intervals, outside → null; 3 edge sets."""
    return market(spark, sf).select(
        "MktID", S.cut_labels("MktDistance", *S.DISTANCE_BANDS).alias("distance_band"),
        S.cut_labels("MktDistance", *S.PREMIUM_BANDS).alias("premium_band"),
        S.cut_labels("MktDistance", *S.DISTANCE_CATEGORIES).alias("distance_category"))


@register("fn_cut_regular", """select MktID, cast(ceil(MktDistance / 100.0) as int) as dist_bin,
0.0e0 + (cast(ceil(MktDistance / 100.0) as int) - 0.5e0) * 100.0e0 as bin_mid
from market where MktDistance > 0 and MktDistance <= 5900""", views=("market",))
def fn_cut_regular(spark, sf):
    """100-mile bins 0–5900 and midpoint."""
    k = S.cut_regular_bin("MktDistance", 100.0, 0.0, 5900.0)
    return (market(spark, sf).select("MktID", k.alias("dist_bin")).filter(F.col("dist_bin").isNotNull())
            .withColumn("bin_mid", S.bin_midpoint("dist_bin", 100.0, 0.0)))


@register("fn_value_map", """select MktID, case Quarter when 1 then 'winter' when 2 then 'spring'
when 3 then 'summer' when 4 then 'fall' end as season,
case MktGeoType when 1 then 'Non-Contiguous (HI, AK, Territories)' when 2 then 'Contiguous (Lower 48)'
else 'Other' end as GeoLabel from market""", views=("market",))
def fn_value_map(spark, sf):
    """Code→label with default; quarter→season."""
    return market(spark, sf).select(
        "MktID", S.season("Quarter").alias("season"),
        S.value_map("MktGeoType", S.GEO_LABELS, "Other").alias("GeoLabel"))


@register("fn_log", f"""select MktID, {_r4sql('log10(greatest(MktFare, 1))')} as log_fare from market""",
          views=("market",))
def fn_log(spark, sf):
    """Log10(max(x,1)); natural log of aggregate."""
    return market(spark, sf).select("MktID", r4(S.log10_floor1("MktFare")).alias("log_fare"))


@register("fn_clip_cap", """select MktID, least(MktFare, 3000.0) as fare_cap3000,
least(MktFare, 1500.0) as fare_cap1500, least(MktFare / greatest(MktDistance, 1), 2.0) as fpm_cap2
from market""", views=("market",))
def fn_clip_cap(spark, sf):
    """Cap values before distribution."""
    return market(spark, sf).select(
        "MktID", S.cap("MktFare", 3000).alias("fare_cap3000"), S.cap("MktFare", 1500).alias("fare_cap1500"),
        S.cap(S.fare_per_mile("MktFare", "MktDistance"), 2.0).alias("fpm_cap2"))


@register("fn_quarter_from_filename", """with names as (
  select distinct concat('Origin_and_Destination_Survey_DB1BMarket_', Year, '_', Quarter, '.csv') as file_name from market
  union all select distinct concat('db1b_', Year, '-', Quarter + 4, '.parquet') from market
  union all select distinct concat('market_', Quarter, '.csv') from market)
select file_name,
case when try_cast(regexp_extract(file_name, '(\\d{4})[_-](\\d)', 1) as int) between 2000 and 2030
  and try_cast(regexp_extract(file_name, '(\\d{4})[_-](\\d)', 2) as int) between 1 and 4
  then try_cast(regexp_extract(file_name, '(\\d{4})[_-](\\d)', 1) as int) end as year,
case when try_cast(regexp_extract(file_name, '(\\d{4})[_-](\\d)', 1) as int) between 2000 and 2030
  and try_cast(regexp_extract(file_name, '(\\d{4})[_-](\\d)', 2) as int) between 1 and 4
  then try_cast(regexp_extract(file_name, '(\\d{4})[_-](\\d)', 2) as int) end as quarter
from names""", views=("market",))
def fn_quarter_from_filename(spark, sf):
    """Year and quarter from file names (YYYY_Q / YYYY-Q), null unless valid."""
    m = market(spark, sf)
    y, q = F.col("Year").cast("string"), F.col("Quarter")
    names = (m.select(F.concat(F.lit("Origin_and_Destination_Survey_DB1BMarket_"), y, F.lit("_"),
                               q.cast("string"), F.lit(".csv")).alias("file_name")).distinct()
             .unionAll(m.select(F.concat(F.lit("db1b_"), y, F.lit("-"), (q + 4).cast("string"),
                                         F.lit(".parquet")).alias("file_name")).distinct())
             .unionAll(m.select(F.concat(F.lit("market_"), q.cast("string"), F.lit(".csv"))
                                .alias("file_name")).distinct()))
    yy, qq = S.quarter_from_name("file_name")
    return names.select("file_name", yy.alias("year"), qq.alias("quarter"))


@register("fn_quarter_sequence", """with b as (select min(Year * 4 + Quarter - 1) as a, max(Year * 4 + Quarter - 1) as z from market),
s as (select unnest(range(a, z + 1)) as qi from b)
select cast(qi // 4 as int) as year, cast(qi % 4 + 1 as int) as quarter from s""", views=("market",))
def fn_quarter_sequence(spark, sf):
    """All quarters between the first and last present in the data, inclusive."""
    qi = S.quarter_index("Year", "Quarter")
    b = market(spark, sf).agg(F.min(qi).alias("a"), F.max(qi).alias("z"))
    s = b.select(F.explode(F.sequence("a", "z")).alias("qi"))
    return s.select(F.floor(F.col("qi") / 4).cast("int").alias("year"),
                    (F.col("qi") % 4 + 1).cast("int").alias("quarter"))


# --- 2.3 filters -----------------------------------------------------------------

@register("flt_basic_clean", """select MktID, Origin, Dest, MktFare, Passengers from market
where MktFare > 0 and Passengers > 0""", views=("market",))
def flt_basic_clean(spark, sf):
    """Fare > 0 and passengers > 0 (if column exists), strings trimmed, removed count."""
    return C.basic_clean(market(spark, sf)).select("MktID", "Origin", "Dest", "MktFare", "Passengers")


@register("flt_basic_clean_report", """select count(*) as rows_before,
count(*) filter (where MktFare > 0 and Passengers > 0) as rows_after,
count(*) filter (where not (MktFare > 0 and Passengers > 0)) as rows_removed from market""",
          views=("market",))
def flt_basic_clean_report(spark, sf):
    """Rows before, after and removed by the basic cleaning."""
    return C.basic_clean_report(market(spark, sf))


@register("flt_usable", f"""select count(*) as rows_after, {_r4sql('avg(MktFare)')} as mean_fare,
{_r4sql('median(MktFare)')} as median_fare, min(MktFare) as min_fare, max(MktFare) as max_fare
from market where MktFare > 0 and MktFare < 10000 and BulkFare = 0 and Passengers > 0""",
          views=("market",))
def flt_usable(spark, sf):
    """0 < fare < 10000, not bulk, passengers > 0 + price stats."""
    u = C.usable(market(spark, sf))
    st = u.agg(F.count(F.lit(1)).alias("rows_after"), r4(F.avg("MktFare")).alias("mean_fare"),
               F.min("MktFare").alias("min_fare"), F.max("MktFare").alias("max_fare"))
    st = A.join_quantiles(st, u, [], "MktFare", [0.5], ["median_fare"])
    return st.select("rows_after", "mean_fare", r4("median_fare").alias("median_fare"), "min_fare", "max_fare")


@register("flt_rules", """select count(*) as rows_before,
count(*) filter (where MktFare >= 10.0 and MktFare <= 5000.0 and MktDistance >= 50 and Passengers >= 1) as rows_after,
count(*) filter (where not coalesce(MktFare >= 10.0, false)) as fail_min_fare,
count(*) filter (where not coalesce(MktFare <= 5000.0, false)) as fail_max_fare,
count(*) filter (where not coalesce(MktDistance >= 50, false)) as fail_min_distance,
count(*) filter (where not coalesce(Passengers >= 1, false)) as fail_min_passengers,
count(*) filter (where MktFare >= 10.0 and MktFare <= 5000.0 and MktDistance >= 50 and Passengers >= 1) * 100.0 / count(*) as retained_pct
from market""", views=("market",))
def flt_rules(spark, sf):
    """Rule set: fare 10–5000, distance ≥ 50, passengers ≥ 1 with retention report (before/after/pct)."""
    return C.rules_retention(market(spark, sf))


@register("flt_rules_rows", """select MktID from market
where MktFare >= 10.0 and MktFare <= 5000.0 and MktDistance >= 50 and Passengers >= 1""",
          views=("market",))
def flt_rules_rows(spark, sf):
    """The rows kept by the cleaning rule set."""
    return C.apply_rules(market(spark, sf)).select("MktID")


#: All columns of the market view, and those of them and of its cleaned form that are numbers.
MARKET_COLS = [n for n, _ in FL.MARKET_FIELDS] + ["Year", "Quarter"]
MARKET_NUMBERS = [n for n, t in FL.MARKET_FIELDS if not isinstance(t, T.StringType)] + ["Year", "Quarter", "FarePerMile"]


@register("flt_constant_columns", " union all ".join(
    f"select '{c}' as \"column\", count({c}) as n_values, count(distinct {c}) <= 1 as constant from market"
    for c in MARKET_COLS), views=("market",))
def flt_constant_columns(spark, sf):
    """Every column with whether it is constant (to drop)."""
    return C.column_constancy(market(spark, sf))


def _seg_sql(value: str, base: str) -> str:
    arms = []
    for i, (lab, lo, hi, kind) in enumerate(C.FARE_SEGMENTS):
        cond = (f"{value} < {hi}" if kind == "lt" else f"{value} > {lo}" if kind == "gt"
                else f"{value} between {lo} and {hi}")
        arms.append(f"select '{lab}' as segment, {i} as ord, count(*) as count, "
                    f"count(*) * 100.0 / (select count(*) from {base}) as pct, "
                    f"median({value}) as median from {base} where {cond}")
    return " union all ".join(arms)


@register("flt_segments", f"""select segment, ord, count, {_r4sql('pct')} as pct, {_r4sql('median')} as median
from ({_seg_sql('MktFare', 'market_clean')}) where count > 0""", views=MC)
def flt_segments(spark, sf):
    """Five fare bands with count, pct, median."""
    s = D.fare_segments(market_clean(spark, sf), "MktFare", C.FARE_SEGMENTS)
    return s.select("segment", F.col("ord").cast("int").alias("ord"), "count",
                    r4("pct").alias("pct"), r4("median").alias("median"))


# --- 2.4 joins / 2.8 feature table ------------------------------------------------

fx.DUCKDB_VIEWS["market_feat_base"] = """select *, concat_ws('_', Origin, Dest) as route from market
where MktFare > 0 and MktFare < 10000 and BulkFare = 0 and Passengers > 0"""
MF = ("market", "market_feat_base")


def _feat_base(spark, sf):
    return C.usable(market(spark, sf)).withColumn("route", S.route_key("Origin", "Dest", "_"))


@register("join_market_share", f"""with s as (select route, TkCarrier,
sum(Passengers) / sum(sum(Passengers)) over (partition by route) as carrier_market_share
from market_feat_base group by route, TkCarrier)
select b.MktID, b.route, b.TkCarrier, {_r4sql('s.carrier_market_share')} as carrier_market_share
from market_feat_base b left join s on b.route = s.route and b.TkCarrier = s.TkCarrier""", views=MF)
def join_market_share(spark, sf):
    """Left equi join of (route, carrier) share back to rows."""
    b = _feat_base(spark, sf)
    share = A.market_share(b, "route", "TkCarrier", "Passengers")
    j = b.join(share, ["route", "TkCarrier"], "left")
    return j.select("MktID", "route", "TkCarrier", r4("carrier_market_share").alias("carrier_market_share"))


@register("join_competition", """with c as (select route, count(distinct TkCarrier) as route_competition
from market_feat_base group by route)
select b.MktID, b.route, c.route_competition from market_feat_base b left join c on b.route = c.route""",
          views=MF)
def join_competition(spark, sf):
    """Map route → distinct carriers onto each row."""
    b = _feat_base(spark, sf)
    return b.join(A.route_carrier_counts(b, "route", "TkCarrier"), "route", "left").select(
        "MktID", "route", "route_competition")


@register("feat_market", f"""with c as (select route, count(distinct TkCarrier) as route_competition
from market_feat_base group by route),
s as (select route, TkCarrier, sum(Passengers) / sum(sum(Passengers)) over (partition by route) as carrier_market_share
from market_feat_base group by route, TkCarrier)
select b.MktID, b.route, c.route_competition, {_r4sql('s.carrier_market_share')} as carrier_market_share,
b.MktFare / greatest(b.MktDistance, 1) as fare_per_mile, cast(b.MktCoupons > 1 as int) as is_connecting,
{_cut_sql('b.MktDistance', *S.DISTANCE_CATEGORIES)} as distance_category,
case b.Quarter when 1 then 'winter' when 2 then 'spring' when 3 then 'summer' when 4 then 'fall' end as season
from market_feat_base b left join c on b.route = c.route
left join s on b.route = s.route and b.TkCarrier = s.TkCarrier""", views=MF)
def feat_market(spark, sf):
    """The reference's market feature table in one plan: both route-level
    tables are aggregates of the same scan and join back on their keys."""
    b = _feat_base(spark, sf)
    comp = A.route_carrier_counts(b, "route", "TkCarrier")
    share = A.market_share(b, "route", "TkCarrier", "Passengers")
    j = b.join(comp, "route", "left").join(share, ["route", "TkCarrier"], "left")
    return j.select(
        "MktID", "route", "route_competition", r4("carrier_market_share").alias("carrier_market_share"),
        S.fare_per_mile("MktFare", "MktDistance").alias("fare_per_mile"),
        S.is_connecting("MktCoupons").alias("is_connecting"),
        S.cut_labels("MktDistance", *S.DISTANCE_CATEGORIES).alias("distance_category"),
        S.season("Quarter").alias("season"))


# --- 2.5 aggregations -------------------------------------------------------------

@register("agg_batch", f"""select Origin, {_r4sql('avg(MktFare)')} as MktFare_mean, {_r4sql('sum(MktFare)')} as MktFare_sum,
count(MktFare) as MktFare_count, min(MktFare) as MktFare_min, max(MktFare) as MktFare_max,
{_r4sql('stddev_samp(MktFare)')} as MktFare_std, sum(Passengers) as Passengers_sum,
count(distinct Year * 4 + Quarter) as _quarter_count
from market where Year between 1994 and 1996 and Year * 4 + Quarter - 1 between 1994 * 4 and 1996 * 4 + 3
and MktDistance >= 100 and Origin is not null group by Origin""", views=("market",))
def agg_batch(spark, sf):
    """Group-by with {col: func or [funcs]} spec over many quarters; …."""
    out = A.batch_aggregate(market(spark, sf), ["Origin"],
                            {"MktFare": ["mean", "sum", "count", "min", "max", "std"],
                             "Passengers": "sum"},
                            start=(1994, 1), end=(1996, 4), filters=[("MktDistance", ">=", 100)])
    return out.select("Origin", r4("MktFare_mean").alias("MktFare_mean"),
                      r4("MktFare_sum").alias("MktFare_sum"), "MktFare_count", "MktFare_min",
                      "MktFare_max", r4("MktFare_std").alias("MktFare_std"), "Passengers_sum",
                      "_quarter_count")


def market_partials(spark, sf) -> DataFrame:
    """Partial aggregates per quarter and origin airport, stored once beside the quarters."""
    def build() -> DataFrame:
        m = market(spark, sf).filter((F.col("MktDistance") >= 100) & F.col("Origin").isNotNull())
        return PA.partial_aggregates(m, ["Origin"], ["MktFare", "Passengers"], ["RPCarrier", "Dest", "MktID"])
    path = land_parquet(spark, sf, "market_partials", build, partition_by=("Year", "Quarter"))
    return spark.read.parquet(path)


@register("agg_batch_stored", f"""select Origin, {_r4sql('avg(MktFare)')} as MktFare_mean, {_r4sql('sum(MktFare)')} as MktFare_sum,
count(MktFare) as MktFare_count, min(MktFare) as MktFare_min, max(MktFare) as MktFare_max,
{_r4sql('stddev_samp(MktFare)')} as MktFare_std, sum(Passengers) as Passengers_sum,
count(distinct Year * 4 + Quarter) as _quarter_count
from market where Year * 4 + Quarter - 1 between 1996 * 4 + 1 and 1999 * 4 + 2
and MktDistance >= 100 and Origin is not null group by Origin""", views=("market",))
def agg_batch_stored(spark, sf):
    """``agg_batch`` over a range of quarters from their stored partial aggregates."""
    parts = A.quarter_range(market_partials(spark, sf), (1996, 2), (1999, 3))
    out = PA.combine_partials(parts, ["Origin"], ["MktFare", "Passengers"])
    return out.select("Origin", r4("MktFare_mean").alias("MktFare_mean"), r4("MktFare_sum").alias("MktFare_sum"),
                      "MktFare_count", "MktFare_min", "MktFare_max", r4("MktFare_std").alias("MktFare_std"),
                      "Passengers_sum", F.col("_unit_count").alias("_quarter_count"))


@register("agg_batch_sketches")
def agg_batch_sketches(spark, sf):
    """Quartiles of the fare and distinct carriers, destinations and tickets per origin over all quarters, from the
    stored sketches (errors: ``partials.QUANTILE_ERROR``, ``DISTINCT_ERROR``)."""
    return PA.combine_partials(market_partials(spark, sf), ["Origin"], ["MktFare"], ["RPCarrier", "Dest", "MktID"],
                               (0.25, 0.5, 0.75))


_PCTS = ", ".join(str(p / 100) for p in D.PERCENTILES)


@register("agg_fare_summary", f"""with s as (select count(MktFare) as n, avg(MktFare) as mean, stddev_samp(MktFare) as std,
skewness(MktFare) as skewness, kurtosis(MktFare) as kurtosis, min(MktFare) as mn,
quantile_cont(MktFare, [{_PCTS}]) as q, max(MktFare) as mx from market_clean),
l as (select unnest([{', '.join(repr(x) for x in ['count', 'mean', 'std', 'skewness', 'kurtosis', 'min'] + [f'p{p}' for p in D.PERCENTILES] + ['max', 'iqr', 'cv'])}]) as statistic,
unnest([cast(n as double), mean, std, skewness, kurtosis, mn, {', '.join(f'q[{i + 1}]' for i in range(9))}, mx, q[6] - q[4], std / mean]) as value,
unnest(range(0, 18)) as ord from s)
select cast(ord as int) as ord, statistic, {_r4sql('value')} as value from l""", views=MC)
def agg_fare_summary(spark, sf):
    """Count, mean, std, skew, kurtosis, min, p1…p99 (9), max, IQR, CV."""
    s = D.fare_summary(market_clean(spark, sf), "MktFare")
    return s.select(F.col("ord").cast("int").alias("ord"), "statistic", r4("value").alias("value"))


_GEO_SQL = """case MktGeoType when 1 then 'Non-Contiguous (HI, AK, Territories)' when 2 then 'Contiguous (Lower 48)' else 'Other' end"""


@register("agg_geo_stats", f"""select {_GEO_SQL} as GeoLabel, count(MktFare) as count,
floor(avg(MktFare) * 100) / 100 as mean, floor(median(MktFare) * 100) / 100 as median,
floor(stddev_samp(MktFare) * 100) / 100 as std, floor(quantile_cont(MktFare, 0.25) * 100) / 100 as p25,
floor(quantile_cont(MktFare, 0.75) * 100) / 100 as p75 from market_clean group by 1""", views=MC)
def agg_geo_stats(spark, sf):
    """By geography: count, mean, median, std, p25, p75, round 2."""
    m = market_clean(spark, sf).withColumn("GeoLabel", S.value_map("MktGeoType", S.GEO_LABELS, "Other"))
    g = A.group_stats(m, "GeoLabel", "MktFare", ("count", "mean", "median", "std", "p25", "p75"))
    f2 = lambda c: (F.floor(F.col(c) * 100) / 100).alias(c)  # noqa: E731  (2 dp, both engines)
    return g.select("GeoLabel", "count", *[f2(c) for c in ("mean", "median", "std", "p25", "p75")])


@register("agg_quarter_trend", f"""select concat(cast(Year as varchar), ' Q', cast(Quarter as varchar)) as YearQuarter,
{_r4sql('avg(MktFare)')} as mean, {_r4sql('median(MktFare)')} as median, count(MktFare) as count
from market_clean group by 1""", views=MC)
def agg_quarter_trend(spark, sf):
    """Mean, median, count by quarter in order."""
    m = market_clean(spark, sf).withColumn("YearQuarter", S.quarter_label("Year", "Quarter"))
    g = A.group_stats(m, "YearQuarter", "MktFare", ("mean", "median", "count"))
    return g.select("YearQuarter", r4("mean").alias("mean"), r4("median").alias("median"),
                    "count").orderBy("YearQuarter")


@register("agg_distance_band", f"""select * from (select {_cut_sql('MktDistance', *S.DISTANCE_BANDS)} as DistanceBand,
count(FarePerMile) as count, {_r4sql('median(FarePerMile)')} as median_fpm, {_r4sql('avg(FarePerMile)')} as mean_fpm,
{_r4sql('median(MktFare)')} as median_fare, {_r4sql('avg(MktDistance)')} as mean_distance
from market_clean group by 1) where DistanceBand is not null""", views=MC)
def agg_distance_band(spark, sf):
    """Count, median/mean fare-per-mile, median fare, mean distance by band."""
    m = market_clean(spark, sf).withColumn("DistanceBand", S.cut_labels("MktDistance", *S.DISTANCE_BANDS))
    m = m.filter(F.col("DistanceBand").isNotNull())
    g = (m.groupBy("DistanceBand")
         .agg(F.count("FarePerMile").alias("count"), r4(F.avg("FarePerMile")).alias("mean_fpm"),
              r4(F.avg("MktDistance")).alias("mean_distance")))
    g = A.join_quantiles(g, m, ["DistanceBand"], "FarePerMile", [0.5], ["median_fpm"])
    g = A.join_quantiles(g, m, ["DistanceBand"], "MktFare", [0.5], ["median_fare"])
    return g.select("DistanceBand", "count", r4("median_fpm").alias("median_fpm"), "mean_fpm",
                    r4("median_fare").alias("median_fare"), "mean_distance")


@register("agg_bulk", f"""select BulkFare, count(MktFare) as count, {_r4sql('avg(MktFare)')} as mean,
{_r4sql('median(MktFare)')} as median from market_clean group by BulkFare""", views=MC)
def agg_bulk(spark, sf):
    """Count, mean, median by bulk flag."""
    g = A.group_stats(market_clean(spark, sf), "BulkFare", "MktFare", ("count", "mean", "median"))
    return g.select("BulkFare", "count", r4("mean").alias("mean"), r4("median").alias("median"))


@register("agg_direct_connecting", f"""select case when MktCoupons = 1 then 'Direct' else 'Connecting' end as IsDirect,
count(MktFare) as count, {_r4sql('avg(MktFare)')} as mean_fare, {_r4sql('median(MktFare)')} as median_fare,
{_r4sql('avg(FarePerMile)')} as mean_fpm, {_r4sql('median(MktDistance)')} as median_distance
from market_clean group by 1""", views=MC)
def agg_direct_connecting(spark, sf):
    """5 stats by direct flag."""
    m = market_clean(spark, sf).withColumn(
        "IsDirect", F.when(F.col("MktCoupons") == 1, F.lit("Direct")).otherwise(F.lit("Connecting")))
    g = m.groupBy("IsDirect").agg(
        F.count("MktFare").alias("count"), r4(F.avg("MktFare")).alias("mean_fare"),
        r4(F.avg("FarePerMile")).alias("mean_fpm"))
    g = A.join_quantiles(g, m, ["IsDirect"], "MktFare", [0.5], ["median_fare"])
    g = A.join_quantiles(g, m, ["IsDirect"], "MktDistance", [0.5], ["median_distance"])
    return g.select("IsDirect", "count", "mean_fare", r4("median_fare").alias("median_fare"), "mean_fpm",
                    r4("median_distance").alias("median_distance"))


ROUTE_COMP_SQL = """select Route, count(MktFare) as records, median(MktFare) as median_fare,
count(distinct RPCarrier) as carriers, avg(MktDistance) as mean_distance, avg(FarePerMile) as mean_fpm
from market_clean group by Route having count(MktFare) >= 100"""


@register("agg_route_competition", f"""select Route, records, {_r4sql('median_fare')} as median_fare, carriers,
{_r4sql('mean_distance')} as mean_distance, {_r4sql('mean_fpm')} as mean_fpm from ({ROUTE_COMP_SQL})""",
          views=MC)
def agg_route_competition(spark, sf):
    """Per route: records, median fare, distinct carriers, mean distance, mean fpm; having records ≥ 100."""
    g = A.route_competition(market_clean(spark, sf))
    return g.select("Route", "records", r4("median_fare").alias("median_fare"), "carriers",
                    r4("mean_distance").alias("mean_distance"), r4("mean_fpm").alias("mean_fpm"))


CARRIER_TIERS_SQL = """select RPCarrier, count(MktFare) as records, median(FarePerMile) as median_fpm,
avg(MktDistance) as mean_distance from market_clean group by RPCarrier having count(MktFare) >= 1000"""


@register("agg_carrier_tiers", f"""select RPCarrier, records, {_r4sql('median_fpm')} as median_fpm,
{_r4sql('mean_distance')} as mean_distance from ({CARRIER_TIERS_SQL})""", views=MC)
def agg_carrier_tiers(spark, sf):
    """Per carrier: records ≥ 1000, median fpm, mean distance, sorted; spread max/min."""
    g = A.carrier_tiers(market_clean(spark, sf), min_records=1000)
    return g.select("RPCarrier", "records", r4("median_fpm").alias("median_fpm"),
                    r4("mean_distance").alias("mean_distance")).orderBy("median_fpm", "RPCarrier")


@register("agg_carrier_spread", f"""select {_r4sql('min(median_fpm)')} as min_fpm, {_r4sql('max(median_fpm)')} as max_fpm,
{_r4sql('max(median_fpm) / min(median_fpm)')} as spread_ratio from ({CARRIER_TIERS_SQL})""", views=MC)
def agg_carrier_spread(spark, sf):
    """Cheapest and dearest carrier tier and their ratio."""
    t = A.tier_spread(A.carrier_tiers(market_clean(spark, sf), min_records=1000))
    return t.select(*[r4(c).alias(c) for c in t.columns])


@register("agg_distance_curve", f"""select * from (select cast(ceil(MktDistance / 100.0) as int) as dist_bin,
0.0e0 + (cast(ceil(MktDistance / 100.0) as int) - 0.5e0) * 100.0e0 as bin_mid, {_r4sql('median(MktFare)')} as median_fare,
{_r4sql('median(FarePerMile)')} as median_fpm, count(MktFare) as count
from market_clean where MktDistance > 0 and MktDistance <= 5900 group by 1, 2) where count >= 50""", views=MC)
def agg_distance_curve(spark, sf):
    """Per 100-mile bin median fare/fpm/count ≥ 50."""
    m = market_clean(spark, sf).withColumn("dist_bin", S.cut_regular_bin("MktDistance", 100.0, 0.0, 5900.0))
    m = m.filter(F.col("dist_bin").isNotNull())
    g = m.groupBy("dist_bin").agg(F.count("MktFare").alias("count")).filter(F.col("count") >= 50)
    kept = m.join(g.select("dist_bin"), "dist_bin", "left_semi")
    g = A.join_quantiles(g, kept, ["dist_bin"], "FarePerMile", [0.5], ["median_fpm"])
    g = A.join_quantiles(g, kept, ["dist_bin"], "MktFare", [0.5], ["median_fare"])
    return g.select("dist_bin", S.bin_midpoint("dist_bin").alias("bin_mid"), r4("median_fare").alias("median_fare"),
                    r4("median_fpm").alias("median_fpm"), "count")


@register("agg_premium_pivot", f"""with p as (select {_cut_sql('MktDistance', *S.PREMIUM_BANDS)} as DistanceBand,
median(FarePerMile) filter (where IsDirect) as d, median(FarePerMile) filter (where not IsDirect) as c
from market_clean group by 1)
select DistanceBand, {_r4sql('d')} as Direct, {_r4sql('c')} as Connecting, {_r4sql('d / c')} as Premium
from p where DistanceBand is not null""", views=MC)
def agg_premium_pivot(spark, sf):
    """Median fpm by band × direct, pivoted, ratio direct/connecting."""
    m = market_clean(spark, sf).withColumn("DistanceBand", S.cut_labels("MktDistance", *S.PREMIUM_BANDS))
    p = A.premium_pivot(m, "DistanceBand", "IsDirect", "FarePerMile")
    return p.select("DistanceBand", *[r4(c).alias(c) for c in ("Direct", "Connecting", "Premium")])


@register("agg_top_counts", """select * from (select 'TkCarrier' as dim, TkCarrier as value, count(*) as count,
row_number() over (order by count(*) desc, TkCarrier) as rnk from market_feat_base group by TkCarrier)
where rnk <= 10 union all
select * from (select 'route' as dim, concat_ws(' -> ', Origin, Dest) as value, count(*) as count,
row_number() over (order by count(*) desc, concat_ws(' -> ', Origin, Dest)) as rnk from market_feat_base group by 2)
where rnk <= 10 union all
select 'purchase_window', value, count(*), row_number() over (order by count(*) desc, value) from (
select case when days < 7 then '0-6 days' when days < 14 then '7-13 days' when days < 21 then '14-20 days' else '21+ days' end as value
from (select departure_date - cast(collected_at as date) as days from calendar) where days >= 0) group by 2""", views=MF + ("calendar",))
def agg_top_counts(spark, sf):
    """Value_counts top 10 of carriers and routes, and the counts of all advance-purchase windows (of the calendar's
    observations, as the market view has no purchase date)."""
    b = _feat_base(spark, sf).withColumn("route_arrow", S.route_key("Origin", "Dest", " -> "))
    days = F.col("days_ahead")
    window = F.when(days < 7, "0-6 days").when(days < 14, "7-13 days").when(days < 21, "14-20 days").otherwise("21+ days")
    ahead = TS.with_lead_time(fx.stored(spark, sf, "calendar")).select(window.alias("window"))
    out = None
    for rows, dim, col in ((b, "TkCarrier", "TkCarrier"), (b, "route", "route_arrow"), (ahead, "purchase_window", "window")):
        t = A.top_counts(rows, col, 10)
        t = t.select(F.lit(dim).alias("dim"), F.col(col).alias("value"), "count",
                     F.row_number().over(Window.orderBy(F.col("count").desc(), F.col(col))).cast("bigint").alias("rnk"))
        out = t if out is None else out.unionByName(t)
    return out


@register("agg_mean_by_group", f"""select MktDistanceGroup, {_r4sql('avg(MktFare)')} as mean_fare
from market_feat_base group by MktDistanceGroup""", views=MF)
def agg_mean_by_group(spark, sf):
    """Mean fare by distance group."""
    g = A.group_stats(_feat_base(spark, sf), "MktDistanceGroup", "MktFare", ("mean",))
    return g.select("MktDistanceGroup", r4("mean").alias("mean_fare"))


@register("agg_market_share", f"""select route, TkCarrier,
{_r4sql('sum(Passengers) / sum(sum(Passengers)) over (partition by route)')} as carrier_market_share
from market_feat_base group by route, TkCarrier""", views=MF)
def agg_market_share(spark, sf):
    """Carrier passengers / route passengers."""
    s = A.market_share(_feat_base(spark, sf), "route", "TkCarrier", "Passengers")
    return s.select("route", "TkCarrier", r4("carrier_market_share").alias("carrier_market_share"))


def _hist_sql(x: str, bins: int, lo: str, hi: str, base: str, by: str = "") -> str:
    byc = f"{by}, " if by else ""
    b = f"cast(least(floor(({x} - {lo}) * {bins} / ({hi} - {lo})), {bins - 1}) as int)"
    return (f"select {byc}{b} as bin, {lo} + {b} * (({hi} - {lo}) / {bins}) as bin_lo, "
            f"{lo} + ({b} + 1) * (({hi} - {lo}) / {bins}) as bin_hi, count(*) as count from {base} "
            f"where {x} between {lo} and {hi} group by {byc}{b}")


@register("agg_histogram", _hist_sql("MktFare", 200, "0.0", "2000.0", "market_clean"), views=MC)
def agg_histogram(spark, sf):
    """Equal-width histograms: 40/50/150/200 bins, fixed range, per group."""
    return D.histogram(market_clean(spark, sf), "MktFare", 200, 0.0, 2000.0)


@register("agg_histogram_log", "with r as (select min(log10(greatest(MktFare, 1))) as lo, max(log10(greatest(MktFare, 1))) as hi from market_clean), "
          "x as (select log10(greatest(MktFare, 1)) as lf, lo, hi from market_clean, r) "
          + _hist_sql("lf", 150, "lo", "hi", "x").replace("group by", "group by lo, hi,"), views=MC)
def agg_histogram_log(spark, sf):
    """150-bin histogram of log10 fares over the data range."""
    m = market_clean(spark, sf).withColumn("lf", S.log10_floor1("MktFare"))
    return D.histogram(m, "lf", 150)


@register("agg_histogram_by_geo", _hist_sql("MktFare", 200, "0.0", "3000.0",
                                            f"(select *, {_GEO_SQL} as GeoLabel from market_clean)",
                                            by="GeoLabel"), views=MC)
def agg_histogram_by_geo(spark, sf):
    """200-bin fare histogram per geography label."""
    m = market_clean(spark, sf).withColumn("GeoLabel", S.value_map("MktGeoType", S.GEO_LABELS, "Other"))
    return D.histogram(m, "MktFare", 200, 0.0, 3000.0, by=["GeoLabel"])


@register("agg_ecdf", """with v as (select MktFare as value, row_number() over (order by MktFare) - 1 as i,
count(*) over () as n from market_clean)
select value as MktFare, (i + 1) / n as ecdf from v where i % greatest(1, n // 10000) = 0""", views=MC)
def agg_ecdf(spark, sf):
    """Value, cumulative share, thinned to ~10,000 points."""
    return D.ecdf(market_clean(spark, sf), "MktFare", 10000)


@register("agg_box_stats", f"""with x as (select least(MktFare, 3000.0) as v from market_clean),
q as (select quantile_cont(v, 0.25) as q1, median(v) as q2, quantile_cont(v, 0.75) as q3 from x)
select {_r4sql('q1')} as q1, {_r4sql('q2')} as median, {_r4sql('q3')} as q3, {_r4sql('q3 - q1')} as iqr,
min(v) filter (where v between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) as whisker_lo,
max(v) filter (where v between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) as whisker_hi,
count(*) filter (where not (v between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1))) as n_outliers
from x, q group by q1, q2, q3""", views=MC)
def agg_box_stats(spark, sf):
    """Quartiles, 1.5·IQR whiskers, outlier count on capped values."""
    b = D.box_stats(market_clean(spark, sf), "MktFare", upper=3000.0)
    return b.select(*[r4(c).alias(c) for c in ("q1", "median", "q3", "iqr")],
                    "whisker_lo", "whisker_hi", "n_outliers")


@register("agg_violin_density", f"""with x as (select concat(cast(Year as varchar), ' Q', cast(Quarter as varchar)) as YearQuarter,
least(MktFare, 1500.0) as v from market_clean),
h as ({_hist_sql('v', 50, '0.0', '1500.0', 'x', by='YearQuarter')}),
m as (select YearQuarter, median(v) as median from x group by 1)
select h.YearQuarter, bin, bin_lo, bin_hi, count, {_r4sql('count / sum(count) over (partition by h.YearQuarter)')} as share,
{_r4sql('median')} as median from h join m on h.YearQuarter = m.YearQuarter""", views=MC)
def agg_violin_density(spark, sf):
    """Capped distribution per quarter with medians."""
    m = market_clean(spark, sf).withColumn("YearQuarter", S.quarter_label("Year", "Quarter"))
    d = D.grouped_density(m, "MktFare", "YearQuarter", 50, 0.0, 1500.0, upper=1500.0)
    return d.select("YearQuarter", "bin", "bin_lo", "bin_hi", "count", r4("share").alias("share"),
                    r4("median").alias("median"))


@register("agg_violin_kernel", f"""with x as (select concat(cast(Year as varchar), ' Q', cast(Quarter as varchar)) as YearQuarter,
least(MktFare, 1500.0) as v from market_clean),
c as (select YearQuarter, greatest(least(floor(v / 15.0), 99), 0) as b, count(*) as c from x group by all),
s as (select YearQuarter, coalesce(nullif(stddev_samp(v) * pow(count(*), -0.2), 0.0), 15.0) as h from x group by 1),
d as (select c.YearQuarter, t.bin, sum(c.c * exp(-pow((t.bin - c.b) * 15.0 / h, 2) / 2)) as d
from c join s using (YearQuarter), (select unnest(range(100)) as bin) t group by all)
select YearQuarter, cast(bin as int) as bin, (bin + 0.5e0) * 15.0e0 as x, {_r4sql('d / sum(d) over (partition by YearQuarter)')} as share
from d""", views=MC)
def agg_violin_kernel(spark, sf):
    """The violins' outlines: Gaussian kernel density per quarter over 100 bins of the capped fare."""
    m = market_clean(spark, sf).withColumn("YearQuarter", S.quarter_label("Year", "Quarter"))
    d = D.kernel_density(m, "MktFare", "YearQuarter", 100, 0.0, 1500.0, upper=1500.0)
    return d.select("YearQuarter", "bin", "x", r4("share").alias("share"))


@register("agg_table_profile", f"""select count(*) as rows, {len(MARKET_COLS)} as columns,
{_r4sql('avg(MktFare)')} as fare_mean, {_r4sql('median(MktFare)')} as fare_median, min(MktFare) as fare_min,
max(MktFare) as fare_max, sum(Passengers) as total_passengers,
{', '.join(f'count(*) filter (where {c} is null) as nulls_{c}' for c in MARKET_COLS)},
count(*) > 0 as valid from market""", views=("market",))
def agg_table_profile(spark, sf):
    """Rows, columns, mean/median/min/max fare, total passengers, null counts of every column; valid = readable,
    non-empty, has fare."""
    m = market(spark, sf)
    return A.table_profile(m).select(
        "rows", "columns", r4("fare_mean").alias("fare_mean"), r4("fare_median").alias("fare_median"), "fare_min",
        "fare_max", "total_passengers", *[f"nulls_{c}" for c in m.columns], "valid")


@register("agg_describe", " union all ".join(
    f"""select '{c}' as "column", count({c}) as count, {_r4sql(f'avg({c})')} as mean,
{_r4sql(f'stddev_samp({c})')} as std, cast(min({c}) as double) as min,
{_r4sql(f'quantile_cont({c}, 0.25)')} as p25, {_r4sql(f'quantile_cont({c}, 0.5)')} as p50,
{_r4sql(f'quantile_cont({c}, 0.75)')} as p75, cast(max({c}) as double) as max from market_clean"""
    for c in MARKET_NUMBERS), views=MC)
def agg_describe(spark, sf):
    """Count/mean/std/min/quartiles/max of all numeric columns of the schema."""
    d = D.describe(market_clean(spark, sf))
    return d.select("column", "count", *[r4(c).alias(c) for c in ("mean", "std")], "min",
                    *[r4(c).alias(c) for c in ("p25", "p50", "p75")], "max")


@register("agg_distincts", """select count(distinct RPCarrier) as n_RPCarrier, count(distinct Origin) as n_Origin,
count(distinct Dest) as n_Dest from market_clean""", views=MC)
def agg_distincts(spark, sf):
    """Number of carriers, airports."""
    return A.distincts(market_clean(spark, sf), ["RPCarrier", "Origin", "Dest"])


@register("agg_carrier_consistency", """select count(*) filter (where RPCarrier is not distinct from TkCarrier
and RPCarrier is not distinct from OpCarrier) as all_match,
count(*) filter (where RPCarrier is distinct from TkCarrier) as tk_differs,
count(*) filter (where RPCarrier is distinct from OpCarrier) as op_differs, count(*) as rows from market_clean""",
          views=MC)
def agg_carrier_consistency(spark, sf):
    """All carrier codes match / ticketing differs / operating differs."""
    return A.carrier_consistency(market_clean(spark, sf))


@register("agg_fare_quality", f"""select count(*) filter (where MktFare < 10.0) as n_low,
count(*) filter (where MktFare >= 10.0 and MktFare <= 5000.0) as n_valid,
count(*) filter (where MktFare > 5000.0) as n_extreme, count(*) as rows,
{_r4sql('count(*) filter (where MktFare < 10.0) * 100.0 / count(*)')} as pct_low,
{_r4sql('count(*) filter (where MktFare >= 10.0 and MktFare <= 5000.0) * 100.0 / count(*)')} as pct_valid,
{_r4sql('count(*) filter (where MktFare > 5000.0) * 100.0 / count(*)')} as pct_extreme from market_clean""",
          views=MC)
def agg_fare_quality(spark, sf):
    """<10, 10–5000, >5000 counts and pct (literals at experiment_notebooks/BTS DB1B.ipynb.py:714)."""
    q = A.fare_quality(market_clean(spark, sf))
    return q.select("n_low", "n_valid", "n_extreme", "rows",
                    *[r4(c).alias(c) for c in ("pct_low", "pct_valid", "pct_extreme")])


# --- 2.7 top-k and sampling ---------------------------------------------------------

@register("topk_extreme", """select Origin, Dest, MktFare, MktDistance, RPCarrier, MktCoupons, MktID
from market_clean order by MktFare desc, MktID limit 20""", views=MC)
def topk_extreme(spark, sf):
    """20 highest fares with columns."""
    return (market_clean(spark, sf).select("Origin", "Dest", "MktFare", "MktDistance", "RPCarrier",
                                           "MktCoupons", "MktID")
            .orderBy(F.col("MktFare").desc(), "MktID").limit(20))


@register("sample_by_quarter", """select MktID, Year, Quarter from (select MktID, Year, Quarter,
row_number() over (partition by Year, Quarter order by md5(concat_ws('|', MktID, '42')), MktID) as r,
round_even(0.1 * count(*) over (partition by Year, Quarter), 0) as k from market_clean) where r <= k""", views=MC)
def sample_by_quarter(spark, sf):
    """Exact fraction per quarter, seeded, saved; create_sample(start,end,fraction,random_state); …."""
    s = exact_sample(market_clean(spark, sf), ["Year", "Quarter"], "MktID", 0.1, seed=42)
    return s.select("MktID", "Year", "Quarter")


def stored_sample(spark, sf) -> str:
    """The 20 % sample per quarter, stored once."""
    return land_once(spark, sf, "market_sample_20", lambda p: store_sample(
        market_clean(spark, sf), p, ["Year", "Quarter"], "MktID", 0.2, seed=42))


@register("sample_load", f"""select MktID, MktFare, Year, Quarter, {_r4sql('r / n')} as depth from (select MktID, MktFare, Year, Quarter,
row_number() over (partition by Year, Quarter order by md5(concat_ws('|', MktID, '42')), MktID) as r,
count(*) over (partition by Year, Quarter) as n from market_clean) where r <= round_even(0.05 * n, 0)""", views=MC)
def sample_load(spark, sf):
    """Five of the stored sample's twenty per cent, two of its columns, in its stored hash order."""
    s = load_sample(spark, stored_sample(spark, sf), ["MktID", "MktFare", "Year", "Quarter", RANK, POPULATION], 0.05)
    return s.select("MktID", "MktFare", "Year", "Quarter", r4(F.col(RANK) / F.col(POPULATION)).alias("depth"))


# --- 2.8 closed-form regressions over the route table ------------------------------

@register("ml_ols_competition", f"""with r as ({ROUTE_COMP_SQL}),
m as (select covar_pop(median_fare, carriers) as syc, covar_pop(median_fare, mean_distance) as syd,
var_pop(carriers) as scc, var_pop(mean_distance) as sdd, covar_pop(carriers, mean_distance) as scd,
avg(median_fare) as my, avg(carriers) as mc, avg(mean_distance) as md, var_pop(median_fare) as syy, count(*) as n from r),
b as (select *, (syc * sdd - syd * scd) / (scc * sdd - scd * scd) as b1,
(syd * scc - syc * scd) / (scc * sdd - scd * scd) as b2 from m)
select {_r4sql('b1')} as coef_carriers, {_r4sql('b2')} as coef_distance, {_r4sql('my - b1 * mc - b2 * md')} as intercept,
{_r4sql('(b1 * syc + b2 * syd) / syy')} as r2, n from b""", views=MC)
def ml_ols_competition(spark, sf):
    """Median fare ~ carriers + distance; coefficients, R²."""
    r = A.route_competition(market_clean(spark, sf))
    o = RG.ols2(r, "median_fare", "carriers", "mean_distance", ("coef_carriers", "coef_distance"))
    return o.select(*[r4_ieee(c).alias(c) for c in ("coef_carriers", "coef_distance", "intercept", "r2")], "n")


@register("ml_ols_single", f"""with r as ({ROUTE_COMP_SQL})
select {_r4sql('regr_slope(mean_fpm, carriers)')} as coef_carriers,
{_r4sql('regr_intercept(mean_fpm, carriers)')} as intercept, {_r4sql('regr_r2(mean_fpm, carriers)')} as r2,
count(*) as n from r""", views=MC)
def ml_ols_single(spark, sf):
    """Mean fpm ~ carriers."""
    r = A.route_competition(market_clean(spark, sf))
    o = RG.ols1(r, "mean_fpm", "carriers")
    return o.select(*[r4(c).alias(c) for c in ("coef_carriers", "intercept", "r2")], "n")


@register("ml_ols_log", f"""with r as (select ln(median_fare) as y, carriers, mean_distance from ({ROUTE_COMP_SQL})),
m as (select covar_pop(y, carriers) as syc, covar_pop(y, mean_distance) as syd,
var_pop(carriers) as scc, var_pop(mean_distance) as sdd, covar_pop(carriers, mean_distance) as scd,
avg(y) as my, avg(carriers) as mc, avg(mean_distance) as md, var_pop(y) as syy, count(*) as n from r),
b as (select *, (syc * sdd - syd * scd) / (scc * sdd - scd * scd) as b1,
(syd * scc - syc * scd) / (scc * sdd - scd * scd) as b2 from m)
select {_r4sql('b1')} as coef_carriers, {_r4sql('b2')} as coef_distance, {_r4sql('my - b1 * mc - b2 * md')} as intercept,
{_r4sql('(b1 * syc + b2 * syd) / syy')} as r2, {_r4sql('(exp(b1) - 1) * 100')} as pct_effect, n from b""", views=MC)
def ml_ols_log(spark, sf):
    """Ln(median fare) ~ carriers + distance; pct effect = (e^b − 1)·100."""
    r = A.route_competition(market_clean(spark, sf)).withColumn("y", F.ln("median_fare"))
    o = RG.ols2(r, "y", "carriers", "mean_distance", ("coef_carriers", "coef_distance"))
    o = o.withColumn("pct_effect", (F.exp("coef_carriers") - 1) * 100)
    return o.select(*[r4_ieee(c).alias(c) for c in ("coef_carriers", "coef_distance", "intercept", "r2",
                                                     "pct_effect")], "n")
