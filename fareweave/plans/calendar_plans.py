"""Price-calendar time series, serving and collection reports on ``calendar``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..functions.numeric import r4
from ..operators import aggregate as A
from ..operators import metrics as M
from ..operators import models as MD
from ..operators import timeseries as TS
from ..sources import dims
from ..sources import fixtures as fx
from .registry import register


def _r4sql(e: str) -> str:
    return f"floor(({e}) * 10000 + 0.5) / 10000"


def _r2sql(e: str) -> str:
    return f"floor(({e}) * 100 + 0.5) / 100"


def calendar(spark: SparkSession, sf: str) -> DataFrame:
    return fx.stored(spark, sf, "calendar")


def cal_loaded(spark: SparkSession, sf: str) -> DataFrame:
    """``load_all_calendars``: lead time added, past departures dropped."""
    return TS.with_lead_time(calendar(spark, sf))


fx.DUCKDB_VIEWS["cal"] = """select origin, destination, departure_date, collected_at, price,
cast(collected_at as date) as collected_date,
cast(departure_date - cast(collected_at as date) as int) as days_ahead,
concat_ws('-', origin, destination) as route
from calendar where departure_date - cast(collected_at as date) >= 0"""
CV = ("calendar", "cal")

fx.DUCKDB_VIEWS["cal_feat"] = """select origin, destination, departure_date, collected_at, price, collected_date,
cast(least(greatest(days_ahead, 0), 365) as int) as days_ahead,
cast(floor(least(greatest(days_ahead, 0), 365) / 7) as int) as weeks_ahead,
cast(isodow(departure_date) - 1 as int) as dep_dow, cast(month(departure_date) as int) as dep_month,
cast(isodow(departure_date) - 1 >= 5 as int) as dep_is_weekend, cast(isodow(collected_date) - 1 as int) as col_dow,
route from cal"""

fx.DUCKDB_VIEWS["cal_lags"] = """select *,
lag(price, 1) over w as raw_lag1, lag(price, 7) over w as raw_lag7,
avg(price) over (w rows between 3 preceding and 1 preceding) as raw_roll3,
avg(price) over (partition by route) as route_mean,
lead(price, 7) over w as price_future7
from cal_feat window w as (partition by route, departure_date order by collected_date)"""

fx.DUCKDB_VIEWS["cal_train"] = """select origin, destination, departure_date, collected_at, price, collected_date,
days_ahead, weeks_ahead, dep_dow, dep_month, dep_is_weekend, col_dow, route,
coalesce(raw_lag1, route_mean) as price_lag1, coalesce(raw_lag7, route_mean) as price_lag7,
coalesce(raw_roll3, route_mean) as price_roll3, coalesce(price - raw_lag1, 0.0) as price_change,
price_future7, cast(price_future7 < price * (1 - 0.02) as int) as should_wait,
coalesce(raw_lag1, route_mean) - coalesce(raw_lag7, route_mean) as trend
from cal_lags where price_future7 is not null"""
CT = ("calendar", "cal", "cal_feat", "cal_lags", "cal_train")


# --- 2.1 sources -------------------------------------------------------------------

@register("src_calendar", """select origin, destination, departure_date, collected_at, price, collected_date, days_ahead
from cal""", views=CV)
def src_calendar(spark, sf):
    """Union all daily calendar files, parse ISO times to UTC, add collected_date, days_ahead, drop negatives, …."""
    return cal_loaded(spark, sf).select("origin", "destination", "departure_date", "collected_at",
                                        "price", "collected_date", "days_ahead")


# --- 2.2 scalars ----------------------------------------------------------------------

@register("fn_days_ahead", """select origin, destination, departure_date, collected_at,
cast(departure_date - cast(collected_at as date) as int) as days_ahead from calendar""", views=("calendar",))
def fn_days_ahead(spark, sf):
    """Whole days departure − collected."""
    c = calendar(spark, sf)
    return c.select("origin", "destination", "departure_date", "collected_at",
                    S.days_ahead("departure_date", "collected_at").alias("days_ahead"))


@register("fn_lead_clip", """select origin, destination, departure_date, collected_at,
cast(least(greatest(departure_date - cast(collected_at as date), 0), 365) as int) as days_ahead,
cast(floor(least(greatest(departure_date - cast(collected_at as date), 0), 365) / 7) as int) as weeks_ahead
from calendar""", views=("calendar",))
def fn_lead_clip(spark, sf):
    """Clip lead time to [0,365]; weeks = floor(/7)."""
    c = calendar(spark, sf)
    d = S.lead_clip(S.days_ahead("departure_date", "collected_at"))
    return c.select("origin", "destination", "departure_date", "collected_at", d.alias("days_ahead"),
                    S.weeks_ahead(d).alias("weeks_ahead"))


@register("fn_calendar_parts", """select origin, destination, departure_date, collected_at, dep_dow, dep_month,
dep_is_weekend, col_dow, route from cal_feat""", views=CV + ("cal_feat",))
def fn_calendar_parts(spark, sf):
    """Departure weekday (Mon=0), month, weekend flag, collection weekday."""
    f = TS.build_features(cal_loaded(spark, sf))
    return f.select("origin", "destination", "departure_date", "collected_at", "dep_dow", "dep_month",
                    "dep_is_weekend", "col_dow", "route")


@register("fn_month", """select cast(date_trunc('month', departure_date) as date) as month,
count(*) as n from calendar group by 1""", views=("calendar",))
def fn_month(spark, sf):
    """Month period."""
    return calendar(spark, sf).groupBy(S.month_start("departure_date").alias("month")).agg(
        F.count(F.lit(1)).alias("n"))


@register("fn_date_prefix", """select distinct substring(cast(collected_at as varchar), 1, 10) as collected_day
from calendar""", views=("calendar",))
def fn_date_prefix(spark, sf):
    """First 10 chars as date key."""
    return calendar(spark, sf).select(S.date_prefix("collected_at").alias("collected_day")).distinct()


@register("fn_trend_text", f"""select route, departure_date, collected_date,
case when abs(d) < 1 then 'stable' when d > 0 then printf('up £%.0f', round_even(abs(d), 0)) else printf('down £%.0f', round_even(abs(d), 0)) end as trend_text
from (select route, departure_date, collected_date, {_r2sql('price_roll3 - price_lag1')} as d from cal_train)""",
          views=CT)
def fn_trend_text(spark, sf):
    """Stable if abs diff < 1, else up/down amount."""
    t = TS.training_frame(calendar(spark, sf))
    d = MD.half_up(F.col("price_roll3") - F.col("price_lag1"), 2)
    return t.select("route", "departure_date", "collected_date", S.trend_text(d).alias("trend_text"))


# --- 2.3 filters -------------------------------------------------------------------

@register("flt_nonneg_lead", """select count(*) as kept, (select count(*) from calendar) - count(*) as dropped
from cal""", views=CV)
def flt_nonneg_lead(spark, sf):
    """Keep days_ahead ≥ 0."""
    c = TS.with_lead_time(calendar(spark, sf), keep_negative=True)
    keep = F.col("days_ahead") >= 0
    return c.agg(F.count_if(keep).alias("kept"), F.count_if(~keep).alias("dropped"))


@register("flt_date_window", """select route, departure_date, collected_date, price from cal
where departure_date between date '2024-01-25' and date '2024-02-05'""", views=CV)
def flt_date_window(spark, sf):
    """Departure date between start/end inclusive."""
    c = cal_loaded(spark, sf).withColumn("route", S.route_key("origin", "destination"))
    return c.filter(F.col("departure_date").between(F.lit("2024-01-25").cast("date"),
                                                    F.lit("2024-02-05").cast("date"))).select(
        "route", "departure_date", "collected_date", "price")


# --- 2.6 windows -------------------------------------------------------------------

def _train(spark, sf):
    return TS.training_frame(calendar(spark, sf))


def _lagged(spark, sf):
    return TS.add_lag_features(TS.build_features(cal_loaded(spark, sf)))


@register("win_lags", """select route, departure_date, collected_date, price, raw_lag1 as price_lag1,
raw_lag7 as price_lag7 from cal_lags""", views=CT[:-1])
def win_lags(spark, sf):
    """Price 1 and 7 *observations* ago per (route, departure_date) ordered by collected_date."""
    f = TS.build_features(cal_loaded(spark, sf))
    w = TS.series_window()
    return f.select("route", "departure_date", "collected_date", "price",
                    F.lag("price", 1).over(w).alias("price_lag1"), F.lag("price", 7).over(w).alias("price_lag7"))


@register("win_roll3", f"""select route, departure_date, collected_date, {_r4sql('raw_roll3')} as price_roll3
from cal_lags""", views=CT[:-1])
def win_roll3(spark, sf):
    """Mean of the 3 previous observations, at least 1."""
    f = TS.build_features(cal_loaded(spark, sf))
    w = TS.series_window().rowsBetween(-3, -1)
    return f.select("route", "departure_date", "collected_date", r4(F.avg("price").over(w)).alias("price_roll3"))


@register("win_price_change", """select route, departure_date, collected_date, coalesce(price - raw_lag1, 0.0) as price_change
from cal_lags""", views=CT[:-1])
def win_price_change(spark, sf):
    """Price − lag1, null → 0."""
    return _lagged(spark, sf).select("route", "departure_date", "collected_date", "price_change")


@register("win_lag_fill", f"""select route, departure_date, collected_date, {_r4sql('coalesce(raw_lag1, route_mean)')} as price_lag1,
{_r4sql('coalesce(raw_lag7, route_mean)')} as price_lag7, {_r4sql('coalesce(raw_roll3, route_mean)')} as price_roll3
from cal_lags""", views=CT[:-1])
def win_lag_fill(spark, sf):
    """Null lags filled with the route mean."""
    return _lagged(spark, sf).select("route", "departure_date", "collected_date",
                                     *[r4(c).alias(c) for c in ("price_lag1", "price_lag7", "price_roll3")])


@register("win_wait_target", """select route, departure_date, collected_date, price, price_future7, should_wait
from cal_train""", views=CT)
def win_wait_target(spark, sf):
    """Price 7 observations ahead < price·(1−0.02) → 1; rows without a future dropped; add_wait_target(df, …."""
    t = TS.add_wait_target(TS.build_features(cal_loaded(spark, sf)))
    return t.select("route", "departure_date", "collected_date", "price", "price_future7", "should_wait")


@register("win_trend", f"""select route, departure_date, collected_date, {_r4sql('trend')} as trend from cal_train""",
          views=CT)
def win_trend(spark, sf):
    """Lag1 − lag7."""
    return _train(spark, sf).select("route", "departure_date", "collected_date", r4("trend").alias("trend"))


_TRAIN_COLS = ["origin", "destination", "departure_date", "collected_at", "price", "collected_date",
               "days_ahead", "weeks_ahead", "dep_dow", "dep_month", "dep_is_weekend", "col_dow", "route",
               "price_lag1", "price_lag7", "price_roll3", "price_change", "price_future7", "should_wait",
               "trend"]
_R4_COLS = {"price_lag1", "price_lag7", "price_roll3", "trend"}


@register("ml_features", "select " + ", ".join(
    _r4sql(c) + f" as {c}" if c in _R4_COLS else c for c in _TRAIN_COLS) + " from cal_train", views=CT)
def ml_features(spark, sf):
    """Load → features → lags → target → trend."""
    t = _train(spark, sf)
    return t.select(*[r4(c).alias(c) if c in _R4_COLS else F.col(c) for c in _TRAIN_COLS])


@register("win_temporal_split", """with s as (select make_timestamp(cast(quantile_cont(epoch_us(cast(collected_date as timestamp)), 0.8) as bigint)) as split_at from cal_train)
select route, departure_date, collected_date, price from cal_train, s where cast(collected_date as timestamp) > split_at""",
          views=CT)
def win_temporal_split(spark, sf):
    """Test = collected_date > interpolated 80 % quantile of dates."""
    _, test = TS.temporal_split(_train(spark, sf))
    return test.select("route", "departure_date", "collected_date", "price")


# --- 2.5 aggregations over the calendar ---------------------------------------------

@register("agg_route_averages", f"select route, {_r4sql('avg(price)')} as route_avg from cal group by route",
          views=CV)
def agg_route_averages(spark, sf):
    """Mean price per route (artefact route_averages; code that made it is absent)."""
    c = cal_loaded(spark, sf).withColumn("route", S.route_key("origin", "destination"))
    return TS.route_averages(c).select("route", r4("route_avg").alias("route_avg"))


@register("agg_booking_curve", f"""select route, days_ahead, {_r4sql('median(price)')} as median_price
from cal group by route, days_ahead""", views=CV)
def agg_booking_curve(spark, sf):
    """Median price by lead time for a route."""
    c = cal_loaded(spark, sf).withColumn("route", S.route_key("origin", "destination"))
    g = A.group_stats(c, ["route", "days_ahead"], "price", ("median",))
    return g.select("route", "days_ahead", r4("median").alias("median_price"))


@register("agg_lowest_by_day", """select route, cast(collected_at as date) as date, min(price) as min_price
from cal group by route, cast(collected_at as date)""", views=CV)
def agg_lowest_by_day(spark, sf):
    """Min price per collection day for a route."""
    c = cal_loaded(spark, sf).withColumn("route", S.route_key("origin", "destination"))
    return c.groupBy("route", F.to_date("collected_at").alias("date")).agg(F.min("price").alias("min_price"))


@register("agg_kpis", """select (select count(*) from cal) as calendar_records,
(select count(*) from itineraries) as itinerary_records,
(select count(distinct origin) * 2 from cal) as routes_tracked,
(select count(distinct route) from cal) as distinct_routes,
(select count(distinct cast(collected_at as date)) from cal) as collection_days,
(select min(collected_at) from cal) as first_collected, (select max(collected_at) from cal) as last_collected""",
          views=CV + ("itineraries",))
def agg_kpis(spark, sf):
    """Row counts, origins×2 as 'routes tracked', collection days, first/last time."""
    c = cal_loaded(spark, sf)
    k = c.agg(F.count(F.lit(1)).alias("calendar_records"),
              (F.count_distinct("origin") * 2).alias("routes_tracked"),
              F.count_distinct("origin", "destination").alias("distinct_routes"),
              F.count_distinct(F.to_date("collected_at")).alias("collection_days"),
              F.min("collected_at").alias("first_collected"), F.max("collected_at").alias("last_collected"))
    n_itin = fx.stored(spark, sf, "itineraries").agg(F.count(F.lit(1)).alias("itinerary_records"))
    # two one-row aggregates side by side, without a join
    return (A.combine_rows(k, n_itin)
            .select("calendar_records", "itinerary_records", "routes_tracked", "distinct_routes",
                    "collection_days", "first_collected", "last_collected"))


@register("agg_month_prices", f"""select route, cast(date_trunc('month', departure_date) as date) as month,
{_r4sql('avg(price)')} as mean, min(price) as min, max(price) as max from cal group by 1, 2""", views=CV)
def agg_month_prices(spark, sf):
    """Mean/min/max by departure month."""
    c = cal_loaded(spark, sf).withColumn("route", S.route_key("origin", "destination"))
    return c.groupBy("route", S.month_start("departure_date").alias("month")).agg(
        r4(F.avg("price")).alias("mean"), F.min("price").alias("min"), F.max("price").alias("max"))


@register("agg_price_histogram", """with r as (select route, min(price) as lo, max(price) as hi from cal group by route),
x as (select c.route, c.price, r.lo, r.hi from cal c join r on c.route = r.route)
select route, cast(least(floor((price - lo) * 40 / (hi - lo)), 39) as int) as bin, count(*) as count
from x group by 1, 2""", views=CV)
def agg_price_histogram(spark, sf):
    """40 equal-width bins per route over that route's own price range."""
    c = cal_loaded(spark, sf).withColumn("route", S.route_key("origin", "destination"))
    rng = c.groupBy("route").agg(F.min("price").alias("lo"), F.max("price").alias("hi"))
    x = c.join(rng, "route")
    b = F.least(F.floor((F.col("price") - F.col("lo")) * 40 / (F.col("hi") - F.col("lo"))), F.lit(39))
    return x.groupBy("route", b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))


# --- serving: as-of features, fallback, scores, best dates ------------------------------

fx.DUCKDB_VIEWS["serve_req"] = """select distinct route, departure_date, departure_date - 10 as as_of from cal
union select distinct route, departure_date, departure_date - 3 from cal
union select route, departure_date + 60, departure_date + 50 from (select distinct route, departure_date from cal)"""

fx.DUCKDB_VIEWS["serve_feat"] = """select r.route, r.departure_date, r.as_of, f.price_lag1, f.price_lag7, f.price_roll3,
f.n_obs, f.n_obs is not null as has_history
from serve_req r left join (
  select route, departure_date, as_of, min_by(price, rn) as price_lag1, max_by(price, rn) as price_lag7,
  avg(price) filter (where rn <= 3) as price_roll3, count(*) as n_obs from (
    select r.route, r.departure_date, r.as_of, c.price,
    row_number() over (partition by r.route, r.departure_date, r.as_of order by c.collected_at desc) as rn
    from serve_req r join cal c on r.route = c.route and r.departure_date = c.departure_date
    where cast(c.collected_at as date) <= r.as_of)
  where rn <= 7 group by all) f
on r.route = f.route and r.departure_date = f.departure_date and r.as_of = f.as_of"""

fx.DUCKDB_VIEWS["serve_filled"] = """select s.route, s.departure_date, s.as_of, s.has_history,
case when s.has_history then s.price_lag1 else coalesce(a.route_avg, 400.0) end as price_lag1,
case when s.has_history then s.price_lag7 else coalesce(a.route_avg, 400.0) end as price_lag7,
case when s.has_history then s.price_roll3 else coalesce(a.route_avg, 400.0) end as price_roll3,
cast(greatest(s.departure_date - s.as_of, 0) as int) as days_ahead,
cast(isodow(s.departure_date) - 1 as int) as dep_dow, cast(month(s.departure_date) as int) as dep_month,
cast(isodow(s.as_of) - 1 as int) as col_dow
from serve_feat s left join (select route, avg(price) as route_avg from cal group by route) a on s.route = a.route"""

fx.DUCKDB_VIEWS["serve_scored"] = f"""select *, price_roll3 as estimated_price_raw,
{_r4sql('1 / (1 + exp((price_lag1 - price_lag7) / 10))')} as wait_probability from serve_filled"""
SV = CV + ("serve_req", "serve_feat", "serve_filled", "serve_scored")


def serving_requests(spark, sf) -> DataFrame:
    """Requests derived from the calendar: every (route, departure) asked 10
    and 3 days ahead, plus the same routes 60 days later (no history)."""
    c = cal_loaded(spark, sf).withColumn("route", S.route_key("origin", "destination"))
    rd = c.select("route", "departure_date").distinct()
    r10 = rd.withColumn("as_of", F.date_sub("departure_date", 10))
    r3 = rd.withColumn("as_of", F.date_sub("departure_date", 3))
    far = rd.select("route", F.date_add("departure_date", 60).alias("departure_date"),
                    F.date_add("departure_date", 50).alias("as_of"))
    return r10.unionByName(r3).unionByName(far).distinct()


def serving_features(spark, sf, req: DataFrame | None = None) -> DataFrame:
    """Features of requests ``route, departure_date, as_of`` (by default the calendar's own)."""
    c = cal_loaded(spark, sf).withColumn("route", S.route_key("origin", "destination"))
    req = serving_requests(spark, sf) if req is None else req
    feats = TS.last_n_features(c, req, keys=("route", "departure_date"), as_of="as_of")
    filled = TS.fill_with_route_average(feats, TS.route_averages(c))
    return (filled.withColumn("days_ahead", F.greatest(F.datediff("departure_date", "as_of"), F.lit(0)))
            .withColumn("dep_dow", S.weekday_mon0("departure_date"))
            .withColumn("dep_month", F.month("departure_date"))
            .withColumn("col_dow", S.weekday_mon0("as_of")))


@register("join_asof_history", f"""select route, departure_date, as_of, price_lag1, price_lag7,
{_r4sql('price_roll3')} as price_roll3, n_obs, has_history from serve_feat""", views=SV[:4])
def join_asof_history(spark, sf):
    """Features from observations known up to an as-of day for (route, date)."""
    c = cal_loaded(spark, sf).withColumn("route", S.route_key("origin", "destination"))
    f = TS.last_n_features(c, serving_requests(spark, sf), keys=("route", "departure_date"), as_of="as_of")
    return f.select("route", "departure_date", "as_of", "price_lag1", "price_lag7",
                    r4("price_roll3").alias("price_roll3"), "n_obs", "has_history")


@register("win_last7_features", f"""select route, departure_date, as_of, days_ahead, dep_dow, dep_month, col_dow,
{_r4sql('price_lag1')} as price_lag1, {_r4sql('price_lag7')} as price_lag7, {_r4sql('price_roll3')} as price_roll3,
has_history from serve_filled""", views=SV[:5])
def win_last7_features(spark, sf):
    """Serving features: last obs, first of last 7, mean of last 3, has_history; over the last 30 daily files."""
    f = serving_features(spark, sf)
    return f.select("route", "departure_date", "as_of", "days_ahead", "dep_dow", "dep_month", "col_dow",
                    *[r4(c).alias(c) for c in ("price_lag1", "price_lag7", "price_roll3")], "has_history")


@register("join_route_fallback", f"""select route, departure_date, as_of, {_r4sql('price_lag1')} as price_lag1
from serve_filled where not has_history""", views=SV[:5])
def join_route_fallback(spark, sf):
    """Route average as default, else 400.0."""
    f = serving_features(spark, sf).filter(~F.col("has_history"))
    return f.select("route", "departure_date", "as_of", r4("price_lag1").alias("price_lag1"))


SCORED = ["route", "departure_date", "as_of", "days_ahead", "estimated_price", "last_observed_price", "action",
          "confidence", "wait_probability", "wait_threshold", "confidence_distance", "has_history"]


def scored_requests(spark, sf, req: DataFrame | None = None) -> DataFrame:
    """Requests scored by the stored models (see ``model_plans``)."""
    from .model_plans import scored
    return scored(spark, sf, serving_features(spark, sf, req)).select(*SCORED)


@register("ml_score_batch")
def ml_score_batch(spark, sf):
    """Every request scored in one job by the stored regressor and classifier (the reference scores one per call)."""
    return scored_requests(spark, sf)


@register("ml_score_batch_requests", f"""select route, departure_date, as_of, days_ahead,
{_r2sql('price_lag1')} as last_observed_price, 0.45e0 as wait_threshold, has_history, true as scored from serve_filled""",
          views=SV[:5])
def ml_score_batch_requests(spark, sf):
    """What a scored request holds besides its scores, and that each one has scores in range."""
    s = scored_requests(spark, sf)
    ok = (F.col("estimated_price") > 0) & F.col("wait_probability").between(0, 1) & (
        (F.col("wait_probability") >= F.col("wait_threshold")) == (F.col("action") == "Price predicted to drop"))
    return s.select("route", "departure_date", "as_of", "days_ahead", "last_observed_price", "wait_threshold",
                    "has_history", F.coalesce(ok, F.lit(False)).alias("scored"))


@register("ml_score_baseline", f"""select route, departure_date, as_of, days_ahead,
{_r2sql('estimated_price_raw')} as estimated_price, {_r2sql('price_lag1')} as last_observed_price,
case when wait_probability >= 0.45 then 'Price predicted to drop' else 'Price predicted to increase' end as action,
case when abs(wait_probability - 0.45) > 0.25 then 'High' when abs(wait_probability - 0.45) > 0.10 then 'Medium' else 'Low' end as confidence,
wait_probability, 0.45e0 as wait_threshold, {_r4sql('abs(wait_probability - 0.45)')} as confidence_distance,
has_history from serve_scored""", views=SV)
def ml_score_baseline(spark, sf):
    """The serving post-processing on a fixed rule's scores, so that SQL can check it."""
    s = MD.apply_outlook(MD.baseline_scores(serving_features(spark, sf)))
    return s.select("route", "departure_date", "as_of", "days_ahead", "estimated_price",
                    "last_observed_price", "action", "confidence", "wait_probability", "wait_threshold",
                    "confidence_distance", "has_history")


@register("fn_outlook", """select route, departure_date, as_of,
case when wait_probability >= 0.45 then 'Price predicted to drop' else 'Price predicted to increase' end as action,
case when wait_probability >= 0.45 then 'may drop' else 'may rise' end as short_outlook from serve_scored""",
          views=SV)
def fn_outlook(spark, sf):
    """Probability ≥ threshold → 'drop' else 'increase'; short form may drop/may rise."""
    s = MD.baseline_scores(serving_features(spark, sf))
    return s.select("route", "departure_date", "as_of", S.outlook("wait_probability").alias("action"),
                    S.outlook("wait_probability", short=True).alias("short_outlook"))


@register("fn_confidence", """select route, departure_date, as_of,
case when abs(wait_probability - 0.45) > 0.25 then 'High' when abs(wait_probability - 0.45) > 0.10 then 'Medium' else 'Low' end as confidence
from serve_scored""", views=SV)
def fn_confidence(spark, sf):
    """Abs(p−threshold): >0.25 High, >0.10 Medium, else Low."""
    s = MD.baseline_scores(serving_features(spark, sf))
    return s.select("route", "departure_date", "as_of", S.confidence("wait_probability").alias("confidence"))


fx.DUCKDB_VIEWS["best_req"] = """select route, min(departure_date) + 3 as start_date, min(departure_date) + 17 as end_date,
max(collected_date) as snapshot_day from cal group by route"""
fx.DUCKDB_VIEWS["best_dates"] = """select * from (select c.route, c.departure_date, c.price,
row_number() over (partition by c.route order by c.price, c.departure_date) as rank
from cal c join best_req r on c.route = r.route and c.collected_date = r.snapshot_day
where c.departure_date between r.start_date and r.end_date) where rank <= 5"""


def best_date_requests(spark, sf) -> DataFrame:
    """One window request per route (start = first departure + 3 days, 14-day
    window), answered from the route's latest snapshot."""
    c = cal_loaded(spark, sf).withColumn("route", S.route_key("origin", "destination"))
    return c.groupBy("route").agg(F.date_add(F.min("departure_date"), 3).alias("start_date"),
                                  F.date_add(F.min("departure_date"), 17).alias("end_date"),
                                  F.max("collected_date").alias("snapshot_day"))


def best_dates(spark, sf, top_n: int = 5) -> DataFrame:
    c = cal_loaded(spark, sf).withColumn("route", S.route_key("origin", "destination"))
    req = best_date_requests(spark, sf)
    j = c.join(req, (c.route == req.route) & (c.collected_date == req.snapshot_day)).filter(
        F.col("departure_date").between(F.col("start_date"), F.col("end_date")))
    w = Window.partitionBy(c.route).orderBy("price", "departure_date")
    return (j.select(c.route, "departure_date", "price", F.row_number().over(w).alias("rank"))
            .filter(F.col("rank") <= top_n))


def _outlook_of(rows: DataFrame, scores: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``rows`` with the outlook columns of their score, ``n/a`` where there is none."""
    j = rows.join(scores.select(*keys, *columns), keys, "left")
    return j.select(*rows.columns, *[F.coalesce(c, F.lit("n/a")).alias(c) for c in columns])


def _best_with_request(spark, sf, days: int) -> DataFrame:
    return best_dates(spark, sf).withColumn("rank", F.col("rank").cast("int")).withColumn(
        "as_of", F.date_sub("departure_date", days))


REQUEST = ["route", "departure_date", "as_of"]


@register("topk_best_dates")
def topk_best_dates(spark, sf):
    """Cheapest dates per window request, each with the stored models' outlook 3 days before departure (``n/a``
    when no score exists)."""
    b = _best_with_request(spark, sf, 3)
    s = scored_requests(spark, sf, b.select(*REQUEST))
    return _outlook_of(b, s, REQUEST, ["action", "confidence"]).drop("as_of")


@register("topk_best_dates_ranked", """select route, departure_date, price, cast(rank as int) as rank, true as has_outlook
from best_dates""", views=CV + ("best_req", "best_dates"))
def topk_best_dates_ranked(spark, sf):
    """The dates of ``topk_best_dates`` without the fitted outlook, and that each has one."""
    t = topk_best_dates(spark, sf)
    return t.select("route", "departure_date", "price", "rank", (F.col("action") != "n/a").alias("has_outlook"))


def journey_outlook(spark, sf) -> DataFrame:
    """Every stored journey with the outlook of its route and date as of the day it was collected. Each distinct
    (route, date, day) is scored once, however many journeys share it."""
    j = fx.stored(spark, sf, "itineraries").select(
        "itinerary_id", S.route_key("origin_code", "dest_code").alias("route"),
        F.col("search_date").alias("departure_date"), F.col("collected_at").alias("as_of"), "price_raw")
    req = j.where(F.col("departure_date").isNotNull() & F.col("as_of").isNotNull()).select(*REQUEST).distinct()
    return _outlook_of(j, scored_requests(spark, sf, req), REQUEST, ["action", "confidence"])


@register("join_scores")
def join_scores(spark, sf):
    """Price outlook of the stored models on each best date (10 days before) and each journey, n/a when missing."""
    b = _best_with_request(spark, sf, 10)
    dates = _outlook_of(b, scored_requests(spark, sf, b.select(*REQUEST)), REQUEST, ["action"])
    cols = ["route", "departure_date", "price", "action"]
    return dates.select(F.lit("date").alias("kind"), F.lit(None).cast("string").alias("itinerary_id"), *cols).union(
        journey_outlook(spark, sf).select(F.lit("journey"), "itinerary_id", "route", "departure_date",
                                          F.col("price_raw").alias("price"), "action"))


@register("join_scores_rows", """select 'date' as kind, route, departure_date, count(*) as rows, count(*) as scored,
min(price) as cheapest from best_dates group by all
union all select 'journey', concat_ws('-', origin_code, dest_code), search_date, count(*), count(*), min(price_raw)
from itineraries group by all""", views=CV + ("itineraries", "best_req", "best_dates"))
def join_scores_rows(spark, sf):
    """Dates and journeys per route and date, all of which have a score."""
    return join_scores(spark, sf).groupBy("kind", "route", "departure_date").agg(
        F.count("*").alias("rows"), F.count_if(F.col("action") != "n/a").alias("scored"), F.min("price").alias("cheapest"))


@register("topk_best_dates_baseline", """select b.route, b.departure_date, b.price, cast(b.rank as int) as rank,
coalesce(case when s.wait_probability >= 0.45 then 'Price predicted to drop' else 'Price predicted to increase' end, 'n/a') as action,
coalesce(case when abs(s.wait_probability - 0.45) > 0.25 then 'High' when abs(s.wait_probability - 0.45) > 0.10 then 'Medium' else 'Low' end, 'n/a') as confidence
from best_dates b left join serve_scored s on b.route = s.route and b.departure_date = s.departure_date
and s.as_of = b.departure_date - 3""", views=SV + ("best_req", "best_dates"))
def topk_best_dates_baseline(spark, sf):
    """``topk_best_dates`` on the fixed rule's scores."""
    b = best_dates(spark, sf)
    s = MD.apply_outlook(MD.baseline_scores(serving_features(spark, sf)))
    s = s.select("route", "departure_date", "as_of", "action", "confidence")
    j = b.join(s, (b.route == s.route) & (b.departure_date == s.departure_date)
               & (s.as_of == F.date_sub(b.departure_date, 3)), "left")
    return j.select(b.route, b.departure_date, "price", F.col("rank").cast("int").alias("rank"),
                    F.coalesce("action", F.lit("n/a")).alias("action"),
                    F.coalesce("confidence", F.lit("n/a")).alias("confidence"))


@register("join_scores_baseline", """select b.route, b.departure_date, b.price,
coalesce(case when s.wait_probability >= 0.45 then 'Price predicted to drop' else 'Price predicted to increase' end, 'n/a') as action
from best_dates b left join serve_scored s on b.route = s.route and b.departure_date = s.departure_date
and s.as_of = b.departure_date - 10""", views=SV + ("best_req", "best_dates"))
def join_scores_baseline(spark, sf):
    """``join_scores`` of the best dates on the fixed rule's scores."""
    b = best_dates(spark, sf)
    s = MD.apply_outlook(MD.baseline_scores(serving_features(spark, sf))).select(
        "route", "departure_date", "as_of", "action")
    j = b.join(s, (b.route == s.route) & (b.departure_date == s.departure_date)
               & (s.as_of == F.date_sub(b.departure_date, 10)), "left")
    return j.select(b.route, b.departure_date, "price", F.coalesce("action", F.lit("n/a")).alias("action"))


# --- evaluation metrics on the temporal test split ------------------------------------

fx.DUCKDB_VIEWS["eval_test"] = f"""select *, price_roll3 as pred_price,
{_r4sql('1 / (1 + exp((price_lag1 - price_lag7) / 10))')} as wait_probability from cal_train,
(select make_timestamp(cast(quantile_cont(epoch_us(cast(collected_date as timestamp)), 0.8) as bigint)) as split_at from cal_train) s
where cast(collected_date as timestamp) > split_at"""


def eval_test(spark, sf) -> DataFrame:
    _, test = TS.temporal_split(_train(spark, sf))
    return MD.baseline_scores(test).withColumn("pred_price", F.col("price_roll3"))


@register("agg_reg_metrics", f"""select {_r4sql('avg(abs(price - pred_price))')} as mae,
{_r4sql('sqrt(avg((price - pred_price) * (price - pred_price)))')} as rmse,
{_r4sql('1 - sum((price - pred_price) * (price - pred_price)) / (var_pop(price) * count(*))')} as r2,
{_r4sql('avg(abs((price - pred_price) / price)) * 100')} as mape, count(*) as n from eval_test""",
          views=CT + ("eval_test",))
def agg_reg_metrics(spark, sf):
    """MAE, RMSE, R², MAPE %."""
    m = M.regression_metrics(eval_test(spark, sf), "price", "pred_price")
    return m.select(*[r4(c).alias(c) for c in ("mae", "rmse", "r2", "mape")], "n")


@register("agg_clf_metrics", f"""with p as (select wait_probability as s, count(*) filter (where should_wait = 1) as np,
count(*) filter (where should_wait <> 1) as nn from eval_test group by 1),
a as (select sum(np * (coalesce(sum(nn) over (order by s rows between unbounded preceding and 1 preceding), 0) + nn / 2.0))
 / (sum(np) over () * sum(nn) over ()) as auc from p),
c as (select (count(*) filter (where should_wait = 1 and wait_probability >= 0.45)
 + count(*) filter (where should_wait <> 1 and wait_probability < 0.45)) / count(*) as accuracy,
coalesce(count(*) filter (where should_wait = 1 and wait_probability >= 0.45) / nullif(count(*) filter (where wait_probability >= 0.45), 0), 0.0) as precision,
coalesce(count(*) filter (where should_wait = 1 and wait_probability >= 0.45) / nullif(count(*) filter (where should_wait = 1), 0), 0.0) as recall,
count(*) as n from eval_test)
select {_r4sql('(select sum(x) from (select np * (coalesce(sum(nn) over (order by s rows between unbounded preceding and 1 preceding), 0) + nn / 2.0) as x from p)) / ((select sum(np) from p) * (select sum(nn) from p))')} as auc,
{_r4sql('accuracy')} as accuracy, {_r4sql('precision')} as precision, {_r4sql('recall')} as recall, n from c""",
          views=CT + ("eval_test",))
def agg_clf_metrics(spark, sf):
    """AUC, accuracy, precision, recall at threshold (≥), zero-division → 0."""
    t = eval_test(spark, sf)
    a = M.auc(t, "should_wait", "wait_probability")
    c = M.classification_metrics(t, "should_wait", "wait_probability", MD.WAIT_THRESHOLD)
    j = A.combine_rows(a, c)
    return j.select(*[r4(x).alias(x) for x in ("auc", "accuracy", "precision", "recall")], "n")


# --- collection inventory and health ----------------------------------------------------

@register("agg_collection_inventory", """with c as (select cast(collected_at as date) as day, count(*) as calendar_rows
from calendar group by 1),
i as (select collected_at as day, count(*) as itinerary_rows,
count(distinct (origin_code, dest_code, search_date)) as route_date_combos from itineraries group by 1)
select coalesce(c.day, i.day) as day, coalesce(calendar_rows, 0) as calendar_rows,
coalesce(itinerary_rows, 0) as itinerary_rows, coalesce(route_date_combos, 0) as route_date_combos
from c full outer join i on c.day = i.day""", views=("calendar", "itineraries"))
def agg_collection_inventory(spark, sf):
    """Per collection day: calendar rows, itinerary rows, route-date combos."""
    c = calendar(spark, sf).groupBy(F.to_date("collected_at").alias("day")).agg(
        F.count(F.lit(1)).alias("calendar_rows"))
    i = fx.stored(spark, sf, "itineraries").groupBy(F.col("collected_at").alias("day")).agg(
        F.count(F.lit(1)).alias("itinerary_rows"),
        F.count_distinct("origin_code", "dest_code", "search_date").alias("route_date_combos"))
    j = c.join(i, "day", "full_outer")
    return j.select("day", *[F.coalesce(x, F.lit(0)).cast("bigint").alias(x)
                             for x in ("calendar_rows", "itinerary_rows", "route_date_combos")])


@register("agg_search_inventory", """select collected_at as day, search_date, count(*) as rows,
count(distinct (origin_code, dest_code)) as routes from itineraries group by 1, 2""", views=("itineraries",))
def agg_search_inventory(spark, sf):
    """Per collection day and search date: rows and routes."""
    return fx.stored(spark, sf, "itineraries").groupBy(F.col("collected_at").alias("day"), "search_date").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("origin_code", "dest_code").alias("routes"))


@register("join_daily_pairs", """with c as (select cast(collected_at as date) as day, count(*) as calendar_rows from calendar group by 1),
i as (select collected_at as day, count(*) as itinerary_rows from itineraries group by 1)
select coalesce(c.day, i.day) as day, c.calendar_rows, i.itinerary_rows, c.day is not null and i.day is not null as both_present
from c full outer join i on c.day = i.day""", views=("calendar", "itineraries"))
def join_daily_pairs(spark, sf):
    """Calendar and itinerary files of the same day, side by side."""
    c = calendar(spark, sf).groupBy(F.to_date("collected_at").alias("day")).agg(
        F.count(F.lit(1)).alias("calendar_rows")).withColumn("_c", F.lit(True))
    i = fx.stored(spark, sf, "itineraries").groupBy(F.col("collected_at").alias("day")).agg(
        F.count(F.lit(1)).alias("itinerary_rows")).withColumn("_i", F.lit(True))
    j = c.join(i, "day", "full_outer")
    return j.select("day", "calendar_rows", "itinerary_rows",
                    (F.col("_c").isNotNull() & F.col("_i").isNotNull()).alias("both_present"))


@register("join_not_collected", """with e as (select concat_ws('-', origin, destination) as route,
unnest(range(date '2024-01-20', date '2024-02-14', interval 1 day))::date as departure_date from routes_dim)
select e.route, e.departure_date from e anti join (select distinct route, departure_date from cal) c
on e.route = c.route and e.departure_date = c.departure_date""", views=CV + ("routes_dim",))
def join_not_collected(spark, sf):
    """Expected (route, departure) pairs — every active route × the departure
    dates the collector asks for — that no calendar row covers."""
    expected = dims.routes(spark).select(
        S.route_key("origin", "destination").alias("route"),
        F.explode(F.sequence(F.lit("2024-01-20").cast("date"), F.lit("2024-02-13").cast("date"))).alias(
            "departure_date"))
    got = cal_loaded(spark, sf).select(S.route_key("origin", "destination").alias("route"),
                                       "departure_date").distinct()
    return F.broadcast(expected).join(got, ["route", "departure_date"], "left_anti")


# fixed values: search dates asked for per route and day; the share of itinerary searches that must succeed
SEARCHES_PER_ROUTE = 2
ITINERARY_SHARE = 0.75


@register("agg_health", f"""with c as (select cast(collected_at as date) as day,
count(distinct concat_ws('-', origin, destination)) as ok from calendar group by 1),
i as (select collected_at as day, count(distinct (origin_code, dest_code, search_date)) as ok from itineraries group by 1),
e as (select count(*) as routes from routes_dim where active),
d as (select coalesce(c.day, i.day) as day, coalesce(c.ok, 0) as calendar_success, routes as calendar_expected,
coalesce(i.ok, 0) as itinerary_success, {SEARCHES_PER_ROUTE} * routes as itinerary_expected
from c full outer join i on c.day = i.day, e)
select *, calendar_success >= calendar_expected and itinerary_success >= {ITINERARY_SHARE} * itinerary_expected as healthy
from d""", views=("calendar", "itineraries", "routes_dim"))
def agg_health(spark, sf):
    """Per collection day: calendars and itinerary searches that brought rows
    against what the active routes ask for (the reference fixes 6 and 12 while
    it collects 12 routes with 2 searches each). Healthy: all calendars and
    75 % of the searches; a day that holds only one of the two has 0 of the
    other."""
    c = calendar(spark, sf).groupBy(F.to_date("collected_at").alias("day")).agg(
        F.count_distinct(S.route_key("origin", "destination")).alias("calendar_success"))
    i = fx.stored(spark, sf, "itineraries").groupBy(F.col("collected_at").alias("day")).agg(
        F.count_distinct("origin_code", "dest_code", "search_date").alias("itinerary_success"))
    # the number of routes is one value: a scalar subquery, not a join
    routes = dims.routes(spark).agg(F.count(F.lit(1)))
    j = c.join(i, "day", "full_outer").fillna(0, ["calendar_success", "itinerary_success"])
    j = j.withColumn("calendar_expected", routes.scalar())
    j = j.withColumn("itinerary_expected", SEARCHES_PER_ROUTE * F.col("calendar_expected"))
    healthy = ((F.col("calendar_success") >= F.col("calendar_expected"))
               & (F.col("itinerary_success") >= ITINERARY_SHARE * F.col("itinerary_expected")))
    return j.select("day", "calendar_success", "calendar_expected", "itinerary_success", "itinerary_expected",
                    healthy.alias("healthy"))


@register("join_group_mean", f"""select route, departure_date, collected_date, price,
{_r4sql('avg(price) over (partition by route)')} as route_mean from cal""", views=CV)
def join_group_mean(spark, sf):
    """Route mean attached to every row: a partial aggregate joined back (the
    route table is tiny and broadcast by AQE), not a window over the route."""
    c = cal_loaded(spark, sf).withColumn("route", S.route_key("origin", "destination"))
    j = TS.group_mean(c, "route", "price", "route_mean")
    return j.select("route", "departure_date", "collected_date", "price", r4("route_mean").alias("route_mean"))


# fixed values: the collector polls a search at most this many times
MAX_POLLS = 3


def attempt_log(spark, sf) -> DataFrame:
    """One row per poll of each itinerary search: the first ``k`` polls come
    back empty, ``k = rows % 4`` (derived from the data); ``k ≥ MAX_POLLS``
    means every poll was empty."""
    i = fx.stored(spark, sf, "itineraries").groupBy("origin_code", "dest_code", "search_date", "collected_at").agg(
        F.count(F.lit(1)).alias("n"))
    k = (F.col("n") % 4).cast("int")
    polls = F.least(k + 1, F.lit(MAX_POLLS))
    return i.select("origin_code", "dest_code", "search_date", "collected_at", "n",
                    F.explode(F.sequence(F.lit(1), polls)).alias("attempt"),
                    k.alias("_k")).select(
        "origin_code", "dest_code", "search_date", "collected_at", "attempt",
        F.when(F.col("attempt") > F.col("_k"), F.col("n")).otherwise(F.lit(0)).alias("rows"))


@register("st_retry_report", """with g as (select origin_code, dest_code, search_date, collected_at, count(*) as n
from itineraries group by all),
a as (select *, cast(n % 4 as int) as k, least(cast(n % 4 as int) + 1, 3) as polls from g)
select collected_at as day, count(*) as searches, count(*) filter (where k < 3) as successes,
count(*) filter (where k >= 3) as empty_results, cast(sum(polls - 1) as bigint) as retries_used,
cast(sum(polls) as bigint) as api_calls from a group by 1""", views=("itineraries",))
def st_retry_report(spark, sf):
    """Per collection day: searches, successes, empty results, retries and calls."""
    log = attempt_log(spark, sf)
    per = log.groupBy("origin_code", "dest_code", "search_date", "collected_at").agg(
        F.count(F.lit(1)).alias("polls"), F.max("rows").alias("rows"))
    return per.groupBy(F.col("collected_at").alias("day")).agg(
        F.count(F.lit(1)).alias("searches"), F.count_if(F.col("rows") > 0).alias("successes"),
        F.count_if(F.col("rows") == 0).alias("empty_results"),
        F.sum(F.col("polls") - 1).cast("bigint").alias("retries_used"),
        F.sum("polls").cast("bigint").alias("api_calls"))
