"""Tracked trips on the ``track_events`` log and the calendar prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as TX
from ..functions.numeric import r4
from ..operators import tracks as TR
from ..sources import fixtures as fx
from .registry import register

AS_OF = "2024-01-25 09:00:00"


def _r4sql(e: str) -> str:
    return f"floor(({e}) * 10000 + 0.5) / 10000"


def tracks(spark: SparkSession, sf: str) -> DataFrame:
    return TR.track_state(fx.track_events(spark, sf))


fx.DUCKDB_VIEWS["tracks"] = """select min(seq) filter (where op = 'track') as id, user_id, origin, destination, departure_date,
arg_max(baseline_price, seq) filter (where op = 'track') as baseline_price, arg_max(op, seq) = 'track' as active,
cast(null as double) as last_notified_price, max(seq) filter (where op = 'track') as tracked_seq
from track_events group by user_id, origin, destination, departure_date
having count(*) filter (where op = 'track') > 0"""
TV = ("track_events", "tracks")


@register("src_tracks", "select * from tracks", views=TV)
def src_tracks(spark, sf):
    """The tracks table (state of the event log)."""
    return tracks(spark, sf)


@register("st_track_state", """select id, user_id, origin, destination, departure_date, baseline_price, active from tracks""",
          views=TV)
def st_track_state(spark, sf):
    """Upsert (reset baseline, reactivate, clear last price), deactivate."""
    return tracks(spark, sf).select("id", "user_id", "origin", "destination", "departure_date",
                                    "baseline_price", "active")


@register("st_track_expiry", f"""select id, active and not (cast(departure_date as timestamp) < timestamp '{AS_OF}') as active
from tracks""", views=TV)
def st_track_expiry(spark, sf):
    """Tracks whose date (midnight) is before now are deactivated."""
    return TR.expire(tracks(spark, sf), AS_OF).select("id", "active")


@register("sort_user_tracks", """select user_id, departure_date, origin, destination, baseline_price from tracks
where active order by user_id, departure_date, origin, destination""", views=TV)
def sort_user_tracks(spark, sf):
    """Active tracks of a user by date."""
    return TR.user_tracks(tracks(spark, sf)).select("user_id", "departure_date", "origin", "destination",
                                                    "baseline_price")


fx.DUCKDB_VIEWS["cur_price"] = f"""select origin, destination, departure_date, arg_max(price, collected_at) as current_price,
max(collected_at) as price_at from calendar where cast(collected_at as date) <= date '{AS_OF[:10]}'
group by origin, destination, departure_date"""


@register("join_track_price", """select t.id, t.user_id, t.origin, t.destination, t.departure_date, t.baseline_price,
p.current_price, p.price_at from tracks t join cur_price p using (origin, destination, departure_date)
where t.active and not (cast(t.departure_date as timestamp) < timestamp '""" + AS_OF + "')",
          views=TV + ("calendar", "cur_price"))
def join_track_price(spark, sf):
    """Active, unexpired tracks with the latest price observed by ``as_of``."""
    t = TR.expire(tracks(spark, sf), AS_OF).filter(F.col("active"))
    p = TR.current_prices(fx.stored(spark, sf, "calendar"), AS_OF[:10])
    return t.join(p, ["origin", "destination", "departure_date"]).select(
        "id", "user_id", "origin", "destination", "departure_date", "baseline_price", "current_price", "price_at")


fx.DUCKDB_VIEWS["alerts_sql"] = """select * from (select t.id, t.user_id, t.origin, t.destination, t.departure_date,
t.baseline_price, c.collected_at, c.price,
(t.baseline_price - c.price) / t.baseline_price >= 0.05 as q,
coalesce(nullif(min(case when (t.baseline_price - c.price) / t.baseline_price >= 0.05 then c.price end)
  over (partition by t.id order by c.collected_at rows between unbounded preceding and 1 preceding), 0.0), t.baseline_price) as last
from tracks t join calendar c using (origin, destination, departure_date) where t.active)
where q and price < last"""


@register("st_price_alerts", f"""select id, user_id, collected_at, price, {_r4sql('(baseline_price - price) / baseline_price * 100')} as drop_pct
from alerts_sql""", views=TV + ("calendar", "alerts_sql"))
def st_price_alerts(spark, sf):
    """Batch twin of the stateful alert stream (see ``streaming.alerts``)."""
    a = TR.alerts(tracks(spark, sf), fx.stored(spark, sf, "calendar"))
    return a.select("id", "user_id", "collected_at", "price", r4("drop_pct").alias("drop_pct"))


@register("fn_alert_text", """select id, collected_at, printf('*Price Drop Alert*
%s-%s on %s

Was £%.0f -> now £%.0f (down %.0f%%)

/optimise %s-%s %s to book.', origin, destination, strftime(departure_date, '%d/%m/%Y'), round_even(baseline_price, 0),
round_even(price, 0), round_even((baseline_price - price) / baseline_price * 100, 0), origin, destination,
strftime(departure_date, '%Y-%m-%d')) as text from alerts_sql""", views=TV + ("calendar", "alerts_sql"))
def fn_alert_text(spark, sf):
    """Price-drop message."""
    a = TR.alerts(tracks(spark, sf), fx.stored(spark, sf, "calendar"))
    return a.select("id", "collected_at", TX.alert_text("origin", "destination", "departure_date",
                                                        "baseline_price", "price").alias("text"))


# --- command requests -----------------------------------------------------------------

from ..operators import validate as VD  # noqa: E402

REQ_AS_OF = "2024-01-25"


def command_requests(spark: SparkSession, sf: str, kind: str = "date") -> DataFrame:
    """Command words derived from the track log: a mix of valid requests and
    every kind of mistake the validator reports."""
    e = fx.track_events(spark, sf)
    route = F.concat_ws("-", "origin", "destination")
    day = F.date_format("departure_date", "yyyy-MM-dd")
    k = F.col("seq") % 8
    if kind == "date":
        args = (F.when(k == 0, F.array(route, day)).when(k == 1, F.array(F.lower(route), day))
                .when(k == 2, F.array(F.concat("origin", "destination"), day))
                .when(k == 3, F.array(F.concat(F.col("origin"), F.lit("-XXX")), day))
                .when(k == 4, F.array(route, F.lit("not-a-date")))
                .when(k == 5, F.array(route, F.date_format(F.date_sub(F.lit(REQ_AS_OF).cast("date"), 3), "yyyy-MM-dd")))
                .when(k == 6, F.array().cast("array<string>")).otherwise(F.array(route)))
    else:
        end = F.date_format(F.date_add("departure_date", 5), "yyyy-MM-dd")
        args = (F.when(k <= 2, F.array(route, day, end)).when(k == 3, F.array(route, end, day))
                .when(k == 4, F.array(route, day)).when(k == 5, F.array(route, day, F.lit("2024-02-30")))
                .when(k == 6, F.array(F.concat(F.lit("XXX-"), F.col("destination")), day, end))
                .otherwise(F.array(route, F.lit("2023-12-31"), end)))
    return e.select("seq", args.alias("args"), F.lit(REQ_AS_OF).cast("date").alias("as_of"))


_REQ_DUCK = {
    "date": f"""select seq, case seq % 8 when 0 then [concat_ws('-', origin, destination), strftime(departure_date, '%Y-%m-%d')]
when 1 then [lower(concat_ws('-', origin, destination)), strftime(departure_date, '%Y-%m-%d')]
when 2 then [concat(origin, destination), strftime(departure_date, '%Y-%m-%d')]
when 3 then [concat(origin, '-XXX'), strftime(departure_date, '%Y-%m-%d')]
when 4 then [concat_ws('-', origin, destination), 'not-a-date']
when 5 then [concat_ws('-', origin, destination), strftime(date '{REQ_AS_OF}' - 3, '%Y-%m-%d')]
when 6 then []::varchar[] else [concat_ws('-', origin, destination)] end as args from track_events""",
    "range": """select seq, case when seq % 8 <= 2 then [concat_ws('-', origin, destination), strftime(departure_date, '%Y-%m-%d'), strftime(departure_date + 5, '%Y-%m-%d')]
when seq % 8 = 3 then [concat_ws('-', origin, destination), strftime(departure_date + 5, '%Y-%m-%d'), strftime(departure_date, '%Y-%m-%d')]
when seq % 8 = 4 then [concat_ws('-', origin, destination), strftime(departure_date, '%Y-%m-%d')]
when seq % 8 = 5 then [concat_ws('-', origin, destination), strftime(departure_date, '%Y-%m-%d'), '2024-02-30']
when seq % 8 = 6 then [concat('XXX-', destination), strftime(departure_date, '%Y-%m-%d'), strftime(departure_date + 5, '%Y-%m-%d')]
else [concat_ws('-', origin, destination), '2023-12-31', strftime(departure_date + 5, '%Y-%m-%d')] end as args from track_events""",
}


def _route_err_sql() -> str:
    ok = "('BKK', 'HAN', 'LHR', 'MAN', 'SGN')"
    r = "upper(args[1])"
    o = f"split_part({r}, '-', 1)"
    d = f"substr({r}, instr({r}, '-') + 1)"
    return (f"""when len(args) = 0 then 'Missing arguments. See /help for usage.'
when not contains({r}, '-') then printf('Route ''%s'' looks wrong. Use ORIGIN-DEST format, e.g. `LHR-SGN`.', {r})
when {o} not in {ok} or {d} not in {ok} then printf('Airport ''%s'' not recognised.' || chr(10) || 'Supported: BKK, HAN, LHR, MAN, SGN', case when {o} not in {ok} then {o} else {d} end)""",
            r, o, d)


def _date_err_sql(x: str) -> str:
    d = f"try_strptime({x}, '%Y-%m-%d')"
    return (f"case when {d} is null then printf('Date ''%s'' is invalid. Use `yyyy-mm-dd`, e.g. `2026-09-15`.', {x}) "
            f"when cast({d} as date) < date '{REQ_AS_OF}' then printf('Date %s is in the past.', {x}) end")


_rerr, _r, _o, _d = _route_err_sql()


@register("flt_validate_requests", f"""with q as ({_REQ_DUCK['date']}),
e as (select seq, args, case {_rerr} when len(args) < 2 then 'Need a date. See /help.'
else {_date_err_sql('args[2]')} end as error from q)
select seq, error, case when error is null then {_r} end as route, case when error is null then {_o} end as origin,
case when error is null then {_d} end as dest, case when error is null then args[2] end as date from e""",
          views=("track_events",))
def flt_validate_requests(spark, sf):
    """Request rows: route format, known airports, date parse, not in past, start ≤ end → value or first error reason."""
    v = VD.validate_requests(command_requests(spark, sf, "date"), need_date=True)
    return v.select("seq", "error", "route", "origin", "dest", "date")


@register("flt_validate_windows", f"""with q as ({_REQ_DUCK['range']}),
e as (select seq, args, case {_rerr} when len(args) < 3 then 'Need START and END dates. See /help.'
when {_date_err_sql('args[2]')} is not null then {_date_err_sql('args[2]')}
when {_date_err_sql('args[3]')} is not null then {_date_err_sql('args[3]')}
when try_strptime(args[2], '%Y-%m-%d') > try_strptime(args[3], '%Y-%m-%d') then 'START date must be before END date.'
end as error from q)
select seq, error, case when error is null then {_r} end as route, case when error is null then {_o} end as origin,
case when error is null then {_d} end as dest, case when error is null then args[2] end as start,
case when error is null then args[3] end as "end" from e""", views=("track_events",))
def flt_validate_windows(spark, sf):
    """Window requests (route, start, end): the value or the first error."""
    v = VD.validate_requests(command_requests(spark, sf, "range"), need_range=True)
    return v.select("seq", "error", "route", "origin", "dest", "start", "end")
