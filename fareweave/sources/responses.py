"""Nested search responses (JSON): explicit schemas, parsers and a builder.

Parsers read JSON text with an explicit schema (``from_json`` — never schema
inference) and flatten with ``explode``/``get``/``transform``. Everything is
per-row work inside whole-stage codegen; there is no driver-side loop and
no Python UDF. Missing arrays give no rows, missing fields give nulls and
malformed documents parse to null and drop out, as in the reference.

``itinerary_documents`` / ``roundtrip_documents`` / ``calendar_documents``
build response documents from the flat fixture tables so the parsers run on
data Spark derives from the driver tables (the reference's responses come
from a live API). One itinerary per document keeps every document bounded;
a calendar document holds one route's departure days (≤ one per day).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import dims

MAX_SEGMENTS = 4

_S = T.StringType()
_NAMED = T.StructType([T.StructField("name", _S), T.StructField("alternateId", _S)])
_OPERATING = T.StructType([T.StructField("name", _S), T.StructField("alternateId", _S),
                           T.StructField("flightNumber", _S), T.StructField("iataCode", _S)])
_PLACE = T.StructType([T.StructField("displayCode", _S), T.StructField("flightPlaceId", _S),
                       T.StructField("city", _S), T.StructField("country", _S)])
SEGMENT = T.StructType([
    T.StructField("origin", _PLACE), T.StructField("destination", _PLACE),
    T.StructField("flightNumber", _S), T.StructField("durationInMinutes", T.IntegerType()),
    T.StructField("departure", _S), T.StructField("arrival", _S),
    T.StructField("marketingCarrier", _NAMED), T.StructField("operatingCarrier", _OPERATING)])
LEG = T.StructType([
    T.StructField("origin", _PLACE), T.StructField("destination", _PLACE),
    T.StructField("departure", _S), T.StructField("arrival", _S),
    T.StructField("durationInMinutes", T.IntegerType()), T.StructField("timeDeltaInDays", T.IntegerType()),
    T.StructField("stopCount", T.IntegerType()),
    T.StructField("carriers", T.StructType([T.StructField("marketing", T.ArrayType(_NAMED)),
                                            T.StructField("operationType", _S)])),
    T.StructField("segments", T.ArrayType(SEGMENT))])
ITINERARY = T.StructType([
    T.StructField("id", _S),
    T.StructField("price", T.StructType([T.StructField("raw", T.DoubleType()),
                                         T.StructField("formatted", _S)])),
    T.StructField("score", T.DoubleType()),
    T.StructField("farePolicy", T.StructType([T.StructField("isChangeAllowed", T.BooleanType()),
                                              T.StructField("isCancellationAllowed", T.BooleanType())])),
    T.StructField("isSelfTransfer", T.BooleanType()),
    T.StructField("tags", T.ArrayType(_S)),
    T.StructField("legs", T.ArrayType(LEG))])
SEARCH_RESPONSE = T.StructType([
    T.StructField("status", T.BooleanType()),
    T.StructField("data", T.StructType([T.StructField("itineraries", T.ArrayType(ITINERARY))]))])
CALENDAR_RESPONSE = T.StructType([
    T.StructField("data", T.StructType([T.StructField("flights", T.StructType([
        T.StructField("days", T.ArrayType(T.StructType([
            T.StructField("day", _S), T.StructField("price", T.DoubleType()),
            T.StructField("group", _S)])))]))]))])

SEGMENT_FIELDS = {  # output suffix → path inside a segment
    "origin": ("origin", "displayCode"), "dest": ("destination", "displayCode"),
    "flight_number": ("flightNumber",), "duration": ("durationInMinutes",),
    "departure": ("departure",), "arrival": ("arrival",),
    "marketing_carrier": ("marketingCarrier", "name"), "marketing_code": ("marketingCarrier", "alternateId"),
    "operating_carrier": ("operatingCarrier", "name"), "operating_code": ("operatingCarrier", "alternateId"),
}


def narrow(schema: T.StructType, paths) -> T.StructType:
    """The part of a schema that dotted ``paths`` name (arrays are stepped through): what is not asked for is skipped by
    the parser and not built."""
    def of(kind, heads: list[list[str]]):
        if [] in heads:
            return kind
        if isinstance(kind, T.ArrayType):
            return T.ArrayType(of(kind.elementType, heads))
        return T.StructType([T.StructField(f.name, of(f.dataType, [h[1:] for h in heads if h[0] == f.name]))
                             for f in kind.fields if any(h[0] == f.name for h in heads)])

    return of(schema, [p.split(".") for p in paths])


def _path(c: Column, path) -> Column:
    for p in path:
        c = c.getField(p)
    return c


# --- parsers -----------------------------------------------------------------------

def _explode(df: DataFrame, keep, arr: Column | str, alias: str) -> DataFrame:
    """``explode`` written as ``explode_outer`` + not-null filter: the same rows,
    but the optimizer does not infer a ``size(arr) > 0`` filter and push a
    second copy of the (expensive) JSON parse below the generator."""
    return df.select(*keep, F.explode_outer(arr).alias(alias)).filter(F.col(alias).isNotNull())


def parse_search(text: DataFrame, col: str = "json", keep: tuple[str, ...] = (),
                 fields: Sequence[str] | None = None) -> DataFrame:
    """JSON text → one row per itinerary (``it``) and leg (``leg``); ``fields`` names the itinerary's fields that are read
    (all by default)."""
    schema = SEARCH_RESPONSE if fields is None else narrow(SEARCH_RESPONSE, [f"data.itineraries.{p}" for p in fields])
    doc = text.select(*keep, F.from_json(F.col(col), schema).alias("doc"))
    its = _explode(doc, keep, "doc.data.itineraries", "it")
    return _explode(its.select(*keep, "it"), [*keep, "it"], "it.legs", "leg")


def join_list(arr: Column) -> Column:
    """``", ".join(list)`` (empty list → empty string, null list → null)."""
    return F.array_join(arr, ", ")


def segment_path(segments: Column) -> Column:
    """``A -> B -> C`` from the first origin and every destination; '' if none."""
    dests = F.transform(segments, lambda s: s["destination"]["displayCode"])
    path = F.concat(F.array(F.get(segments, 0)["origin"]["displayCode"]), dests)
    return F.when(F.coalesce(F.size(segments), F.lit(0)) > 0, F.array_join(path, " -> ")).otherwise(F.lit(""))


#: Flat columns that few fields make → the itinerary's fields they are made of.
FLAT_FIELDS = {"itinerary_id": ("id",), "departure": ("legs.departure",)}
FLAT_FIELDS |= {f"seg{i}_{name}": (f"legs.segments.{'.'.join(path)}",) for i in range(MAX_SEGMENTS)
                for name, path in SEGMENT_FIELDS.items()}
FLAT_FIELDS |= {f"seg{i}_flight": ("legs.segments.marketingCarrier.alternateId", "legs.segments.flightNumber")
                for i in range(MAX_SEGMENTS)}


def parse_flat(text: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The ``FLAT_FIELDS`` columns asked for of the flat record per (itinerary, leg), from a parse of their fields."""
    fields = sorted({"legs.departure", *[f for c in columns for f in FLAT_FIELDS[c]]})
    return flat_itineraries(parse_search(text, fields=fields), columns=columns)


def flat_itineraries(legs: DataFrame, keep: tuple[str, ...] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """The reference's flat record per (itinerary, leg), ``seg{i}_*`` for the
    first ``MAX_SEGMENTS`` segments; ``columns`` names those wanted (all by default)."""
    it, leg = F.col("it"), F.col("leg")
    segs = leg["segments"]
    marketing = leg["carriers"]["marketing"]
    cols = {
        "itinerary_id": it["id"],
        "price_raw": it["price"]["raw"],
        "price_formatted": it["price"]["formatted"],
        "score": it["score"],
        "is_change_allowed": it["farePolicy"]["isChangeAllowed"],
        "is_cancel_allowed": it["farePolicy"]["isCancellationAllowed"],
        "is_self_transfer": it["isSelfTransfer"],
        "tags": join_list(it["tags"]),
        "origin_code": leg["origin"]["displayCode"],
        "origin_city": leg["origin"]["city"],
        "dest_code": leg["destination"]["displayCode"],
        "dest_city": leg["destination"]["city"],
        "departure": leg["departure"],
        "arrival": leg["arrival"],
        "duration_minutes": leg["durationInMinutes"],
        "time_delta_days": leg["timeDeltaInDays"],
        "stop_count": leg["stopCount"],
        "is_direct": (F.coalesce(leg["stopCount"], F.lit(0)) == 0),
        "num_segments": F.coalesce(F.size(segs), F.lit(0)),
        "carrier_names": F.coalesce(join_list(F.transform(marketing, lambda c: F.coalesce(c["name"], F.lit("")))), F.lit("")),
        "carrier_codes": F.coalesce(join_list(F.transform(marketing, lambda c: F.coalesce(c["alternateId"], F.lit("")))), F.lit("")),
        "operation_type": F.coalesce(leg["carriers"]["operationType"], F.lit("")),
        "segment_route": segment_path(segs),
    }
    for i in range(MAX_SEGMENTS):
        s = F.get(segs, i)
        for name, path in SEGMENT_FIELDS.items():
            cols[f"seg{i}_{name}"] = _path(s, path)
        flight = F.concat(F.coalesce(s["marketingCarrier"]["alternateId"], F.lit("")),
                          F.coalesce(s["flightNumber"], F.lit("")))
        cols[f"seg{i}_flight"] = F.when(s.isNotNull(), flight)
    return legs.select(*keep, *[c.alias(n) for n, c in cols.items() if columns is None or n in columns])


TRANSITS = ("transit_airports", "transit_countries", "layover_hours")


def transit_details(segments: Column, kind: T.DataType = SEGMENT, names: Sequence[str] = TRANSITS) -> Column:
    """``names`` of (airport, country, layover hours) between consecutive segments, one struct for each pair;
    an empty array with ≤ 1 segment. Pairs come from ``transform`` with the
    index and the next element; ``filter`` drops the last (null) pair, so no
    sequence over a possibly negative range is built."""
    pairs = F.filter(F.transform(segments, lambda s, i: F.struct(
        s.alias("a"), F.get(segments, i + 1).alias("b"))), lambda p: p["b"].isNotNull())
    pairs = F.coalesce(pairs, F.array().cast(T.ArrayType(T.StructType([
        T.StructField("a", kind), T.StructField("b", kind)]))))

    def hours(p):
        secs = (F.unix_timestamp(F.try_to_timestamp(p["b"]["departure"]))
                - F.unix_timestamp(F.try_to_timestamp(p["a"]["arrival"])))
        return F.bround(secs / 3600.0 * 10, 0) / 10

    made = {"transit_airports": lambda p: p["a"]["destination"]["flightPlaceId"],
            "transit_countries": lambda p: F.coalesce(p["a"]["destination"]["country"], F.lit("UNKNOWN")), "layover_hours": hours}
    return F.transform(pairs, lambda p: F.struct(*[made[n](p).alias(n) for n in names]))


def flight_numbers(segments: Column, kind: T.DataType = SEGMENT) -> Column:
    """``iataCode + flightNumber`` of the operating carrier, only when both exist."""
    codes = F.transform(F.coalesce(segments, F.array().cast(T.ArrayType(kind))),
                        lambda s: F.when((F.coalesce(s["operatingCarrier"]["iataCode"], F.lit("")) != "")
                                         & (F.coalesce(s["operatingCarrier"]["flightNumber"], F.lit("")) != ""),
                                         F.concat(s["operatingCarrier"]["iataCode"],
                                                  s["operatingCarrier"]["flightNumber"])))
    return F.filter(codes, lambda x: x.isNotNull())


#: Columns of a leg in ``parse_roundtrip`` → the leg's fields they are made of.
LEG_FIELDS = {
    "origin": ("origin.displayCode",), "destination": ("destination.displayCode",), "departure": ("departure",),
    "arrival": ("arrival",), "duration_min": ("durationInMinutes",), "stops": ("stopCount",),
    "airline": ("carriers.marketing.name",),
    "flight_numbers": ("segments.operatingCarrier.iataCode", "segments.operatingCarrier.flightNumber"),
    "transit_countries": ("segments.destination.country",), "transit_airports": ("segments.destination.flightPlaceId",),
    "layover_hours": ("segments.departure", "segments.arrival"),
}
#: Read whatever is asked for: they decide on rows, or dates and totals are made of them.
ALWAYS = ("departure", "duration_min", "stops")


def parse_roundtrip(text: DataFrame, col: str = "json", legs: Sequence[str] | None = None) -> DataFrame:
    """One row per round-trip itinerary: leg 0 outbound, leg 1 return. ``legs`` names the columns of a leg that are read
    besides ``ALWAYS`` (``LEG_FIELDS``, all by default)."""
    wanted = [c for c in LEG_FIELDS if legs is None or c in legs or c in ALWAYS]
    fields = ["id", "price.raw", *[f"legs.{p}" for c in wanted for p in LEG_FIELDS[c]]]
    schema = narrow(SEARCH_RESPONSE, ["status", *[f"data.itineraries.{p}" for p in fields]])
    doc = text.select(F.from_json(F.col(col), schema).alias("doc"))
    # the status is looked at where the list is: a filter of its own would be pushed down and parse the text again
    held = F.when(F.coalesce(F.col("doc.status"), F.lit(False)), F.col("doc.data.itineraries"))
    its = _explode(doc, [], held, "it")
    leg_type = schema["data"].dataType["itineraries"].dataType.elementType["legs"].dataType.elementType
    kind = leg_type["segments"].dataType.elementType if "segments" in leg_type.names else None
    out, transits, between = [], [], [c for c in TRANSITS if c in wanted]
    for side, i in (("out", 0), ("ret", 1)):
        leg = F.get(F.col("it.legs"), i)
        if between:  # a column of its own: the pairs of segments are made once for all that is told of them
            transits.append(transit_details(leg["segments"], kind, between).alias(f"{side}_transits"))
        made = {
            "origin": lambda leg: leg["origin"]["displayCode"],
            "destination": lambda leg: leg["destination"]["displayCode"],
            "departure": lambda leg: leg["departure"], "arrival": lambda leg: leg["arrival"],
            "duration_min": lambda leg: leg["durationInMinutes"], "stops": lambda leg: leg["stopCount"],
            "airline": lambda leg: F.coalesce(join_list(F.transform(
                leg["carriers"]["marketing"], lambda c: F.coalesce(c["name"], F.lit("")))), F.lit("")),
            "flight_numbers": lambda leg: flight_numbers(leg["segments"], kind),
            **{c: lambda leg, side=side, c=c: F.col(f"{side}_transits")[c] for c in between},
        }
        out += [made[c](leg).alias(f"{side}_{c}") for c in wanted]
    flat = its.select("it", *transits).select(F.col("it.id").alias("flight_id"),
                      F.coalesce(F.col("it.price.raw"), F.lit(0.0)).alias("price_gbp"), *out)
    out_ts = F.try_to_timestamp("out_departure")
    ret_ts = F.try_to_timestamp("ret_departure")
    # an itinerary with a malformed departure time is skipped, the others stay
    readable = [F.col(c).isNull() | t.isNotNull() for c, t in (("out_departure", out_ts), ("ret_departure", ret_ts))]
    return (flat.filter(readable[0] & readable[1])
            .withColumn("total_duration_min", F.coalesce("out_duration_min", F.lit(0))
                        + F.coalesce("ret_duration_min", F.lit(0)))
            .withColumn("total_stops", F.coalesce("out_stops", F.lit(0)) + F.coalesce("ret_stops", F.lit(0)))
            .withColumn("out_departure_date", F.to_date(out_ts))
            .withColumn("ret_departure_date", F.to_date(ret_ts))
            .withColumn("trip_length_days",
                        F.floor((F.unix_timestamp(ret_ts) - F.unix_timestamp(out_ts)) / 86400).cast("int")))


def parse_calendar(text: DataFrame, col: str = "json",
                   keep: tuple[str, ...] = ("collected_at", "origin", "destination"),
                   currency: str = "GBP") -> DataFrame:
    """Price-calendar response → one row per day with a price."""
    doc = text.select(*keep, F.from_json(F.col(col), CALENDAR_RESPONSE).alias("doc"))
    days = _explode(doc, keep, "doc.data.flights.days", "d")
    return days.filter(F.col("d.price").isNotNull()).select(
        *keep, F.lit(currency).alias("currency"), F.col("d.day").alias("departure_date"),
        F.col("d.price").alias("price"), F.col("d.group").alias("group"))


# --- builders (test input derived from the fixture tables) ---------------------------

CITY = {r[0]: r[2] for r in dims.ROUTES} | {r[1]: r[3] for r in dims.ROUTES}
# fixed values: countries of the transit hubs used by the fixture itineraries
COUNTRY = {"DXB": "AE", "SIN": "SG", "HKG": "HK", "SGN": "VN", "HAN": "VN", "BKK": "TH",
           "LHR": "GB", "MAN": "GB"}


def _lookup(code: Column, table: dict) -> Column:
    expr = None
    for k, v in table.items():
        expr = F.when(code == k, F.lit(v)) if expr is None else expr.when(code == k, F.lit(v))
    return expr


def _iso(epoch: Column) -> Column:
    return F.date_format(F.timestamp_seconds(epoch), "yyyy-MM-dd'T'HH:mm:ss")


def _with_leg_inputs(df: DataFrame, *sides: str) -> DataFrame:
    """Adds to each leg's inputs (``{side}_airports``, …) what all of its segments share, as columns: an expression
    used inside ``transform`` would be worked out again for every use of every element."""
    def of(side: str, name: str) -> Column:
        return F.col(f"{side}_{name}")

    df = df.select("*", *[c for s in sides for c in (
        (F.size(of(s, "airports")) - 1).alias(f"{s}_n"),
        F.transform(of(s, "airports"), lambda a: _lookup(a, COUNTRY)).alias(f"{s}_countries"),
        F.transform(of(s, "airports"), lambda a: _lookup(a, CITY)).alias(f"{s}_cities"))])
    return df.select("*", *[F.floor(of(s, "dur") / of(s, "n")).alias(f"{s}_step") for s in sides])


def _leg(side: str) -> Column:
    airports, countries, cities, carriers, dep0, dur, n, step = (
        F.col(f"{side}_{c}") for c in ("airports", "countries", "cities", "carriers", "dep0", "dur", "n", "step"))
    lay = lambda i: 30 + 12 * i + 6 * (dur % 10)  # noqa: E731  (minutes, multiple of 6)
    mk = F.get(carriers, 0)

    def place(i, city):
        code = F.get(airports, i)
        return F.struct(code.alias("displayCode"), code.alias("flightPlaceId"), city.alias("city"),
                        F.get(countries, i).alias("country"))

    def seg(i):
        dep = dep0 + i * step * 60
        arr = dep0 + ((i + 1) * step - F.when(i < n - 1, lay(i)).otherwise(F.lit(0))) * 60
        fno = (100 + (dur + 37 * i) % 900).cast("string")
        nowhere = F.lit(None).cast("string")
        return F.struct(
            place(i, nowhere).alias("origin"), place(i + 1, nowhere).alias("destination"),
            fno.alias("flightNumber"), ((arr - dep) / 60).cast("int").alias("durationInMinutes"),
            _iso(dep).alias("departure"), _iso(arr).alias("arrival"),
            mk.alias("marketingCarrier"),
            F.struct(mk["name"].alias("name"), mk["alternateId"].alias("alternateId"), fno.alias("flightNumber"),
                     mk["alternateId"].alias("iataCode")).alias("operatingCarrier"))

    segments = F.transform(F.sequence(F.lit(0), n - 1), seg)
    arr_leg = dep0 + dur * 60
    return F.struct(
        place(F.lit(0), F.get(cities, 0)).alias("origin"), place(n, F.get(cities, n)).alias("destination"),
        _iso(dep0).alias("departure"), _iso(arr_leg).alias("arrival"), dur.cast("int").alias("durationInMinutes"),
        F.datediff(F.to_date(F.timestamp_seconds(arr_leg)), F.to_date(F.timestamp_seconds(dep0)))
        .alias("timeDeltaInDays"),
        (n - 1).cast("int").alias("stopCount"),
        F.struct(carriers.alias("marketing"),
                 F.when(F.size(carriers) > 1, F.lit("partially_operated")).otherwise(F.lit("fully_operated"))
                 .alias("operationType")).alias("carriers"),
        segments.alias("segments"))


def _carriers(names: Column) -> Column:
    return F.transform(F.split(names, ", "), lambda x: F.struct(
        x.alias("name"), F.upper(F.substring(x, 1, 2)).alias("alternateId")))


def _itinerary(df_cols, legs: Column) -> Column:
    price, stops = F.col("price_raw"), F.col("stop_count")
    tags = F.filter(F.array(F.when(stops == 0, F.lit("direct")), F.when(price < 300, F.lit("cheap"))),
                    lambda t: t.isNotNull())
    return F.struct(
        F.col("itinerary_id").alias("id"),
        F.struct(price.alias("raw"), F.format_string("£%.2f", price).alias("formatted")).alias("price"),
        F.lit(None).cast("double").alias("score"),
        F.struct((stops < 2).alias("isChangeAllowed"), (stops == 0).alias("isCancellationAllowed")
                 ).alias("farePolicy"),
        (stops == 3).alias("isSelfTransfer"), tags.alias("tags"), legs.alias("legs"))


def _dep0(day: Column) -> Column:
    return F.unix_seconds(day.cast("timestamp")) + 10 * 3600


_RECORD = ("itinerary_id", "price_raw", "stop_count")


def itinerary_documents(itins: DataFrame) -> DataFrame:
    """One search-response JSON document per itinerary (one leg)."""
    rows = itins.select("collected_at", "search_date", *_RECORD, F.split("segment_route", " -> ").alias("out_airports"),
                        _carriers(F.col("carrier_names")).alias("out_carriers"),
                        _dep0(F.col("search_date")).alias("out_dep0"), F.col("duration_minutes").alias("out_dur"))
    rows = _with_leg_inputs(rows, "out")
    doc = F.struct(F.lit(True).alias("status"),
                   F.struct(F.array(_itinerary(None, F.array(_leg("out")))).alias("itineraries")).alias("data"))
    return rows.select("collected_at", "search_date", F.to_json(doc).alias("json"))


def roundtrip_documents(itins: DataFrame) -> DataFrame:
    """One round-trip response per itinerary: the outbound leg and a return
    leg over the reversed airports ``7 + duration % 14`` days later."""
    dur = F.col("duration_minutes")
    rows = itins.select(*_RECORD, F.split("segment_route", " -> ").alias("out_airports"),
                        _carriers(F.col("carrier_names")).alias("out_carriers"),
                        _dep0(F.col("search_date")).alias("out_dep0"), dur.alias("out_dur"))
    rows = rows.select("*", F.reverse("out_airports").alias("ret_airports"), F.reverse("out_carriers").alias("ret_carriers"),
                       (F.col("out_dep0") + (7 + F.col("out_dur") % 14) * 86400 + 3600).alias("ret_dep0"),
                       (F.col("out_dur") + 45).alias("ret_dur"))
    rows = _with_leg_inputs(rows, "out", "ret")
    legs = F.array(_leg("out"), _leg("ret"))
    doc = F.struct(F.lit(True).alias("status"),
                   F.struct(F.array(_itinerary(None, legs)).alias("itineraries")).alias("data"))
    return rows.select(F.to_json(doc).alias("json"))


def calendar_documents(cal: DataFrame) -> DataFrame:
    """Price-calendar responses per (route, collection day, departure month)
    — at most 31 days per document whatever the data size; departures in
    the past carry a null price (dropped by the parser)."""
    price = F.when(F.col("departure_date") >= F.to_date("collected_at"), F.col("price"))
    group = (F.when(F.col("price") < 310, F.lit("low")).when(F.col("price") < 320, F.lit("medium"))
             .otherwise(F.lit("high")))
    day = F.struct(F.date_format("departure_date", "yyyy-MM-dd").alias("day"), price.alias("price"),
                   group.alias("group"))
    g = cal.groupBy("origin", "destination", F.to_date("collected_at").alias("collected_day"),
                    F.trunc("departure_date", "month").alias("month")).agg(
        F.min("collected_at").alias("collected_at"), F.collect_list(day).alias("days"))
    doc = F.struct(F.struct(F.struct(F.col("days").alias("days")).alias("flights")).alias("data"))
    return g.select(F.date_format("collected_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("collected_at"),
                    "origin", "destination", F.to_json(doc).alias("json"))


# --- landing the derived documents as files -------------------------------------------

def landed_documents(spark, sf_dir: str, kind: str, build) -> DataFrame:
    """Calendar response documents (search responses are built as they are read) landed once per input directory under the
    session's shared checkpoint folder, then read back — how real responses
    arrive. Documents without side columns are JSON-lines text; documents
    with side columns (collection time, search date) land as Parquet rows
    holding the JSON text next to them. Reading them back (instead of
    parsing the builder's output in the same plan) also stops the optimizer
    from folding ``from_json(to_json(struct))`` and inlining the builder into
    every parsed column."""
    from .landing import land_once

    docs = build()
    keep = [f.name for f in docs.schema.fields if f.name != "json"]

    def write(path: str) -> None:
        # spread the documents over enough files for a parallel read
        out = docs.repartition(2 * spark.sparkContext.defaultParallelism)
        if keep:
            out.write.mode("overwrite").parquet(path)
        else:
            out.select(F.col("json").alias("value")).write.mode("overwrite").text(path)

    path = land_once(spark, sf_dir, f"responses_{kind}", write)
    if keep:
        return spark.read.schema(docs.schema).parquet(path)
    return spark.read.text(path).select(F.col("value").alias("json"))
