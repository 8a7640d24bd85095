"""Airport and route dimension tables (literal, tiny, broadcast by design).

The same literals render as a DuckDB ``VALUES`` list for the oracles, so the
two engines never disagree on the dimension data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: airport code → (latitude, longitude), as listed by the reference
AIRPORTS = [
    ("LHR", 51.4700, -0.4543), ("MAN", 53.3537, -2.2750),
    ("SGN", 10.8188, 106.6520), ("HAN", 21.2212, 105.8072),
    ("BKK", 13.6900, 100.7501),
    ("ZRH", 47.4647, 8.5492), ("SIN", 1.3644, 103.9915),
    ("AUH", 24.4330, 54.6511), ("VIE", 48.1103, 16.5697),
    ("HKG", 22.3080, 113.9185), ("DXB", 25.2532, 55.3657),
    ("DOH", 25.2731, 51.6080), ("IST", 41.2753, 28.7519),
    ("FRA", 50.0379, 8.5622), ("CDG", 49.0097, 2.5479),
    ("AMS", 52.3105, 4.7683), ("HEL", 60.3172, 24.9633),
    ("KUL", 2.7456, 101.7099), ("CGK", -6.1256, 106.6558),
    ("DEL", 28.5562, 77.1000), ("BOM", 19.0896, 72.8656),
    ("MUC", 48.3538, 11.7861),
    ("BGY", 45.6739, 9.7042), ("MXP", 45.6306, 8.7281),
    ("BVA", 49.4544, 2.1128), ("CRL", 50.4592, 4.4538),
    ("DUB", 53.4213, -6.2701), ("ASB", 37.9687, 58.3610),
    ("STN", 51.8850, 0.2350), ("LGW", 51.1537, -0.1821),
    ("BCN", 41.2971, 2.0785), ("MAD", 40.4719, -3.5626),
    ("WAW", 52.1657, 20.9671), ("SVO", 55.9726, 37.4146),
    ("TAS", 41.2579, 69.2812), ("ALA", 43.3521, 77.0405),
    ("CAN", 23.3924, 113.2988), ("PVG", 31.1443, 121.8083),
    ("ICN", 37.4602, 126.4407), ("TPE", 25.0777, 121.2328),
    ("KMG", 25.1019, 102.9292), ("REP", 13.4107, 103.8130),
    ("PNH", 11.5466, 104.8441),
]

# fixed values: collected routes (origin, destination, origin city, destination
# city, great-circle miles, active). The reference lists BKK→MAN with
# the two city names swapped; they are given the right way round here.
ROUTES = [
    ("MAN", "SGN", "Manchester", "Ho Chi Minh City", 5940, True),
    ("MAN", "HAN", "Manchester", "Hanoi", 5590, True),
    ("MAN", "BKK", "Manchester", "Bangkok", 5890, True),
    ("SGN", "MAN", "Ho Chi Minh City", "Manchester", 5940, True),
    ("HAN", "MAN", "Hanoi", "Manchester", 5590, True),
    ("BKK", "MAN", "Bangkok", "Manchester", 5890, True),
    ("LHR", "SGN", "London", "Ho Chi Minh City", 5980, True),
    ("LHR", "HAN", "London", "Hanoi", 5630, True),
    ("LHR", "BKK", "London", "Bangkok", 5930, True),
    ("SGN", "LHR", "Ho Chi Minh City", "London", 5980, True),
    ("HAN", "LHR", "Hanoi", "London", 5630, True),
    ("BKK", "LHR", "Bangkok", "London", 5930, True),
    ("LHR", "SIN", "London", "Singapore", 6760, False),
    ("LHR", "DAD", "London", "Da Nang", 5770, False),
]

AIRPORT_SCHEMA = "code string, lat double, lon double"
ROUTE_SCHEMA = ("origin string, destination string, origin_city string, dest_city string, "
                "distance_miles int, active boolean")


def airports(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(AIRPORTS, AIRPORT_SCHEMA)


def routes(spark: SparkSession, active_only: bool = True) -> DataFrame:
    df = spark.createDataFrame(ROUTES, ROUTE_SCHEMA)
    return df.filter(F.col("active")) if active_only else df


def _sql_lit(v) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, float):
        return f"{v!r}e0" if "e" not in repr(v) else repr(v)
    return f"cast({v} as int)" if isinstance(v, int) else str(v)


def values_sql(rows, names) -> str:
    body = ", ".join("(" + ", ".join(_sql_lit(v) for v in r) + ")" for r in rows)
    return f"select * from (values {body}) t({', '.join(names)})"


DUCKDB_AIRPORTS = values_sql(AIRPORTS, ["code", "lat", "lon"])
DUCKDB_ROUTES = values_sql(ROUTES, ["origin", "destination", "origin_city", "dest_city",
                                    "distance_miles", "active"]) + " where active"
