"""Edge frames of operators that were mended: history without a cut, causal fill, zero baselines, many routes."""

from __future__ import annotations

from pyspark.sql import functions as F

from fareweave.functions.arrays import parse_list_text
from fareweave.operators import models, timeseries, tracks


def test_old_observation_is_history(spark):
    history = spark.sql("select 'A-B' route, date'2024-06-01' departure_date, timestamp'2024-01-01 00:00:00' collected_at, 90.0D price")
    asked = spark.sql("select 'A-B' route, date'2024-06-01' departure_date, date'2024-03-01' as_of")
    r = timeseries.last_n_features(history, asked, keys=("route", "departure_date")).first()
    assert r.has_history and r.price_lag1 == 90.0


def test_zero_baseline_gives_no_alert(spark):
    t = spark.sql("""select 1 id, 7 user_id, 'A' origin, 'B' destination, date'2024-06-01' departure_date,
                  0.0D baseline_price, true active""")
    p = spark.sql("select 'A' origin, 'B' destination, date'2024-06-01' departure_date, timestamp'2024-01-01 00:00:00' collected_at, 5.0D price")
    assert tracks.alerts(t, p).count() == 0


def test_list_text_keeps_apostrophes(spark):
    df = spark.createDataFrame([('["O\'Hare", "LHR"]',), ("['A', 'B']",), ("junk",), (None,)], "t string")
    assert [r[0] for r in df.select(parse_list_text("t")).collect()] == [["O'Hare", "LHR"], ["A", "B"], [], []]


def test_bins_hold_every_route(spark):
    assert models.bins_for(spark.range(70).select(F.col("id").cast("string").alias("route"))) == 72


def test_causal_fill_uses_earlier_rows_of_the_route(spark):
    rows = [("A-B", "2024-06-01", "2024-01-01", 100.0), ("A-B", "2024-07-01", "2024-01-02", 50.0)]
    df = spark.createDataFrame(rows, "route string, departure_date string, collected_date string, price double").select(
        "route", F.to_date("departure_date").alias("departure_date"), F.to_date("collected_date").alias("collected_date"),
        "price")
    name = next(n for n in dir(timeseries) if callable(getattr(timeseries, n)) and "causal" in getattr(
        getattr(timeseries, n), "__code__", type("c", (), {"co_varnames": ()})).co_varnames)
    got = {str(r.collected_date): r.price_lag1 for r in getattr(timeseries, name)(df, causal=True).collect()}
    assert got == {"2024-01-01": None, "2024-01-02": 100.0}


def test_dates_without_leading_zeros_are_valid(spark):
    from fareweave.operators.validate import _parse_day
    df = spark.createDataFrame([("2024-9-5",), ("2024-09-05",), ("2024-13-01",)], "d string")
    assert [str(r[0]) for r in df.select(_parse_day(F.col("d"))).collect()] == ["2024-09-05", "2024-09-05", "None"]


def test_csv_rows_do_not_depend_on_the_columns(spark, tmp_path):
    """Good and rejected lines together are all lines, whatever columns are asked for."""
    from fareweave.sources import files
    folder = tmp_path / "csv" / "Year=1996" / "Quarter=1"
    folder.mkdir(parents=True)
    names = [n for n, _ in files.MARKET_FIELDS]
    good = ["1" if n != "MktID" else "m" for n in names]
    bad = ["bad" if n == "MktFare" else v for n, v in zip(names, good)]
    unnamed = ["" if n == "ItinID" else v for n, v in zip(names, good)]
    lines = [names, good, good, good, bad, unnamed]
    (folder / "part.csv").write_text("".join(",".join(v) + ",\n" for v in lines))
    path = str(tmp_path / "csv")
    for columns in (None, ["MktID"], ["Year", "Quarter"], ["MktID", "MktFare"]):
        rows = files.read_market_csv(spark, path, columns)
        assert (len(rows.collect()), rows.count()) == (3, 3), columns
    rejects = files.read_market_csv(spark, path, with_rejects=True)[1]
    assert len(rejects.collect()) == 2


def test_constant_columns_of_a_whole_table(spark):
    """One value, or none but nulls, is constant; two values are not."""
    from fareweave.operators.clean import column_constancy, constant_columns
    df = spark.createDataFrame([(1, "a", None), (1, "b", None), (1, None, None)], "one int, two string, none string")
    assert {r[0] for r in constant_columns(df).collect()} == {"one", "none"}
    assert {tuple(r) for r in column_constancy(df).collect()} == {("one", 3, True), ("two", 2, False), ("none", 0, True)}
    assert all(r.constant and r.n_values == 0 for r in column_constancy(df.limit(0)).collect())
    assert "Expand" not in constant_columns(df)._jdf.queryExecution().executedPlan().toString()
