"""Stored partial aggregates, kernel density, stored samples and daily collection."""

import datetime as dt
import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareweave.operators import distribution as D
from fareweave.operators import partials as PA
from fareweave.operators import sample as SM
from fareweave.sources import daily as DY


def test_partials_merge_to_the_whole(spark):
    rng = np.random.default_rng(4)
    rows = [(2000 + k % 2, 1 + k % 4, "ab"[k % 3 == 0], None if k % 50 == 0 else 1e9 + float(rng.normal()), f"d{k % 700}")
            for k in range(4000)] + [(2001, 1, "lone", 5.0, "x"), (2001, 1, "none", None, None)]
    df = spark.createDataFrame(rows, "Year int, Quarter int, g string, v double, d string")
    parts = PA.partial_aggregates(df, ["g"], ["v"], ["d"])
    got = {r.g: r for r in PA.combine_partials(parts, ["g"], ["v"], ["d"], (0.1, 0.5)).collect()}
    for g in "ab":
        v = [r[3] for r in rows if r[2] == g and r[3] is not None]
        r = got[g]
        assert (r.rows, r.v_count, r.v_min, r.v_max) == (sum(x[2] == g for x in rows), len(v), min(v), max(v))
        assert math.isclose(r.v_sum, math.fsum(v)) and math.isclose(r.v_std, statistics.stdev(v), rel_tol=1e-6)
        for q, found in ((0.1, r.v_q0), (0.5, r.v_q1)):
            assert abs(sum(x <= found for x in v) / len(v) - q) <= 2 * PA.QUANTILE_ERROR
        distinct = len({x[4] for x in rows if x[2] == g})
        assert abs(r.d_nunique - distinct) <= 4 * PA.DISTINCT_ERROR * distinct
    assert got["lone"].v_std is None and got["lone"].v_mean == 5.0 and got["lone"]._unit_count == 1
    assert got["none"].v_count == 0 and got["none"].v_mean is None and got["none"].rows == 1


def test_kernel_density_is_a_smoothed_share(spark):
    df = spark.createDataFrame([("a", 10.0)] * 30 + [("a", 20.0)] * 10 + [("one", 3.0), ("flat", 7.0), ("flat", 7.0), (None, 1.0),
                               ("a", None), ("a", 500.0)], "g string, v double")
    got = D.kernel_density(df, "v", "g", 40, 0.0, 40.0, upper=40.0).collect()
    v = [10.0] * 30 + [20.0] * 10 + [40.0]
    h = statistics.stdev(v) * len(v) ** -0.2
    bins = [min(int(x), 39) for x in v]
    raw = [sum(math.exp(-(((b - k) / h) ** 2) / 2) for b in bins) for k in range(40)]
    a = {r.bin: r for r in got if r.g == "a"}
    assert all(math.isclose(a[k].share, raw[k] / sum(raw), rel_tol=1e-9) and a[k].x == k + 0.5 for k in range(40))
    assert {r.g for r in got} == {"a", "one", "flat"} and len(got) == 120


def test_stored_sample_is_nested_and_column_pruned(spark, tmp_path):
    df = spark.createDataFrame([(k, k % 3, float(k)) for k in range(3000)], "id long, s int, v double")
    path = str(tmp_path / "sample")
    SM.store_sample(df, path, ["s"], "id", 0.2)
    whole = {r.id for r in SM.load_sample(spark, path).collect()}
    assert whole == {r.id for r in SM.exact_sample(df, ["s"], "id", 0.2).collect()} and len(whole) == 600
    part = SM.load_sample(spark, path, ["id"], 0.05)
    assert {r.id for r in part.collect()} == {r.id for r in SM.exact_sample(df, ["s"], "id", 0.05).collect()}
    plan = SM.load_sample(spark, path, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan
    assert SM.load_sample(spark, path).columns == ["id", "v", "s"]
    with pytest.raises(ValueError):
        SM.ranked_sample(df, ["s"], "id", 1.5)


def test_days_are_collected_once_unless_forced(spark, tmp_path):
    day = [dt.date(2024, 1, d) for d in (1, 2, 4)]
    df = spark.createDataFrame([(k, d) for k, d in enumerate(day)] + [(9, None)], "n int, collected_date date")
    path = str(tmp_path / "days")
    assert DY.landed_days(spark, path) == []
    assert DY.collect_once(df.filter(F.col("collected_date") == F.lit(day[0])), path) == day[:1]
    assert DY.collect_once(df, path) == day[1:] and DY.collect_once(df, path) == []
    assert DY.collect_once(df, path, force=[day[1]]) == [day[1]]
    got = {r[0]: r[1] for r in spark.read.parquet(path).groupBy("collected_date").count().collect()}
    assert got == {day[0]: 1, day[1]: 2, day[2]: 1}
    left = DY.days_to_collect(spark, path, dt.date(2023, 12, 31), dt.date(2024, 1, 5)).collect()
    assert [r.day.day for r in left] == [31, 3, 5]
