"""Skylines over any objectives and front numbers against brute force."""

import datetime as dt

import numpy as np
import pytest

from fareweave.operators import skyline as SK

SCHEMA = "id int, g string, price_raw double, duration_minutes int, stop_count int, d date"


def rows(seed=0, n=400):
    rng = np.random.default_rng(seed)
    day = dt.date(2024, 1, 1)
    out = [(k, [None, "a", "b", "b", "b"][int(rng.integers(5))], float(rng.integers(30)), int(rng.integers(20)),
            int(rng.integers(4)), day + dt.timedelta(int(rng.integers(6)))) for k in range(n)]
    out += [(n, "a", None, 1, 1, day), (n + 1, "a", 1.0, None, 1, day), (n + 2, "c", 1.0, 1, 1, None),
            (n + 3, "lone", 5.0, 5, 5, day), (n + 4, "lone", 5.0, 5, 5, day), (n + 5, "b", float("nan"), 0, 0, day)]
    return out


def beats(a, b):
    return all(x <= y for x, y in zip(a, b)) and a != b


def usable(r, cols):
    return all(r[c] is not None and r[c] == r[c] for c in cols)


@pytest.mark.parametrize("buckets", [1, 5])
def test_skyline_of_four_objectives(spark, buckets):
    data = rows()
    pts = [(r[0], r[1], (r[2], r[3], r[4], -r[5].toordinal())) for r in data if usable(r, (2, 3, 4, 5))]
    want = sorted(i for i, g, p in pts if not any(h == g and beats(q, p) for _, h, q in pts))
    df = spark.createDataFrame(data, SCHEMA)
    sky = SK.skyline(df, ["g"], ["price_raw", "duration_minutes", "stop_count", "d"], maximise=["d"], buckets=buckets)
    assert sky.columns == df.columns
    assert sorted(r.id for r in sky.collect()) == want
    plan = sky._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_skyline_without_a_group_and_of_an_empty_table(spark):
    df = spark.createDataFrame([(k, 9 - k % 4) for k in range(12)] + [(0, 99)], "a int, b int")
    assert sorted(tuple(r) for r in SK.skyline(df, [], ["a", "b"]).collect()) == [(0, 9), (1, 8), (2, 7), (3, 6)]
    assert SK.skyline(df.limit(0), ["a"], ["b"]).count() == 0


@pytest.mark.parametrize("held", [(1, 3), (2, 10_000), (4096, 200_000)])
def test_few_points_are_shuffled_and_none_is_lost(spark, monkeypatch, held):
    """Tasks drop what their own rows dominate; with any bound on what they hold, the skyline is the same."""
    monkeypatch.setattr(SK, "GROUP_POINTS", held[0])
    monkeypatch.setattr(SK, "TASK_POINTS", held[1])
    data = [r for r in rows(5, 3_000) if usable(r, (2, 3, 4, 5))]
    pts = {(r[1], float(r[2]), float(r[3]), float(r[4]), -float(r[5].toordinal())) for r in data}
    want = {p for p in pts if not any(q[0] == p[0] and beats(q[1:], p[1:]) for q in pts)}
    df = spark.createDataFrame(data, SCHEMA).repartition(2)
    points = df.selectExpr("g", "price_raw as p", "cast(duration_minutes as double) as m", "cast(stop_count as double) as s",
                           "cast(-unix_date(d) - 719163 as double) as d")
    kept = {tuple(r) for r in SK._candidates(points, ["g"], ["p", "m", "s", "d"]).collect()}
    assert want <= kept <= pts
    if held[0] == 4096:
        assert len(kept) < len(pts) / 4
    sky = SK.skyline(df, ["g"], ["price_raw", "duration_minutes", "stop_count", "d"], maximise=["d"])
    assert {(r.g, r.price_raw, r.duration_minutes, r.stop_count, -r.d.toordinal()) for r in sky.collect()} == want


def test_front_number_of_every_row(spark):
    data = [r for r in rows(2) if r[2] is None or r[2] == r[2]]
    left = {r[0]: (r[1], (r[2], r[3], r[4])) for r in data if usable(r, (2, 3, 4))}
    want, front = {}, 0
    while left:
        now = [i for i, (g, p) in left.items() if not any(h == g and beats(q, p) for h, q in left.values())]
        want |= dict.fromkeys(now, front)
        for i in now:
            del left[i]
        front += 1
    got = {r.id: r.front for r in SK.front_numbers(spark.createDataFrame(data, SCHEMA), ["g"]).collect()}
    assert got == want and front > 5
    assert SK.front_numbers(spark.createDataFrame([], SCHEMA), ["g"]).count() == 0
