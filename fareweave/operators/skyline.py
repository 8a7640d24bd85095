"""Pareto (skyline) selection: ``pareto_front`` and ``front_numbers`` over (price, duration, stops), all
minimised, and ``skyline`` over any objectives.

``pareto_front`` is exact and without a quadratic self-join:

1. rows collapse to one candidate per distinct (group, price, stops) with
   the minimum duration — anything slower at the same price and stops is
   dominated (or equal, and equal points are re-attached at the end); this
   pre-aggregation is map-side combined, so the windows below see distinct
   values, not rows, however hot a group is;
2. over the candidates of a group ordered by price rank, for every stop
   level ``k`` the best duration among *strictly cheaper* candidates with
   ``stops ≤ k`` is a running ``min`` over ``rangeBetween(unbounded, -1)``;
   a candidate is dominated if that best duration is ≤ its own at its stop
   level, or if at the *same* price a candidate with fewer stops is at
   least as fast, or one with the same stops is faster;
3. survivors are semi-joined back to the rows, so every row equal to a
   front point is kept.

The stop dimension must be a small integer domain. ``levels`` lists it where
the caller has trimmed the rows to it (the reference trims to ``stops ≤ 2``);
left out, it is read from the data, one distinct stop count a row. Rows with
a null objective cannot be compared and are left out. ``peel_fronts`` repeats the step for the
next fronts (a bounded loop of plan extensions).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _front_keys(df: DataFrame, group: Sequence[str], price: str, minutes: str, stops: str,
                levels: Sequence[int]) -> DataFrame:
    g = list(group)
    known = F.col(price).isNotNull() & F.col(minutes).isNotNull() & F.col(stops).isNotNull()
    cand = (df.filter(known).groupBy(*g, price, stops).agg(F.min(minutes).alias("_m")))
    cand = cand.withColumn("_pr", F.dense_rank().over(Window.partitionBy(*g).orderBy(price)))
    cheaper = Window.partitionBy(*g).orderBy("_pr").rangeBetween(Window.unboundedPreceding, -1)
    same = Window.partitionBy(*g).orderBy("_pr").rangeBetween(0, 0)
    dominated = F.lit(False)
    for k in levels:
        best_cheaper = F.min(F.when(F.col(stops) <= k, F.col("_m"))).over(cheaper)
        best_same_fewer = F.min(F.when(F.col(stops) < k, F.col("_m"))).over(same)
        at_k = F.col(stops) == k
        beaten = (F.coalesce(best_cheaper <= F.col("_m"), F.lit(False))
                  | F.coalesce(best_same_fewer <= F.col("_m"), F.lit(False)))
        dominated = dominated | (at_k & beaten)
    # same price and stops but faster is impossible: _m is already the minimum
    keys = (cand.withColumn("_dom", dominated).filter(~F.col("_dom"))
            .select(*g, price, stops, F.col("_m").alias(minutes)))
    return keys


def _levels(df: DataFrame, stops: str, levels: Sequence[int] | None) -> list:
    """The stop counts to compare: as given, or those that occur."""
    if levels is not None:
        return list(levels)
    return df.agg(F.sort_array(F.collect_set(stops))).first()[0]


def pareto_front(df: DataFrame, group: Sequence[str], price: str = "price_raw",
                 minutes: str = "duration_minutes", stops: str = "stop_count",
                 levels: Sequence[int] | None = None) -> DataFrame:
    """Rows of ``df`` on the first non-dominated front of their group."""
    keys = _front_keys(df, group, price, minutes, stops, _levels(df, stops, levels))
    return df.join(keys, [*group, price, stops, minutes], "left_semi")


def peel_fronts(df: DataFrame, group: Sequence[str], k: int, price: str = "price_raw",
                minutes: str = "duration_minutes", stops: str = "stop_count",
                levels: Sequence[int] | None = None) -> DataFrame:
    """Rows of the first ``k`` fronts with their 0-based ``front`` index."""
    on = [*group, price, stops, minutes]
    levels = _levels(df, stops, levels)
    rest = df
    out = None
    for i in range(k):
        keys = _front_keys(rest, group, price, minutes, stops, levels)
        front = rest.join(keys, on, "left_semi").withColumn("front", F.lit(i))
        out = front if out is None else out.unionByName(front)
        rest = rest.join(keys, on, "left_anti")
    return out


# --- any objectives: partitioned skyline --------------------------------------

def skyline(df: DataFrame, group: Sequence[str], objectives: Sequence[str], maximise: Sequence[str] = (),
            buckets: int = 16, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Rows of ``df`` that no row of their group dominates: better or equal in all ``objectives`` (numbers or dates; small
    is better, but for those in ``maximise``) and better in one. Equal rows all stay; rows with a null or NaN objective
    can't be compared and are left out; null group keys are a group.

    Every task that reads rows first drops the points that others of its own dominate (``_candidates``), so that few are
    shuffled. Each group's points are dealt over ``buckets`` by hash, every bucket finds its own skyline, and what
    survives is compared once more per group, so a hot group is worked by many tasks and only local survivors meet. Each
    task reads its points sorted, where a point can only be dominated by one before it, and holds no more than the
    skyline so far: there is no join of points with points. ``keep`` may write the skyline's points and give them back,
    so that the rows are joined to a table of known size.
    """
    group, objectives = list(group), list(objectives)
    names = [f"_o{k}" for k in range(len(objectives))]
    keys = [f"_g{k}" for k in range(len(group))]

    def number(c: str):
        x = F.unix_date(c) if dict(df.dtypes)[c] == "date" else F.col(c)
        x = x.cast("double")
        return -x if c in maximise else x

    rows = df.select("*", *[F.col(c).alias(k) for c, k in zip(group, keys)],
                     *[number(c).alias(n) for c, n in zip(objectives, names)])
    known = F.lit(True)
    for n in names:
        known = known & F.col(n).isNotNull() & ~F.isnan(n)
    rows = rows.filter(known)
    one = F.struct(*keys) if keys else F.lit(0)
    points = _candidates(rows.select(*keys, *names), keys, names)
    points = points.select("*", F.xxhash64(one).alias("_key")).distinct()
    points = points.withColumn("_bucket", F.pmod(F.xxhash64(*names), F.lit(buckets)).cast("int"))
    local = _local_skylines(points, [*keys, "_key", "_bucket"], keys, names)
    whole = _local_skylines(local.withColumn("_bucket", F.lit(0)), [*keys, "_key", "_bucket"], keys, names)
    front = whole.drop("_key", "_bucket")
    if keep is not None:
        front = keep(front)
    on = F.lit(True)
    for c in [*keys, *names]:
        on = on & rows[c].eqNullSafe(front[c])
    return rows.join(front, on, "left_semi").select(*df.columns)


#: Points a task holds at most per group, and of all its groups, before it passes them on.
GROUP_POINTS, TASK_POINTS = 4096, 200_000


def _undominated(points, window):
    """Mask of the ``points`` that no point of ``window`` is at least as good as. Pieces of the window: most points fall to
    its first ones."""
    import numpy as np

    left = np.arange(len(points))
    for first in range(0, len(window), 64):
        part, rest = window[first:first + 64], points[left]
        beaten = part[:, 0] <= rest[:, :1]
        for k in range(1, points.shape[1]):
            beaten &= part[:, k] <= rest[:, k:k + 1]
        left = left[~beaten.any(axis=1)]
    alive = np.zeros(len(points), bool)
    alive[left] = True
    return alive


def _skyline_of(points):
    """The distinct points of an array that no other of it dominates, sorted."""
    import numpy as np

    points, window = np.unique(points, axis=0), points[:0]
    for first in range(0, len(points), 256):  # none dominates one before it
        block = points[first:first + 256]
        block = block[_undominated(block, window)]
        at_least = (block[None, :, :] <= block[:, None, :]).all(axis=2)
        window = np.concatenate([window, block[~np.tril(at_least, -1).any(axis=1)]])
    return window


def _candidates(rows: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """``rows`` (``keys`` and the numbers ``names``) without repeated points and without most that another row of the same
    task and group dominates. A task holds at most ``TASK_POINTS`` points and ``GROUP_POINTS`` of a group; beyond that it
    passes on what it has and begins anew, so some dominated points may come through, but none is lost."""
    import numpy as np
    import pyarrow as pa

    keys, names, group_points, task_points = list(keys), list(names), GROUP_POINTS, TASK_POINTS

    def run(batches):
        held, fresh, schema = {}, {}, None  # per group: its skyline so far; points not yet compared with each other

        def out(tag):
            points = _skyline_of(np.concatenate([held.pop(tag), *fresh.pop(tag)]))
            columns = [pa.array([v] * len(points), schema.field(c).type) for c, v in zip(keys, tag)]
            return pa.RecordBatch.from_arrays([*columns, *(pa.array(points[:, k]) for k in range(len(names)))],
                                              [*keys, *names])

        for batch in batches:
            if not batch.num_rows:
                continue
            schema = batch.schema
            codes = np.zeros(batch.num_rows, np.int64)
            for c in keys:
                column = batch.column(c).dictionary_encode(null_encoding="encode")
                codes = np.unique(codes * len(column.dictionary) + column.indices.to_numpy(), return_inverse=True)[1]
            values = np.column_stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names])
            order = np.argsort(codes, kind="stable")
            starts = np.flatnonzero(np.diff(codes[order], prepend=-1))
            tags = batch.select(keys).take(pa.array(order[starts])).to_pylist()
            for tag, at in zip(tags, np.split(order, starts[1:])):
                tag = tuple(tag.values())
                window = held.setdefault(tag, values[:0])
                new = fresh.setdefault(tag, [])
                new.append(values[at[_undominated(values[at], window)]])
                if sum(map(len, new)) > max(256, len(window)):
                    held[tag], fresh[tag] = _skyline_of(np.concatenate([window, *new])), []
                    if len(held[tag]) > group_points:
                        yield out(tag)
            if sum(map(len, held.values())) + sum(len(a) for new in fresh.values() for a in new) > task_points:
                for tag in list(held):
                    yield out(tag)
        for tag in list(held):
            yield out(tag)

    return rows.mapInArrow(run, rows.schema)


def _local_skylines(points: DataFrame, by: Sequence[str], keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """The skyline of each ``by`` group of distinct points."""
    import numpy as np
    import pyarrow as pa

    names, by = list(names), list(by)

    def run(batches):
        held, window = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            tags = [tuple(r.values()) for r in batch.select(by).to_pylist()]
            values = np.column_stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names])
            keep = np.zeros(batch.num_rows, bool)
            starts = [k for k in range(len(tags)) if not k or tags[k] != tags[k - 1]] + [len(tags)]
            for a, b in zip(starts, starts[1:]):
                if tags[a] != held:
                    held, window = tags[a], np.empty((0, len(names)))
                for first in range(a, b, 256):  # a block against the skyline so far, then in its own order
                    block = values[first:min(first + 256, b)]
                    alive = np.ones(len(block), bool)
                    for w in range(0, len(window), 4096):
                        part = window[w:w + 4096]
                        alive &= ~(part[None, :, :] <= block[:, None, :]).all(axis=2).any(axis=1)
                    block_at = np.flatnonzero(alive)
                    inner = block[block_at]
                    beaten = np.tril((inner[None, :, :] <= inner[:, None, :]).all(axis=2), -1).any(axis=1)
                    window = np.concatenate([window, inner[~beaten]])
                    keep[first + block_at[~beaten]] = True
            yield batch.filter(pa.array(keep))

    dealt = points.repartition(*[c for c in by if c not in keys]).sortWithinPartitions(*by, *names)
    return dealt.mapInArrow(run, points.schema)


# --- the front number of every row ---------------------------------------------

def front_numbers(df: DataFrame, group: Sequence[str], price: str = "price_raw", minutes: str = "duration_minutes",
                  stops: str = "stop_count") -> DataFrame:
    """``df`` with ``front``: 0 for the first non-dominated front of its group, 1 for the next, … for every row that
    has all three objectives (others are left out).

    A row's front is the length of the longest chain of points dominating it. Distinct points of a group are swept in
    the order (price, minutes, stops), where all that dominate a point come before it. For every stop count the sweep
    keeps the least minutes of each front among points with no more stops; these rise with the front, so a point's
    front is found by bisection. A task reads its sorted points as a stream and holds one number per stop count and
    front, never a group. Points of one group follow each other, so one group is one task's sweep over its distinct
    points.
    """
    from bisect import bisect_right

    import pyarrow as pa

    group = list(group)
    keys = [f"_g{k}" for k in range(len(group))]
    known = F.col(price).isNotNull() & F.col(minutes).isNotNull() & F.col(stops).isNotNull()
    rows = df.filter(known).select("*", *[F.col(c).alias(k) for c, k in zip(group, keys)],
                                   F.col(price).cast("double").alias("_p"), F.col(minutes).cast("double").alias("_m"),
                                   F.col(stops).cast("double").alias("_s"))
    one = F.struct(*keys) if keys else F.lit(0)
    points = rows.select(*keys, "_p", "_m", "_s", F.xxhash64(one).alias("_key")).distinct()
    schema = T.StructType([*points.schema.fields, T.StructField("front", T.IntegerType())])

    def run(batches):
        held, best = None, {}
        for batch in batches:
            fronts = []
            for row in batch.select(["_key", *keys, "_m", "_s"]).to_pylist():
                *tag, m, s = row.values()
                if tag != held:
                    held, best = tag, {}
                if s not in best:  # as the nearest lower stop count so far has it
                    lower = [k for k in best if k < s]
                    best[s] = list(best[max(lower)]) if lower else []
                front = bisect_right(best[s], m)
                fronts.append(front)
                for k, least in best.items():
                    if k >= s:
                        if front == len(least):
                            least.append(m)
                        elif m < least[front]:
                            least[front] = m
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fronts, pa.int32())],
                                             [*batch.schema.names, "front"])

    swept = points.repartition("_key").sortWithinPartitions("_key", *keys, "_p", "_m", "_s").mapInArrow(run, schema)
    on = F.lit(True)
    for c in [*keys, "_p", "_m", "_s"]:
        on = on & rows[c].eqNullSafe(swept[c])
    return rows.join(swept, on).select(*[rows[c] for c in df.columns], "front")
