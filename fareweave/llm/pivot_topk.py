"""Exact top-k by inner product with a pivot-distance index.

One more component sqrt(M - |x|^2) (M: the largest squared length of a row; 0 for a query) makes the largest inner
product the smallest Euclidean distance: d(q, x)^2 = |q|^2 + M - 2 <q, x>. Every row is keyed by its nearest pivot and
its distance to it. A pivot's rows are cut by that distance into rings of about equal size (approximate quantiles),
and a ring that ties make too large by hash into parts of a bounded size; a part's rows are sorted by the distance.
A query starts at its own distance to the pivot and expands sorted annuli outwards on both sides; by the triangle
inequality a row at distance s from the pivot is at least |d(q, pivot) - s| away, so a side stops when that is more
than the k-th best distance. A first round over one part of the ring nearest to each query bounds the k-th best
distance, and the second round goes to the parts of the other rings only where the bound doesn't exclude the ring.
Queries pass a part one batch after another, and many queries meet copies of it in several groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import key_pieces, materialize
from .vectors import finite

#: A pivot for every so many rows up to a largest number; about the rows of a ring and of a part, and the largest number
#: of rings of a pivot (so that the table of rings, which every task holds, has a bound).
CELL_ROWS = 256
MAX_PIVOTS = 256
PART_ROWS = 4096
MAX_RINGS = 1024
#: Rows taken by a query at a time, and about how many queries share one copy of a part.
STEP = 512
VISIT_ROWS = 4096
#: Relative rounding of the distances, on the safe side of every bound.
SLACK = 1e-9


class Annuli:
    """Rows of one part of a pivot, sorted by their distance to it."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, distance: np.ndarray, longest: float) -> None:
        order = np.lexsort((ids, distance))
        self.ids, self.rows, self.distance, self.longest = ids[order], rows[order], distance[order], longest

    def search(self, own: int, query: np.ndarray, at: float, k: int, bound: float) -> list[tuple[int, int]]:
        """The best ``(score, id)`` for ``query``, whose distance to the pivot is ``at``, of those that reach ``bound``."""
        square = float(query @ query) + self.longest
        best_s, best_i = np.zeros(0), np.zeros(0, np.int64)
        low = high = int(np.searchsorted(self.distance, at))
        reach = self._reach(square, bound)
        while True:
            down = low > 0 and at - self.distance[low - 1] <= reach
            up = high < len(self.ids) and self.distance[high] - at <= reach
            if not down and not up:
                return [(int(s), int(i)) for s, i in zip(best_s, best_i) if s >= bound]
            if down and (not up or at - self.distance[low - 1] <= self.distance[high] - at):
                a, b = max(0, low - STEP), low
                low = a
            else:
                a, b = high, min(len(self.ids), high + STEP)
                high = b
            keep = self.ids[a:b] != own
            s = np.concatenate([best_s, (self.rows[a:b] @ query)[keep]])
            i = np.concatenate([best_i, self.ids[a:b][keep]])
            order = np.lexsort((i, -s))[:k]
            best_s, best_i = s[order], i[order]
            if len(best_s) == k:
                reach = self._reach(square, max(bound, float(best_s[-1])))

    def _reach(self, square: float, score: float) -> float:
        """The distance of a row with this score (further rows score less)."""
        if score == -np.inf:
            return np.inf
        return float(np.sqrt(max(square - 2 * score, 0.0)) + SLACK * np.sqrt(square + self.longest) + 1e-6)


def _place(rows: DataFrame, pivots: np.ndarray, longest: float) -> DataFrame:
    """``id, vec`` with the nearest pivot and the distance to it."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = np.stack(batch["vec"].tolist())
                d = _distances(x, np.sqrt(np.maximum(longest - (x * x).sum(axis=1), 0)), pivots)
                yield batch[["id", "vec"]].assign(pivot=d.argmin(axis=1).astype(np.int32), distance=d.min(axis=1))

    return rows.mapInPandas(run, "id long, vec array<double>, pivot int, distance double")


def _distances(x: np.ndarray, extra: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of the augmented rows to the (augmented) pivots."""
    full = np.concatenate([x, extra[:, None]], axis=1)
    square = (full * full).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None, :] - 2 * full @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def _visit(index: DataFrame, visits: DataFrame, k: int, longest: float) -> DataFrame:
    """``query_id, score, vec_id``: each visit's best rows of its part. A part's rows come first in its group, then the
    visits in batches; only parts that are visited are sent, one copy for each share of the queries that visits them."""
    keys = ["pivot", "ring", "part", "share"]
    met = visits.select(*keys).distinct()
    both = index.join(met, ["pivot", "ring", "part"]).select(
        *keys, F.lit(0).alias("kind"), "id", "vec", "distance", F.lit(None).cast("double").alias("bound")).unionByName(
        visits.select(*keys, F.lit(1).alias("kind"), "id", "vec", "distance", "bound"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: tuple | None = None
        rows: list[pd.DataFrame] = []
        part = None
        for (*key, kind), piece in key_pieces(batches, [*keys, "kind"]):
            if kind == 0:
                if held != tuple(key):
                    held, rows, part = tuple(key), [], None
                rows.append(piece)
                continue
            if held != tuple(key):
                continue
            if part is None:
                own = pd.concat(rows)
                part = Annuli(own["id"].to_numpy(), np.stack(own["vec"].tolist()), own["distance"].to_numpy(), longest)
                rows = []
            out = [(q, s, i) for q, vec, at, bound in piece[["id", "vec", "distance", "bound"]].itertuples(index=False)
                   for s, i in part.search(q, np.asarray(vec), at, k, -np.inf if bound is None or np.isnan(bound) else bound)]
            if out:
                yield pd.DataFrame(out, columns=["query_id", "score", "vec_id"])

    order = [*keys, "kind"]
    return both.repartition(*keys).sortWithinPartitions(*order).select(
        *order, "id", "vec", "distance", "bound").mapInPandas(run, "query_id long, score long, vec_id long")


class Rings:
    """The rings of all pivots: distances they span, rows and parts. At most MAX_PIVOTS * MAX_RINGS."""

    def __init__(self, table: pd.DataFrame) -> None:
        table = table.sort_values(["pivot", "ring"])
        self.pivot, self.ring, self.parts = (table[c].to_numpy(np.int64) for c in ("pivot", "ring", "parts"))
        self.low, self.high = table["low"].to_numpy(float), table["high"].to_numpy(float)
        self.rows = table["n"].to_numpy(np.int64) // self.parts

    def start(self, d: np.ndarray, k: int) -> int:
        """The ring nearest to a query with these distances to the pivots, of those with rows enough for a bound."""
        gap = self.gap(d)
        return int(np.lexsort((self.ring, d[self.pivot], gap, self.rows < 2 * k))[0])

    def gap(self, d: np.ndarray) -> np.ndarray:
        at = d[self.pivot]
        return np.maximum(np.maximum(self.low - at, at - self.high), 0.0)

    def able(self, d: np.ndarray, square: float, bound: float) -> np.ndarray:
        """The rings that can hold a row scoring ``bound``: a row scores at most (|q|^2 + M - gap^2) / 2."""
        gap = self.gap(d) * (1 - SLACK)
        return np.flatnonzero((square - gap * gap) / 2 + 1e-3 >= bound)


def _plan(asked: DataFrame, pivots: np.ndarray, rings: Rings, longest: float, k: int, first: bool) -> DataFrame:
    """Visits of the queries: one part each (``first``), or all other parts of the rings that ``bound`` leaves open."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for query, vec, share, bound in batch[["id", "vec", "share", "bound"]].itertuples(index=False):
                x = np.asarray(vec, float)
                d = _distances(x[None, :], np.zeros(1), pivots)[0]
                own = rings.start(d, k)
                if first:
                    ring, part = np.array([own]), np.zeros(1, np.int64)
                else:
                    limit = -np.inf if bound is None or np.isnan(bound) else bound
                    ring = rings.able(d, float(x @ x) + longest, limit)
                    n = rings.parts[ring]
                    part = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    ring = np.repeat(ring, n)
                    other = (ring != own) | (part != 0)
                    ring, part = ring[other], part[other]
                for at in range(0, len(ring), 10_000):
                    r = ring[at:at + 10_000]
                    yield pd.DataFrame({"id": query, "vec": [vec] * len(r), "share": share, "bound": bound,
                                        "pivot": rings.pivot[r], "ring": rings.ring[r], "part": part[at:at + 10_000],
                                        "distance": d[rings.pivot[r]]})

    return asked.mapInPandas(run, "id long, vec array<double>, share int, bound double, pivot int, ring int, part int, "
                                  "distance double")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_inner_products(vectors: DataFrame, queries: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding",
                       k: int = 10, scale: int = 1024, max_pivots: int = MAX_PIVOTS, cell_rows: int = CELL_ROWS,
                       part_rows: int = PART_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k largest inner products of each query with all other rows.

    Components become floor(scale * x). Vectors that are null, empty or hold null or non-finite components, and
    rows with a null id, take no part; vectors of other lengths than the query's are not its candidates. Ties go
    to the smaller id. Rows that repeat an id are candidates each, but not for a query of that id; a query id that
    repeats is answered once (by the smallest of its vectors). A pivot is taken for every ``cell_rows`` rows up to
    ``max_pivots``, and rings and parts hold about ``part_rows`` rows.
    """
    def whole(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec")).where(
            F.col("id").isNotNull() & finite("vec")).select("id", F.transform(
                "vec", lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("vec"))

    rows = materialize(whole(vectors), "rows")
    asked = materialize(whole(queries).groupBy("id").agg(F.min("vec").alias("vec")), "asked")
    sizes = [r[0] for r in asked.select(F.size("vec")).distinct().orderBy(F.size("vec")).collect()]
    found = None
    for size in sizes:  # one in any sane table
        part = _search(rows.where(F.size("vec") == size), asked.where(F.size("vec") == size), k, (max_pivots, cell_rows, part_rows))
        found = part if found is None else found.union(part)
    if found is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _cut(placed: DataFrame, part_rows: int) -> tuple[DataFrame, Rings]:
    """``placed`` with ``ring`` and ``part``, and the table of rings."""
    fractions = [j / MAX_RINGS for j in range(1, MAX_RINGS)]
    found = placed.groupBy("pivot").agg(
        F.count("*").alias("n"), F.percentile_approx("distance", fractions, 10_000).alias("cuts"))
    cuts = {}
    for r in found.toPandas().itertuples(index=False):  # a row a pivot, MAX_RINGS values each
        rings = min(MAX_RINGS, -(-r.n // part_rows))
        cuts[r.pivot] = np.unique([r.cuts[j * MAX_RINGS // rings - 1] for j in range(1, rings)])

    def ring(pivot: pd.Series, distance: pd.Series) -> np.ndarray:
        out = np.zeros(len(pivot), np.int32)
        for p in pivot.unique():
            own = (pivot == p).to_numpy()
            out[own] = np.searchsorted(cuts[p], distance.to_numpy()[own])
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(ring=ring(batch["pivot"], batch["distance"]))

    rows = materialize(placed.mapInPandas(run, "id long, vec array<double>, pivot int, distance double, ring int"), "rings")
    table = rows.groupBy("pivot", "ring").agg(
        F.min("distance").alias("low"), F.max("distance").alias("high"), F.count("*").alias("n")).withColumn(
        "parts", F.ceil(F.col("n") / (2 * part_rows)).cast("int"))  # rings are of about equal size; ties make larger ones
    table = materialize(table, "spans")
    parts = F.broadcast(table.select("pivot", "ring", "parts"))  # at most MAX_PIVOTS * MAX_RINGS rows
    # equal vectors at one distance are told apart by their ids, rows of one id by the vector
    return rows.join(parts, ["pivot", "ring"]).withColumn(
        "part", F.pmod(F.xxhash64("id", "vec"), F.col("parts")).cast("int")).drop("parts"), Rings(table.toPandas())


def _search(rows: DataFrame, asked: DataFrame, k: int, sizes: tuple[int, int, int]) -> DataFrame:
    max_pivots, cell_rows, part_rows = sizes
    square = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    n, longest = rows.agg(F.count("*"), F.coalesce(F.max(square), F.lit(0.0))).first()
    if not n:
        return rows.sparkSession.createDataFrame([], "query_id long, score long, vec_id long")
    wanted = max(1, min(max_pivots, -(-n // cell_rows)))
    picked = rows.orderBy(F.xxhash64("id")).limit(wanted).select("vec").toPandas()["vec"].tolist()  # bounded
    base = np.stack(picked)
    pivots = np.concatenate([base, np.sqrt(np.maximum(longest - (base * base).sum(axis=1), 0))[:, None]], axis=1)
    index, rings = _cut(materialize(_place(rows, pivots, longest), "placed"), part_rows)
    index = materialize(index, "index")
    shares = -(-asked.count() // VISIT_ROWS)
    asked = asked.withColumn("share", F.pmod(F.xxhash64("id"), F.lit(shares)).cast("int"))
    none = F.lit(None).cast("double").alias("bound")
    once = materialize(_visit(index, materialize(_plan(asked.select("*", none), pivots, rings, longest, k, True), "visits"),
                              k, longest), "first")
    bounds = _best(once, k).where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").cast(
        "double").alias("bound"))
    rest = _plan(asked.join(bounds, "id", "left"), pivots, rings, longest, k, False)
    return once.union(_visit(index, materialize(rest, "visits"), k, longest))
