"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Ids and small keys are broadcast up to this many rows (8 MB of longs); beyond it the join is left to Catalyst.
BROADCAST_ROWS = 1_000_000
#: A step's table of ids and other small columns has at most one file for so many rows; fewer files where Spark makes fewer.
ROWS_A_FILE = 16_384


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it Spark removes the shuffle files of a query as soon as it ends; otherwise they stay until the driver's
    garbage collector finds them, and an operator of many steps holds those of all its steps at once."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, True)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def materialize(df: DataFrame, name: str, rows: int | None = None, rows_a_file: int = ROWS_A_FILE) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and read it back (cuts the lineage; survives lost executors).
    No other query reads the shuffles of a write, so they go with it.

    ``rows`` is a bound or a measure of its rows, where known: a small table of many partitions is then written as few
    files. Each costs a create, a rename and, on a file system without native calls, a process for each change of its
    rights, in which the executor's memory is seen twice."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    with shuffles_removed(spark):
        (df if rows is None else df.coalesce(max(1, -(-rows // rows_a_file)))).write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._written_to = path
    return back


def discard(df: DataFrame) -> None:
    """Remove a table of ``materialize`` from the shared folder once no plan that is still to run reads it."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._written_to)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def remainder(id_col: str, n: int) -> Column:
    """``crc32(id as text) mod n``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def is_remainder(id_col: str, n: int, value: int) -> Column:
    return F.coalesce(remainder(id_col, n) == value, F.lit(False))


def small_or_plain(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Mark ``df`` for broadcast when its counted size is below the bound; otherwise leave it to a shuffle join."""
    rows = df.count() if rows is None else rows
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def key_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """Consecutive groups of a partition that is sorted by ``keys``; holds one group at a time."""
    held: list[pd.DataFrame] = []
    held_key: tuple | None = None
    for batch in batches:
        if batch.empty:
            continue
        batch = batch.reset_index(drop=True)
        changed = (batch[keys] != batch[keys].shift()).any(axis=1).to_numpy()
        changed[0] = True
        starts = changed.nonzero()[0].tolist() + [len(batch)]
        for a, b in zip(starts, starts[1:]):
            key = tuple(batch[k].iat[a] for k in keys)
            if held_key is not None and key != held_key:
                yield held_key, pd.concat(held, ignore_index=True)
                held = []
            held_key = key
            held.append(batch.iloc[a:b])
    if held_key is not None:
        yield held_key, pd.concat(held, ignore_index=True)


def key_pieces(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """Consecutive rows of one key within a batch, of a partition that is sorted by ``keys``: a large group comes in
    several pieces, so that no more than a batch is held."""
    for batch in batches:
        if batch.empty:
            continue
        batch = batch.reset_index(drop=True)
        changed = (batch[keys] != batch[keys].shift()).any(axis=1).to_numpy()
        changed[0] = True
        starts = changed.nonzero()[0].tolist() + [len(batch)]
        for a, b in zip(starts, starts[1:]):
            yield tuple(batch[k].iat[a] for k in keys), batch.iloc[a:b]


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every end of ``edges``: the smallest node reachable.

    Alternating large-star / small-star rounds over a shrinking edge table: each round hooks every node to the
    smallest node of its neighbourhood, so a chain of n nodes ends in O(log² n) rounds. The minima are map-side
    combined aggregates joined back, so a hub is never gathered in one task; each round is written to the
    shared checkpoint folder. ``edges`` are read twice, once for their number.
    """
    pairs = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    pairs = materialize(pairs, "cc", edges.count())
    before, size = None, pairs.count()
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            small_low.select("u", F.col("m").alias("v")))
        last, pairs = pairs, materialize(small.where(F.col("u") != F.col("v")).distinct(), "cc", 2 * size)
        discard(last)
        after = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before, size = after, after[0]
    roots = pairs.select(F.col("v").alias("node")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component")))
