"""Derived inputs written once as files under the shared checkpoint folder.

Some operators consume *files* (CSV exports, daily snapshot partitions,
response documents). Their input is derived from the driver tables by Spark
and landed once per input directory; later runs read the same files. The
folder is ``<spark.checkpoint.dir>/tables`` — a shared location on a
cluster, never a machine-local temp folder.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

# bumped whenever the layout of a landed input changes, so an old landing in
# a long-lived shared folder is never read with a new reader
LANDING_VERSION = "v3"


def _fs_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _input_tag(spark: SparkSession, sf_dir: str) -> str:
    """Identity of the input folder: its path plus name, size and modification
    time of every file in it, so a landing is redone when the inputs change.
    A folder that can't be listed is an error: its landing might be stale."""
    h = hashlib.sha1(os.path.abspath(sf_dir).encode())
    p = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    for st in sorted(fs.listStatus(p), key=lambda x: x.getPath().getName()):
        h.update(f"{st.getPath().getName()}:{st.getLen()}:{st.getModificationTime()}".encode())
    return h.hexdigest()[:12]


def landed_path(spark: SparkSession, sf_dir: str, kind: str) -> str:
    return scratch_path(spark, f"landed_{LANDING_VERSION}_{kind}_{_input_tag(spark, sf_dir)}")


def land_at(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Run ``write(path)`` unless a completed landing exists there; return the path."""
    if not _fs_exists(spark, os.path.join(path, "_SUCCESS")) and not _fs_exists(spark, os.path.join(path, "_LANDED")):
        write(path)
        marker = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(path, "_LANDED"))
        marker.getFileSystem(spark._jsc.hadoopConfiguration()).create(marker, True).close()
    return path


def land_once(spark: SparkSession, sf_dir: str, kind: str,
              write: Callable[[str], None]) -> str:
    """Run ``write(path)`` once per input folder and kind; return the path."""
    return land_at(spark, landed_path(spark, sf_dir, kind), write)


#: Partition folders a task writes side by side, and the bytes each of their Parquet files buffers.
OPEN_FILES, ROW_GROUP_BYTES = 64, 16 << 20


@contextmanager
def open_writers(spark: SparkSession) -> Iterator[None]:
    """Within it a partitioned write keeps one file open per partition value, so that a task needs no sort of all its
    rows; rows of more than ``OPEN_FILES`` values in one task are sorted as usual."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, OPEN_FILES)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def land_parquet(spark: SparkSession, sf_dir: str, kind: str, build: Callable[[], DataFrame],
                 partition_by: tuple[str, ...] = ()) -> str:
    def write(path: str) -> None:
        w = build().write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by).option("parquet.block.size", ROW_GROUP_BYTES)
        with open_writers(spark):
            w.parquet(path)
    return land_once(spark, sf_dir, kind, write)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines of all fields, null ones too, compressed: names and repeated values make most of their text."""
    df.write.mode("overwrite").option("compression", "gzip").option("ignoreNullFields", False).json(path)
