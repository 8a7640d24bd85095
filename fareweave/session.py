"""Spark session helpers.

The library never creates a cluster session on its own; ``local_session`` is
for tests, the bench and the examples. On a cluster the caller's session is
used as it is and ``checkpoint_dir`` reads the shared folder it names.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "fareweave") -> SparkSession:
    """A local[N] session with the settings the library expects."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is; a machine-local temporary folder is only taken when nothing is set and
    the master is local (tests, local runs). Elsewhere it must be set.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    try:
        path = path or spark.sparkContext.getCheckpointDir()
    except Exception:  # no SparkContext handle (e.g. a Connect session)
        pass
    if not path:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError(f"{CHECKPOINT_CONF} must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="fareweave-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, path)
    try:
        spark.sparkContext.setCheckpointDir(path)
    except Exception:
        pass
    return path


def ship_package(spark: SparkSession) -> None:
    """Give the workers this package (once per session), also where it is only on the driver's path."""
    sc = spark.sparkContext
    if getattr(sc, "_fareweave_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="fareweave-py-"), "fareweave.zip")  # Spark sends it from the driver
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("fareweave", os.path.relpath(full, here)))
    sc.addPyFile(path)
    sc._fareweave_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", name)
