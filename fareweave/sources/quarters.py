"""The quarterly pipeline as incremental runs over a commit log.

A pipeline folder holds ``parquet/`` (cleaned quarters), ``features/`` (their feature tables), ``commits/`` (one row per
run, quarter and stage: outcome, rows, bytes, the source files' identity) and ``status/`` (what each run found before it
started). A run converts in one job every quarter whose CSV files are there and whose last commit is not a finished
one of the same files; then it commits. A run that dies before its commit is simply done again: quarters are replaced
as a whole (dynamic partition overwrite). A quarter without a readable row is committed as failed and stays pending.

Status comes from metadata alone: folder listings (one entry a quarter) and row counts that Spark takes from the Parquet
footers (aggregate push-down), never from a scan of rows. A quarter whose footers can't be read, or hold another
number of rows than was committed, is not valid and is converted again.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import clean as C
from . import files as FL

COMMITS = ("run int, Year int, Quarter int, stage string, outcome string, rows long, bytes long, source string, note string")
QUARTER = ["Year", "Quarter"]
Span = tuple[tuple[int, int], tuple[int, int]]


def index_of(year: int, quarter: int) -> int:
    return year * 4 + quarter - 1


def quarter_of(index: int) -> tuple[int, int]:
    return index // 4, index % 4 + 1


def list_quarters(spark: SparkSession, path: str) -> dict[tuple[int, int], tuple[int, str]]:
    """(year, quarter) → (bytes, identity of the files) of the ``Year=/Quarter=`` folders; no file is opened."""
    root = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(path, "Year=*", "Quarter=*"))
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {}
    for folder in fs.globStatus(root) or []:
        m = re.search(r"Year=(\d+)/Quarter=(\d+)$", folder.getPath().toString())
        files = [f for f in fs.listStatus(folder.getPath()) if not f.getPath().getName().startswith(("_", "."))]
        if m and files:
            size = sum(f.getLen() for f in files)
            found[int(m[1]), int(m[2])] = (size, f"{len(files)}:{size}:{max(f.getModificationTime() for f in files)}")
    return found


@contextmanager
def _footer_session(spark: SparkSession) -> Iterator[SparkSession]:
    """A session of its own on the same cluster whose file reads answer counts from Parquet footers and leave
    unreadable files out; the file source looks at the active session, so it is that for the while."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.files.ignoreCorruptFiles", "true")
    own.conf.set("spark.sql.caseSensitive", "true")  # grouping is pushed only under the partition columns' exact names
    active = spark._jvm.org.apache.spark.sql.classic.SparkSession
    active.setActiveSession(own._jsparkSession)
    try:
        yield own
    finally:
        active.setActiveSession(spark._jsparkSession)


def footer_count(own: SparkSession, path: str) -> DataFrame:
    """Rows per quarter; in a footer session a plan with ``PushedAggregation``."""
    return own.read.schema("MktFare double, Year int, Quarter int").parquet(path).groupBy(*QUARTER).agg(
        F.count(F.lit(1)).alias("rows"))


def footer_rows(spark: SparkSession, path: str) -> list[tuple[int, int, int]]:
    """``(Year, Quarter, rows)`` from the Parquet footers, one row a quarter; unreadable files count nothing."""
    with _footer_session(spark) as own:
        return [tuple(r) for r in footer_count(own, path).collect()]


def quarter_features(market: DataFrame) -> DataFrame:
    """The market feature table, with route competition and carrier share taken within each quarter."""
    b = C.usable(market).withColumn("route", S.route_key("Origin", "Dest", "_"))
    carriers = b.groupBy(*QUARTER, "route", "TkCarrier").agg(F.sum("Passengers").alias("_pax"))
    of_route = Window.partitionBy(*QUARTER, "route")  # one row a carrier
    share = carriers.select(
        *QUARTER, "route", "TkCarrier", F.try_divide("_pax", F.sum("_pax").over(of_route)).alias("carrier_market_share"),
        F.count("TkCarrier").over(of_route).alias("route_competition"))
    return b.join(share, [*QUARTER, "route", "TkCarrier"], "left").select(
        "MktID", "route", "TkCarrier", "MktFare", "carrier_market_share", "route_competition",
        S.fare_per_mile("MktFare", "MktDistance").alias("fare_per_mile"),
        S.is_connecting("MktCoupons").alias("is_connecting"),
        S.cut_labels("MktDistance", *S.DISTANCE_CATEGORIES).alias("distance_category"),
        S.season("Quarter").alias("season"), *QUARTER)


@dataclass(frozen=True)
class QuarterPipeline:
    spark: SparkSession
    csv: str
    base: str

    @property
    def parquet(self) -> str:
        return os.path.join(self.base, "parquet")

    @property
    def features(self) -> str:
        return os.path.join(self.base, "features")

    def _log(self, name: str, schema: str) -> DataFrame:
        path = os.path.join(self.base, name)
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        there = p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)
        return self.spark.read.schema(schema).parquet(path) if there else self.spark.createDataFrame([], schema)

    def commits(self) -> DataFrame:
        return self._log("commits", COMMITS)

    def last_commits(self, stage: str) -> DataFrame:
        """The last outcome of each quarter in a stage; runs that found nothing to do don't count."""
        done = self.commits().where((F.col("stage") == stage) & F.col("outcome").isin("done", "failed"))
        return done.groupBy(*QUARTER).agg(F.max_by(F.struct("run", "outcome", "rows", "source"), "run").alias("c")).select(
            *QUARTER, "c.*")

    def _listed(self, path: str, name: str) -> DataFrame:
        rows = [(y, q, size, source) for (y, q), (size, source) in list_quarters(self.spark, path).items()]
        return self.spark.createDataFrame(rows, f"Year int, Quarter int, {name}_bytes long, {name}_source string")

    def inventory(self) -> DataFrame:
        """What each stage holds per quarter, from listings, footers and the commit log."""
        csv, pq = self._listed(self.csv, "csv"), self._listed(self.parquet, "parquet")
        footers = footer_rows(self.spark, self.parquet) if list_quarters(self.spark, self.parquet) else []
        counted = self.spark.createDataFrame(footers, "Year int, Quarter int, parquet_rows long")
        told = self.last_commits("parquet").select(*QUARTER, F.col("rows").alias("committed_rows"),
                                                   F.col("outcome").alias("committed"), F.col("source").alias("committed_source"))
        return (csv.join(pq, QUARTER, "full").join(self._listed(self.features, "processed"), QUARTER, "full")
                .join(counted, QUARTER, "left").join(told, QUARTER, "left"))

    def status(self, span: Span) -> DataFrame:
        return FL.pipeline_status(FL.quarter_frame(self.spark, *span), self.inventory())

    def span(self) -> Span:
        """First and last quarter that has CSV files."""
        found = sorted(list_quarters(self.spark, self.csv))
        return found[0], found[-1]

    def pending(self, span: Span) -> DataFrame:
        """Quarters of the span with CSV files that no finished and still valid conversion of the same files covers."""
        inv = self.inventory()
        finished = inv.where((F.col("committed") == "done") & (F.col("committed_source") == F.col("csv_source"))
                             & (F.col("parquet_rows") == F.col("committed_rows")))
        return FL.quarter_frame(self.spark, *span).join(self._listed(self.csv, "csv"), QUARTER).join(
            finished.select(*QUARTER), QUARTER, "left_anti")

    def run(self, span: Span, features: bool = False) -> int:
        """One incremental run over a span of quarters; returns its number."""
        run = self.commits().agg(F.coalesce(F.max("run"), F.lit(0))).first()[0] + 1
        # the quarter after the span shows whether there is something to fetch
        ahead = (span[0], quarter_of(index_of(*self.span()[1]) + 1))
        self.status(ahead).withColumn("run", F.lit(run)).coalesce(1).write.mode("append").parquet(
            os.path.join(self.base, "status"))
        todo = {(r.Year, r.Quarter): r.csv_source for r in self.pending(span).collect()}  # one row a quarter
        log = self._stage(todo, "parquet", self.parquet, self._cleaned)
        there = list_quarters(self.spark, self.csv)
        for k in range(index_of(*span[0]), index_of(*span[1]) + 1):
            if quarter_of(k) not in todo:
                log.append((*quarter_of(k), "parquet", "skipped" if quarter_of(k) in there else "missing", 0, 0, None, None))
        self._commit(run, log)
        if features:
            self._commit(run, self._stage(self._unprocessed(span), "features", self.features, self._featured))
        return run

    def _cleaned(self, wanted: Column) -> DataFrame:
        return C.basic_clean(FL.read_market_csv(self.spark, self.csv).filter(wanted))

    def _featured(self, wanted: Column) -> DataFrame:
        return quarter_features(self.spark.read.parquet(self.parquet).filter(wanted))

    def _unprocessed(self, span: Span) -> dict[tuple[int, int], str]:
        """Valid converted quarters whose features are missing or older than their conversion."""
        pq, done = self.last_commits("parquet"), self.last_commits("features").where("outcome = 'done'")
        fresh = done.select(*QUARTER, F.col("source").alias("of_run"))
        rows = FL.quarter_frame(self.spark, *span).join(pq.where("outcome = 'done'"), QUARTER).join(fresh, QUARTER, "left")
        stale = rows.where(~F.col("of_run").eqNullSafe(F.col("run").cast("string")))
        return {(r.Year, r.Quarter): str(r.run) for r in stale.collect()}  # one row a quarter

    def _stage(self, todo: dict, stage: str, path: str, build) -> list[tuple]:
        """Write the quarters of ``todo`` in one job; if that fails, one by one, so that a broken one fails alone."""
        if not todo:
            return []
        try:
            rows, notes = self._write(list(todo), path, build), {}
        except Exception:
            rows, notes = {}, {}
            for quarter in todo:
                try:
                    rows |= self._write([quarter], path, build)
                except Exception as e:
                    notes[quarter] = f"{type(e).__name__}: {e}"[:200]
        held = list_quarters(self.spark, path)
        log = []
        for quarter, source in todo.items():
            n = rows.get(quarter, 0)
            log.append((*quarter, stage, "done" if n else "failed", n, held.get(quarter, (0, ""))[0] if n else 0, source,
                        notes.get(quarter, None if n else "no readable row")))
        return log

    def _write(self, quarters: list[tuple[int, int]], path: str, build) -> dict[tuple[int, int], int]:
        """Write some quarters and return their rows, counted while they are written."""
        def is_in(quarter: tuple[int, int]) -> Column:
            return (F.col("Year") == quarter[0]) & (F.col("Quarter") == quarter[1])

        wanted = F.lit(False)
        for quarter in quarters:
            wanted = wanted | is_in(quarter)
        seen = Observation()
        counts = [F.count_if(is_in(quarter)).alias(f"q{index_of(*quarter)}") for quarter in quarters]
        FL.write_quarters_parquet(build(wanted).observe(seen, *counts), path)
        return {quarter: seen.get[f"q{index_of(*quarter)}"] for quarter in quarters}

    def _commit(self, run: int, log: list[tuple]) -> None:
        if log:
            self.spark.createDataFrame([(run, *row) for row in log], COMMITS).coalesce(1).write.mode("append").parquet(
                os.path.join(self.base, "commits"))

    def report(self) -> DataFrame:
        """Per run and stage: quarters pending at its start, processed, skipped, failed, missing; rows and bytes."""
        def n(*outcomes: str) -> Column:
            return F.count_if(F.col("outcome").isin(*outcomes))

        return self.commits().groupBy("run", "stage").agg(
            n("done", "failed").alias("pending"), n("done").alias("processed"), n("skipped").alias("skipped"),
            n("failed").alias("failed"), n("missing").alias("missing"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"))
