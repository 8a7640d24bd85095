"""File sources and sinks for the market table and the collected data.

* quarterly CSV exports → typed reads with an explicit schema, bad lines kept
  aside in a rejects table (``columnNameOfCorruptRecord``), the trailing
  comma's phantom column dropped by name;
* CSV → Parquet partitioned by ``Year``/``Quarter`` with dynamic partition
  overwrite (re-converting a quarter replaces only that quarter);
* the per-quarter pipeline status from an inventory of what each stage holds
  (the runs themselves are in ``quarters``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalar as S
from .landing import ROW_GROUP_BYTES, open_writers

# market columns as written by the fixture export, in file order
MARKET_FIELDS = [
    ("ItinID", T.LongType()), ("MktID", T.StringType()), ("MktCoupons", T.IntegerType()),
    ("Origin", T.StringType()), ("Dest", T.StringType()), ("RPCarrier", T.StringType()),
    ("TkCarrier", T.StringType()), ("OpCarrier", T.StringType()), ("BulkFare", T.DoubleType()),
    ("Passengers", T.DoubleType()), ("MktFare", T.DoubleType()), ("MktDistance", T.DoubleType()),
    ("MktDistanceGroup", T.IntegerType()), ("MktMilesFlown", T.DoubleType()),
    ("NonStopMiles", T.DoubleType()), ("MktGeoType", T.IntegerType()),
]
PHANTOM = "_trailing"
CORRUPT = "_corrupt_record"
MARKET_CSV_SCHEMA = T.StructType([T.StructField(n, t) for n, t in MARKET_FIELDS]
                                 + [T.StructField(PHANTOM, T.StringType()),
                                    T.StructField(CORRUPT, T.StringType())])


def write_market_csv(market: DataFrame, path: str, bad_every: int | None = None) -> None:
    """Quarterly CSV export (``Year=/Quarter=`` folders, header, trailing comma).
    ``bad_every`` corrupts the fare of every n-th itinerary to exercise the
    reader's reject path."""
    cols = [F.col(n).cast("string").alias(n) for n, _ in MARKET_FIELDS]
    if bad_every:
        fare = F.when(F.col("ItinID") % bad_every == 0, F.lit("bad")).otherwise(F.col("MktFare").cast("string"))
        cols = [fare.alias("MktFare") if c == "MktFare" else F.col(c).cast("string").alias(c)
                for c, _ in MARKET_FIELDS]
    out = market.select(*cols, F.lit(None).cast("string").alias(PHANTOM), "Year", "Quarter")
    with open_writers(market.sparkSession):
        (out.write.mode("overwrite").partitionBy("Year", "Quarter").option("header", True)
         .option("emptyValue", "").option("nullValue", "").csv(path))


def read_market_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                    with_rejects: bool = False):
    """Typed read of the CSV export; returns good rows (and rejected lines).

    The schema is explicit — no inference pass over the data. ``Year`` and
    ``Quarter`` come from the folder names (partition discovery)."""
    raw = (spark.read.schema(MARKET_CSV_SCHEMA).option("header", True).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    # a line is good or rejected as a whole, so the parser must look at every
    # field whatever columns are asked for (CSV column pruning would skip the
    # unrequested ones); good and rejected lines together are all lines
    every = F.array(*[F.col(n).cast("string") for n, _ in MARKET_FIELDS])
    parsed = (F.col(CORRUPT).isNull() & F.col("ItinID").isNotNull()
              & (F.size(every) == len(MARKET_FIELDS)))
    good = drop_phantom(raw.filter(parsed).drop(CORRUPT))
    if columns is not None:
        good = good.select(*[c for c in columns if c in good.columns])
    if not with_rejects:
        return good
    rejects = raw.filter(~parsed).select("Year", "Quarter", "ItinID", F.col(CORRUPT).alias("line"))
    return good, rejects


def drop_phantom(df: DataFrame) -> DataFrame:
    """Drop the unnamed column a trailing comma creates."""
    return df.drop(*[c for c in df.columns if c == PHANTOM or c.startswith("Unnamed") or c.startswith("_c")])


def write_quarters_parquet(df: DataFrame, path: str) -> None:
    """Typed Parquet per quarter; only the quarters present in ``df`` are
    replaced (dynamic partition overwrite)."""
    with open_writers(df.sparkSession):
        (df.write.mode("overwrite").partitionBy("Year", "Quarter").option("compression", "snappy")
         .option("parquet.block.size", ROW_GROUP_BYTES).option("partitionOverwriteMode", "dynamic").parquet(path))


def quarter_frame(spark: SparkSession, start: tuple[int, int], end: tuple[int, int]) -> DataFrame:
    """All quarters ``start``..``end`` inclusive (error if reversed)."""
    seq = spark.range(1).select(F.explode(S.quarter_sequence(start, end)).alias("qi"))
    return seq.select(F.floor(F.col("qi") / 4).cast("int").alias("Year"),
                      (F.col("qi") % 4 + 1).cast("int").alias("Quarter"))


def pipeline_status(quarters: DataFrame, inventory: DataFrame) -> DataFrame:
    """Stage and next action per quarter from the inventory of ``quarters.QuarterPipeline``. A Parquet quarter is
    valid if its footers hold rows, as many as were committed (where a commit is known)."""
    j = quarters.join(inventory, ["Year", "Quarter"], "left")
    has_csv = F.col("csv_bytes").isNotNull()
    has_pq = F.col("parquet_bytes").isNotNull()
    rows = F.coalesce("parquet_rows", F.lit(0))
    valid = has_pq & (rows > 0) & (F.coalesce("committed_rows", rows) == rows)
    has_proc = F.col("processed_bytes").isNotNull()
    stage = (F.when(has_proc, F.lit("processed")).when(has_pq, F.lit("parquet"))
             .when(has_csv, F.lit("csv")).otherwise(F.lit("not_started")))
    action = (F.when(has_proc & valid, F.lit("complete")).when(valid, F.lit("process_features"))
              .when(has_pq, F.lit("reconvert")).when(has_csv, F.lit("convert_to_parquet"))
              .otherwise(F.lit("download")))
    return j.select("Year", "Quarter", has_csv.alias("has_csv"), has_pq.alias("has_parquet"),
                    has_proc.alias("has_processed"), rows.alias("parquet_rows"),
                    valid.alias("parquet_valid"), stage.alias("stage"), action.alias("next_action"))
