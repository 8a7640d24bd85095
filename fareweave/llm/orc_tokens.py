"""Token-id shards as ORC files: run-length encoded ids, row indexes and Bloom filters on the document id.

Documents are range-partitioned by id, encoded in that order and written one file a task. An ORC stripe holds a
bounded number of bytes, so a file is read stripe by stripe in parallel; the row index (minimum and maximum per
row group) and the Bloom filter let a reader skip stripes and row groups by document id. ``start`` needs only
the per-file totals (one row a file) on top of what each file holds.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

FILE_SCHEMA = "doc_id long, start_in_file long, n_tokens long, ids array<int>"

#: Fixed by the format's readers: rows a row-index entry covers, bytes a stripe holds, false positives of the filter.
ORC_OPTIONS = {"orc.row.index.stride": "1000", "orc.stripe.size": str(16 << 20), "orc.create.index": "true",
               "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "compression": "none"}


def write_tokens(docs: DataFrame, path: str, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = 1, files: int | None = None) -> None:
    """Encode every whole text (null: empty), append ``end_id`` and write ORC files in ascending id order.

    Null ids come first; rows with equal ids are ordered by their text. ``files`` is the number of ranges, by
    default the session's shuffle partitions.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .tokens import encoder

        encode = encoder(tokenizer, keep_space=False).encode
        end, start = int(end_id).to_bytes(4, "little"), 0
        for batch in batches:
            for k in range(0, batch.num_rows, 256):  # long texts: keep an output batch small
                part = batch.slice(k, 256)
                ids = [np.frombuffer(encode(t or "") + end, "<i4") for t in part.column(1).to_pylist()]
                counts = np.array([len(x) for x in ids], np.int64)
                starts = start + np.concatenate([[0], np.cumsum(counts)[:-1]])
                start += int(counts.sum())
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(starts), pa.array(counts), lists],
                    ["doc_id", "start_in_file", "n_tokens", "ids"])

    spark = docs.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).repartitionByRange(
        files, F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text")
    ordered.mapInArrow(run, FILE_SCHEMA).write.options(**ORC_OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document in the files under ``path``."""
    # by number: from 100,000 files on, names are not in order
    number = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("long")
    rows = spark.read.schema(FILE_SCHEMA).orc(path).withColumn("file", number)
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    # one row a file; files are numbered in range order
    before = F.sum("total").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("file", F.coalesce(before, F.lit(0)).alias("before"))
    return rows.join(F.broadcast(offsets), "file").select(
        "doc_id", (F.col("before") + F.col("start_in_file")).alias("start"), "n_tokens", "ids")


def read_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The rows of some documents; stripes and row groups without them are skipped by index and Bloom filter."""
    return spark.read.schema(FILE_SCHEMA).orc(path).where(F.col("doc_id").isin(doc_ids))


def checksums(tokens: DataFrame) -> DataFrame:
    """``tokens`` with ``ids_crc32`` (of the ids as little-endian unsigned 32-bit integers) in place of the ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            data = lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False).tobytes()
            at = lists.offsets.to_numpy().astype(np.int64) * 4
            crc = [zlib.crc32(data[a:b]) for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), pa.array(crc, pa.int64())],
                                             ["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
                end_id: int = 1) -> DataFrame:
    """Write the files into the shared folder, read them back and return the digest of each document."""
    spark = docs.sparkSession
    path = scratch_path(spark, f"llm-orc-{uuid.uuid4().hex}")
    write_tokens(docs, path, tokenizer, id_col=id_col, text_col=text_col, end_id=end_id)
    return checksums(read_tokens(spark, path))
