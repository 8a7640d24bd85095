"""Importance resampling towards a target by bit-sliced sums of bucket gains.

A document is the counts of its hashed features (runs of 1 to ``run`` words) in ``BUCKETS`` buckets. Its counts are
held as bit planes (plane j has bit j of all counts) and the signed gains likewise, in two's complement; the sum of
count times gain over all buckets is then the sum over plane pairs of ``2^(j+k)`` times the population count of
their AND, the gains' sign plane counting as ``-2^top``. All of it is integer work, so weights are exact.

What is gathered from the corpus is one count per bucket, combined map side: its size depends on ``BUCKETS`` alone.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

BUCKETS = 10_000
_WORDS = 64 * -(-BUCKETS // 64)  # bits of a plane, in whole 64-bit words

#: A-Z to a-z, the digits and all bytes of non-ASCII characters as they are, every other byte a separator.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """The lower-cased words of a whole text (null: none)."""
    return (text or "").encode().translate(_FOLD).split()


class _Crc(dict):
    """Word → crc32 of the word, filled on first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = zlib.crc32(word)
        return found


class BucketCounter:
    """Counts of a text's features per bucket; the word cache is emptied when full."""

    def __init__(self, run: int = 2, limit: int = 500_000) -> None:
        self.run, self.limit, self.crc = run, limit, _Crc()

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self.crc) > self.limit:
            self.crc.clear()
        last = list(map(self.crc.__getitem__, words))
        found = list(last)
        for k in range(1, self.run):  # crc32 goes on from the run one word shorter
            last = list(map(zlib.crc32, [b" " + w for w in words[k:]], last))
            found += last
        return np.bincount(np.array(found, np.uint32) % BUCKETS, minlength=BUCKETS)


def bucket_counts(texts: DataFrame, text_col: str = "text", run: int = 2) -> DataFrame:
    """``bucket, n``: how often each bucket occurs over whole texts; buckets without a feature are absent."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, total = BucketCounter(run), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                words = words_of(text.as_py())
                if words:
                    total += counter(words)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    parts = texts.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "bucket int, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def _dense(counts: DataFrame) -> list[int]:
    dense = [0] * BUCKETS  # BUCKETS rows at most, whatever the corpus holds
    for row in counts.collect():
        dense[row["bucket"]] = row["n"]
    return dense


def bucket_gains(source: DataFrame, target: DataFrame) -> list[int]:
    """``floor(1000 * ln((t+1)(S+BUCKETS) / ((s+1)(T+BUCKETS))))`` per bucket, from two tables of bucket counts."""
    s, t = _dense(source), _dense(target)
    total_s, total_t = sum(s), sum(t)
    return [math.floor(1000 * math.log(float(b + 1) * float(total_s + BUCKETS)
                                       / (float(a + 1) * float(total_t + BUCKETS)))) for a, b in zip(s, t)]


def _planes(values: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes of non-negative integers as rows of 64-bit words, lowest bit first."""
    padded = np.zeros(_WORDS, np.int64)
    padded[:len(values)] = values
    bit = (padded[None, :] >> np.arange(bits)[:, None]) & 1
    return np.packbits(bit.astype(np.uint8), axis=1).view(np.uint64)


class GainPlanes:
    """Signed gains as two's complement bit planes, the last one the sign."""

    def __init__(self, gains: list[int]) -> None:
        g = np.array(gains, np.int64)
        top = max(int(np.abs(g).max(initial=0)), 1).bit_length()
        self.planes = _planes(g & ((1 << (top + 1)) - 1), top + 1)
        self.scale = [1 << k for k in range(top)] + [-(1 << top)]

    def total(self, counts: np.ndarray) -> int:
        """The exact sum of count times gain."""
        found = 0
        for j, plane in enumerate(_planes(counts, int(counts.max(initial=0)).bit_length())):
            ones = np.bitwise_count(self.planes & plane).sum(axis=1, dtype=np.int64).tolist()
            found += sum(map(int.__mul__, ones, self.scale)) << j
        return found


def weigh(docs: DataFrame, gains: list[int], *, id_col: str = "doc_id", text_col: str = "text", run: int = 2,
          seed: int = 7) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every row: the floored mean gain of its features (none: 0)
    and that weight plus floored Gumbel noise drawn from the id. A null id gives the noise of the empty text."""
    def run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, planes = BucketCounter(run), GainPlanes(gains)
        for batch in batches:
            n_words, n_features, weight, score = [], [], [], []
            for text, h in zip(batch.column(1), batch.column(2).to_pylist()):
                words = words_of(text.as_py())
                counts = counter(words)
                n = int(counts.sum())
                w = planes.total(counts) // n if n else 0
                n_words.append(len(words))
                n_features.append(n)
                weight.append(w)
                score.append(w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (n_words, n_features, weight, score))],
                ["doc_id", "n_words", "n_features", "weight", "score"])

    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       h.alias("h")).mapInArrow(
        run_rows, "doc_id long, n_words long, n_features long, weight long, score long")


def draw(scored: DataFrame, *, percent: int = 25, min_words: int = 20) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3 … for the ``floor(percent * N / 100)`` highest scores among the N rows of at
    least ``min_words`` words, ties to the smaller id (null ids last); null for all other rows.

    Scores are integers in a range that the gains and the noise bound (under 100,000 values), so the histogram that
    gives each score its first rank is small at every size. Rows equal in all columns are counted, not sorted, and
    one score holds a 2,700th of the other rows at most (the peak of the noise), so no ordered group is hot.
    ``scored`` is read several times: write it before.
    """
    able = F.col("n_words") >= min_words
    hist = scored.where(able).groupBy("score").agg(F.count("*").alias("n"))
    spans = hist.select("score", (F.sum("n").over(Window.orderBy(F.desc("score"))) - F.col("n")).alias("before"),
                        F.sum("n").over(Window.partitionBy()).alias("total"))
    limit = F.floor(F.lit(percent) * F.col("total") / 100)
    spans = spans.select("score", "before", limit.alias("limit"), (F.col("before") < limit).alias("reached"))
    rows = scored.withColumn("able", F.coalesce(able, F.lit(False))).join(F.broadcast(spans), "score", "left")
    reached = F.col("able") & F.coalesce(F.col("reached"), F.lit(False))
    columns = scored.columns
    upto = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features", "n_words").rowsBetween(
        Window.unboundedPreceding, 0)
    counted = rows.where(reached).groupBy(*columns, "before", "limit").agg(F.count("*").alias("copies"))
    ranked = counted.withColumn("last", F.col("before") + F.sum("copies").over(upto)).withColumn(
        "rank", F.explode(F.sequence(F.col("last") - F.col("copies") + 1, F.col("last"))))
    drawn = ranked.select(*columns, F.when(F.col("rank") <= F.col("limit"), F.col("rank")).alias("rank"))
    return drawn.union(rows.where(~reached).select(*columns, F.lit(None).cast("long").alias("rank")))


def resample(docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", run: int = 2, percent: int = 25, min_words: int = 20,
             seed: int = 7) -> DataFrame:
    """Every row's ``doc_id, n_words, n_features, weight, score, rank`` with ``rank`` as ``draw`` gives it.

    Null and empty texts have no feature, weight 0 and are never drawn; repeated rows are drawn one by one; an empty
    ``target`` counts as one without features and an empty ``docs`` gives no row. Other columns of ``docs`` play no part.
    """
    gains = bucket_gains(bucket_counts(docs, text_col, run), bucket_counts(target, target_text_col, run))
    scored = weigh(docs, gains, id_col=id_col, text_col=text_col, run=run, seed=seed)
    return draw(materialize(scored, "weights"), percent=percent, min_words=min_words)
