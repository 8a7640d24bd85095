"""Hashed n-gram counts of whole texts, and their document frequencies over a whole table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Buckets of the n-gram hash; a fixed vector size, the same for every table.
BUCKETS = 4096
#: Classes that a sample can be drawn from.
MAX_CLASSES = 10_000
#: Repetition marks of a text.
MARKS = 33

_LETTERS = bytes(b if chr(b).isalpha() or b >= 128 else 32 for b in range(128)) + bytes(range(128, 256))
_SHAPES = bytes(97 if chr(b).islower() else 65 if chr(b).isupper() else 48 if chr(b).isdigit() else b
                for b in range(128)) + bytes([233] * 128)


def trigram_counts(data: bytes) -> np.ndarray:
    """Counts of the byte trigrams of ``data`` in ``BUCKETS`` hash buckets."""
    a = np.frombuffer(data, np.uint8).astype(np.uint32)
    h = a[:-2] * np.uint32(0x9E3779B1) + a[1:-1] * np.uint32(0x85EBCA77) + a[2:] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return np.bincount(h >> np.uint32(20), minlength=BUCKETS)


def letter_counts(text: str | None) -> np.ndarray:
    """Trigrams of the lower-cased letters and the spaces between words (runs of anything else are one space)."""
    data = b" " + b" ".join((text or "").lower().encode().translate(_LETTERS).split()) + b" "
    return trigram_counts(data)


def shape_counts(text: str | None) -> np.ndarray:
    """Trigrams of character shapes (letters and digits by kind, other characters as they are)."""
    return trigram_counts(b"\n" + (text or "").encode().translate(_SHAPES) + b"\n")


def repetition(text: str | None) -> np.ndarray:
    """How much a text repeats itself: ten steps each for distinct words, distinct lines and the top word's share."""
    words = (text or "").split()
    lines = [x for x in (text or "").split("\n") if x.strip()]
    out = np.zeros(MARKS)
    if words:
        distinct = set(words)
        # the expected share of distinct words falls with length; compare on the scale of the square root
        share = min(1.0, len(distinct) / max(1.0, len(words)) * max(1.0, len(words) / 400) ** 0.25)
        out[int(10 * share)] = 1
        out[11 + int(10 * len(set(lines)) / len(lines))] = 1
        longest = max(len(w) for w in distinct)
        out[22 + min(10, longest // 8)] = 1
    return out


def document_frequencies(docs: DataFrame, text_col: str, counts: Callable[[str | None], np.ndarray],
                         class_col: str | None = None) -> tuple[np.ndarray, int]:
    """In how many rows of ``docs`` each bucket occurs, and the number of rows: one small vector a task, summed.

    With ``class_col`` (a few classes) every class counts alike: the frequency is the mean of the classes' shares
    of rows, times all rows, so that the n-grams of a large class are not taken for common ones.
    """
    rows = docs.select(text_col, (F.col(class_col) if class_col else F.lit("")).cast("string").alias("c"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, c in zip(*(batch.column(k).to_pylist() for k in (0, 1))):
                if c not in totals:
                    totals[c] = np.zeros(BUCKETS + 1, np.int64)
                totals[c][:-1] += counts(text) > 0
                totals[c][-1] += 1
        for c, total in totals.items():
            hit = total.nonzero()[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([c] * len(hit)), pa.array(hit, pa.int32()), pa.array(total[hit], pa.int64())], ["c", "b", "n"])

    found = rows.mapInArrow(run, "c string, b int, n long").groupBy("c", "b").agg(F.sum("n").alias("n")).toPandas()
    shares, size = [], 0
    for _, own in found.groupby("c"):
        total = np.zeros(BUCKETS + 1, np.int64)
        total[own["b"].to_numpy()] = own["n"].to_numpy()
        shares.append(total[:-1] / total[-1])
        size += int(total[-1])
    return (np.mean(shares, axis=0) if shares else np.zeros(BUCKETS)) * size, size


def inverse_frequencies(df: np.ndarray, rows: int) -> np.ndarray:
    return np.log((1 + rows) / (1 + df)).astype(np.float32) + np.float32(0.1)


def tf_idf(counts: np.ndarray, idf: np.ndarray, tf=np.log1p) -> np.ndarray:
    """Normalised TF-IDF rows (term frequencies by ``tf``); a row without terms stays zero."""
    x = np.array(counts, np.float32)
    if tf is not np.asarray:
        tf(x, out=x)
    x *= idf
    x /= np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x)), np.float32(1e-12))[:, None]
    return x


def bounded_sample(rows: DataFrame, class_col: str, key_col: str, per_class: int, seed: int,
                   text_col: str | None = None) -> DataFrame:
    """About ``per_class`` rows of each class, chosen by a hash of the key (of ``text_col`` where the key is null), and
    never more than twice as many, those with the smallest hashes; adds ``weight`` = rows a sampled row stands for. With
    ``text_col``, repeated rows of one key and text count once.

    Classes are labels or languages: more than ``MAX_CLASSES`` of them are refused with a ValueError.
    """
    sizes = {r[0]: r[1] for r in rows.groupBy(class_col).count().limit(MAX_CLASSES + 1).collect()}
    if len(sizes) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} values of {class_col}: it doesn't name classes")
    if not sizes:
        return rows.withColumn("weight", F.lit(1.0)).limit(0)
    share = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, per_class / n)))])
    by_key = F.xxhash64(F.lit(seed), F.col(key_col))
    tie = by_key if text_col is None else F.xxhash64(F.lit(seed), F.col(text_col))
    chosen = by_key if text_col is None else F.when(F.col(key_col).isNull(), tie).otherwise(by_key)
    unit = F.pmod(chosen, F.lit(1 << 30)) / float(1 << 30)
    p = F.element_at(share, F.col(class_col))
    picked = rows.where(unit < p).withColumns({"weight": 1.0 / p, "_chosen": chosen, "_tie": tie})
    if text_col is not None:
        picked = picked.dropDuplicates([class_col, "_chosen", "_tie"])
    order = F.row_number().over(Window.partitionBy(class_col).orderBy(unit, "_chosen", "_tie"))
    return picked.withColumn("_order", order).where(F.col("_order") <= 2 * per_class).drop("_order", "_chosen", "_tie")


def count_rows(rows: DataFrame, text_col: str, keep: list[str], counts: Callable[[str | None], np.ndarray]
               ) -> tuple[pd.DataFrame, list[tuple[np.ndarray, np.ndarray]]]:
    """The ``keep`` columns and the sparse count vectors of a bounded sample, on the driver."""
    schema = ", ".join(f"{c} {t}" for c, t in rows.select(*keep).dtypes) + ", at binary, n binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dense_rows = [counts(t) for t in batch.column(0).to_pylist()]
            at = [v.nonzero()[0] for v in dense_rows]
            n = [v[k].astype("<f4").tobytes() for v, k in zip(dense_rows, at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array([k.astype("<u2").tobytes() for k in at], pa.binary()), pa.array(n, pa.binary())],
                [*keep, "at", "n"])

    got = rows.select(text_col, *keep).mapInArrow(run, schema).toPandas().sort_values([*keep, "at", "n"], ignore_index=True)
    return got, [(np.frombuffer(k, "<u2"), np.frombuffer(n, "<f4")) for k, n in zip(got.pop("at"), got.pop("n"))]


def dense(rows: list[tuple[np.ndarray, np.ndarray]], width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.float32)
    for row, (at, n) in zip(out, rows):
        row[at] = n
    return out
