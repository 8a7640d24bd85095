"""Quality by nearest-neighbour voting in a latent-semantic space.

Shape trigrams and repetition marks of a bounded, documented sample of labelled rows are reduced to a few latent
dimensions; the labelled vectors (a fixed number of short rows) go to every task, and each document's exact cosine
with all of them is computed block by block. Its nearest labelled rows vote, weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import (BUCKETS, MARKS, bounded_sample, count_rows, dense, document_frequencies, inverse_frequencies,
                       repetition, shape_counts, tf_idf)

#: Labelled rows per class whose vectors are kept, latent dimensions, and neighbours that vote.
PER_CLASS = 1500
DIMENSIONS = 48
NEIGHBOURS = 15
THRESHOLD = 0.3
#: Weight of a repetition mark beside the unit-length trigram vector.
MARK_WEIGHT = 0.35


@dataclass
class Neighbours:
    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    weights: np.ndarray


def _counts(text: str | None) -> np.ndarray:
    return np.concatenate([shape_counts(text), repetition(text)])


def _rows(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return np.concatenate([tf_idf(counts[:, :BUCKETS], idf), np.float32(MARK_WEIGHT) * counts[:, BUCKETS:]], axis=1)


def _latent(x: np.ndarray, basis: np.ndarray) -> np.ndarray:
    z = x @ basis
    return z / np.maximum(np.sqrt((z * z).sum(axis=1, keepdims=True)), np.float32(1e-12))


def fit_neighbours(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", per_class: int = PER_CLASS, dimensions: int = DIMENSIONS
                   ) -> Neighbours | None:
    """The labelled vectors; None without labelled rows. Document frequencies cover all of ``docs``.

    Null ids or labels are not learned from; of repeated labels of an id the smallest counts.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(id_col).agg(
        F.min(label_col).cast("int").alias("_label"))
    picked = bounded_sample(known, "_label", id_col, per_class, seed=6)
    # bounded by 2 * per_class * number of labels rows
    rows = docs.select(id_col, text_col).join(F.broadcast(picked), id_col).dropDuplicates([id_col])
    sample, counts = count_rows(rows, text_col, [id_col, "_label", "weight"], _counts)
    if not len(sample):
        return None
    idf = inverse_frequencies(*document_frequencies(docs, text_col, shape_counts))
    x = _rows(dense(counts, BUCKETS + MARKS), idf)
    rng = np.random.default_rng(6)
    q = rng.standard_normal((x.shape[1], dimensions + 16)).astype(np.float32)
    for _ in range(4):  # power iterations towards the leading right singular vectors
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
    basis = (q @ vt.T[:, :dimensions]).astype(np.float32)
    return Neighbours(idf, basis, _latent(x, basis), sample["_label"].to_numpy(float), sample["weight"].to_numpy(float))


def vote(z: np.ndarray, model: Neighbours, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """The similarity-weighted share of label 1 among each row's nearest labelled rows."""
    cosines = z @ model.vectors.T
    k = min(neighbours, cosines.shape[1])
    near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
    sims = np.maximum(np.take_along_axis(cosines, near, axis=1), 1e-6).astype(float) ** 8 * model.weights[near]
    return (sims * model.labels[near]).sum(axis=1) / sims.sum(axis=1)


def score_quality(docs: DataFrame, model: Neighbours | None, *, text_col: str = "text",
                  threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted``; nothing is shuffled.

    Null and empty texts are scored like any text (no trigram but the ends). Without a model every score is 0.5.
    Columns of ``docs`` with these names are replaced; repeated rows get equal results.
    """
    out = docs.drop("score", "predicted")
    names = out.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                texts = part.column(names.index(text_col)).to_pylist()
                score = np.full(len(texts), 0.5)
                if model is not None:
                    x = np.stack([_counts(t) for t in texts]).astype(np.float32)
                    score = np.clip(vote(_latent(_rows(x, model.idf), model.basis), model), 0.0, 1.0)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                    [*names, "score", "predicted"])

    schema = out.withColumns({"score": F.lit(0.0), "predicted": F.lit(1)}).schema
    return out.mapInArrow(run, schema)
