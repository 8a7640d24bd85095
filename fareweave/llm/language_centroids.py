"""Language identification by the nearest of several clustered centroids per language.

Texts become normalised TF-IDF vectors of letter trigrams; the vectors of a bounded, documented sample of each
language are clustered by spherical k-means, and a text takes the language of the centroid with the largest
cosine. Each centroid has a rejection distance, a low quantile of its own rows; a text farther than that from every
centroid is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import (BUCKETS, bounded_sample, count_rows, dense, document_frequencies, inverse_frequencies,
                       letter_counts, tf_idf)

#: Sampled rows per language that the centroids are fitted on, and centroids per language.
PER_LANGUAGE = 800
CENTROIDS = 4
#: Term frequency: the count itself, so that the larger part of a mixed text decides its language.
TF = np.asarray
#: A cosine is rejected under this share of the quantile of the cosines of the centroid's own rows.
REJECT_SHARE, REJECT_QUANTILE = 0.8, 0.01
#: A centroid of a smaller share of its language's rows is an outlier or a wrong label and lets no text pass; one of
#: fewer rows takes the quantile of its language.
CORE_SHARE, CORE_ROWS = 0.02, 30
#: Short texts have lower cosines: with n trigrams by sqrt(n / (n + SHORT)).
SHORT = 150


@dataclass
class Centroids:
    idf: np.ndarray
    vectors: np.ndarray
    languages: list[str]
    bounds: np.ndarray


def _clusters(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts from the rows farthest from those already taken."""
    centres = [x.mean(axis=0) / max(np.linalg.norm(x.mean(axis=0)), 1e-12)]
    while len(centres) < min(k, len(x)):
        centres.append(x[(x @ np.array(centres).T).max(axis=1).argmin()])
    c = np.array(centres)
    for _ in range(rounds):
        nearest = (x @ c.T).argmax(axis=1)
        sums = np.array([x[nearest == j].sum(axis=0) if (nearest == j).any() else c[j] for j in range(len(c))])
        c = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return c.astype(np.float32)


def _reach(sizes: np.ndarray) -> np.ndarray:
    """How much of a long text's cosine a text of so many trigrams can be expected to have."""
    return np.sqrt(sizes / (sizes + SHORT))


def _bounds(cosines: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The least cosine, over ``_reach``, of each centroid of a language, from the cosines of its sample's rows."""
    rows = np.bincount(cosines.argmax(axis=1), minlength=cosines.shape[1])
    core = np.flatnonzero(rows >= min(CORE_SHARE * len(cosines), rows.max()))
    nearest = core[cosines[:, core].argmax(axis=1)]
    best = cosines[:, core].max(axis=1) / _reach(sizes)
    out = np.full(cosines.shape[1], np.inf)
    for j in core:
        own = best[nearest == j]
        out[j] = REJECT_SHARE * np.quantile(own if len(own) >= CORE_ROWS else best, REJECT_QUANTILE)
    return out


def fit_centroids(labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  per_language: int = PER_LANGUAGE, centroids: int = CENTROIDS) -> Centroids | None:
    """Centroids from rows with text and language; None if there are none. Document frequencies cover all rows."""
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    df, n = document_frequencies(rows, text_col, letter_counts, lang_col)
    if not n:
        return None
    idf = inverse_frequencies(df, n)
    sample, counts = count_rows(bounded_sample(rows, lang_col, id_col, per_language, seed=4, text_col=text_col), text_col,
                                [lang_col], letter_counts)
    vectors, languages, bounds = [], [], []
    for lang, at in sample.groupby(lang_col).indices.items():
        x = tf_idf(dense([counts[k] for k in at], BUCKETS), idf, TF)
        c = _clusters(x, centroids)
        vectors.append(c)
        languages += [lang] * len(c)
        bounds.append(_bounds(x @ c.T, np.array([counts[k][1].sum() for k in at])))
    return Centroids(idf, np.concatenate(vectors), languages, np.concatenate(bounds)) if vectors else None


def predict_language(docs: DataFrame, model: Centroids | None, *, id_col: str = "doc_id", text_col: str = "text"
                     ) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (largest cosine, 0 to 1) and ``rejected``; nothing is shuffled.

    ``und`` with score 0 and rejected: null text, empty text, text without letters, or no model. Columns of
    ``docs`` with these names are replaced. Long texts are read whole; repeated rows get equal results; a tie
    between centroids goes to the language first in order.
    """
    out = docs.drop("lang_pred", "score", "rejected")
    names = out.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                texts = part.column(names.index(text_col)).to_pylist()
                lang, score, rejected = ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
                lettered = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
                if model is not None and lettered:
                    x = np.empty((len(lettered), BUCKETS), np.float32)
                    for r, i in enumerate(lettered):
                        x[r] = letter_counts(texts[i])
                    cosines = tf_idf(x, model.idf, TF) @ model.vectors.T
                    far = (cosines < model.bounds * _reach(x.sum(axis=1))[:, None]).all(axis=1)
                    for i, j, s, r in zip(lettered, cosines.argmax(axis=1), cosines.max(axis=1), far):
                        lang[i], score[i], rejected[i] = model.languages[j], min(max(float(s), 0.0), 1.0), bool(r)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(lang), pa.array(score), pa.array(rejected)],
                    [*names, "lang_pred", "score", "rejected"])

    schema = out.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0), "rejected": F.lit(True)}).schema
    return out.mapInArrow(run, schema)
