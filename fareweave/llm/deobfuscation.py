"""Toxicity of restored text: obfuscated words are decoded under a character model, then scored.

The character model counts 4-grams over all documents. Letters without a doubled one have one reading; all other
tokens that can hold a word, and runs of neighbouring tokens of up to three characters with any white space between
them, are decoded by Viterbi without a beam. The restored words count beside the words as they are written. When
texts are scored, a token is decoded only if evidence can come out of its lattice (an exact test on letters that are
folded, see ``folded``). Words and word
beginnings that tell toxic from other labelled texts are learned from a bounded, documented sample by greedy cover:
the one that explains the most of what toxic texts have left to explain is taken next, so words that merely occur
together with toxic ones are not. The score is the posterior of the evidence in a text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .char_lattice import (GRAMS, SHORT, CharModel, Decoder, count_grams, folded, has_pair, needs_decoding,
                           plain_words, short_runs)
from .features import bounded_sample

#: Labelled rows per class that evidence is learned from.
PER_CLASS = 3000
THRESHOLD = 0.3
#: Lengths of word beginnings that can be evidence.
PREFIXES = range(4, 9)
#: Evidence must occur in so many toxic sample rows, and be toxic with this probability.
MIN_ROWS, MIN_SHARE, MIN_PRECISION = 3, 0.002, 0.85
#: What is left of a toxic row to explain once evidence is found in it, and the least that new evidence must explain
#: (in rows, as a share of the rows that it must occur in).
REST, MIN_GAIN = 0.3, 0.7
CACHE_LIMIT = 1_000_000

_READERS: dict[str, "Reader"] = {}


@dataclass
class Evidence:
    weights: dict[str, float]
    prior: float
    without: float


def char_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """4-gram counts over every text: one sparse vector a task, summed (at most 28^4 rows come back)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(GRAMS, np.int64)
        for batch in batches:
            held, size = [], 0
            for text in batch.column(0).to_pylist():
                held.append(text)
                size += len(text or "")
                if size > 1 << 21:
                    total += count_grams(held)
                    held, size = [], 0
            total += count_grams(held)
        hit = total.nonzero()[0]
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(total[hit])], ["g", "n"])

    found = docs.select(text_col).mapInArrow(run, "g int, n long").groupBy("g").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(GRAMS, np.int64)
    out[found["g"].to_numpy()] = found["n"].to_numpy()
    return out


class Reader:
    """The restored words of texts; each distinct token is read once while it stays in the cache."""

    def __init__(self, cost: np.ndarray, value, wanted: list[str] | None = None) -> None:
        """With ``wanted`` (words or their beginnings) only tokens that can hold one of them are decoded."""
        self.decoder, self.value = Decoder(cost.reshape(-1)), value
        self.tokens: dict[str, object] = {}
        self.able = None
        if wanted is not None:
            stems = sorted({f for w in wanted if (f := folded(w))})
            self.able = re.compile("|".join(map(re.escape, stems)) or r"(?!)")

    def decoded(self, core: str) -> list[str]:
        if self.able is not None and not self.able.search(folded(core)) and not has_pair(core):
            return []
        return self.decoder.decode(core).split()

    def words(self, token: str) -> list[str]:
        core = needs_decoding(token)
        return plain_words(token) + (self.decoded(core) if core else [])

    def __call__(self, text: str | None) -> list:
        """``value(words)`` of every distinct token of the text, without the empty ones."""
        if not text:
            return []
        if len(self.tokens) > CACHE_LIMIT:
            self.tokens.clear()
        text = text.lower()
        known, out = self.tokens, []
        for token in set(text.split()):
            try:
                v = known[token]
            except KeyError:
                v = known[token] = self.value(self.words(token))
            if v:
                out.append(v)
        for run in set(short_runs(text)):
            if v := self.value([w for w in self.decoded(run) if len(w) > SHORT]):  # shorter words are tokens already
                out.append(v)
        return out


def _reader(key: str, cost: np.ndarray, value, wanted: list[str]) -> Reader:
    """The worker's own reader for a model, kept between tasks."""
    if key not in _READERS:
        _READERS.clear()
        _READERS[key] = Reader(cost, value, wanted)
    return _READERS[key]


def _features(words: list[str]) -> tuple[str, ...]:
    """Beginnings (ending in *) and whole words."""
    return tuple({f for w in words for f in [w, *(w[:n] + "*" for n in PREFIXES if len(w) >= n)]})


def learn_evidence(docs: DataFrame, labels: DataFrame, cost: np.ndarray, *, id_col: str = "doc_id",
                   text_col: str = "text", label_col: str = "toxic", per_class: int = PER_CLASS) -> Evidence:
    """Evidence from the labelled rows of ``docs``; nulls are not learned from; of repeated labels the largest counts."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(id_col).agg(
        F.max(label_col).cast("int").alias("_label"))
    picked = bounded_sample(known, "_label", id_col, per_class, seed=1)
    # bounded by 2 * per_class * number of labels rows
    rows = docs.select(id_col, text_col).join(F.broadcast(picked), id_col).dropDuplicates([id_col])
    shared = docs.sparkSession.sparkContext.broadcast(cost)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = Reader(shared.value, _features)
        for batch in batches:
            for k in range(0, batch.num_rows, 200):
                part = batch.slice(k, 200)
                found = [sorted(set().union(*read(t))) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), part.column(3), pa.array(found, pa.list_(pa.string()))],
                    ["id", "label", "weight", "features"])

    read = rows.select(F.col(id_col).cast("string"), text_col, "_label", "weight").mapInArrow(
        run, "id string, label int, weight double, features array<string>")
    totals = {r[0]: (r[1], r[2]) for r in rows.groupBy("_label").agg(F.count("*"), F.sum("weight")).collect()}
    toxic, toxic_w = totals.get(1, (0, 0.0))
    clean, clean_w = totals.get(0, (0, 0.0))
    if not toxic or not clean:
        return Evidence({}, 0.5 if not totals else float(bool(toxic)), 0.0)
    ratio = (clean_w / clean) / (toxic_w / toxic)
    least = max(MIN_ROWS, int(MIN_SHARE * toxic))
    each = read.select("id", "label", F.explode("features").alias("feature"))
    counts = each.groupBy("feature").agg(
        F.count_if(F.col("label") == 1).alias("t"), F.count_if(F.col("label") == 0).alias("c"))
    able = counts.where((F.col("t") >= least) & (F.col("t") >= MIN_PRECISION * (F.col("t") + ratio * F.col("c"))))
    held = each.where("label = 1").join(able, "feature").groupBy("id").agg(
        F.collect_list(F.struct("feature", "t", "c")).alias("f")).toPandas()  # bounded by the sample
    number: dict[str, tuple[int, int]] = {}
    rows_of: dict[str, list[int]] = {}
    for k, found in enumerate(held["f"]):
        number.update({x["feature"]: (x["t"], x["c"]) for x in found})
        for x in found:
            rows_of.setdefault(x["feature"], []).append(k)
    weights: dict[str, float] = {}
    unexplained = np.ones(len(held))
    gain = {f: float(len(k)) for f, k in rows_of.items()}
    while gain:
        best = max(gain, key=lambda f: (gain[f], -number[f][1], len(f), f))
        now = float(unexplained[rows_of[best]].sum())
        if now < gain[best] - 1e-9:  # others were taken since: its gain is less now
            gain[best] = now
            continue
        if now < MIN_GAIN * least:
            break
        t, c = number[best]
        weights[best] = float(np.log((t + 0.5) / (toxic + 1)) - np.log((c + 0.5) / (clean + 1)))
        unexplained[rows_of[best]] *= REST
        del gain[best]
    explained = int((unexplained < 1).sum())
    prior = toxic_w / (toxic_w + clean_w)
    missed = (toxic - explained + 1) / (toxic + 2)
    return Evidence(weights, float(np.log(prior / (1 - prior))), float(np.log(missed)))


def score_toxicity(docs: DataFrame, cost: np.ndarray, evidence: Evidence, *, id_col: str = "doc_id",
                   text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs``' id and ``score``, ``predicted``, ``n_evidence`` (distinct restored tokens that are evidence).

    Null and empty texts have no evidence and get the score of a text without any. Null ids and repeated rows are
    rows like any other; long texts are read whole; other columns are not read.
    """
    weights = evidence.weights
    shared = docs.sparkSession.sparkContext.broadcast(cost)
    key = f"{hash(tuple(sorted(weights.items())))}-{float(cost.sum())}"

    def value(words: list[str]) -> float:
        return max((weights.get(f, 0.0) for f in _features(words)), default=0.0) if words else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = _reader(key, shared.value, value, [f.rstrip("*") for f in weights])
        for batch in batches:
            found = [read(t) for t in batch.column(1).to_pylist()]
            total = np.array([sum(f) if f else evidence.without for f in found])
            score = 1 / (1 + np.exp(-(evidence.prior + total)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array((score >= threshold).astype(np.int32)),
                 pa.array([len(f) for f in found], pa.int32())], [id_col, "score", "predicted", "n_evidence"])

    return docs.select(F.col(id_col).cast("long").alias(id_col), text_col).mapInArrow(
        run, f"{id_col} long, score double, predicted int, n_evidence int")


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> tuple[np.ndarray, Evidence]:
    """The character model over all of ``docs`` and the evidence from its labelled rows."""
    cost = CharModel(char_counts(docs, text_col)).cost
    return cost, learn_evidence(docs, labels, cost, id_col=id_col, text_col=text_col, label_col=label_col)
