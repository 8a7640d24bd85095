"""Fill-in-middle examples cut through a learned rank index of token boundaries.

The boundaries of a text's tokens are a rising sequence: boundary ``i`` ends token ``i`` (boundary 0 is the start).
``RankIndex`` fits it with straight segments, each from its first boundary on and off by at most ``error`` code points
(the cone of slopes that keep all boundaries so far within the error; a boundary that empties the cone starts the next
segment). What a segment's line misses is stored as a residual per boundary, so a looked-up cut is the prediction
plus its residual: exact whatever the fit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed by the format: the three marks of an example.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def boundaries(text: str) -> np.ndarray:
    """Code-point offsets of all token boundaries, 0 first: a token is a word with the white space before it
    (``\\x20\\x09-\\x0D``), or the white space that ends the text."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(code):
        return np.zeros(1, np.int64)
    word = ~((code == 32) | ((code >= 9) & (code <= 13)))
    end = word.copy()
    end[:-1] &= ~word[1:]
    end[-1] = True
    return np.concatenate([[0], np.flatnonzero(end) + 1])


class RankIndex:
    """Piecewise-linear prediction of ``offsets[rank]`` within ``error``, exact with the stored residuals."""

    def __init__(self, offsets: np.ndarray, error: int = 32) -> None:
        n = len(offsets)
        firsts, slopes, at = [], [], 0
        while at < n:
            slope, size = self._segment(offsets, at, error)
            firsts.append(at)
            slopes.append(slope)
            at += size
        self.firsts = np.array(firsts, np.int64)
        self.bases = offsets[self.firsts]
        self.slopes = np.array(slopes)
        small = np.int8 if error < 126 else np.int32
        self.residuals = (offsets - self.predict(np.arange(n))).astype(small)

    @staticmethod
    def _segment(offsets: np.ndarray, first: int, error: int) -> tuple[float, int]:
        """The slope and number of boundaries of the longest segment from ``first``; looks ahead in growing steps."""
        low, high, done, step = -np.inf, np.inf, 1, 64
        while first + done < len(offsets):
            rise = offsets[first + done:first + done + step] - offsets[first]
            run = np.arange(done, done + len(rise))
            lows = np.maximum(np.maximum.accumulate((rise - error) / run), low)
            highs = np.minimum(np.minimum.accumulate((rise + error) / run), high)
            bad = np.flatnonzero(lows > highs)
            fits = int(bad[0]) if len(bad) else len(rise)
            if fits:
                low, high = float(lows[fits - 1]), float(highs[fits - 1])
            done += fits
            if len(bad):
                break
            step *= 2
        return (0.0 if done == 1 else (low + high) / 2), done

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        """The lines' offsets, rounded to whole code points."""
        seg = np.searchsorted(self.firsts, ranks, "right") - 1
        return self.bases[seg] + np.rint(self.slopes[seg] * (ranks - self.firsts[seg])).astype(np.int64)

    def lookup(self, ranks) -> np.ndarray:
        """The exact offsets."""
        ranks = np.asarray(ranks, np.int64)
        return self.predict(ranks) + self.residuals[ranks]


def _draws(id_col: str, seed: int) -> list[Column]:
    """The first four 32-bit numbers of sha256 of ``seed:id`` (a null id as the empty text)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def fill_in_middle(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", seed: int = 42,
                   percent: int = 50, spm_percent: int = 80, error: int = 32) -> DataFrame:
    """One row per document: ``doc_id, n`` (tokens), ``form`` (plain, psm or spm), ``prefix_chars, middle_chars`` (code
    points, null if plain), ``output`` (the example's text), ``n_segments`` and ``max_residual`` of its rank index.

    Null and empty texts, and texts that hold a mark, are plain; the output of a null text is empty. Each row depends on
    its own id and text alone, so repeated rows and ties give equal rows. Other columns of ``docs`` play no part.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):  # long texts: keep an output batch small
                part = batch.slice(k, 256)
                rows = [_example(t or "", *h) for t, *h in zip(*(part.column(c).to_pylist() for c in range(1, 6)))]
                n, form, prefix, middle, output, segments, residual = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()),
                     pa.array(middle, pa.int64()), pa.array(output), pa.array(segments, pa.int64()),
                     pa.array(residual, pa.int64())],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "n_segments", "max_residual"])

    def _example(text: str, h1: int, h2: int, h3: int, h4: int) -> tuple:
        offsets = boundaries(text)
        n = len(offsets) - 1
        index = RankIndex(offsets, error)
        shape = (len(index.firsts), int(np.abs(index.residuals.astype(np.int64)).max()))
        if not text or h3 % 100 >= percent or PREFIX in text or SUFFIX in text or MIDDLE in text:
            return n, "plain", None, None, text, *shape
        a, b = index.lookup(sorted((h1 % (n + 1), h2 % (n + 1)))).tolist()
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        if h4 % 100 < spm_percent:
            return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}", *shape
        return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}", *shape

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       *_draws(id_col, seed))
    return rows.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, "
                                "n_segments long, max_residual long")


def restored_text(output: str = "output", form: str = "form") -> Column:
    """The text an example was made from: the pieces between the marks in reading order."""
    piece = F.split(F.col(output), f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    psm = F.concat(piece[1], piece[3], piece[2])
    spm = F.concat(piece[2], piece[3], piece[1])
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.col(output))
