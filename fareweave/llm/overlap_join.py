"""Exact Jaccard join of documents on word n-grams by T-occurrence search (DivideSkip), and its components.

1. A document becomes its set of 64-bit n-gram hashes; equal sets are one class, named by its smallest id, or by a
   number from the set's digest where that id has several rows (or is null). Ids come back in at the end.
2. *Routing.* Two sets of sizes a <= b with Jaccard >= t differ in at most H = (a + b)(1 - t)/(1 + t) elements. The
   n-gram universe is cut by a hash into H + 1 + spare parts (H taken for the size class of a): at least
   spare + 1 parts are equal in both sets, so two linked sets share the digest of a non-empty part. A set with
   more than spare empty parts also joins its size class's cell of sparse sets, which covers the case that the
   equal parts are all empty. A cell is the representatives that share a digest. A set of which too few parts are
   shared with anyone (T-occurrence over the part digests: parts - differences - empty parts) can't be linked.
3. *Star search.* Every set is a candidate of the smallest set that it shares a cell with; that one asks a
   T-occurrence search over its candidates' inverted lists. Links so found are contracted into components.
4. *Rest search.* Sets that share cells, directly or in a chain, form a block; no link leaves a block. A block that
   still holds several components is searched: the sets outside its largest component ask all its sets. After that
   every pair that shares a cell is linked, searched or known to be in one component, so nothing is missed.

Large blocks are split by a salt (a bounded number of indexed sets a task, queries sent to every part); all counts and
minima are map-side combined aggregates; intermediate tables go to the shared checkpoint folder.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from itertools import islice
from math import log2

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, discard, key_pieces, materialize, small_or_plain

#: Parts beyond the number of differences H: at least so many, and one for every so many differences.
SPARE, SPARE_EACH = 3, 6
#: A size class ends where it is this many times a factor 1/t wide.
CLASS_STEPS = 2
#: Sets indexed together in one task; larger groups are split.
INDEX_ROWS = 2000
#: Tables of parts, cells and links have at most one file for so many documents.
DOCS_A_FILE = 1000
#: DivideSkip's weight of a binary probe against a heap step.
PROBE_WEIGHT = 0.0085

_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the ``words``-grams; a shorter text is one n-gram; no words give an empty set.

    Words are the runs without ASCII white space, after lower-casing A-Z only (`bytes.lower`, `bytes.split`).
    """
    from xxhash import xxh64_intdigest

    found = (text or "").encode().lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxh64_intdigest, found), np.uint64, len(found))
    n = min(words, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[k:len(h) - n + 1 + k])
    return np.unique(out)


class Threshold:
    """Jaccard >= percent / 100 in whole numbers, and the size classes and parts that follow from it."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.lows = [1]

    def largest_partner(self, a: int) -> int:
        return a * 100 // self.percent

    def needed(self, a: int, b: int) -> int:
        """The smallest intersection of sets of these sizes that links them."""
        return -(-(a + b) * self.percent // (100 + self.percent))

    def size_class(self, n: int) -> int:
        while self.lows[-1] <= n:
            top = self.lows[-1]
            for _ in range(CLASS_STEPS):
                top = self.largest_partner(top) + 1
            self.lows.append(top)
        k = bisect_left(self.lows, n + 1) - 1
        return k

    def differences(self, total: int) -> int:
        """The most elements in which linked sets differ, by the sum of their sizes."""
        return total * (100 - self.percent) // (100 + self.percent)

    def parts(self, k: int) -> tuple[int, int]:
        """Parts of the universe for pairs whose smaller set is in class ``k``, and how many of them are spare."""
        self.size_class(self.lows[k])
        a = self.lows[k + 1] - 1
        most = self.differences(a + self.largest_partner(a))
        spare = SPARE + most // SPARE_EACH
        return most + 1 + spare, spare

    def shared(self, n: int, k: int, empty: int) -> int:
        """Non-empty parts that a set of ``n`` with ``empty`` empty parts shares at least with a linked one in ``k``."""
        other = self.largest_partner(n) if self.size_class(n) == k else self.lows[k + 1] - 1
        return max(1, self.parts(k)[0] - self.differences(n + other) - empty)

    def classes(self, n: int) -> list[int]:
        """The classes that the smaller set of a linked pair with a set of ``n`` can be in, as far as ``n`` >= it."""
        own = self.size_class(n)
        return [own] if own == 0 or self.largest_partner(self.lows[own] - 1) < n else [own, own - 1]


def part_digests(grams: np.ndarray, threshold: Threshold) -> tuple[np.ndarray, list[int]]:
    """The digests of the non-empty parts of a set, and that of the sparse cell where it belongs there; the lowest
    bit is that of the class. With them, for classes of even and odd number, how many a linked set shares."""
    out, shared = [], [0, 0]
    spread = _mixed(grams)
    for k in threshold.classes(len(grams)):
        m, spare = threshold.parts(k)
        part = ((spread >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        order = np.argsort(part, kind="stable")
        sorted_part = part[order]
        starts = np.flatnonzero(np.concatenate([[True], sorted_part[1:] != sorted_part[:-1]]))
        sums = np.add.reduceat(spread[order], starts)
        found = _mixed(sums + sorted_part[starts] * _MIX + np.uint64(k + 1))
        empty = m - len(starts)
        if empty > spare:
            found = np.append(found, _mixed(np.array([k + 1], np.uint64) * _MIX))
        out.append(found & ~np.uint64(1) | np.uint64(k & 1))
        shared[k & 1] = threshold.shared(len(grams), k, empty)
    return np.concatenate(out), shared


def shingle_rows(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """``doc_id, text_key, n_shingles, digest`` (of the set; null if empty), ``parts`` (digests) and ``shared`` of every
    document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        threshold = Threshold(percent)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sizes, digests, parts, shared = [], [], [], []
                for text in part.column(1).to_pylist():
                    grams = shingle_set(text, words)
                    sizes.append(len(grams))
                    digests.append(xxh3_128_digest(grams.tobytes()) if len(grams) else None)
                    found, least = part_digests(grams, threshold) if len(grams) else (np.zeros(0, np.uint64), [0, 0])
                    parts.append(found.view(np.int64))
                    shared.append(least)
                offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts))),
                     pa.array(shared, pa.list_(pa.int32()))],
                    ["doc_id", "text_key", "n_shingles", "digest", "parts", "shared"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("text_key")).mapInArrow(
        run, "doc_id long, text_key long, n_shingles long, digest binary, parts array<long>, shared array<int>")


class Inverted:
    """Inverted lists over a bounded number of sets, searched by DivideSkip."""

    def __init__(self, sets: list[np.ndarray], threshold: Threshold) -> None:
        self.threshold = threshold
        self.sizes = np.array([len(s) for s in sets])
        grams = np.concatenate(sets)
        order = np.argsort(grams, kind="stable")
        self.owners = np.repeat(np.arange(len(sets)), self.sizes)[order]
        grams = grams[order]
        starts = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
        self.grams = grams[starts]
        self.starts = np.append(starts, len(grams))

    def search(self, query: np.ndarray, indexed: bool) -> list[int]:
        """The sets whose intersection with ``query`` reaches what their two sizes need, itself included if ``indexed``."""
        n = len(query)
        need = self.threshold.needed
        in_range = self.sizes[(self.sizes * 100 >= n * self.threshold.percent)
                              & (self.sizes * self.threshold.percent <= n * 100)]
        if not len(in_range):
            return []
        t = need(n, int(in_range.min()))
        at = np.minimum(np.searchsorted(self.grams, query), len(self.grams) - 1)
        at = at[self.grams[at] == query]
        lengths = self.starts[at + 1] - self.starts[at]
        if (lengths > 1).sum() < t if indexed else len(at) < t:
            return []  # too few lists hold another set
        by_length = at[np.argsort(lengths, kind="stable")]
        longest = int(lengths.max())
        long_lists = min(t - 1, int(t / (PROBE_WEIGHT * log2(longest + 1) + 1)))
        cut = len(by_length) - long_lists
        counts = self._merged([self.owners[self.starts[g]:self.starts[g + 1]].tolist() for g in by_length[:cut]],
                              t - long_lists)
        if not counts:
            return []
        found = np.fromiter(counts, np.int64, len(counts))
        total = np.fromiter(counts.values(), np.int64, len(counts))
        for g in by_length[cut:]:
            held = self.owners[self.starts[g]:self.starts[g + 1]]
            k = np.searchsorted(held, found)
            total += held[np.minimum(k, len(held) - 1)] == found
        return [int(o) for o, c in zip(found, total) if c >= need(n, int(self.sizes[o]))]

    @staticmethod
    def _merged(lists: list[list[int]], least: int) -> dict[int, int]:
        """Heap-merge of sorted lists: owners that occur at least ``least`` times, with their counts, in order."""
        out: dict[int, int] = {}
        current, count = -1, 0
        for owner in heapq.merge(*lists):
            if owner == current:
                count += 1
                continue
            if count >= least and current >= 0:
                out[current] = count
            current, count = owner, 1
        if count >= least and current >= 0:
            out[current] = count
        return out


class CellPart:
    """The indexed rows of one cell part, which come first, and the answers to those that ask them."""

    def __init__(self, threshold: Threshold) -> None:
        self.threshold = threshold
        self.pieces: list[pd.DataFrame] = []
        self.index: Inverted | None = None

    def indexed(self) -> Iterator[tuple[int, int]]:
        """Index the rows so far; the links of those among them that ask."""
        if self.pieces:
            kept, self.pieces = pd.concat(self.pieces), []
            self.ids = kept["id"].to_numpy()
            self.index = Inverted([np.frombuffer(g, np.uint64) for g in kept["grams"]], self.threshold)
            yield from self.answers(kept)

    def answers(self, askers: pd.DataFrame) -> Iterator[tuple[int, int]]:
        if self.index is None:
            return
        for asker, grams, own in askers.loc[askers["asks"], ["id", "grams", "indexed"]].itertuples(index=False):
            for k in self.index.search(np.frombuffer(grams, np.uint64), own):
                if self.ids[k] != asker:
                    yield asker, self.ids[k]


def cell_links(batches: Iterator[pd.DataFrame], percent: int) -> Iterator[tuple[int, int]]:
    """Links of a partition's cell parts. Rows are sorted by ``cell, salt`` and, in a part, the indexed ones come first;
    these are held (the salt bounds them), rows that only ask pass in pieces of a batch."""
    threshold = Threshold(percent)
    part, at = CellPart(threshold), None
    for (cell, salt, indexed), piece in key_pieces(batches, ["cell", "salt", "indexed"]):
        if (cell, salt) != at:
            yield from part.indexed()
            part, at = CellPart(threshold), (cell, salt)
        if indexed:
            part.pieces.append(piece)
        else:
            yield from part.indexed()
            yield from part.answers(piece)
    yield from part.indexed()


def _search_cells(rows: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` in cells given as rows ``cell, salt, id, grams, indexed, asks``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        links = cell_links(batches, percent)
        while some := list(islice(links, 10_000)):
            yield pd.DataFrame(some, columns=["a", "b"])

    spread = rows.repartition("cell", "salt").sortWithinPartitions("cell", "salt", F.desc("indexed"))
    return spread.select("cell", "salt", "id", "grams", "indexed", "asks").mapInPandas(run, "a long, b long")


def _with_sets(members: DataFrame, sets: DataFrame) -> DataFrame:
    return members.join(sets, "id")


def _star_links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The linked ones of candidate ``pairs (id, centre)``: each centre asks an index of its members."""
    parts = pairs.groupBy("centre").agg(F.ceil(F.count("*") / INDEX_ROWS).cast("int").alias("n"))
    members = pairs.join(parts, "centre").select(
        F.col("centre").alias("cell"), F.pmod(F.xxhash64("id"), F.col("n")).cast("int").alias("salt"), "id",
        F.lit(True).alias("indexed"), F.lit(False).alias("asks"))
    centres = parts.select(F.col("centre").alias("cell"), F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("salt"),
                           F.col("centre").alias("id"), F.lit(False).alias("indexed"), F.lit(True).alias("asks"))
    return _search_cells(_with_sets(members.unionByName(centres), sets), percent)


def _rest_links(blocks: DataFrame, components: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links in the blocks that hold several components: the members outside the largest one ask all members."""
    named = blocks.join(components, "id", "left").select(
        "id", F.col("block").alias("cell"), F.coalesce("component", "id").alias("component"))
    mixed = named.groupBy("cell", "component").count().groupBy("cell").agg(
        F.count("*").alias("kinds"), F.max_by("component", F.struct("count", "component")).alias("largest"),
        F.ceil(F.sum("count") / INDEX_ROWS).cast("int").alias("n"), F.sum("count").alias("size")).where(
        (F.col("kinds") > 1) & (F.col("size") > 2)).select("cell", "largest", "n")
    rows = named.join(mixed, "cell").withColumn("asks", F.col("component") != F.col("largest")).withColumn(
        "own", F.pmod(F.xxhash64("id"), F.col("n")).cast("int"))
    spread = rows.withColumn("salt", F.explode(F.when(F.col("asks"), F.sequence(F.lit(0), F.col("n") - 1)).otherwise(
        F.array("own")))).select("cell", "salt", "id", (F.col("salt") == F.col("own")).alias("indexed"), "asks")
    return _search_cells(_with_sets(spread, sets), percent)


def jaccard_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
                       percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id, class_id, group_id, text_key`` of every row of ``docs``.

    Two documents link when 100 * intersection >= percent * union of their sets of ``words``-grams. ``class_id`` is
    the smallest id with the same set, ``component_id`` the smallest id reachable by links (null ids are left out of
    both; null if there is no other). ``group_id`` is one number per component, whatever its ids; ``text_key`` is
    xxhash64 of the text. Null, empty and wordless texts have no n-gram, are their own class and component and have
    no group. Rows are told apart by their texts: an id that repeats with other texts is in the component of each of
    them, and repeated rows are each returned. Other columns are not read.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    shingles = materialize(shingle_rows(docs, "doc_id", "text", words, percent), "shingles")
    rows = materialize(shingles.select("doc_id", "text_key", "n_shingles", "digest"), "rows")
    n = rows.count()
    # ids of several rows, which may hold different sets, and null: no class is named by them
    odd = materialize(rows.groupBy("doc_id").count().where(F.col("doc_id").isNull() | (F.col("count") > 1)).select(
        F.col("doc_id").alias("odd_id")), "odd", n)
    odd = small_or_plain(odd)
    is_odd = F.col("doc_id").eqNullSafe(F.col("odd_id"))
    classes = shingles.where(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("rows"), F.first("shared").alias("shared"))
    classes = materialize(classes.join(odd, F.col("class_id").eqNullSafe(F.col("odd_id")), "left").select(
        "digest", "class_id", "rows", "shared", (F.col("odd_id").isNotNull() | F.col("class_id").isNull()).alias("odd")), "classes", n)
    classes = classes.withColumn("id", _class_name(classes))
    by_digest = classes.where("odd").select("digest", "id")
    copies = rows.join(classes.where("rows > 1").select("digest", "class_id"), "digest").where(
        F.col("doc_id") != F.col("class_id")).select("doc_id")
    copies = materialize(copies, "copies", n)
    plain = shingles.where("n_shingles > 0").join(odd, is_odd, "left_anti").join(small_or_plain(copies), "doc_id", "left_anti")
    named_apart = shingles.join(odd, is_odd, "left_semi").join(by_digest, "digest").dropDuplicates(["id"])
    one = plain.select(F.col("doc_id").alias("id"), "parts").union(named_apart.select("id", "parts"))
    parts = one.select("id", F.explode("parts").alias("cell"))
    met = materialize(_met(parts), "met", n, DOCS_A_FILE)
    discard(shingles)
    # a set that shares too few parts leaves
    enough = met.groupBy("id", F.col("cell").bitwiseAND(F.lit(1)).alias("bit")).count().join(
        classes.select("id", "shared"), "id").where(
        F.col("count") >= F.get("shared", F.col("bit").cast("int"))).select("id", "bit").distinct()
    cells = materialize(_met(met.withColumn("bit", F.col("cell").bitwiseAND(F.lit(1))).join(
        enough, ["id", "bit"], "left_semi").select("id", "cell")), "cells", n, DOCS_A_FILE)
    discard(met)
    pairs = materialize(cells.where(F.col("id") != F.col("centre")).select("id", "centre").distinct(), "pairs", cells.count())
    wanted = materialize(cells.select("id").distinct(), "wanted", n)
    discard(cells)
    held = small_or_plain(wanted)
    asked = docs.join(odd, is_odd, "left_anti").join(held, docs["doc_id"] == held["id"], "left_semi")
    apart = _sets(docs.join(odd, is_odd, "left_semi"), words).join(by_digest, "digest").join(held, "id", "left_semi")
    sets = materialize(_sets(asked, words).select(F.col("doc_id").alias("id"), "grams").union(
        apart.select("id", "grams").dropDuplicates(["id"])), "sets")

    first = pairs.groupBy("id").agg(F.min("centre").alias("centre"))
    links = materialize(_star_links(first, sets, percent), "links", n, DOCS_A_FILE)
    known = materialize(connected_components(links, "a", "b"), "components", n)
    blocks = connected_components(pairs, "id", "centre").select(F.col("node").alias("id"), F.col("component").alias("block"))
    rest = materialize(_rest_links(blocks, known.withColumnRenamed("node", "id"), sets, percent), "rest", n, DOCS_A_FILE)
    discard(sets)
    known = connected_components(
        rest.union(known.select(F.col("node").alias("a"), F.col("component").alias("b"))), "a", "b")
    grouped = classes.join(known, classes["id"] == known["node"], "left").select(
        "digest", "class_id", F.coalesce("component", "id").alias("group_id"), F.col("component").isNotNull().alias("linked"))
    least = grouped.where("linked").groupBy("group_id").agg(F.min("class_id").alias("least"))
    named = grouped.join(small_or_plain(least), "group_id", "left").select(
        "digest", "class_id", "group_id", F.coalesce("least", "class_id").alias("component_id"))
    found = rows.select("doc_id", "text_key", "n_shingles", "digest").join(named, "digest", "left")
    alone = F.col("digest").isNull()
    return found.select("doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), "group_id", "text_key")


def _class_name(classes: DataFrame) -> Column:
    """A number for each class, no two alike: its smallest id where that has one row, else a 64-bit hash of its
    digest, with the first seed that has no collision."""
    for seed in range(1000):
        name = F.when(F.col("odd"), F.xxhash64("digest", F.lit(seed))).otherwise(F.col("class_id"))
        if classes.groupBy(name.alias("id")).count().where("count > 1").isEmpty():
            return name
    raise RuntimeError("no seed gives every set a name of its own")


def _met(parts: DataFrame) -> DataFrame:
    """``id, cell, centre`` for the cells with two members and more; the centre is the smallest. The rows are shuffled
    by cell once, and that shuffle is read for the centres and again for the members."""
    parts = parts.repartition("cell")
    centres = parts.groupBy("cell").agg(F.min("id").alias("centre"), F.max("id").alias("last")).where(
        F.col("centre") < F.col("last")).select("cell", "centre")
    return parts.join(centres, "cell").select("id", "cell", "centre").distinct()


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, digest, grams`` (the sorted hashes as bytes) of the documents that have words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                grams = [shingle_set(t, words).tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([xxh3_128_digest(g) for g in grams], pa.binary()),
                     pa.array(grams, pa.binary())], ["doc_id", "digest", "grams"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, digest binary, grams binary").where(
        F.octet_length("grams") > 0)
