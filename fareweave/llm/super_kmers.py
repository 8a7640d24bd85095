"""Repeated passages by super-k-mer partitioning.

A window is ``window`` consecutive words. Its minimiser is the smallest hash of the ``part``-word runs in it, and
neighbouring windows mostly share it: such a run of windows (a super-k-mer) travels as one packed string to the bucket
of its minimiser. Equal windows have equal minimisers, so each bucket alone tells which of its windows came first: it
sorts them (by a rolling hash of exact word codes, equal hashes compared word by word).

Documents are ordered by id (a null id as the largest), then by a hash of the text; rows that agree in both are one
document. A window is *repeated* if an equal window starts earlier in that order, or earlier in the same document.

Skew: equal packed strings of a task are sent once, the others are repeats on the spot. Where one minimiser of a task
has ``hot`` different strings or more (a common line in many contexts), its windows leave the bucket scheme and
travel by their own 128-bit digest, and a marker tells the bucket to pass on its first windows of that minimiser too.
A bucket with more words than one task should hold is worked in pieces, whose first windows are passed on likewise.
The windows passed on meet by digest in an ordinary aggregation. Nothing is dropped or capped on any of these ways.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

LAST_ID = (1 << 63) - 1
#: Words a task cuts into super-k-mers at a time, words a bucket works on at a time, bytes of packed strings a bucket
#: is meant to hold, and different strings of a minimiser in one cut from which on it is hot.
CUT_WORDS, BUCKET_WORDS, BUCKET_BYTES, HOT = 1_000_000, 2_000_000, 4 << 20, 32
_MARKER, _STRINGS, _REPEATS, _WINDOWS = 0, 1, 2, 3
_CODEC = "zstd"
_GAP = re.compile(rb"[ \t-\r]")
#: Odd multipliers of the windows' rolling hash (of a word's code, of the hash so far).
_MIX = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_SENT = "bucket int, kind int, size long, body binary"
_FOUND = "digest binary, doc_id long, text_key long, start long, windows long"


def pieces(data: bytes, words: int, overlap: int) -> Iterator[tuple[int, list[bytes]]]:
    """``(number of the first word, words)`` of a text, at most about ``words`` at a time, each piece starting with the
    last ``overlap`` words of the one before."""
    step, at, first, carry = 8 * words, 0, 0, []
    while True:
        gap = _GAP.search(data, at + step)  # the first white space from there on: a word is never cut
        end = gap.start() if gap else len(data)
        found = carry + data[at:end].split()
        yield first, found
        if end >= len(data):
            return
        keep = min(overlap, len(found))
        first += len(found) - keep
        carry = found[len(found) - keep:]
        at = end


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = found = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return found


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of ``x[i:i + width]`` for every start, by doubling."""
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:len(x) - have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


def _runs(flags: np.ndarray, joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First positions and lengths of the runs of set flags; a run goes on only where ``joined`` is set."""
    opens = flags.copy()
    opens[1:] &= ~(flags[:-1] & joined[1:])
    firsts = np.flatnonzero(opens)
    return firsts, np.add.reduceat(flags, firsts, dtype=np.int64) if len(firsts) else np.zeros(0, np.int64)


class _Cutter:
    """Super-k-mers of the documents of one task, sent as packed strings."""

    def __init__(self, window: int, part: int, buckets: int, hot: int) -> None:
        self.window, self.part, self.buckets, self.hot = window, part, buckets, hot
        self.hashes = _WordHash()

    def _parts(self, words: list[bytes]) -> np.ndarray:
        """A well-mixed hash of every ``part``-word run."""
        if len(self.hashes) > 500_000:
            self.hashes.clear()
        one = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
        n = len(words) - self.part + 1
        x = np.zeros(n, np.uint64)
        for k in range(self.part):
            x = x * np.uint64(0x9E3779B97F4A7C15) + one[k:k + n]
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))

    def cut(self, docs: list[tuple[int, int, int, list[bytes]]]) -> Iterator[tuple]:
        """Rows ``(bucket, kind, size, body)`` of some ``(id, text key, first word's number, words)``."""
        docs = sorted((d for d in docs if len(d[3]) >= self.window), key=lambda d: d[:3])
        if not docs:
            return
        words = [w for d in docs for w in d[3]]
        sizes = np.array([len(d[3]) for d in docs])
        ends = np.cumsum(sizes)
        doc_of = np.repeat(np.arange(len(docs)), sizes)
        low = _sliding_min(self._parts(words), self.window - self.part + 1)
        valid = np.arange(len(low)) + self.window <= ends[doc_of[:len(low)]]
        same = np.zeros(len(low), bool)
        same[1:] = low[1:] == low[:-1]
        firsts, lengths = _runs(valid, same)
        joined = b" ".join(words)
        at = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)])
        begin, end = at[firsts].tolist(), (at[firsts + lengths + self.window - 1] - 1).tolist()
        packed = [joined[a:b] for a, b in zip(begin, end)]
        owner = doc_of[firsts]
        start = firsts - (ends - sizes)[owner] + np.array([d[2] for d in docs], np.int64)[owner]
        ids = np.array([d[0] for d in docs], np.int64)[owner]
        keys = np.array([d[1] for d in docs], np.int64)[owner]
        low = low[firsts]
        # the documents are in order, so the first place of a string is its earliest one here
        first_at: dict[bytes, int] = {}
        earliest = np.fromiter(map(first_at.setdefault, packed, count()), np.int64, len(packed))
        once = np.flatnonzero(earliest == np.arange(len(packed)))
        again = np.flatnonzero(earliest != np.arange(len(packed)))
        before = earliest[again]
        again = again[(ids[before] != ids[again]) | (keys[before] != keys[again]) | (start[before] != start[again])]
        value, inverse, number = np.unique(low[once], return_inverse=True, return_counts=True)
        is_hot = (number >= self.hot)[inverse]
        hot, once = once[is_hot], once[~is_hot]
        bucket = (low % np.uint64(self.buckets)).astype(np.int64)
        tag = (low >> np.uint64(48)).astype(np.uint16)
        by = np.argsort(bucket[once], kind="stable")
        once = once[by]
        cuts = np.flatnonzero(np.diff(bucket[once], prepend=-1, append=-1)) if len(once) else []
        for a, b in zip(cuts, cuts[1:]):
            k = once[a:b]
            yield int(bucket[k[0]]), _STRINGS, int(lengths[k].sum() + len(k) * (self.window - 1)), _strings(
                ids[k], keys[k], start[k], lengths[k], tag[k], [packed[j] for j in k.tolist()])
        for v in value[number >= self.hot].tolist():
            yield v % self.buckets, _MARKER, 0, (v >> 48).to_bytes(2, "little")
        spread = int(ids[0] ^ keys[0]) % self.buckets
        if len(again):
            yield spread, _REPEATS, len(again), np.stack(
                [ids[again], keys[again], start[again], lengths[again]]).tobytes()
        if len(hot):
            yield from self._hot_windows(words, firsts[hot], lengths[hot], ids[hot], keys[hot], start[hot], spread)

    def _hot_windows(self, words, firsts, lengths, ids, keys, start, spread) -> Iterator[tuple]:
        """The windows of hot minimisers by digest, earliest first; later equal ones are repeats."""
        seen: dict[bytes, tuple] = {}
        repeats = []
        for f, n, i, k, s in zip(*(x.tolist() for x in (firsts, lengths, ids, keys, start))):
            for j in range(n):
                digest = window_digest(words[f + j:f + j + self.window])
                place = (i, k, s + j)
                if seen.setdefault(digest, place) != place:
                    repeats.append((*place, 1))
        if repeats:
            yield spread, _REPEATS, len(repeats), np.array(repeats, np.int64).T.tobytes()
        yield spread, _WINDOWS, len(seen), b"".join(seen) + np.array(list(seen.values()), np.int64).T.tobytes()


def window_digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _strings(ids, keys, starts, lengths, tags, packed: list[bytes]) -> bytes:
    """One compressed body of some super-k-mers."""
    head = np.array([len(ids)], np.int64).tobytes()
    raw = head + b"".join(x.astype(t).tobytes() for x, t in (
        (np.diff(ids, prepend=0), np.int64), (keys, np.int64), (starts, np.int64), (lengths, np.int64),
        (tags, np.uint16))) + b" ".join(packed)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec=_CODEC, asbytes=True)


def _unpack(body: bytes) -> tuple:
    raw = pa.decompress(body[8:], int.from_bytes(body[:8], "little"), codec=_CODEC, asbytes=True)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    ids, keys, starts, lengths = np.frombuffer(raw, np.int64, 4 * n, 8).reshape(4, n)
    tags = np.frombuffer(raw, np.uint16, n, 8 + 32 * n)
    return np.cumsum(ids), keys, starts, lengths, tags, raw[8 + 34 * n:].split(b" ")


def _first_windows(strings: list[tuple], window: int) -> tuple:
    """All windows of some super-k-mers in document order with what makes each a first, a repeat or the same place."""
    ids, keys, starts, lengths, tags = (np.concatenate([s[k] for s in strings]) for k in range(5))
    words = [w for s in strings for w in s[5]]
    sizes = lengths + window - 1
    begin = np.cumsum(sizes) - sizes
    order = np.lexsort((starts, keys, ids))
    ids, keys, starts, lengths, tags, begin = (x[order] for x in (ids, keys, starts, lengths, tags, begin))
    owner = np.repeat(np.arange(len(ids)), lengths)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = begin[owner] + offset
    place = starts[owner] + offset
    codes: defaultdict[bytes, int] = defaultdict(count().__next__)
    code = np.fromiter(map(codes.__getitem__, words), np.int64, len(words))
    rolling = np.zeros(len(code) - window + 1, np.uint64)
    mixed = (code.astype(np.uint64) + np.uint64(1)) * np.uint64(_MIX[0])
    mixed ^= mixed >> np.uint64(29)
    for k in range(window):
        rolling = rolling * np.uint64(_MIX[1]) + mixed[k:k + len(rolling)]
    value = rolling[at]
    by = np.argsort(value, kind="stable")
    equal = np.zeros(len(by), bool)
    equal[1:] = value[by[1:]] == value[by[:-1]]
    near = np.flatnonzero(equal)
    a, b = at[by[near]], at[by[near - 1]]
    if any((code[a + k] != code[b + k]).any() for k in range(window)):  # one hash, different words: sort the words
        by = np.lexsort([np.arange(len(at)), *(code[at + k] for k in range(window))])
        a, b = at[by[1:]], at[by[:-1]]
        equal[1:] = np.logical_and.reduce([code[a + k] == code[b + k] for k in range(window)])
    group = np.cumsum(~equal) - 1
    first = by[np.flatnonzero(~equal)][group]  # of each window, in sorted order
    earliest = np.empty(len(by), np.int64)
    earliest[by] = first
    is_first = earliest == np.arange(len(by))
    i, k = ids[owner], keys[owner]
    repeat = ~is_first & ((i[earliest] != i) | (k[earliest] != k) | (place[earliest] != place))
    return i, k, place, tags[owner], offset > 0, is_first, repeat, words, at


def _work_bucket(strings: list[tuple], window: int, hot: set[int], pass_all: bool) -> Iterator[pa.RecordBatch]:
    ids, keys, place, tags, joined, is_first, repeat, words, at = _first_windows(strings, window)
    firsts, lengths = _runs(repeat, joined)
    yield _found(None, ids[firsts], keys[firsts], place[firsts], lengths)
    if hot or pass_all:
        on = np.flatnonzero(is_first & (True if pass_all else np.isin(tags, sorted(hot))))
        for k in range(0, len(on), 100_000):
            part = on[k:k + 100_000]
            digests = [window_digest(words[a:a + window]) for a in at[part].tolist()]
            yield _found(digests, ids[part], keys[part], place[part], np.ones(len(part), np.int64))


def _found(digests: list[bytes] | None, ids, keys, starts, windows) -> pa.RecordBatch:
    names = pa.nulls(len(ids), pa.binary()) if digests is None else pa.array(digests, pa.binary())
    return pa.RecordBatch.from_arrays(
        [names, *(pa.array(np.ascontiguousarray(x), pa.int64()) for x in (ids, keys, starts, windows))],
        ["digest", "doc_id", "text_key", "start", "windows"])


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("given_id"), text.alias("text")).select(
        "given_id", F.coalesce("given_id", F.lit(LAST_ID)).alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")


def _word_bytes(rows: DataFrame) -> int:
    return rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]


def repeated_windows(keyed: DataFrame, *, window: int = 20, part: int = 5, cut_words: int | None = None,
                     bucket_words: int | None = None, bucket_bytes: int | None = None, hot: int | None = None
                     ) -> DataFrame:
    """``doc_id, text_key, start, windows``: runs of repeated windows of ``doc_id, text_key, text`` (no nulls)."""
    cut_words, bucket_words = cut_words or CUT_WORDS, bucket_words or BUCKET_WORDS
    bucket_bytes, hot = bucket_bytes or BUCKET_BYTES, hot or HOT
    spark = keyed.sparkSession
    travelling = _word_bytes(keyed) * (1 + 2 * (window - 1) / (window - part + 2))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(parts, min(int(travelling // bucket_bytes) + 1, 1 << 30))
    parts = max(parts, buckets // 16)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, held, size = _Cutter(window, part, buckets, hot), [], 0

        def flush() -> pa.RecordBatch:
            rows = list(cutter.cut(held))
            columns = list(zip(*rows)) if rows else [[], [], [], []]
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()),
                 pa.array(columns[3], pa.binary())], ["bucket", "kind", "size", "body"])

        for batch in batches:
            for i, k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                for first, words in pieces(text.as_py().encode(), cut_words, window - 1):
                    held.append((i, k, first, words))
                    size += len(words)
                    if size >= cut_words:
                        yield flush()
                        held, size = [], 0
        yield flush()

    def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, hot_tags, held, size, split = None, set(), [], 0, False
        for batch in batches:
            for bucket, kind, n, body in zip(*(batch.column(c) for c in range(4))):
                bucket, kind, body = bucket.as_py(), kind.as_py(), body.as_py()
                if kind == _REPEATS:
                    yield _found(None, *np.frombuffer(body, np.int64).reshape(4, -1))
                    continue
                if kind == _WINDOWS:
                    n = n.as_py()
                    places = np.frombuffer(body, np.int64, 3 * n, 16 * n).reshape(3, n)
                    yield _found([body[k:k + 16] for k in range(0, 16 * n, 16)], *places, np.ones(n, np.int64))
                    continue
                if bucket != at:
                    if held:
                        yield from _work_bucket(held, window, hot_tags, split)
                    at, hot_tags, held, size, split = bucket, set(), [], 0, False
                if kind == _MARKER:
                    hot_tags.add(int.from_bytes(body, "little"))
                    continue
                if held and size + n.as_py() > bucket_words:
                    split = True
                    yield from _work_bucket(held, window, hot_tags, split)
                    held, size = [], 0
                held.append(_unpack(body))
                size += n.as_py()
        if held:
            yield from _work_bucket(held, window, hot_tags, split)

    sent = keyed.select("doc_id", "text_key", "text").mapInArrow(send, _SENT)
    # markers come before the strings of their bucket
    dealt = sent.repartition(parts, "bucket").sortWithinPartitions("bucket", "kind")
    found = materialize(dealt.mapInArrow(receive, _FOUND), "windows")
    place = F.struct("doc_id", "text_key", "start")
    passed = found.where(F.col("digest").isNotNull())
    earliest = passed.groupBy("digest").agg(F.min(place).alias("earliest"))
    later = passed.join(earliest, "digest").where(place > F.col("earliest"))
    columns = ["doc_id", "text_key", "start", "windows"]
    return found.where(F.col("digest").isNull()).select(columns).union(later.select(columns))


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 20,
                   part: int = 5, **limits) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` of every row: its words without those that a repeated window covers, joined
    by one space. Windows are judged on the input.

    Null and empty texts have no words and keep the empty text; a text of fewer words than a window keeps them all. Rows
    with equal ids and texts are one document and give equal rows; with equal ids and other texts they are different
    documents. Null ids come last. Other columns of ``docs`` play no part, and an empty table gives no row.
    """
    keyed = _keyed(docs, id_col, text_col)
    runs = repeated_windows(keyed, window=window, part=part, **limits)
    # of one document's windows only, so no longer than its own row
    per_doc = runs.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "windows")).alias("runs"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):  # long texts: keep an output batch small
                rows = batch.slice(k, 256)
                n_words, n_removed, kept = [], [], []
                for text, found in zip(rows.column(1), rows.column(2).to_pylist()):
                    words = text.as_py().encode().split()
                    n_words.append(len(words))
                    if not found:
                        n_removed.append(0)
                        kept.append(b" ".join(words).decode())
                        continue
                    edge = np.zeros(len(words) + 1, np.int64)
                    start = np.array([r["start"] for r in found])
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + [r["windows"] + window - 1 for r in found], -1)
                    stay = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
                    n_removed.append(len(words) - len(stay))
                    kept.append(b" ".join([words[j] for j in stay.tolist()]).decode())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept)],
                    ["doc_id", "n_words", "n_removed", "kept"])

    joined = keyed.join(per_doc, ["doc_id", "text_key"], "left")
    return joined.select(F.col("given_id").alias("doc_id"), "text", "runs").mapInArrow(
        keep, "doc_id long, n_words long, n_removed long, kept string")
