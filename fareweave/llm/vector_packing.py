"""Packing instruction data into sequences: vector bin packing by the dot-product heuristic.

Every example has a demand vector (tokens, segments, loss-bearing tokens) and a sequence is a bin with a limit on
each. Documents need no order between tasks, so packing is local to the input partition: one pass, no shuffle.
Inside a task documents are taken in windows of a fixed number of rows (bounded memory); a window is packed whole
and leaves no half-filled bin behind, because a last bin is cut into lengths that need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Documents packed together in a task; bounds memory, not results: every window is packed whole.
WINDOW = 4096

PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
                "offset long, segment int, loss_tokens long")


def pack_window(docs: list[tuple[np.ndarray, np.ndarray]], capacity: int, max_segments: int, max_loss: int
                ) -> list[list[tuple[int, int, int]]]:
    """Sequences of ``(document, start, length)`` pieces over ``docs`` = [(ids, loss-bearing flags)].

    Full-length pieces are cut off first wherever the loss limit allows; the rests are the items. A bin takes,
    again and again, the item with the largest dot product of its demand with the bin's free capacity (both as
    shares of the limits) among those that fit; when none fits, an item is cut so that its first part fills the
    bin. A bin that can't be filled (nothing is left) is split into powers of two.
    """
    limits = np.array([capacity, max_segments, max_loss], dtype=float)
    bins: list[list[tuple[int, int, int]]] = []
    loss = [np.concatenate([[0], np.cumsum(flags)]) for _, flags in docs]
    rest: list[tuple[int, int, int]] = []
    for d, (ids, _) in enumerate(docs):
        at, n = 0, len(ids)
        while n - at >= capacity:
            if loss[d][at + capacity] - loss[d][at] > max_loss:
                break
            bins.append([(d, at, capacity)])
            at += capacity
        if at < n:
            rest.append((d, at, n - at))
    items = {k: x for k, x in enumerate(rest)}
    demand = np.zeros((len(rest), 3))
    for k, (d, at, n) in items.items():
        demand[k] = n, 1, loss[d][at + n] - loss[d][at]
    alive = np.ones(len(rest), bool)
    left = len(rest)
    while left:
        free, held = limits.copy(), []
        while left and free[0] >= 1 and free[1] >= 1:
            fits = alive & (demand <= free).all(axis=1)
            if fits.any():
                score = np.where(fits, demand @ (free / limits ** 2), -1.0)
                k = int(score.argmax())
                held.append(items.pop(k))
                alive[k] = False
                free -= demand[k]
                left -= 1
                continue
            k = int(np.where(alive, demand[:, 0], -1).argmax())  # cut the longest item to fill the bin
            d, at, n = items[k]
            take = int(min(free[0], n - 1))
            if loss[d][at + take] - loss[d][at] > free[2]:
                take = int(np.searchsorted(loss[d], loss[d][at] + free[2], side="right")) - 1 - at
            if take < 1:
                break
            held.append((d, at, take))
            free -= np.array([take, 1, loss[d][at + take] - loss[d][at]])
            items[k] = (d, at + take, n - take)
            demand[k] = n - take, 1, loss[d][at + n] - loss[d][at + take]
        bins.append(held)
    return [b for held in bins for b in _unpadded(held, capacity)]


def _unpadded(held: list[tuple[int, int, int]], capacity: int) -> Iterator[list[tuple[int, int, int]]]:
    """``held`` itself if its length is the capacity, else its pieces over sequences whose lengths are powers of two."""
    total = sum(n for _, _, n in held)
    if total == capacity:
        yield held
        return
    pieces, k = list(held), 0
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        out = []
        while room:
            d, at, n = pieces[k]
            take = min(n, room)
            out.append((d, at, take))
            room -= take
            if take == n:
                k += 1
            else:
                pieces[k] = (d, at + take, n - take)
        yield out


def pack_documents(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = 1024, max_segments: int = 256, max_loss: int = 1024, end_id: int = 0) -> DataFrame:
    """Pack every document's ids (whole text, then ``end_id``) into sequences; one row per piece.

    Loss-bearing are all ids but the end id. Null text counts as empty (its end id alone is packed); a null id,
    repeated rows and ties are packed like any other row; an empty table gives no rows; other columns of
    ``docs`` are not read. ``sequence_id`` is unique over the result: the task's partition number in the upper
    bits. The rows of a partition come from the scan in its own order, so a lost task gives the same pieces
    again.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from .tokens import encoder

        encode = encoder(tokenizer, keep_space=True).encode
        end = int(end_id).to_bytes(4, "little")
        base, sequence = TaskContext.get().partitionId() << 33, 0
        window: list[tuple[int | None, bytes]] = []

        def flush() -> pa.RecordBatch:
            nonlocal sequence
            docs = []
            for _, data in window:
                ids = np.frombuffer(data, "<u4")
                flags = np.ones(len(ids), np.int64)
                flags[-1] = 0
                docs.append((ids, flags))
            rows = []
            for held in pack_window(docs, capacity, max_segments, max_loss):
                offset = 0
                for segment, (d, at, n) in enumerate(held):
                    ids, flags = docs[d]
                    rows.append((window[d][0], at, n, zlib.crc32(window[d][1][4 * at:4 * (at + n)]), len(ids),
                                 base + sequence, offset, segment, int(flags[at:at + n].sum())))
                    offset += n
                sequence += 1
            window.clear()
            types = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
            names = [c.split()[0] for c in PIECE_SCHEMA.split(", ")]
            cols = list(zip(*rows)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                window.append((doc, encode(text or "") + end))
                if len(window) == WINDOW:
                    yield flush()
        if window:
            yield flush()

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, PIECE_SCHEMA)
