"""Byte-level BPE by DuckDB recursive queries, one embedded database a task.

Every distinct word of a batch starts as its bytes' tokens. The recursive query joins the token positions with the
merge table, takes each word's leftmost pair of minimum rank and contracts it, until no word has a pair left; an
ordered aggregation of the tokens' bytes decodes. A document's ids are its words' ids in order. Words stay in a
cache of bounded size between batches; texts are cut into words by the vocabulary's own pattern.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import BYTE_PATTERN, FIRST_OTHER

#: Words of more bytes contract all occurrences of the minimum-rank pair at a time (the same result: a pair made
#: later has a higher rank), so that one very long word doesn't take a step per token.
LONG_WORD = 64
#: Cached words and chunks; the caches are emptied beyond it.
CACHE_LIMIT = 800_000
#: Words given to one recursive query.
QUERY_WORDS = 50_000

#: All steps of a short word are kept and the last one taken; long words keep the last step only.
ENCODE = """
WITH RECURSIVE state(wid, toks) AS (
  SELECT wid, toks FROM words
  UNION ALL
  SELECT s.wid, list_concat(list_append(s.toks[:b.best % 1048576 - 1], (b.best // 1048576)::INT),
                            s.toks[b.best % 1048576 + 2:])
  FROM state s JOIN (
    SELECT p.wid, min(m.id::BIGINT * 1048576 + p.pos) AS best
    FROM (SELECT wid, unnest(toks[:-2]) AS tok, unnest(toks[2:]) AS nxt,
                 generate_subscripts(toks[2:], 1) AS pos FROM state) p
    JOIN merges m ON m.l = p.tok AND m.r = p.nxt GROUP BY p.wid) b ON b.wid = s.wid)
SELECT wid, arg_min(toks, len(toks)) AS toks FROM state GROUP BY wid ORDER BY wid
"""

ENCODE_LONG = """
WITH RECURSIVE state(wid, toks) USING KEY (wid) AS (
  SELECT wid, toks FROM words
  UNION
  SELECT wid, list(tok ORDER BY pos) FROM (
    SELECT wid, pos, CASE WHEN hit THEN best ELSE tok END AS tok,
           coalesce(lag(hit) OVER (PARTITION BY wid ORDER BY pos), false) AS eaten
    FROM (
      SELECT wid, pos, tok, best, rank IS NOT DISTINCT FROM best
             AND row_number() OVER (PARTITION BY wid, rank IS NOT DISTINCT FROM best, run ORDER BY pos) % 2 = 1 AS hit
      FROM (
        SELECT *, count(*) FILTER (WHERE rank IS DISTINCT FROM best) OVER (PARTITION BY wid ORDER BY pos) AS run
        FROM (
          SELECT p.wid, p.pos, p.tok, m.id AS rank, min(m.id) OVER (PARTITION BY p.wid) AS best
          FROM (SELECT wid, unnest(toks) AS tok, unnest(list_append(toks[2:], NULL)) AS nxt,
                       generate_subscripts(toks, 1) AS pos FROM state) p
          LEFT JOIN merges m ON m.l = p.tok AND m.r = p.nxt)
        WHERE best IS NOT NULL)))
  WHERE NOT eaten GROUP BY wid)
SELECT wid, toks FROM state ORDER BY wid
"""

DECODE = """
SELECT wid, string_agg(v.hex, '' ORDER BY pos) AS hex
FROM (SELECT wid, unnest(toks) AS tok, generate_subscripts(toks, 1) AS pos FROM found) p JOIN vocabulary v ON v.id = p.tok
GROUP BY wid ORDER BY wid
"""

_CODERS: dict[tuple, "RecursiveBpe"] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge_pairs(ranks: dict[bytes, int]) -> list[tuple[int, int, int]]:
    """``(left, right, id)``: the last pair that merging makes each token of (its parts have lower ranks)."""
    out = []
    for token, rank in ranks.items():
        parts = [token[k:k + 1] for k in range(len(token))]
        while len(parts) > 2:
            best, at = min((ranks.get(a + b, rank), k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
            if best >= rank:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) == 2:
            out.append((ranks[parts[0]], ranks[parts[1]], rank))
    return out


class RecursiveBpe:
    def __init__(self, path: str, pattern: str) -> None:
        import duckdb
        import regex

        ranks = read_ranks(path)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "500MB"})
        pairs = pa.table(dict(zip("l r id".split(), map(lambda c: pa.array(c, pa.int32()), zip(*merge_pairs(ranks))))))
        tokens = pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "hex": [t.hex() for t in ranks]})
        for name, rows in (("merges", pairs), ("vocabulary", tokens)):
            self.con.register("rows", rows)
            self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM rows")
            self.con.unregister("rows")
        self.first = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.words_of = regex.compile(pattern).findall
        plain = BYTE_PATTERN.replace(r"\p{L}\p{N}", "A-Za-z0-9").replace(r"\p{L}", "[A-Za-z]").replace(
            r"\p{N}", "[0-9]").replace(r"[^\s", r"[^ \t\n\r\x0b\x0c").replace(r"\s+", r"[ \t\n\r\x0b\x0c]+")
        self.ascii_words = re.compile(plain).findall
        self.by_chunk = pattern == BYTE_PATTERN
        self.words: dict[str, tuple[bytes, bytes]] = {}
        self.chunks: dict[str, tuple[bytes, bytes] | None] = {}

    def _query(self, words: list[bytes], sql: str) -> None:
        sizes = [len(w) for w in words]
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        toks = pa.ListArray.from_arrays(offsets, pa.array(self.first[np.frombuffer(b"".join(words), np.uint8)]))
        self.con.register("words", pa.table({"wid": pa.array(np.arange(len(words), dtype=np.int32)), "toks": toks}))
        found = self.con.sql(sql).to_arrow_table().combine_chunks()
        self.con.register("found", found)
        decoded = self.con.sql(DECODE).to_arrow_table()["hex"].to_pylist()
        lists = found["toks"].chunk(0)
        data = lists.values.to_numpy().astype("<u4").tobytes()
        at = (lists.offsets.to_numpy().astype(np.int64) * 4).tolist()
        for k, word in enumerate(words):
            self.words[word.decode()] = (data[at[k]:at[k + 1]], bytes.fromhex(decoded[k]))

    def _learn(self, words: set[str]) -> None:
        """Run the recursive queries for the words that aren't known."""
        fresh = sorted(w.encode() for w in words if w not in self.words)
        short = [w for w in fresh if len(w) <= LONG_WORD]
        for k in range(0, len(short), QUERY_WORDS):
            self._query(short[k:k + QUERY_WORDS], ENCODE)
        for w in fresh:
            if len(w) > LONG_WORD:
                self._query([w], ENCODE_LONG)

    def _split(self, chunk: str) -> list[str]:
        text = " " + chunk
        if not text.isascii():
            return [text] if max(text) < FIRST_OTHER and chunk.isalpha() else self.words_of(text)
        if chunk.isalpha():
            return [text]
        if chunk[:-1].isalpha() and chunk[-1] in ".,":
            return [text[:-1], text[-1]]
        return self.ascii_words(text)

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """The ids (little-endian unsigned 32-bit integers) and the bytes decoded from them, of each text.

        As in `tokens`, a text is cut at single spaces, before which a token of this pattern always ends; a text
        with a run of white space across such a cut is split by the pattern as a whole.
        """
        parts = [t.split(" ") for t in texts]
        if len(self.chunks) > CACHE_LIMIT or len(self.words) > CACHE_LIMIT:
            self.chunks.clear()
            self.words.clear()
        fresh = set().union(*parts).difference(self.chunks)
        # None: white space across the cut, the text is split by the pattern as a whole
        split = {c: self._split(c) if c and not c[-1].isspace() else None for c in fresh}
        heads = [self.words_of(ps[0]) for ps in parts]
        self._learn(set().union(*filter(None, split.values()), *heads))
        known = self.words.__getitem__
        for c, words in split.items():
            found = words and [known(w) for w in words]
            self.chunks[c] = found and (found[0] if len(found) == 1 else tuple(b"".join(x) for x in zip(*found)))
        chunk, found, whole = self.chunks.__getitem__, [], {}
        for k, (ps, head) in enumerate(zip(parts, heads)):
            found.append(list(map(chunk, ps)))
            if not self.by_chunk or len(ps) > 1 and None in found[k]:
                whole[k] = self.words_of(texts[k])
            else:
                found[k][:1] = map(known, head)
        self._learn(set().union(*whole.values()))
        for k, words in whole.items():
            found[k] = list(map(known, words))
        return [(b"".join(map(itemgetter(0), f)), b"".join(map(itemgetter(1), f))) for f in found]


def coder(path: str, pattern: str) -> RecursiveBpe:
    """The worker's own coder, kept between tasks."""
    if (path, pattern) not in _CODERS:
        _CODERS[path, pattern] = RecursiveBpe(path, pattern)
    return _CODERS[path, pattern]


def encode_documents(docs: DataFrame, ranks: str, pattern: str = BYTE_PATTERN, *, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row of ``docs``; nothing is shuffled.

    Null text counts as empty (no ids, the digests of no bytes). Null ids, repeated rows and ties are rows like
    any other; very long texts and words are encoded whole; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(ranks, pattern)
        for batch in batches:
            for k in range(0, batch.num_rows, 2000):
                part = batch.slice(k, 2000)
                found = bpe.encode([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(i) // 4 for i, _ in found], pa.int64()),
                     pa.array([hashlib.sha256(i).hexdigest() for i, _ in found]),
                     pa.array([hashlib.sha256(d).hexdigest() for _, d in found])],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
