"""Whole texts to token ids through the `tokenizers` library, one library call per distinct word.

A text is cut at single spaces, where no token of the two vocabularies used here can cross:

* byte-level BPE (`keep_space=True`): the pre-tokenizer's pattern never matches a non-space followed by white
  space, so the place before a space that follows a non-space is always a token boundary; the space belongs to
  the chunk after it. A text with a chunk that is empty or ends in white space (a run of white space crosses
  the cut) goes to the library whole.
* word BPE (`keep_space=False`): white space is dropped by the pre-tokenizer, so every space is a boundary.

A chunk of characters below U+0250 (no combining marks there, so NFC leaves it as it is) is cut into words by
the pre-tokenizer's own pattern and each distinct word goes to the library's BPE model; any other chunk goes to
the library whole. Both are checked against whole-text encoding in tests/llm. The caches live as long as the
Python worker and are emptied when full, so memory is bounded.
"""

from __future__ import annotations

import os
import re

import numpy as np

# The two vocabularies' own pre-tokenizer patterns, and the byte alphabet of byte-level BPE.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
PRINTABLE_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]

FIRST_OTHER = "ɐ"
_ENCODERS: dict[tuple, "ChunkEncoder"] = {}


def byte_alphabet() -> dict[int, str]:
    """Byte → the character that stands for it in a byte-level vocabulary."""
    others = [b for b in range(256) if b not in set(PRINTABLE_BYTES)]
    return {b: chr(b) for b in PRINTABLE_BYTES} | {b: chr(256 + k) for k, b in enumerate(others)}


class ChunkEncoder:
    def __init__(self, path: str, keep_space: bool, limit: int = 1_000_000) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.tokenizer.model
        self.keep_space, self.limit = keep_space, limit
        pattern = BYTE_PATTERN if keep_space else WORD_PATTERN
        ascii_only = pattern.replace(r"\p{L}\p{N}", "A-Za-z0-9").replace(r"\p{L}", "[A-Za-z]").replace(
            r"\p{N}", "[0-9]").replace(r"[^\s", r"[^ \t\n\r\x0b\x0c").replace(r"\s+", r"[ \t\n\r\x0b\x0c]+")
        self.ascii_words = re.compile(ascii_only).findall
        self.words_of = regex.compile(pattern).findall
        self.alphabet = byte_alphabet()
        self.chunks = _Chunks(self._chunk)
        self.words: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _word(self, word: str) -> bytes:
        letters = word.encode().decode("latin-1").translate(self.alphabet)
        ids = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(letters)])
        self.words[word] = ids
        return ids

    def _words(self, chunk: str) -> list[str] | None:
        """The pre-tokenizer's words of a chunk; None where only the library itself can tell."""
        text = " " + chunk if self.keep_space else chunk.lower()
        if text.isascii():
            if chunk.isalpha():
                return [text]
            if chunk[:-1].isalpha() and chunk[-1] in ".,":
                return [text[:-1], text[-1]]
            return self.ascii_words(text)
        if max(text) >= FIRST_OTHER:
            return None
        return [text] if chunk.isalpha() else self.words_of(text)

    def _chunk(self, chunk: str) -> bytes | None:
        if self.keep_space and (not chunk or chunk[-1].isspace()):
            return None  # a run of white space crosses the cut
        found = self._words(chunk)
        if found is None:
            return self._whole(" " + chunk if self.keep_space else chunk)
        known, word = self.words.get, self._word
        return b"".join([known(w) or word(w) for w in found])

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if len(self.chunks) > self.limit or len(self.words) > self.limit:
            self.chunks.clear()
            self.words.clear()
        parts = text.split(" ")
        if not self.keep_space:
            return b"".join(map(self.chunks.__getitem__, parts))
        head = parts[0]
        if len(parts) > 1 and (not head or head[-1].isspace()):
            return self._whole(text)
        parts[0] = ""
        ids = list(map(self.chunks.__getitem__, parts))
        if None in ids[1:]:
            return self._whole(text)
        ids[0] = self._whole(head)
        return b"".join(ids)


class _Chunks(dict):
    """Chunk → ids, filled on first use."""

    def __init__(self, fill) -> None:
        self.fill = fill

    def __missing__(self, chunk: str) -> bytes | None:
        self[chunk] = ids = self.fill(chunk)
        return ids


def encoder(path: str, keep_space: bool) -> ChunkEncoder:
    """The worker's own encoder for ``path``, kept between tasks."""
    key = (path, keep_space)
    if key not in _ENCODERS:
        _ENCODERS[key] = ChunkEncoder(path, keep_space)
    return _ENCODERS[key]
