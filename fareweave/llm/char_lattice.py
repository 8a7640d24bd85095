"""Noisy-channel restoration of obfuscated words: character lattices decoded by Viterbi under a character 4-gram model."""

from __future__ import annotations

import re

import numpy as np

#: Symbols of the model: 0 is the word boundary, 1-26 are a-z, 27 is any byte of another letter.
SYMBOLS = 28
GRAMS = SYMBOLS ** 4
#: Neighbouring tokens of up to so many characters can be parts of one word.
SHORT = 3

# Letters that a character can stand for, and characters put between letters.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g", "@": "a",
        "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l"}
LEET_PAIRS = {"|)": "d", "|<": "k", "|3": "b", "|2": "r", "/\\": "a", "\\/": "v", "()": "o", "vv": "w"}
SEPARATORS = set(" .-_*~'`,:;/\\^=·•­​‌‍﻿")

#: Channel costs (negative log): a leet letter, a dropped separator, a dropped repetition, a space kept or dropped
#: between single letters, a character that stays what it is although no letter.
COST = {"leet": 0.7, "separator": 0.3, "repeat": 0.3, "split": 0.5, "join": 0.5, "other": 7.0}

_RUN = re.compile(r"(.)\1+", re.S)
_EDGES = re.compile(r"^[^\w@$!|+(<£€/\\]+|[^\w@$+)|<£€/\\]+$|[@$]{3,}$")
_PLAIN = re.compile(r"[^\W\d_]+")
_SHORT_RUN = re.compile(rf"(?<!\S)\S{{1,{SHORT}}}(?!\S)(?:\s+\S{{1,{SHORT}}}(?!\S))+")
#: One letter for each set of letters that a leet character can stand for, and nothing for a separator.
_FOLD = str.maketrans({**{c: {"l": "i", "g": "b"}.get(x[0], x[0]) for c, x in LEET.items()}, "l": "i", "g": "b",
                       **dict.fromkeys(SEPARATORS, "")})

_SYMBOL = bytes(ord(chr(b).lower()) - 96 if chr(b).isalpha() else 0 for b in range(128)) + bytes([27] * 128)


def count_grams(texts: list[str | None]) -> np.ndarray:
    """Counts of the 4-grams of words and their boundaries (non-letters) in ``texts``."""
    data = ("   ".join(t for t in texts if t) + "   ").encode().translate(_SYMBOL)
    a = np.frombuffer(b"\0\0\0" + data, np.uint8).astype(np.int64)
    g = ((a[:-3] * SYMBOLS + a[1:-2]) * SYMBOLS + a[2:-1]) * SYMBOLS + a[3:]
    out = np.bincount(g, minlength=GRAMS)
    out[:SYMBOLS] = 0  # boundaries in a row say nothing
    out[0::SYMBOLS][:1] = 0
    return out


class CharModel:
    """Interpolated 4-gram costs (negative log) from counts."""

    def __init__(self, counts: np.ndarray) -> None:
        n4 = counts.reshape((SYMBOLS,) * 4).astype(float)
        lower = np.full(SYMBOLS, 1.0 / SYMBOLS)
        for order in (1, 2, 3, 4):
            n = n4.sum(axis=tuple(range(4 - order)))
            lower = (n + 4.0 * lower) / (n.sum(axis=-1, keepdims=True) + 4.0)
        self.cost = (-np.log(lower)).astype(np.float32)

    def flat(self) -> list[float]:
        return self.cost.reshape(-1).tolist()


class Decoder:
    """Viterbi over the lattice of a token; a state is the last three symbols, and no path is cut."""

    def __init__(self, cost: np.ndarray) -> None:
        self.cost = cost

    def decode(self, token: str) -> str:
        """The most likely restoration of a lower-case token (spaces only where it has them or for other characters)."""
        cost, size = self.cost, SYMBOLS ** 3
        # the columns that are still open; a path is its last output and the path before it
        columns: list[dict[int, tuple[float, tuple | None]]] = [{0: (0.0, None)}, {}, {}]
        last = ""
        for i, c in enumerate(token):
            states, new, later = columns

            def step(to: dict, symbols: list[int], letter: str, extra: float) -> None:
                for s, (t, out) in states.items():
                    t += extra
                    for x in symbols:
                        s = s * SYMBOLS + x
                        t += float(cost[s])
                        s %= size
                    if s not in to or t < to[s][0]:
                        to[s] = (t, (out, letter))

            def drop(extra: float) -> None:
                for s, (t, out) in states.items():
                    if s not in new or t + extra < new[s][0]:
                        new[s] = (t + extra, out)

            def end(extra: float) -> None:
                for s, (t, out) in states.items():
                    t += extra + (float(cost[s * SYMBOLS]) if s % SYMBOLS else 0.0)
                    if 0 not in new or t < new[0][0]:
                        new[0] = (t, (out, " "))

            if c == " ":
                drop(COST["join"])
                end(COST["split"])
            else:
                if c.isalpha():
                    step(new, [ord(c) - 96] if "a" <= c <= "z" else [27] * len(c.encode()), c, 0.0)
                for x in LEET.get(c, ""):
                    step(new, [ord(x) - 96], x, COST["leet"])
                if x := LEET_PAIRS.get(token[i:i + 2]):
                    step(later, [ord(x) - 96], x, COST["leet"])
                if c in SEPARATORS and 0 < i < len(token) - 1:
                    drop(COST["separator"])
                if c == last:
                    drop(COST["repeat"])
                if not c.isalpha():
                    end(COST["other"])
                last = c
            columns = [new, later, {}]
        _, path = min(((t + (float(cost[s * SYMBOLS]) if s % SYMBOLS else 0.0), p) for s, (t, p) in columns[0].items()),
                      key=lambda x: x[0])
        out = []
        while path:
            path, letter = path
            out.append(letter)
        return "".join(reversed(out))


def plain_words(token: str) -> list[str]:
    """The words of a token as it is written: its runs of letters."""
    return [token] if token.isalpha() else _PLAIN.findall(token)


def needs_decoding(token: str) -> str:
    """The part of a token that is read through the lattice; empty for letters without any doubled one, which have one
    reading, and for what holds neither a letter nor a character that can stand for one."""
    core = token if token.isalpha() else _EDGES.sub("", token)
    if core.isalpha() and not _RUN.search(core):
        return ""
    return core if any(c.isalpha() or c in LEET for c in core) else ""


def short_runs(text: str) -> list[str]:
    """Runs of neighbouring short tokens, whatever white space is between them (one space in the result)."""
    return [" ".join(run.split()) for run in _SHORT_RUN.findall(text)]


def folded(word: str) -> str:
    """What all readings of a token have in common: letters that a character can stand for become one, separators and
    repetitions go. Without a pair of ``LEET_PAIRS`` in the token, a word can come out of its lattice only if the
    word's folded form occurs in the token's."""
    return _RUN.sub(r"\1", word.translate(_FOLD))


def has_pair(token: str) -> bool:
    return any(p in token for p in LEET_PAIRS)
