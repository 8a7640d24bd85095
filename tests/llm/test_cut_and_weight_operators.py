"""Super-k-mers, learned cuts and bit-sliced weights against brute force and exact round trips."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareweave.llm import bit_sliced_weights as W
from fareweave.llm import learned_cuts as C
from fareweave.llm import super_kmers as K

DOCS = "doc_id long, text string"


def brute_removed(rows, window):
    """Rows as ``(id, key, text)``; gives ``(id, n_words, n_removed, kept)`` of every row."""
    first = {}
    cut = [(K.LAST_ID if i is None else i, k, (t or "").encode().split()) for i, k, t in rows]
    for i, k, words in cut:
        for s in range(len(words) - window + 1):
            w = tuple(words[s:s + window])
            first[w] = min(first.get(w, (i, k, s)), (i, k, s))
    out = []
    for (given, _, _), (i, k, words) in zip(rows, cut):
        gone = set()
        for s in range(len(words) - window + 1):
            if first[tuple(words[s:s + window])] != (i, k, s):
                gone.update(range(s, s + window))
        kept = b" ".join(w for p, w in enumerate(words) if p not in gone).decode()
        out.append((given, len(words), len(gone), kept))
    return sorted(out, key=repr)


def keyed_rows(spark, rows):
    df = spark.createDataFrame(rows, DOCS)
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    return df, [tuple(r) for r in df.select("doc_id", key, "text").collect()]


def passages(seed=3, docs=120):
    """Random texts of a small vocabulary with shared lines, copies, loops, odd white space and repeated rows."""
    rng = np.random.default_rng(seed)
    vocab = [f"w{k}" for k in range(300)] + ["é", "ß x", "語"]
    line = [f"line{k}" for k in range(9)]
    long = [f"long{k}" for k in range(60)]
    rows = []
    for d in range(docs):
        words = list(rng.choice(vocab, int(rng.integers(0, 90))))
        if d % 2:
            at = int(rng.integers(0, len(words) + 1))
            words[at:at] = line
        if d % 5 == 0:
            words += long[int(rng.integers(0, 20)):]
        if d % 17 == 0:
            words += ["loop"] * 50
        rows.append((d, str(rng.choice([" ", "  ", "\n", "\t "])).join(words)))
    rows += [(500 + k, rows[3][1]) for k in range(30)]
    rows += [rows[5], rows[5], (5, rows[6][1]), (None, rows[5][1]), (None, rows[7][1]), (None, None), (900, None), (901, ""),
             (902, " \n "), (-4, rows[10][1])]
    return rows


@pytest.mark.parametrize("limits", [{}, {"hot": 2}, {"cut_words": 150}, {"bucket_words": 200, "bucket_bytes": 1 << 30},
                                    {"cut_words": 300, "hot": 3, "bucket_words": 100, "bucket_bytes": 2000}])
def test_repeats_match_brute_force_on_every_route(spark, limits):
    df, rows = keyed_rows(spark, passages())
    got = sorted(map(tuple, K.remove_repeats(df.repartition(3), window=12, part=4, **limits).collect()), key=repr)
    assert got == brute_removed(rows, 12)


def test_repeats_with_hash_collisions_are_told_apart(monkeypatch):
    cutter = K._Cutter(4, 2, 1, 99)
    docs = [(d, 0, 0, [b"%d" % (k % (5 + d)) for k in range(40)]) for d in range(3)]
    strings = [K._unpack(body) for _, kind, _, body in cutter.cut(docs) if kind == K._STRINGS]
    want = K._first_windows(strings, 4)
    monkeypatch.setattr(K, "_MIX", (0, 0))  # every window gets the same hash
    got = K._first_windows(strings, 4)
    assert all(np.array_equal(a, b) for a, b in zip(want[:7], got[:7]))
    assert want[5].sum() < len(want[5])


def test_pieces_cover_a_text_once():
    text = b" ".join(b"x" * (k % 40 + 1) for k in range(500)) + b"\n"
    words = text.split()
    for size in (1, 3, 20, 1000):
        seen = {}
        for first, part in K.pieces(text, size, 7):
            for k, w in enumerate(part):
                assert seen.setdefault(first + k, w) == w
        assert [seen[k] for k in sorted(seen)] == words


def test_repeats_of_empty_tables_and_other_columns(spark):
    empty = spark.createDataFrame([], DOCS)
    assert K.remove_repeats(empty).collect() == []
    odd = spark.createDataFrame([(1, "a b", 5, "x")], "doc_id long, text string, n_words int, text_key string")
    assert [tuple(r) for r in K.remove_repeats(odd).collect()] == [(1, 2, 0, "a b")]


TEXTS = ["", " ", "one", " lead", "tail \n", "a  b\tc\r\nd", "語 é x y", "mark <P> in it " * 3, "x" * 5000,
         " ".join("w" * (k % 13 + 1) for k in range(3000)), "a " * 2000 + "b" * 900 + " c" * 2000, "\x00 \x1f y"]


@pytest.mark.parametrize("error", [0, 1, 4, 32, 500])
def test_rank_index_is_exact_and_error_bounded(error):
    rng = np.random.default_rng(error)
    more = [" ".join("v" * int(n) for n in rng.geometric(0.2, 2000)) for _ in range(3)]
    for text in [*TEXTS, *more]:
        tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
        want = np.cumsum([0, *map(len, tokens)])
        offsets = C.boundaries(text)
        assert np.array_equal(offsets, want)
        index = C.RankIndex(offsets, error)
        assert np.array_equal(index.lookup(np.arange(len(want))), want)
        assert np.abs(index.residuals.astype(int)).max() <= error
    even = C.RankIndex(np.arange(0, 50_000, 5), 2)
    assert len(even.firsts) == 1


def test_fill_in_middle_matches_the_rule_and_restores_texts(spark):
    rows = [(k * 7 + j, t) for k, t in enumerate(TEXTS * 6) for j in (0, 3)] + [(None, "no id here at all"), (1, None), (1, None)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, form string")
    got = C.fill_in_middle(df).withColumn("back", C.restored_text()).collect()
    want = []
    for i, t in rows:
        t = t or ""
        h = hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
        tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", t)
        a, b = sorted((h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)))
        p, m, s = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
        if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
            want.append((i, len(tokens), "plain", None, None, t, t))
        elif h4 % 100 < 80:
            want.append((i, len(tokens), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", t))
        else:
            want.append((i, len(tokens), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", t))
    found = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in got]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert {r.form for r in got} == {"plain", "spm", "psm"}
    assert C.fill_in_middle(spark.createDataFrame([], DOCS)).collect() == []


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def test_resampling_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    vocab = ["Alpha", "beta", "é-x", "c3", "ÄB", "語", "zeta", "d_e"]
    rows = [(k, " ".join(rng.choice(vocab, int(rng.integers(0, 70))))) for k in range(150)]
    rows += [(7, rows[7][1]), (7, rows[7][1]), (None, rows[9][1] + " beta" * 30), (None, rows[9][1] + " beta" * 30),
             (160, None), (161, ""), (162, "beta " * 5000)]
    target = [("beta zeta é", ), (None, ), ("Alpha c3 c3", )]
    count = Counter(zlib.crc32(f.encode()) % 10000 for _, t in rows for f in features(t)[1])
    aim = Counter(zlib.crc32(f.encode()) % 10000 for t, in target for f in features(t)[1])
    s, t = sum(count.values()), sum(aim.values())
    want = []
    for i, text in rows:
        words, found = features(text)
        gains = [math.floor(1000 * math.log((aim[b] + 1) * (s + 10000) / ((count[b] + 1) * (t + 10000))))
                 for b in (zlib.crc32(f.encode()) % 10000 for f in found)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        want.append([i, len(words), len(found), weight, score, None])
    able = sorted((r for r in want if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0]))
    for k, r in enumerate(able[:25 * len(able) // 100]):
        r[5] = k + 1
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, rank string").repartition(4)
    got = W.resample(df, spark.createDataFrame(target, "text string")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr)


def test_resampling_of_empty_tables(spark):
    empty, one = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a " * 40)], DOCS)
    assert W.resample(empty, one).collect() == []
    assert [r["rank"] for r in W.resample(one, empty).collect()] == [None]  # floor(25 * 1 / 100) rows are drawn
    assert [r["rank"] for r in W.resample(one, empty, percent=100).collect()] == [1]


def test_bit_planes_sum_exactly():
    rng = np.random.default_rng(2)
    gains = rng.integers(-25_000, 25_000, W.BUCKETS)
    gains[:2] = [-32_768, 32_767]
    planes = W.GainPlanes(gains.tolist())
    for top in (1, 2, 7, 100_000):
        counts = rng.integers(0, top + 1, W.BUCKETS)
        assert planes.total(counts) == int((counts * gains).sum())
    assert planes.total(np.zeros(W.BUCKETS, np.int64)) == 0
    assert W.GainPlanes([0] * W.BUCKETS).total(np.ones(W.BUCKETS, np.int64)) == 0
