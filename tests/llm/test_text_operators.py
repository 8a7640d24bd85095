"""Edge rows and brute-force twins of the operators on texts."""

from __future__ import annotations

import hashlib
import os
import random
import shutil
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fareweave.llm import bpe_recursive, char_lattice, deobfuscation, overlap_join
from fareweave.llm.common import connected_components
from fareweave.llm.features import bounded_sample
from fareweave.llm.language_centroids import fit_centroids, predict_language
from fareweave.llm.orc_tokens import read_documents, read_tokens, token_files, write_tokens
from fareweave.llm.overlap_join import Threshold, cell_links
from fareweave.llm.quality_neighbours import fit_neighbours, score_quality
from fareweave.llm.vector_packing import pack_documents, pack_window
from fareweave.session import scratch_path

SCHEMA = "doc_id long, text string, lang string, score string, digest string, rejected string"
LONG = " ".join(f"word{k % 977} and more" for k in range(30_000))
ODD = ["", None, " ", "a  b", "x\n y ", "don't <|endoftext|> É\tq", "日本語   x\x1cy", "é ² ½x Ⅷ İstanbul", "\n\n a",
       "a" * 3000, "😀😀 ok", "!!! ??? 123", LONG]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, odd and very long texts, repeated rows and ids, columns with the operators' own names."""
    rows = [(k, t, None if k % 3 else "en", "s", None, "r") for k, t in enumerate(ODD)]
    return spark.createDataFrame([*rows, rows[4], (None, "null id", None, None, None, None), (4, "x", "fr", "", "", "")],
                                 SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _ids(name, text):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids


def test_orc_files_hold_the_library_ids(spark, odd, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.start, r.n_tokens, r.ids_crc32)
                 for r in token_files(odd, path).collect())
    want = {}
    for r in odd.collect():
        ids = np.array(_ids("word_bpe_49k.json", r.text) + [1], "<u4")
        want.setdefault(-1 if r.doc_id is None else r.doc_id, []).append((len(ids), zlib.crc32(ids.tobytes())))
    at = 0
    for doc, start, n, crc in sorted(got, key=lambda r: (r[0], r[1])):
        assert start == at and (n, crc) in want[doc]
        want[doc].remove((n, crc))
        at += n
    assert not any(want.values())
    assert token_files(empty, path).count() == 0


def test_orc_files_are_split_and_skipped(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("some words here").alias("text"))
    path = scratch_path(spark, f"test-orc-{random.random()}")
    write_tokens(docs, path, public_tokenizers.path("word_bpe_49k.json"), files=4)
    files = [f for f in os.listdir(path) if f.endswith(".orc")]
    assert len(files) == 4
    assert read_documents(spark, path, [17, 2900]).count() == 2
    ordered = read_tokens(spark, path).orderBy("start").select("doc_id").collect()
    assert [r[0] for r in ordered] == list(range(3000))


def test_byte_bpe_matches_tiktoken(spark, odd, empty):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe_recursive.read_ranks(path),
                            special_tokens={})
    want = []
    for r in odd.collect():
        ids = own.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((r.text or "").encode()).hexdigest()))
    got = [tuple(r) for r in bpe_recursive.encode_documents(odd, path, public_tokenizers.PATTERN).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert bpe_recursive.encode_documents(empty, path).count() == 0


def test_packing_keeps_every_id(spark, odd, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = pack_documents(odd, path).toPandas()
    want = sorted(zlib.crc32(np.array(_ids("byte_bpe_50k.json", r.text) + [0], "<u4").tobytes()) for r in odd.collect())
    assert int(pieces.loc[pieces["start"] == 0, "doc_tokens"].sum()) == int(pieces["length"].sum())
    whole = pieces[(pieces["start"] == 0) & (pieces["length"] == pieces["doc_tokens"])]
    assert set(whole["ids_crc32"]) <= set(want)
    for _, held in pieces.sort_values("offset").groupby("sequence_id"):
        lengths = held["length"].to_numpy()
        assert held["offset"].tolist() == np.concatenate([[0], np.cumsum(lengths)[:-1]]).tolist()
        total = int(lengths.sum())
        assert total == 1024 or total & (total - 1) == 0 and total < 1024
    assert pack_documents(empty, path).count() == 0


def test_packing_respects_all_limits():
    rng = random.Random(3)
    docs = [(np.arange(n := rng.randint(1, 300)), np.array([rng.random() < 0.5 for _ in range(n)], int)) for _ in range(200)]
    seen = [np.zeros(len(i), int) for i, _ in docs]
    for held in pack_window(docs, 64, 4, 40):
        assert sum(n for _, _, n in held) <= 64 and len(held) <= 4
        assert sum(docs[d][1][a:a + n].sum() for d, a, n in held) <= 40
        for d, a, n in held:
            seen[d][a:a + n] += 1
    assert all((s == 1).all() for s in seen)


def _brute_components(rows, words=4, percent=85):
    sets = {}
    for doc, text in rows:
        w = (text or "").encode().lower().split()
        n = min(words, len(w))
        sets[doc] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set()
    own = {d: d for d in sets}

    def root(d):
        while own[d] != d:
            d = own[d]
        return d

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                ra, rb = root(a), root(b)
                own[max(ra, rb)] = min(ra, rb)
    return {d: (len(sets[d]), root(d)) for d in ids}


def test_overlap_join_matches_brute_force(spark):
    rng = random.Random(5)
    vocab = [f"w{k}" for k in range(4000)]
    rows = []
    for family in range(40):
        base = [rng.choice(vocab) for _ in range(rng.choice([3, 6, 9, 20, 60, 200]))]
        for _ in range(rng.choice([1, 2, 5, 12])):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                text[rng.randrange(len(text))] = rng.choice(vocab)
            if rng.random() < 0.3:
                text += [rng.choice(vocab) for _ in range(rng.randint(0, 4))]
            rows.append((len(rows), " ".join(text)))
    passage = " ".join(rng.choice(vocab) for _ in range(40))
    rows += [(len(rows) + k, " ".join(rng.choice(vocab) for _ in range(rng.randint(5, 30))) + " " + passage)
             for k in range(60)]
    rows += [(len(rows), ""), (len(rows) + 1, None), (len(rows) + 2, "One TWO"), (len(rows) + 3, "one two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("digest", F.lit(1))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in overlap_join.jaccard_components(docs).collect()}
    assert got == _brute_components(rows)


def test_overlap_join_splits_large_groups(spark, monkeypatch):
    monkeypatch.setattr(overlap_join, "INDEX_ROWS", 7)
    rng = random.Random(8)
    base = [f"b{k}" for k in range(80)]
    rows = []
    for k in range(60):
        text = list(base)
        for _ in range(rng.randint(0, 4)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(10_000)}"
        rows.append((k, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in overlap_join.jaccard_components(docs).collect()}
    assert got == _brute_components(rows)


def test_overlap_join_edges(odd, empty):
    got = overlap_join.jaccard_components(odd).collect()
    assert len(got) == odd.count()
    assert {r.component_id for r in got if r.doc_id == 0} == {0}
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    assert overlap_join.jaccard_components(empty).count() == 0


def test_part_digests_meet_for_every_linked_pair():
    rng = np.random.default_rng(2)
    for percent in (80, 85):
        t = overlap_join.Threshold(percent)
        for n in [1, 2, 6, 7, 8, 13, 40, 200, 700]:
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            most = t.differences(2 * n)
            for cut in range(most // 2 + 1):
                b = np.unique(np.concatenate([a[cut:], rng.integers(0, 1 << 63, cut, dtype=np.uint64)]))
                both = len(np.intersect1d(a, b))
                if 100 * both >= percent * len(np.union1d(a, b)):
                    da, na = overlap_join.part_digests(a, t)
                    db, _ = overlap_join.part_digests(b, t)
                    met = np.intersect1d(da, db)
                    assert len(met)
                    for k in t.classes(len(a)):
                        if k in t.classes(len(b)) and k in (t.size_class(len(a)), t.size_class(len(b))):
                            assert (met % 2 == k % 2).sum() >= min(na[k & 1], 1)


def test_components_of_a_long_chain(spark):
    n = 300
    order = list(range(n))
    random.Random(1).shuffle(order)
    edges = spark.createDataFrame([(order[k], order[k + 1]) for k in range(n - 1)] + [(1000, 1001)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges, "a", "b").collect()}
    assert got == {k: 0 for k in range(n)} | {1000: 1000, 1001: 1000}


LANGS = {"aa": ["tabo", "minu", "kero", "tasi", "molu"], "bb": ["schund", "reich", "keit", "ungen", "zwar"]}


def _lang_rows(n, seed):
    rng = random.Random(seed)
    return [(k, " ".join(rng.choice(LANGS[lang]) + rng.choice(LANGS[lang]) for _ in range(30)), lang)
            for k, lang in ((k, rng.choice(sorted(LANGS))) for k in range(n))]


def test_language_centroids(spark, odd, empty):
    model = fit_centroids(spark.createDataFrame(_lang_rows(300, 1), "doc_id long, text string, lang string"))
    test = spark.createDataFrame(_lang_rows(100, 2), "doc_id long, text string, lang string")
    got = predict_language(test, model).collect()
    assert sum(r.lang == r.lang_pred and not r.rejected for r in got) >= 98
    edge = predict_language(odd, model).collect()
    assert len(edge) == odd.count()
    assert all((r.lang_pred == "und") == (not any(map(str.isalpha, r.text or ""))) for r in edge)
    assert all(0 <= r.score <= 1 for r in edge)
    far = predict_language(spark.createDataFrame([(1, "qqq xxw qxz wvq xqj zzx" * 20)], "doc_id long, text string"), model)
    assert far.first().rejected
    assert fit_centroids(empty) is None
    assert {r.lang_pred for r in predict_language(odd, None).collect()} == {"und"}
    assert predict_language(empty, model).count() == 0


def test_quality_neighbours(spark, odd, empty):
    rng = random.Random(4)
    rows = [(k, t if k % 2 else t.upper() + " !!! ### " * 20) for k, t, _ in _lang_rows(300, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)] + [(None, 1), (3, None), (5, 1)], "doc_id long, quality int")
    model = fit_neighbours(docs, labels)
    got = score_quality(docs, model).collect()
    assert all(r.predicted == r.doc_id % 2 for r in got)
    edge = score_quality(odd, model).collect()
    assert len(edge) == odd.count() and all(0 <= r.score <= 1 for r in edge)
    assert fit_neighbours(docs, labels.limit(0)) is None
    assert {r.score for r in score_quality(odd, None).collect()} == {0.5}
    assert score_quality(empty, model).count() == 0
    assert rng


def test_lattice_restores_obfuscated_words():
    words = ["idiot", "stupid", "loser", "the", "cat", "sat", "on", "a", "mat", "moron", "about", "letter"]
    model = char_lattice.CharModel(char_lattice.count_grams([" ".join(words * 50)]))
    read = deobfuscation.Reader(model.cost, lambda w: tuple(w))
    for token, want in (("1d10t", "idiot"), ("i.d.i.o.t", "idiot"), ("$tup1d", "stupid"), ("stuuuupid", "stupid"),
                        ("l0s3r", "loser"), ("i d i o t", "idiot"), ("mmoorroonn", "moron"), ("letter", "letter")):
        assert want in read.words(token), token
    assert any("idiot" in w for w in read("x\n1d10t, about"))
    for token, want in (("id-iot", "idiot"), ("id*iot", "idiot"), ("mo.ron", "moron"), ("stu*pid", "stupid"),
                        ("stuupid", "stupid"), ("iddiott", "idiot"), ("1|)10+", "idiot"), ("$7up1d", "stupid")):
        assert want in read.words(token), token
    for text in ("i  d  i  o  t", "i\nd\ni\no\nt", "id iot", "i d iot", "the idi ot sat"):
        assert any("idiot" in w for w in read(text)), text
    few = deobfuscation.Reader(model.cost, lambda w: tuple(x for x in w if x.startswith(("idio", "moron", "savvy"))), ["idio", "moron", "savvy"])
    for text in ("id-iot", "i d iot", "mo.ron", "1|)10+", "iddiott", "the cat", "mmoorroonn 455 letter", "a 1 d10 t", "sav-vy"):
        assert few(text) == [v for w in read(text) if (v := tuple(x for x in w if x.startswith(("idio", "moron", "savvy"))))], text
    assert read(None) == [] and read("") == [] and read("... 123") == []


def _best_reading(cost, token):
    """The cheapest path of a token's lattice, by enumeration of all of them."""
    best = []

    def go(i, last, state, total, out):
        def add(j, symbols, letter, extra):
            s, t = state, total + extra
            for x in symbols:
                t += float(cost[s * 28 + x])
                s = (s * 28 + x) % 28 ** 3
            go(j, token[i] if token[i] != " " else last, s, t, out + letter)

        close = float(cost[state * 28]) if state % 28 else 0.0
        if i == len(token):
            best.append((total + close, out))
            return
        c, costs = token[i], char_lattice.COST
        if c == " ":
            go(i + 1, last, state, total + costs["join"], out)
            return go(i + 1, last, 0, total + costs["split"] + close, out + " ")
        if c.isalpha():
            add(i + 1, [ord(c) - 96], c, 0.0)
        else:
            go(i + 1, c, 0, total + costs["other"] + close, out + " ")
        for x in char_lattice.LEET.get(c, ""):
            add(i + 1, [ord(x) - 96], x, costs["leet"])
        if pair := char_lattice.LEET_PAIRS.get(token[i:i + 2]):
            s = state * 28 + ord(pair) - 96
            go(i + 2, token[i + 1], s % 28 ** 3, total + costs["leet"] + float(cost[s]), out + pair)
        if c in char_lattice.SEPARATORS and 0 < i < len(token) - 1:
            go(i + 1, c, state, total + costs["separator"], out)
        if c == last:
            go(i + 1, c, state, total + costs["repeat"], out)

    go(0, "", 0, 0.0, "")
    return min(best)[0], {out for t, out in best if t <= min(best)[0] + 1e-6}


def test_decoder_equals_enumeration_of_all_paths():
    words = ["idiot", "stupid", "loser", "the", "cat", "moron", "letter", "add"]
    cost = char_lattice.CharModel(char_lattice.count_grams([" ".join(words * 20)])).cost.reshape(-1)
    rng = random.Random(8)
    for _ in range(150):
        token = "".join(rng.choice("adilost 1105$+!.-*)|") for _ in range(rng.randrange(1, 8))).strip() or "a"
        assert char_lattice.Decoder(cost).decode(token) in _best_reading(cost, token)[1], token


def test_toxicity(spark, odd, empty):
    rng = random.Random(6)
    clean = ["about", "letter", "house", "garden", "window", "table", "river", "mountain"]
    rows = []
    for k in range(240):
        words = [rng.choice(clean) for _ in range(20)]
        if k % 2:
            words[rng.randrange(20)] = rng.choice(["idiot", "loser"] if k < 200 else ["1d10t", "l o s e r", "idiiiot"])
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)] + [(None, 1), (7, None)], "doc_id long, toxic int")
    cost, evidence = deobfuscation.fit(docs, labels)
    got = deobfuscation.score_toxicity(docs, cost, evidence).collect()
    assert all(r.predicted == r.doc_id % 2 for r in got)
    edge = deobfuscation.score_toxicity(odd, cost, evidence).collect()
    assert len(edge) == odd.count() and all(0 <= r.score <= 1 and r.predicted == 0 for r in edge)
    assert deobfuscation.score_toxicity(empty, cost, evidence).count() == 0
    none, nothing = deobfuscation.fit(empty, labels.limit(0))
    assert deobfuscation.score_toxicity(odd, none, nothing).count() == odd.count()


def test_orc_offsets_follow_the_number_of_the_file(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("some words here").alias("text"))
    path, many = (scratch_path(spark, f"test-orc-{random.random()}") for _ in range(2))
    write_tokens(docs, path, public_tokenizers.path("word_bpe_49k.json"), files=2)
    names = sorted(f for f in os.listdir(path) if f.endswith(".orc"))
    os.makedirs(many)
    for name, number in zip(names, ("99999", "100000")):
        shutil.copy(os.path.join(path, name), os.path.join(many, name.replace(name.split("-")[1], number, 1)))
    ordered = read_tokens(spark, many).orderBy("start").select("doc_id").collect()
    assert [r[0] for r in ordered] == list(range(3000))


def test_sample_of_rows_without_ids(spark):
    rows = spark.range(5000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"), F.lit("xx").alias("lang"))
    copies = spark.range(5000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("copy").alias("text"), F.lit("xx").alias("lang"))
    named = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("n"), "id").alias("text"), F.lit("yy").alias("lang"))
    for seed in range(6):
        got = bounded_sample(rows.union(copies).union(named), "lang", "doc_id", 200, seed, text_col="text").toPandas()
        sizes = got.groupby("lang").size()
        assert 60 <= sizes["xx"] <= 160 and 150 <= sizes["yy"] <= 250 and got["text"].is_unique
    assert list(got.columns) == ["doc_id", "text", "lang", "weight"]
    assert bounded_sample(named.limit(0), "lang", "doc_id", 200, 1).count() == 0


def test_asking_rows_pass_in_pieces():
    rng, threshold = random.Random(5), Threshold(50)
    sets = [np.unique(np.array([rng.randrange(14) for _ in range(rng.randrange(1, 9))], np.uint64)) for _ in range(400)]
    rows = [(cell, salt, k, s.tobytes(), cell < 3 and k % 5 == salt, k % 2 == 0 or k % 5 != salt)
            for cell in (1, 2, 3) for salt in (0, 1) for k, s in enumerate(sets)]
    rows.sort(key=lambda r: (r[0], r[1], not r[4]))
    table = pd.DataFrame(rows, columns=["cell", "salt", "id", "grams", "indexed", "asks"])
    batches = (table.iloc[k:k + 50].copy() for k in range(0, len(table), 50))
    want = Counter((r[2], o[2]) for r in rows for o in rows if r[:2] == o[:2] and r[5] and o[4] and r[2] != o[2]
                   and len(np.intersect1d(sets[r[2]], sets[o[2]])) >= threshold.needed(len(sets[r[2]]), len(sets[o[2]])))
    assert Counter((int(a), int(b)) for a, b in cell_links(batches, 50)) == want


def test_memory_of_a_part_does_not_grow_with_its_askers():
    rng = np.random.default_rng(1)
    columns = ["cell", "salt", "id", "grams", "indexed", "asks"]
    kept = np.sort(rng.integers(0, 1 << 60, 1000, np.uint64))

    def batches():  # 160 MB in all
        yield pd.DataFrame([(1, 0, 0, kept.tobytes(), True, False)], columns=columns)
        for k in range(200):
            sets = [kept if k == j == 7 else np.sort(rng.integers(0, 1 << 60, 1000, np.uint64)) for j in range(100)]
            yield pd.DataFrame([(1, 0, 1 + 100 * k + j, s.tobytes(), False, True) for j, s in enumerate(sets)], columns=columns)

    tracemalloc.start()
    links = list(cell_links(batches(), 85))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert links == [(708, 0)] and peak < 20 << 20
