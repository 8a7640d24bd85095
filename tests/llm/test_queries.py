"""The registered queries against DuckDB SQL or brute force on the given tables, and the pipeline's stages."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from fareweave.llm.common import is_remainder
from fareweave.llm.language_centroids import fit_centroids, predict_language
from fareweave.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, con, name):
    want = con.execute(ORACLES[name]).fetchall()
    names = [c[0] for c in con.description]
    got = QUERIES[name](spark, SF).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize("name", ["op1_deobfuscated_toxicity", "op4_language_centroids", "op6_quality_neighbours"])
def test_model_queries_cover_all_rows(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    assert sorted(got["doc_id"]) == sorted(r[0] for r in con.execute("SELECT doc_id FROM documents").fetchall())
    assert got["score"].between(0, 1).all()
    if name.startswith("op4"):
        lang = dict(con.execute("SELECT doc_id, lang FROM documents WHERE lang IS NOT NULL").fetchall())
        held = got[got["held_out"]]
        assert (held["lang_pred"] == held["doc_id"].map(lang)).mean() > 0.9


def test_pipeline(spark, con):
    import numpy as np

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns and 0 < docs.count() <= before
        before = docs.count()
    texts = docs.select("doc_id", "text").collect()
    sets = [set(zip(*(w[k:] for k in range(5)))) for w in ((r.text or "").encode().lower().split() for r in texts)]
    assert not any(100 * len(a & b) >= 80 * len(a | b) for k, a in enumerate(sets) for b in sets[:k] if a and b)
    pieces = corpus_pipeline.packing(spark, docs, SF).toPandas()
    assert set(pieces["doc_id"]) == {r.doc_id for r in texts}
    totals = pieces.groupby("doc_id").agg(got=("length", "sum"), want=("doc_tokens", "first"))
    assert np.array_equal(totals["got"], totals["want"])


def test_near_duplicates_of_five_words_and_null_ids(spark):
    words = [f"w{k}" for k in range(50)]
    near = " ".join([*words[:25], "other", *words[26:]])
    alone = " ".join(f"n{k}" for k in range(40))
    rows = [(1, " ".join(words)), (2, near), (None, " ".join(words)), (None, near), (None, alone), (None, alone),
            (None, alone + " n40"), (3, ""), (None, None), (4, "far from all of them"), (4, "far from all of them")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()]
    named = sorted(r for r in got if r[0] is not None)
    assert named == [(1, rows[0][1]), (3, ""), (4, rows[9][1])]
    unnamed = [r[1] for r in got if r[0] is None]
    assert len(unnamed) == 2 and None in unnamed and any(t and t.startswith(alone) for t in unnamed)


def _ids_with_other_texts():
    a, b = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(60))
    return a, b, [(1, a), (1, b), (2, b + " x"), (3, a + " x"), (2, "c d e f g"), (None, a), (4, None), (1, a), (None, "q r s t u v")]


def test_links_of_ids_that_repeat_with_other_texts(spark):
    from fareweave.llm.overlap_join import jaccard_components

    a, b, rows = _ids_with_other_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard_components(docs).select("doc_id", "component_id", "group_id", "n_shingles").collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=repr) == sorted(
        [(1, 1), (1, 1), (2, 1), (3, 1), (2, 2), (None, 1), (4, 4), (1, 1), (None, None)], key=repr)
    groups = {}
    for r in got:
        groups.setdefault(r.group_id, []).append(r.doc_id)
    assert sorted(map(len, groups.values())) == [1, 1, 1, 2, 4]


def test_near_duplicates_keep_other_texts_of_an_id_and_columns_of_any_name(spark):
    a, b, rows = _ids_with_other_texts()
    docs = spark.createDataFrame([(*r, "s", k, "p", "key") for k, r in enumerate(rows)],
                                 "doc_id long, text string, score string, _row int, predicted string, text_key string")
    got = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted([(r.doc_id, r.text) for r in got.collect()], key=repr) == sorted(
        [(1, a), (1, b), (2, "c d e f g"), (4, None), (None, "q r s t u v")], key=repr)
    assert all((r.score, r.predicted, r.text_key) == ("s", "p", "key") for r in got.collect())


@pytest.mark.parametrize("stage", ["language", "quality"])
def test_stages_leave_columns_of_their_own_names_alone(spark, stage):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    wide = docs.selectExpr("*", "'mine' as score", "'mine' as predicted", "'mine' as lang_pred", "7 as rejected")
    run = dict(corpus_pipeline.STAGES)[stage]
    got, plain = run(spark, wide, SF), run(spark, docs, SF)
    assert got.schema == wide.schema and 0 < got.count() == plain.count()
    assert got.where("score = 'mine' and predicted = 'mine' and lang_pred = 'mine' and rejected = 7").count() == plain.count()


def test_near_duplicates_match_brute_force(spark, con):
    rows = con.execute("SELECT doc_id, text FROM documents WHERE doc_id IS NOT NULL").fetchall()
    sets = {}
    for doc, text in rows:
        w = (text or "").encode().lower().split()
        n = min(5, len(w))
        sets[doc] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set()
    own = {d: d for d in sets}
    ids = sorted(sets)
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[:k]
             if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in ids:
        low = {**own}
        for a, b in pairs:
            low[a] = low[b] = min(low[a], low[b])
        if low == own:
            break
        own = low
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r[0] for r in corpus_pipeline.near_duplicates(spark, docs, SF).select("doc_id").collect())
    assert got == [d for d in ids if own[d] == d]


@pytest.mark.parametrize("out", ["de", "en", "es", "fr"])
def test_documents_of_a_language_left_out_are_rejected(spark, out):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang is not null")
    held_out = is_remainder("doc_id", 4, 2)
    model = fit_centroids(docs.where(~held_out & (docs["lang"] != out)))
    got = predict_language(docs.withColumn("held_out", held_out), model).where("lang_pred <> 'und'").toPandas()
    assert got.loc[got["lang"] == out, "rejected"].mean() > 0.98
    assert got.loc[(got["lang"] != out) & got["held_out"], "rejected"].mean() < 0.05
