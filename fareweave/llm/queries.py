"""The registered queries of this subpackage and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bit_sliced_weights import resample
from .bpe_recursive import encode_documents
from .common import is_remainder, read_table
from .deobfuscation import fit, score_toxicity
from .language_centroids import fit_centroids, predict_language
from .learned_cuts import fill_in_middle, restored_text
from .metric_range_join import range_join
from .orc_tokens import token_files
from .overlap_join import jaccard_components
from .pivot_topk import top_inner_products
from .quality_neighbours import fit_neighbours, score_quality
from .site_style_tree import main_text
from .super_kmers import remove_repeats
from .vector_packing import pack_documents


def op1_deobfuscated_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document's restored text."""
    docs = read_table(spark, sf_dir, "documents")
    held_out = is_remainder("doc_id", 4, 2)
    cost, evidence = fit(docs, read_table(spark, sf_dir, "labels").where(~held_out))
    found = score_toxicity(docs, cost, evidence)
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted", "n_evidence")


def op2_orc_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document through ORC files with row indexes and Bloom filters."""
    return token_files(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return main_text(read_table(spark, sf_dir, "pages"))


def op4_language_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document by its nearest centroid."""
    docs = read_table(spark, sf_dir, "documents")
    held_out = is_remainder("doc_id", 4, 2)
    model = fit_centroids(docs.where(~held_out))
    found = predict_language(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op5_recursive_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document and the bytes decoded from them."""
    return encode_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                            public_tokenizers.PATTERN)


def op6_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document by its labelled neighbours' vote."""
    docs = read_table(spark, sf_dir, "documents")
    held_out = is_remainder("doc_id", 5, 0)
    model = fit_neighbours(docs, read_table(spark, sf_dir, "labels").where(~held_out))
    found = score_quality(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op7_metric_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors: links, components and the rows kept."""
    return range_join(read_table(spark, sf_dir, "embeddings"))


def op8_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten largest inner products of every hundredth vector."""
    rows = read_table(spark, sf_dir, "embeddings")
    return top_inner_products(rows, rows.where(F.col("vec_id") % 100 == 0))


def op9_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of at most 1024 tokens."""
    return pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_overlap_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 4-word shingles have a Jaccard similarity of at least 0.85."""
    return jaccard_components(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op11_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 20-word windows that start earlier elsewhere."""
    found = remove_repeats(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op12_learned_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-middle examples of every document, and the texts rebuilt from them."""
    found = fill_in_middle(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                        F.sha2(restored_text(), 256).alias("restored_sha256"))


def op13_bit_sliced_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of every document towards the benchmark texts and the quarter of the documents drawn by them."""
    found = resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {f.__name__: f for f in (
    op1_deobfuscated_toxicity, op2_orc_token_files, op3_site_style_tree, op4_language_centroids, op5_recursive_bpe,
    op6_quality_neighbours, op7_metric_range_join, op8_pivot_topk, op9_vector_packing, op10_overlap_join,
    op11_super_kmers, op12_learned_cuts, op13_bit_sliced_weights)}

_USABLE = """
v AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)"""

ORACLES = {
    "op7_metric_range_join": f"""
WITH RECURSIVE {_USABLE},
u AS (SELECT vec_id, x, sqrt(list_inner_product(x, x)) AS n FROM v WHERE list_inner_product(x, x) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_inner_product(a.x, b.x) / (a.n * b.n) >= 0.9),
reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id) AS n_links, min(r.other) AS component_id,
       e.vec_id = min(r.other) AS kept
FROM embeddings e JOIN reach r USING (vec_id) GROUP BY e.vec_id
""",
    "op8_pivot_topk": f"""
WITH {_USABLE},
w AS (SELECT vec_id, list_transform(x, lambda c: floor(1024 * c)) AS x FROM v),
s AS (
  SELECT q.vec_id AS query_id, w.vec_id, list_inner_product(q.x, w.x)::BIGINT AS score
  FROM w q JOIN w ON q.vec_id <> w.vec_id AND len(q.x) = len(w.x) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
""",
    "op10_overlap_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
g AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
         ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) END) AS grams
  FROM w),
e AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM g),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM g UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT g.doc_id, len(g.grams)::BIGINT AS n_shingles, min(r.other) AS component_id
FROM g JOIN reach r USING (doc_id) GROUP BY g.doc_id, g.grams
""",
    "op11_super_kmers": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (
  SELECT doc_id, unnest(range(1, len(words) - 18)) AS start, unnest(list_transform(range(1, len(words) - 18),
         lambda i: array_to_string(words[i:i + 19], ' '))) AS win FROM d WHERE len(words) >= 20),
f AS (SELECT doc_id, start, min({'d': doc_id, 's': start}) OVER (PARTITION BY win) AS first FROM w),
r AS (SELECT DISTINCT doc_id, unnest(range(start, start + 20)) AS pos FROM f
      WHERE first <> {'d': doc_id, 's': start}),
p AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM d),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS kept, count(*) AS n
      FROM p ANTI JOIN r USING (doc_id, pos) GROUP BY doc_id)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, len(d.words)::BIGINT - coalesce(k.n, 0) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
""",
    "op12_learned_cuts": r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens
  FROM documents),
c AS (
  SELECT doc_id, text, tokens, len(tokens)::BIGINT AS n, ('0x' || h[1:8])::BIGINT % (len(tokens) + 1) AS a,
         ('0x' || h[9:16])::BIGINT % (len(tokens) + 1) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR ('0x' || h[17:24])::BIGINT % 100 >= 50 THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM t),
s AS (
  SELECT doc_id, n, form, text, coalesce(array_to_string(tokens[1:least(a, b)], ''), '') AS prefix,
         coalesce(array_to_string(tokens[least(a, b) + 1:greatest(a, b)], ''), '') AS middle,
         coalesce(array_to_string(tokens[greatest(a, b) + 1:n], ''), '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN text ELSE prefix || middle || suffix END) AS restored_sha256
FROM s
""",
    "op13_bit_sliced_weights": r"""
WITH RECURSIVE steps(byte, bit, v) AS (
  SELECT range, 0, range::BIGINT FROM range(256) UNION ALL
  SELECT byte, bit + 1, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM steps WHERE bit < 8),
crc AS (SELECT list(v ORDER BY byte) AS tbl FROM steps WHERE bit = 8),
texts AS (SELECT 'd' AS side, doc_id, text FROM documents UNION ALL SELECT 'b', NULL, text FROM benchmark),
w AS (
  SELECT side, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts),
g AS (
  SELECT side, doc_id, unnest(words || CASE WHEN len(words) < 2 THEN []::VARCHAR[] ELSE list_transform(
         range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END) AS feature FROM w),
n AS (SELECT side, doc_id, feature, count(*) AS n FROM g GROUP BY ALL),
b AS (
  SELECT feature, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, strlen(feature)),
         lambda i: ('0x' || hex(feature)[2 * i + 1:2 * i + 2])::BIGINT)),
         lambda c, x: xor(c >> 8, tbl[xor(c & 255, x) + 1])), 4294967295::BIGINT) % 10000 AS bucket
  FROM (SELECT DISTINCT feature FROM n), crc),
f AS (SELECT side, doc_id, bucket, sum(n) AS n FROM n JOIN b USING (feature) GROUP BY ALL),
totals AS (SELECT coalesce(sum(n) FILTER (side = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 'b'), 0)::DOUBLE AS t
           FROM f),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(sum(n) FILTER (side = 'b'), 0)::DOUBLE + 1) * (any_value(s) + 10000)
         / ((coalesce(sum(n) FILTER (side = 'd'), 0)::DOUBLE + 1) * (any_value(t) + 10000))))::BIGINT AS gain
  FROM f, totals GROUP BY bucket),
weights AS (SELECT doc_id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS total
            FROM f JOIN gains USING (bucket) WHERE side = 'd' GROUP BY doc_id),
scored AS (
  SELECT w.doc_id, len(w.words) AS n_words, coalesce(n_features, 0) AS n_features,
         CASE WHEN n_features > 0 THEN (total - ((total % n_features) + n_features) % n_features) // n_features ELSE 0 END
         AS weight, ('0x' || sha256('7:' || coalesce(w.doc_id::VARCHAR, ''))[1:8])::BIGINT AS h
  FROM w LEFT JOIN weights USING (doc_id) WHERE side = 'd'),
noisy AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM scored),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS total
           FROM noisy WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 25 * total // 100 THEN rank END AS rank
FROM noisy LEFT JOIN ranked USING (doc_id)
""",
}
