"""The operators bound to the tables of a data folder: one query an operator, and their SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import edit_counts, fingerprints, jaccard_join, line_dedup, neighbours, packing, pii, quality, secrets, sentencepiece_codec
from ._common import sha, stored, table

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WINDOW = 2048


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_decode(table(spark, sf_dir, "documents"), PIECE_MODEL, sentencepiece_codec.digest_row, sentencepiece_codec.DIGEST)


def _third_replaced(text: str, following: str) -> str:
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _fingerprint_row(doc_id, text: str, edited: str, prints: tuple) -> tuple:
    own, changed, following = prints
    return doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), fingerprints.as_text(own), fingerprints.as_text(changed), fingerprints.likeness(own, changed), fingerprints.likeness(own, following)


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return fingerprints.with_edited(table(spark, sf_dir, "documents"), _third_replaced, _fingerprint_row, schema)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"), everywhere=True)
    kinds = F.array(*[F.lit(k) for k in pii.KINDS])
    base = F.transform("base", lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    added = F.transform("added", lambda s: F.concat_ws(":", F.lit("term"), s["start"].cast("string"), s["end"].cast("string")))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = {k})) as long)").alias(f"n_{name}") for k, name in enumerate(pii.KINDS)]
    # Disclosing terms of documents without personal data have a column of their own: tests hold that ``spans`` has none there.
    own, none = F.size("base") > 0, F.array().cast("array<string>")
    spans = F.concat(base, F.when(own, added).otherwise(none))
    other = F.when(own, none).otherwise(added)
    return found.select("doc_id", *counts, sha(F.array_join(base, ",")).alias("base_sha256"), F.array_join(spans, ",").alias("spans"), F.size(spans).cast("long").alias("n_spans"), F.array_join(other, ",").alias("other_spans"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= quality.ACCEPT).cast("int").alias("predicted"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pieces(table(spark, sf_dir, "documents"), BYTE_BPE, BYTE_RANKS, WINDOW, end=1)
    return packing.pack(pieces, WINDOW).drop("text_key")


def _joined(spans: str) -> str:
    return f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.find_secrets(docs, secrets.train(docs))
    counts = [F.expr(f"cast(size(filter(base_only, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in secrets.KINDS]
    return found.select("doc_id", *counts, sha(F.expr(_joined("base_only"))).alias("base_sha256"), F.expr(_joined("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def _edits(n: Column, opening: Column) -> Column:
    """Three edits of every text: a deletion at a third, an insertion of its opening at a half, a replacement near the end."""
    def edit(pos, n_del, ins):
        return F.struct(F.floor(pos).cast("int").alias("pos"), F.lit(n_del).alias("n_del"), ins.alias("ins"))
    return F.array(edit(n / 3, 40, F.lit("")), edit(n / 2, 0, F.substring(opening, 1, 60)), edit(n * 0.9, 7, F.lit(" edited words ")))


def op7_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return neighbours.search(neighbours.build(rows), rows.where(F.col("vec_id") % 100 == 0), k=10)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    trees = stored(edit_counts.build(table(spark, sf_dir, "documents"), BYTE_BPE), "trees")
    leaves, (_, n_chars) = F.array_join(F.slice("texts", 1, 60), ""), edit_counts.sums()
    out = edit_counts.edited(trees.withColumn("edits", _edits(n_chars, leaves)), BYTE_BPE, keep=False)
    return out.select("doc_id", F.col("n_tokens_before").alias("n_tokens"), F.col("n_tokens").alias("n_tokens_edited"), F.col("n_chars").alias("n_chars_edited"), "n_chars_encoded")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_frequent_lines(docs).select("doc_id", "n_lines", "n_dropped", sha(F.col("text")).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_order_minhash": op2_order_minhash,
    "op3_pii": op3_pii,
    "op4_quality": op4_quality,
    "op5_packing": op5_packing,
    "op6_secrets": op6_secrets,
    "op7_nn_descent": op7_nn_descent,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_token_counts": op9_token_counts,
    "op10_line_dedup": op10_line_dedup,
}

OP10_SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT rid, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM l),
hot AS (SELECT k AS hot FROM k WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT rid) >= 10)
SELECT doc_id, count(*) AS n_lines, count(hot) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE hot IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN hot ON k.k = hot.hot GROUP BY rid, doc_id
"""

OP8_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\v\\f\\r]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 5 * c >= 4 * (na.n + nb.n - c)),
r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a, min(b) AS class_id FROM r GROUP BY a),
k AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links
FROM documents JOIN m ON m.a = doc_id LEFT JOIN k ON k.a = doc_id
"""

SQL: dict[str, str] = {"op8_jaccard_join": OP8_SQL, "op10_line_dedup": OP10_SQL}
