"""One query for each operator of this subpackage, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import bpe, chunking, knn, licenses, line_dedup, media, mixing, ngram_join, quality, toxicity
from tallyline.llm.common import table
from tallyline.llm.training import fold, labelled

#: Rank file and splitting pattern of the tokenizer; the path is a parameter of the query.
RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def op1_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.join(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 100 == 0)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), fold("doc_id", 5) == 0
    sample = labelled(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "quality", quality.ROWS, ~held)
    found = quality.score(docs, "doc_id", "text", quality.train(sample))
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("raw"))
    payload = media.padded(F.col("raw"))
    figure = F.format_string('<article><p>Document %s</p><figure><img src="sha256:%s"><figcaption>%s bytes</figcaption></figure></article>', F.col("doc_id").cast("string"), F.sha2(payload, 256), F.octet_length("raw").cast("string"))
    pages = docs.select("doc_id", figure.alias("html"))
    refs = media.references(media.sequences(pages, "doc_id", "html"), "doc_id")
    stored = media.describe(media.media_table(docs.select(payload.alias("payload")), "payload"))
    size = F.regexp_extract("caption", r"(\d+) bytes", 1).cast("long")
    return media.resolve(refs.withColumn("n_bytes", size), stored).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "pos", "caption")


def op4_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), fold("doc_id", 3) == 1
    sample = labelled(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "toxic", toxicity.ROWS, ~held)
    found = toxicity.score(docs, "doc_id", "text", toxicity.train(sample))
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.passages(table(spark, sf_dir, "documents"), "doc_id", "text")


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"), size=3, percent=90)


def op8_byte_bpe(spark: SparkSession, sf_dir: str, rank_file: str | None = None) -> DataFrame:
    import public_tokenizers

    vocabulary = bpe.load_ranks(rank_file or public_tokenizers.path(RANK_FILE))
    return bpe.round_trip(table(spark, sf_dir, "documents"), "doc_id", "text", vocabulary, public_tokenizers.PATTERN)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), "doc_id", "text")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_voronoi_knn": op1_voronoi_knn,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_media_columns": op3_media_columns,
    "op4_mixing_sources": op4_mixing_sources,
    "op5_toxicity": op5_toxicity,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_line_dedup": op9_line_dedup,
    "op10_license_scan": op10_license_scan,
    "pipeline": pipeline,
}

OP1_SQL = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.v, d.v) AS BIGINT) AS score
  FROM e q JOIN e d ON d.vec_id <> q.vec_id AND len(q.v) = len(d.v) WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

ORACLE_SQL: dict[str, str] = {
    "op1_voronoi_knn": OP1_SQL,
}
