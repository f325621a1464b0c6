"""The numbered queries over the whole given tables, with production parameters."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carbonloom.llm import hard_negatives, katz, leak_scan, licence_rules, line_dedup, ngram_join, quality_cascade, ranked_search, secret_scan, sentence_pieces, suffix_merge, toxic_neighbours, url_rules

URL_RULES = (
    url_rules.UrlRule("allow", "com/"),
    url_rules.UrlRule("block", "example.com/en/"),
    url_rules.UrlRule("allow", "www.example.com/en/"),
    url_rules.UrlRule("block", "net/es/"),
    url_rules.UrlRule("block", "net/fr/"),
)


#: The vocabulary that op7 and the pipeline encode with; its folder is set by the environment.
PIECES = os.path.join(os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers"), "piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(by: int) -> Column:
    """crc32 of the doc_id as text, modulo ``by``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(by))


def op1_toxic_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxic_neighbours.fit(docs, labels.where(remainder(5) != 0))
    found = toxic_neighbours.score(docs, model)
    return found.select("doc_id", (remainder(5) == 0).alias("held_out"), "score", "predicted", "evidence")


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op3_suffix_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_merge.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = katz.score(table(spark, sf_dir, "documents"), remainder(10) != 0)
    return found.select("doc_id", (remainder(10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup(table(spark, sf_dir, "documents"), counts=True)
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op7_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = sentence_pieces.read_vocabulary(PIECES)
    found = sentence_pieces.encode(table(spark, sf_dir, "documents"), v, decoded="decoded")
    return found.select(
        "doc_id",
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_pieces"),
        F.xxhash64("ids").alias("ids_hash"),
        F.col("text").eqNullSafe(F.col("decoded")).alias("round_trip"),
    )


def op8_licence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licence_rules.scan(table(spark, sf_dir, "documents"))
    licences = F.array_sort(F.array_distinct(F.transform("findings", lambda x: x.licence)))
    return found.select(
        "doc_id",
        F.size("sentences").cast("long").alias("n_sentences"),
        F.size("findings").cast("long").alias("n_findings"),
        F.array_join(licences, ",").alias("licences"),
    )


def op9_leak_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak_scan.digest(leak_scan.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op10_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cascade.verdicts(table(spark, sf_dir, "documents"), every=True)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES = {
    "op1_toxic_neighbours": op1_toxic_neighbours,
    "op2_url_rules": op2_url_rules,
    "op3_suffix_merge": op3_suffix_merge,
    "op4_katz": op4_katz,
    "op5_ngram_join": op5_ngram_join,
    "op6_line_dedup": op6_line_dedup,
    "op7_sentence_pieces": op7_sentence_pieces,
    "op8_licence_rules": op8_licence_rules,
    "op9_leak_scan": op9_leak_scan,
    "op10_quality_cascade": op10_quality_cascade,
    "op11_ranked_search": op11_ranked_search,
    "op12_secret_scan": op12_secret_scan,
    "op13_hard_negatives": op13_hard_negatives,
}
