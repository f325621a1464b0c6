"""From raw documents to token ids: quality rules, line dedup, near-copy join, decontamination, SentencePiece.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps; the last one their token ids. ``run``
writes every stage's rows as Parquet in the shared folder and reads them again, so a lost executor costs at
most the stage at work.

No stage reads columns beside the id and the text; all but the last hand them on as they were (``n_chars`` follows the
text). Null texts fail the quality rules; an empty table stays empty through all stages.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carbonloom.llm import leak_scan, line_dedup, ngram_join, quality_cascade, sentence_pieces, shared
from carbonloom.llm.queries import PIECES, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return quality_cascade.keep(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines seen before, alike or equal; a document that loses all its lines goes."""
    out = line_dedup.dedup(docs, counts=False, drop_emptied=True)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def near_copy_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of smallest id."""
    return ngram_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return leak_scan.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def sentence_piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    v = sentence_pieces.read_vocabulary(PIECES)
    found = sentence_pieces.encode(docs, v, decoded="decoded")
    same = F.col("text").eqNullSafe(F.col("decoded")).alias("round_trip")
    return found.select("doc_id", "ids", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_pieces"), same)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_deduplication),
    ("ngram_join", near_copy_join),
    ("decontamination", decontamination),
    ("sentence_pieces", sentence_piece_ids),
]

#: The fuzzy line and document groups are components over similarities of every pair: not a query to state in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared.folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
