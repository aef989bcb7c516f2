"""A pipeline over the documents for training data: each stage works on all that the one before kept.

Stages keep the documents' columns, whatever their names, but for the last. An empty table stays empty in each. A text that is
null counts as empty where it is read and stays null where it is kept. Rows of one doc_id are judged each by its own text but
for near duplicates, where they stay or go together; rows without doc_id are judged like the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import bpe, decontaminate, ngram_join, pii, quality
from marketlens.llm.common import dropped, n_made, new_path, small, table, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects. Null and empty texts are scored as empty ones; with no labels
    every score is 0.5, and all documents go."""
    return quality.accepted(docs, quality.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): that with the smallest doc_id. Repeated
    rows of a doc_id stay together. A row without doc_id is a document by its text and stays where its group has no document
    with a doc_id. Texts without words have no copies."""
    key = F.coalesce(docs["doc_id"].cast("long"), F.lit(1 << 62) + F.pmod(F.xxhash64(docs["text"]), F.lit(1 << 62)))
    groups = ngram_join.join(docs.select(key.alias("doc_id"), "text"))
    copies = written(groups.where("component_id <> doc_id").select(F.col("doc_id").alias("copy")).distinct(), "copies")
    return docs.join(small(copies), key == copies["copy"], "left_anti")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that contain a benchmark item. Texts without words contain none, and an empty benchmark removes
    nothing."""
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def sanitised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and the terms that disclose it replaced; n_chars follows. Null texts stay null."""
    return pii.sanitise(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, and digests of them and of the bytes that they decode to. Null and empty texts have no ids."""
    return bpe.digests(docs, keep_ids=True)


STAGES = [("quality", keep_quality), ("near_duplicates", one_of_each_group), ("decontamination", without_benchmark), ("pii", sanitised), ("byte_bpe", encoded)]

#: SQL cannot express a trained classifier, the search for disclosing terms or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Tables of a stage are deleted once its output is written, but for the last output."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        before = n_made()
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        dropped(before, *([last] if last else []))
        docs, last = spark.read.parquet(path), path
    return docs
