"""A training-data pipeline over ``documents``: each stage works on all that the one before it kept.

1. Quality: documents that the classifier rejects go. It learns from the labelled rows that op8 learns from.
2. Lines: repeated lines go, as in op5, except that the smallest doc_id keeps a line and not the largest, because the next
   stage keeps the smallest too; a document stays even if no line of it does.
3. Near duplicates: of each group, the document with the smallest doc_id stays; rows that repeat a doc_id stay together,
   and so do rows without one. A line's one copy is still lost if the document that keeps it is a near copy of a smaller
   document without that line.
4. Benchmark: documents go in which eight consecutive words of a benchmark item occur, or windows of two items or more, as
   in op9. An item of fewer than eight words, a window as a whole, can thus not condemn a document by itself, however often
   it occurs.
5. Tokens: each document's ids, and whether decoding them gives its text back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, line_dedup, ngram_join, quality, queries
from tidemark.llm.common import discard, join_small, scratch, stored, unused


def _aside(docs: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the user's columns of these names under others, and how to name them back."""
    moved = {n: unused(f"{n}_", [*docs.columns, *names]) for n in docs.columns if n.lower() in names}
    return docs.withColumnsRenamed(moved), moved


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(queries.crc_remainder(3) != 1)
    name = unused("score", docs.columns)
    scored = quality.score(docs, quality.train(docs, labels), name)
    return scored.filter(F.col(name) >= 0.5).select(docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, moved = _aside(docs, ("n_lines", "n_dropped", "keep_runs", "kept_text"))
    # ~doc_id reverses the order of the ids: the largest then is the smallest doc_id.
    out = line_dedup.dedup_lines(rows.withColumn("doc_id", F.bitwise_not("doc_id")), min_chars=20, min_docs=3)
    out = out.withColumn("doc_id", F.bitwise_not("doc_id")).withColumn("text", F.col("kept_text")).withColumn("n_chars", F.char_length("kept_text").cast("long"))
    return out.select([F.col(moved.get(c, c)).alias(c) for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = ngram_join.near_duplicates(docs, size=5, percent=75)
    spare = stored(groups.groupBy("doc_id").agg(F.min("component_id").alias("first")).filter("first <> doc_id").select("doc_id"), "near-duplicates")
    return join_small(docs, spare, "doc_id", "left_anti").select(docs.columns)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), size=8)
    leaks = stored(found.filter((F.col("longest") >= 8) | (F.size("items") >= 2)).select("doc_id").distinct(), "leaks")
    return join_small(docs, leaks, docs["doc_id"].eqNullSafe(leaks["doc_id"]), "left_anti").select(docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = queries.tokenizer_path()
    kept = [c for c in ("doc_id", "lang", "source") if c in docs.columns]
    out = bpe.encode_and_decode(docs.select(*kept, "text"), path)
    return out.select(*kept, F.size("ids").cast("long").alias("n_tokens"), "ids", (F.coalesce("text", F.lit("")) == F.col("decoded")).alias("restored"))


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", benchmark_stage),
    ("BPE encoding and decoding", token_stage),
]

#: SQL can express neither the classifier nor the tokens; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with scratch(spark):  # what a stage stores for itself goes when its result is written
            out = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"), keep=True)
        if docs is not given:
            discard(docs)
        docs = out
    return docs
