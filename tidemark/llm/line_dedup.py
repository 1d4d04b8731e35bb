"""Line deduplication: hashes of lines, range-partitioned with a secondary sort by document and position; keep bitmaps
instead of text.

A key's lines are sorted by document, the largest first, and position. The first document met keeps its lines; the others'
go if enough documents hold the key. Keys that hold a large share of a range are settled by partial aggregates instead, so
no range waits for one key. What comes back for a document are the runs of lines that stay.

Nulls and ties: a null or empty text is one empty line. A null doc_id counts as one document, smaller than any other.
Rows that repeat a doc_id count as one document for the number of documents that hold a line, and each row gets a result
of its own. Columns besides doc_id and text are carried through, but for those that are named as a result is. An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ASCII_SPACE, join_small, shuffle_width, stored, unused

#: A key with more lines than this share of a range's mean is hot: it gets partial aggregates instead of a place in a range.
HOT_SHARE = 1 / 8


def _key_hashes(line: Column) -> list[Column]:
    """96 bits that stand for the line's key.

    A-Z must be lower-cased and no other letter. Read as Latin-1, a text's bytes become one character each, and lower()
    then changes A-Z and, besides, the lead bytes C0-DE to E0-FE. The bytes that follow still tell which it was, so two
    lines get the same string only if their keys are equal.
    """
    key = F.lower(F.decode(F.btrim(line, F.lit(ASCII_SPACE)).cast("binary"), "ISO-8859-1"))
    return [F.xxhash64(key).alias("h1"), F.hash(key).alias("h2")]


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _row_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Rows (doc_id, row_hash, dropped) for the texts that lose lines; dropped: sorted line numbers, from 0.

    Lines whose key has at least ``min_chars`` code points and is found in at least ``min_docs`` documents are lost in all
    documents but the one with the largest doc_id.
    """
    spark = docs.sparkSession
    lines = docs.select(F.col("doc_id"), _row_hash(F.col("text")).alias("row_hash"), F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    lines = lines.filter(F.char_length(F.btrim(F.col("line"), F.lit(ASCII_SPACE))) >= min_chars)
    lines = stored(lines.select("doc_id", "row_hash", "pos", *_key_hashes(F.col("line"))), "lines")
    # Keys that hold a large share of a range: at most ranges / HOT_SHARE of them, whatever the input's size.
    width = shuffle_width(spark)
    least = max(1000, int(lines.count() / width * HOT_SHARE))
    counts = lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter(F.col("n") > least)
    hot = stored(counts.select("h1", "h2"), "hot-lines")
    # Hot keys: two partial aggregates, then a join with at most as many rows as there are hot keys; their lines are not shuffled.
    held = join_small(lines, hot, ["h1", "h2"], "left_semi").groupBy("h1", "h2", "doc_id").agg(F.count("*").alias("n"))
    held = held.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last")).filter(F.col("n_docs") >= min_docs)
    hot_drops = join_small(lines, stored(held, "hot-holders"), ["h1", "h2"], "inner").filter(~F.col("doc_id").eqNullSafe(F.col("last")))
    # All other keys: ranges of the hash, within them sorted by key, document (largest first) and position. The first
    # document of a key is met first and keeps its lines; the others' lines go if enough documents follow.
    rest = join_small(lines, hot, ["h1", "h2"], "left_anti").repartitionByRange(width, "h1", "h2")
    by_key = Window.partitionBy("h1", "h2")
    in_order = by_key.orderBy(F.col("doc_id").desc_nulls_last())
    rest = rest.withColumn("nth", F.dense_rank().over(in_order)).withColumn("n_docs", F.max("nth").over(by_key))
    rest_drops = rest.filter((F.col("nth") > 1) & (F.col("n_docs") >= min_docs))
    drops = hot_drops.select("doc_id", "row_hash", "pos").unionByName(rest_drops.select("doc_id", "row_hash", "pos"))
    return drops.groupBy("doc_id", "row_hash").agg(F.sort_array(F.collect_set("pos")).alias("dropped"))


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """All rows of ``docs`` with n_lines, n_dropped, keep_runs and kept_text.

    keep_runs is the run-length compressed keep bitmap: the runs of lines that stay, each as its first line and length.
    """
    names = {n: unused(n, docs.columns) for n in ("_id", "_row", "dropped")}
    maps = keep_bitmaps(docs.select("doc_id", "text"), min_chars, min_docs).select(F.col("doc_id").alias(names["_id"]), F.col("row_hash").alias(names["_row"]), F.col("dropped").alias(names["dropped"]))
    docs = docs.drop("keep_runs", "kept_text", "n_lines", "n_dropped")
    out = docs.join(maps, F.col("doc_id").eqNullSafe(F.col(names["_id"])) & (_row_hash(F.col("text")) == F.col(names["_row"])), "left").drop(names["_id"], names["_row"])
    out = out.withColumn("n_lines", F.size(_lines(F.col("text"))).cast("long"))
    edges = F.concat(F.array(F.lit(-1)), F.coalesce(names["dropped"], F.array().cast("array<int>")), F.array(F.col("n_lines").cast("int")))
    runs = F.zip_with(F.slice(edges, 1, F.size(edges) - 1), F.slice(edges, 2, F.size(edges) - 1), lambda a, b: F.struct((a + 1).alias("first"), (b - a - 1).alias("n")))
    out = out.withColumn("keep_runs", F.filter(runs, lambda r: r["n"] > 0))
    kept = F.array_join(F.flatten(F.transform("keep_runs", lambda r: F.slice(_lines(F.col("text")), r["first"] + 1, r["n"]))), "\n")
    out = out.withColumn("kept_text", F.when(F.col(names["dropped"]).isNull(), F.coalesce("text", F.lit(""))).otherwise(kept))
    return out.withColumn("n_dropped", F.coalesce(F.size(names["dropped"]), F.lit(0)).cast("long")).drop(names["dropped"])
