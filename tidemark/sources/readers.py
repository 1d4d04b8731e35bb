"""Sources: event tables, JSON bodies, message topics, tweets, metric tables, and a load generator."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import TWEET


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def json_bodies(spark: SparkSession, path: str) -> DataFrame:
    """One request body a line, to be parsed and validated by ingest."""
    return spark.read.text(path).withColumnRenamed("value", "body")


def json_events(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Events from JSON lines; a line that can't be parsed is kept in _corrupt_record."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])).option("mode", "PERMISSIVE").json(path)


def topic(spark: SparkSession, servers: str, topics: Sequence[str], streaming: bool = False, per_trigger: int | None = None) -> DataFrame:
    """Messages of topics. Offsets are kept by the query's checkpoint; per_trigger limits the rate of a replay."""
    reader = (spark.readStream if streaming else spark.read).format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", ",".join(topics))
    return (reader.option("maxOffsetsPerTrigger", per_trigger) if per_trigger else reader).load()


def tweets(spark: SparkSession, path: str) -> DataFrame:
    """Tweets as JSON lines: country, lang, user, hashtags joined by commas, time, text."""
    return spark.read.schema(TWEET).json(path)


def volume(second: float, base: int = 2, peak: float = 30, hour_weight: float = 1.0) -> float:
    """Events that the generator makes in a second: a sine over two minutes, weighted by the hour."""
    return base + base * (peak - 1) * math.sin(second * math.pi / 60) * hour_weight


def templated(rows: DataFrame, users: int, seed: int) -> DataFrame:
    """An event's attributes for each ``id``, from templates; the same for the same seed."""
    pick = lambda values, k: F.element_at(F.array(*map(F.lit, values)), (F.pmod(F.xxhash64("id", F.lit(seed + k)), F.lit(len(values))) + 1).cast("int"))
    return rows.select(
        "*",
        F.concat(F.lit("user-"), F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(users)).cast("string")).alias("si"),
        pick(["view", "click", "purchase", "Mobile"], 2).alias("et"),
        pick(["10.0.0.7", "10.1.2.3", "172.16.5.5", "192.168.1.9"], 3).alias("ipv4"),
        pick(["Mozilla/5.0 (Windows NT 10.0) Chrome/120.0", "Mozilla/5.0 (iPhone; CPU iPhone OS 17_1 like Mac OS X) Version/17.1 Mobile Safari/604.1", "Mozilla/5.0 (X11; Linux x86_64) Firefox/121.0"], 4).alias("ua"),
        pick([f"item{i}" for i in range(30)], 5).alias("itmT"),
    )


def generated(spark: SparkSession, n: int, users: int = 100, seed: int = 42, start_millis: int = 1_704_067_200_000) -> DataFrame:
    """``n`` events, some ten a second; the same for the same seed."""
    ct = F.lit(start_millis) + F.col("id") * 100 + F.pmod(F.xxhash64("id", F.lit(seed + 1)), F.lit(100))
    return templated(spark.range(n), users, seed).select("si", ct.alias("ct"), "et", "ipv4", "ua", "itmT")


def load(spark: SparkSession, first_second: int, seconds: int, start_millis: int = 1_704_067_200_000, **volumes: float) -> DataFrame:
    """Generated events, as many in each second as ``volume`` says, their times in that second."""
    counts = [(s, int(volume(s, **volumes))) for s in range(first_second, first_second + seconds)]  # a row for each second
    table = spark.createDataFrame([c for c in counts if c[1] > 0], "second long, n long")
    places = table.select("second", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("nth"), "n")
    numbered = places.withColumn("id", F.col("second") * 1_000_000 + F.col("nth"))
    made = templated(numbered, 100, 42)
    return made.withColumn("ct", F.lit(start_millis) + F.col("second") * 1000 + F.expr("nth * 1000 div n")).drop("second", "nth", "n", "id")


def multiplied(rows: DataFrame, factor: int, name: str = "metricname") -> DataFrame:
    """Each metric ``factor`` times, its name followed by the round: a load for the store."""
    return rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(factor))).alias("_round")).withColumn(name, F.concat(name, F.col("_round").cast("string"))).drop("_round")
