"""Structured Streaming: the same transformations on streams, with watermarks on event time."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import epoch_micros


def event_stream(spark: SparkSession, path: str, schema: T.StructType, source: str = "parquet", **options: str) -> DataFrame:
    """A stream of events from files or, with source="kafka", from topics whose values are JSON."""
    if source == "kafka":
        raw = spark.readStream.format("kafka").option("subscribe", path).options(**options).load()
        return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("e")).select("e.*")
    return spark.readStream.schema(schema).format(source).options(**options).load(path)


def timed(events: DataFrame, lateness: str, time: str = "ts") -> DataFrame:
    """Event time as TIMESTAMP, with a watermark."""
    us = epoch_micros(F.col(time)) if dict(events.dtypes)[time] == "timestamp_ntz" else F.unix_micros(time)
    return events.withColumn("us", us).withColumn(time, F.timestamp_micros(us)).withWatermark(time, lateness)


def metric_stream(events: DataFrame, keys: Sequence[str], short: str = "10 seconds", period: str = "5 minutes") -> DataFrame:
    """Counts of short windows, summed into periods, in append mode."""
    partial = events.groupBy(F.window("ts", short).alias("w"), *keys).agg(F.count("*").alias("count"))
    total = partial.groupBy(F.window("w", period).alias("w"), *keys).agg(F.sum("count").alias("count"))
    return total.select(F.unix_millis("w.start").alias("start"), *keys, "count")


def session_stream(events: DataFrame, ttl_millis: int, key: str = "si") -> DataFrame:
    gap = f"{ttl_millis * 1000 - 1} microseconds"
    found = events.groupBy(key, F.session_window("ts", gap).alias("w")).agg(F.min("us").alias("lo"), F.max("us").alias("hi"), F.count("*").alias("snec"))
    return found.select(key, F.expr("lo div 1000").alias("snst_ms"), F.expr("hi div 1000").alias("snet_ms"), "snec")


def session_processor(ttl_millis: int, max_active_millis: int):
    """A state function for applyInPandasWithState with a longest active time; state: start, last and number of events."""

    def run(key, batches, state):
        import pandas as pd

        done = []
        current = list(state.get) if state.exists else None
        if state.hasTimedOut:
            done.append(tuple(current))
            current = None
            state.remove()
        else:
            rows = pd.concat(list(batches)).sort_values(["us", "event_id"])
            for us in rows["us"].tolist():
                if current is None or us >= current[1] + ttl_millis * 1000 or us > current[0] + max_active_millis * 1000:
                    if current is not None:
                        done.append(tuple(current))
                    current = [us, us, 1]
                else:
                    current = [current[0], us, current[2] + 1]
            state.update(tuple(current))
            state.setTimeoutTimestamp(max(current[1] // 1000 + ttl_millis, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame([(key[0], s // 1000, e // 1000, n) for s, e, n in done], columns=["si", "snst_ms", "snet_ms", "snec"])

    return run


def bounded_session_stream(events: DataFrame, ttl_millis: int, max_active_millis: int, key: str = "si") -> DataFrame:
    """Sessions with a longest active time, ended by arrival or by an event-time timer."""
    return events.groupBy(key).applyInPandasWithState(session_processor(ttl_millis, max_active_millis), f"{key} string, snst_ms long, snet_ms long, snec long", "st long, en long, n long", "append", "EventTimeTimeout")


def drained(stream: DataFrame, name: str, checkpoint: str) -> DataFrame:
    """Run a stream over all that is there now and return what it put out: files beside the checkpoint, written by the
    executors, so the driver holds none of it. A run that goes on from the checkpoint adds to them."""
    found = f"{checkpoint}-out"
    query = stream.writeStream.outputMode("append").format("parquet").queryName(name).option("path", found).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(found)


def to_store(stream: DataFrame, merge: Callable[[DataFrame, int], object], checkpoint: str):
    """Merge each micro-batch into a table."""
    return stream.writeStream.foreachBatch(lambda batch, batch_id: merge(batch, batch_id) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
