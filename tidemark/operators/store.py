"""Metric tables: upserts, counters, retention. A micro-batch is merged at most once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_MILLIS = 86_400_000


def upserted(table: DataFrame, batch: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The last write of each key, by ``order``; aggregated before the shuffle, so a hot key is no problem."""
    values = [c for c in table.columns if c not in keys]
    both = table.unionByName(batch)
    latest = both.groupBy(*keys).agg(F.max(F.struct(order, *(v for v in values if v != order))).alias("l"))
    return latest.select(*keys, *(F.col(f"l.{v}").alias(v) for v in values))


def counted(table: DataFrame, batch: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Counters of each key, grown by those of the batch."""
    return table.unionByName(batch).groupBy(*keys).agg(F.sum(value).alias(value))


def kept(table: DataFrame, now_millis: Column, keep_millis: int = DAY_MILLIS, time: str = "metrictime") -> DataFrame:
    return table.filter(F.col(time) >= now_millis - keep_millis)


class MetricStore:
    """Parquet tables under a folder, a directory for each day, in it a version for each micro-batch that touched the day.

    A batch is merged at most once: its name among the committed ones is written last, and versions of batches that aren't
    committed are never read. Only the days that a batch touches are written anew; of each, the last two versions stay."""

    def __init__(self, spark, folder: str, time: str = "metrictime"):
        self.spark, self.folder, self.time = spark, folder.rstrip("/"), time

    def _at(self, *parts: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *parts]))
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _names(self, *parts: str) -> list[str]:
        fs, path = self._at(*parts)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def _committed(self, name: str) -> set[int]:
        return {int(x) for x in self._names(name, "batches")}

    def _versions(self, name: str, day: str, committed: set[int]) -> list[int]:
        return sorted(v for v in (int(x[1:]) for x in self._names(name, "days", day)) if v in committed)

    def read(self, name: str, days: Sequence[str] | None = None) -> DataFrame | None:
        """The table, or only some of its days."""
        committed = self._committed(name)
        found = [(d, self._versions(name, d, committed)) for d in (self._names(name, "days") if days is None else days)]
        paths = [f"{self.folder}/{name}/days/{d}/v{v[-1]}" for d, v in found if v]
        return self.spark.read.parquet(*paths) if paths else None

    def merge(self, name: str, batch: DataFrame, batch_id: int, keys: Sequence[str], additive: bool = False, order: str | None = None) -> bool:
        """Merge a micro-batch; False if it was merged already. For foreachBatch. What a batch writes replaces what was there,
        and within a batch the last by ``order``."""
        if batch_id in self._committed(name):
            return False
        day = F.floor(F.col(self.time) / DAY_MILLIS).cast("long")
        batch = batch.persist()
        try:
            for (d,) in batch.select(day).distinct().collect():  # as many as the batch has days, not rows
                part, old = batch.filter(day == d), self.read(name, [str(d)])
                old = part.limit(0) if old is None else old
                merged = counted(old, part, keys) if additive else self._replaced(old, part, keys, order)
                merged.write.mode("overwrite").parquet(f"{self.folder}/{name}/days/{d}/v{batch_id}")
        finally:
            batch.unpersist()
        fs, path = self._at(name, "batches", str(batch_id))
        fs.create(path, True).close()
        self._clean(name)
        return True

    def _replaced(self, old: DataFrame, part: DataFrame, keys: Sequence[str], order: str | None) -> DataFrame:
        stamp = F.struct(F.lit(1).alias("late"), F.col(order or self.time).alias("at"))
        rows = upserted(old.withColumn("_at", F.struct(F.lit(0).alias("late"), F.col(order or self.time).alias("at"))), part.withColumn("_at", stamp), keys, "_at")
        return rows.drop("_at").select(part.columns)

    def _clean(self, name: str) -> None:
        committed = self._committed(name)
        for d in self._names(name, "days"):
            for v in self._versions(name, d, committed)[:-2]:
                fs, path = self._at(name, "days", d, f"v{v}")
                fs.delete(path, True)

    def expire(self, name: str, before_millis: int) -> None:
        """Delete the days that end before a time."""
        for d in self._names(name, "days"):
            if (int(d) + 1) * DAY_MILLIS <= before_millis:
                fs, path = self._at(name, "days", d)
                fs.delete(path, True)
