"""Windowed metrics: counts by any key in tumbling windows, roll-ups, thresholds, top lists, audits."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import day_at_offset, floor_millis, split_literal


@dataclass(frozen=True)
class MetricSpec:
    """A metric: what it counts, by which keys (the first is the group, others are tags), and for how long a window."""

    name: str
    source: str = "events"
    keys: tuple[str, ...] = ()
    minutes: int = 5
    top_n: int | None = None
    threshold: int = 0


# The names of the metrics, what they count and by which keys.
METRICS = [
    MetricSpec("pageviews"),
    MetricSpec("visitors", "session_ends"),
    MetricSpec("pgspercn", "events", ("country",)),
    MetricSpec("pgsperbf", "events", ("browser",)),
    MetricSpec("pgsperos", "events", ("os",)),
    MetricSpec("vistspercn", "session_ends", ("country",)),
    MetricSpec("vistsperbf", "session_ends", ("browser",)),
    MetricSpec("vistsperos", "session_ends", ("os",)),
    MetricSpec("pgspercnandcity", "events", ("country", "city")),
    MetricSpec("pgspercnandbf", "events", ("country", "browser")),
    MetricSpec("pgspercnandos", "events", ("country", "os")),
    MetricSpec("vistspercnandcity", "session_ends", ("country", "city")),
    MetricSpec("vistspercnandbf", "session_ends", ("country", "browser")),
    MetricSpec("vistspercnandos", "session_ends", ("country", "os")),
    MetricSpec("pageviewspergeoanddevice", "events", ("country", "continent", "city", "device", "os", "browser"), 10, threshold=1),
    MetricSpec("viperitm", "events", ("item",), 1, top_n=100),
]
#: Minutes after which a metric can be flushed.
PERIODS = (1, 5, 10, 30)
BY_NAME = {m.name: m for m in METRICS}


def live_counts(events: DataFrame, keys: Sequence[str] = (), length: str = "10 seconds") -> DataFrame:
    """Rows (start, end, keys, count), one for each window and key that has events; times in epoch milliseconds."""
    rows = events.dropna(subset=list(keys)) if keys else events
    counted = rows.groupBy(F.window("ts", length).alias("w"), *keys).agg(F.count("*").alias("count"))
    return counted.select(F.unix_millis("w.start").alias("start"), F.unix_millis("w.end").alias("end"), *keys, "count")


def zero_filled(counts: DataFrame, length_millis: int) -> DataFrame:
    """Ungrouped counts (start, count) with a 0 for each empty window between the first and the last."""
    ends = counts.agg(F.min("start").alias("lo"), F.max("start").alias("hi")).filter("lo IS NOT NULL")
    starts = ends.select(F.explode(F.sequence("lo", "hi", F.lit(length_millis).cast("long"))).alias("start"))
    return starts.join(counts, "start", "left").select("start", F.coalesce("count", F.lit(0)).alias("count"))


def roll_up(partials: DataFrame, keys: Sequence[str], length_millis: int) -> DataFrame:
    """Sum counts of short windows into longer ones; windows are aligned, so no count is divided."""
    start = floor_millis(F.col("start"), length_millis)
    return partials.groupBy(start.alias("start"), *keys).agg(F.sum("count").alias("count"))


def metric(events: DataFrame, spec: MetricSpec) -> DataFrame:
    """Rows (metricname, groupid, metrictime, tags, value): counts over the metric's period, strictly above its threshold.

    Counting the period directly equals summing 10-second counts and takes one shuffle instead of two.
    """
    counted = live_counts(events, spec.keys, f"{spec.minutes} minutes").filter(F.col("count") > spec.threshold)
    if spec.keys:
        counted = counted.filter(F.trim(spec.keys[0]) != "")
    if spec.top_n:
        counted = top_n(counted, ["start"], F.col("count"), list(spec.keys), spec.top_n)
    group = F.col(spec.keys[0]) if spec.keys else F.lit(spec.name)
    tags = [F.col(k).alias("tag_value" if len(spec.keys) == 2 else f"tag_{k}") for k in spec.keys[1:]]
    return counted.select(F.lit(spec.name).alias("metricname"), group.alias("groupid"), F.col("end").alias("metrictime"), *tags, F.col("count").alias("value"))


def all_metrics(events: DataFrame, specs: Sequence[MetricSpec]) -> DataFrame:
    """Many metrics of up to two keys and one period in a single scan and shuffle: each event counts once for each."""
    assert len({s.minutes for s in specs}) == 1 and all(len(s.keys) < 3 and not s.top_n for s in specs)
    key = lambda s, i: F.col(s.keys[i]) if len(s.keys) > i else F.lit(None).cast("string")
    entries = F.array(*(F.when(F.lit(True) if not s.keys else F.concat(*(F.col(k).isNotNull().cast("string") for k in s.keys)).rlike("^(true)+$"), F.struct(F.lit(s.name).alias("metricname"), key(s, 0).alias("k0"), key(s, 1).alias("tag_value"))) for s in specs))
    rows = events.select("ts", F.explode(F.array_compact(entries)).alias("m"))
    counted = rows.groupBy(F.window("ts", f"{specs[0].minutes} minutes").alias("w"), "m.metricname", "m.k0", "m.tag_value").agg(F.count("*").alias("value"))
    named = counted.select("metricname", F.coalesce("k0", "metricname").alias("groupid"), F.unix_millis("w.end").alias("metrictime"), "tag_value", "value")
    return named.filter(F.trim("groupid") != "")


def top_n(rows: DataFrame, groups: Sequence[str], value: Column, ties: Sequence[str], n: int) -> DataFrame:
    """The n largest of each group, ties broken by the keys; a group limit is pushed below the sort by Spark."""
    order = Window.partitionBy(*groups).orderBy(value.desc(), *(F.col(t) for t in ties))
    return rows.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= n).drop("_n")


def top_tokens(rows: DataFrame, column: str, separator: str, k: int) -> DataFrame:
    """Exactly the k most frequent tokens of a separated column, empty tokens included; ties by token."""
    counted = rows.select(F.explode(split_literal(F.col(column), separator)).alias("item")).groupBy("item").agg(F.count("*").alias("count"))
    return counted.orderBy(F.desc("count"), "item").limit(k)


def approximate_top_tokens(rows: DataFrame, column: str, separator: str, k: int, capacity: int) -> DataFrame:
    """The same by a frequent-items sketch of bounded size."""
    tokens = rows.select(F.explode(split_literal(F.col(column), separator)).alias("item"))
    return tokens.agg(F.expr(f"approx_top_k(item, {k}, {capacity})").alias("top")).select(F.explode("top").alias("t")).select("t.item", "t.count")


def merge_top(tops: DataFrame, n: int, map_column: str = "top") -> DataFrame:
    """Merge top lists, arrays of (item, count), by adding the counts."""
    rows = tops.select(F.explode(map_column).alias("t")).select("t.item", "t.count")
    return rows.groupBy("item").agg(F.sum("count").alias("count")).orderBy(F.desc("count"), "item").limit(n)


def average_counter(rows: DataFrame, keys: Sequence[str], total: str, count: str) -> DataFrame:
    """Integer average of what was added over how often; 0 where nothing was."""
    sums = rows.groupBy(*keys).agg(F.sum(total).alias("_t"), F.sum(count).alias("_n"))
    return sums.select(*keys, F.when(F.col("_n") == 0, F.lit(0)).otherwise(F.expr("_t div _n")).alias("value"))


def multi_counters(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Each named column summed into a row of its own."""
    sums = rows.agg(*(F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in names))
    return sums.unpivot([], list(names), "metricname", "value")


def counter_names(columns: Sequence[str]) -> list[str]:
    """The columns of an event that are counters: those whose name contains "count"."""
    return [c for c in columns if "count" in c]


def second_level(counts: DataFrame, keys: Sequence[str], length_millis: int, top: int | None = None) -> DataFrame:
    """Rows (context_id, keys, value): live counts summed once more in windows of their own, all or only the largest."""
    start = floor_millis(F.col("start"), length_millis)
    rows = counts.groupBy(start.alias("context_id"), *keys).agg(F.sum("count").alias("value"))
    return top_n(rows, ["context_id"], F.col("value"), list(keys), top) if top else rows


def windowed_tokens(rows: DataFrame, column: str, separator: str, length: str, k: int) -> DataFrame:
    """Rows (start, item, count): in each window the k most frequent tokens of a separated column, empty ones included."""
    tokens = rows.select("ts", F.explode(split_literal(F.col(column), separator)).alias("item"))
    return top_n(live_counts(tokens, ["item"], length), ["start"], F.col("count"), ["item"], k).select("start", "item", "count")


def audit_deltas(events: DataFrame, name: str, now_millis: Column, offset_hours: int = -7, keep_millis: int = 86_400_000) -> DataFrame:
    """The hourly audit as it is flushed: for each minute what it adds to its hour, of the last ``keep_millis``."""
    minute, hour = floor_millis(F.col("ct"), 60_000), floor_millis(F.col("ct"), 3_600_000)
    recent = events.filter(hour >= now_millis - keep_millis)
    return recent.groupBy(F.lit(name).alias("metricname"), day_at_offset(hour, offset_hours).alias("groupid"), hour.alias("metrictime"), minute.alias("flushed")).agg(F.count("*").alias("delta"))


def delta_counter(marks: DataFrame, keys: Sequence[str], order: str, value: str, threshold: int = 0) -> DataFrame:
    """The growth of a running total since the mark before, where it is above the threshold; less is lost, not carried."""
    before = F.lag(value, 1, 0).over(Window.partitionBy(*keys).orderBy(order))
    return marks.withColumn("delta", F.col(value) - before).filter(F.col("delta") > threshold)


def hourly_audit(events: DataFrame, name: str, offset_hours: int = -7) -> DataFrame:
    """Rows (metricname, groupid, metrictime, value): events by day (at a fixed offset from UTC) and hour."""
    hour = floor_millis(F.col("ct"), 3_600_000)
    return events.groupBy(F.lit(name).alias("metricname"), day_at_offset(hour, offset_hours).alias("groupid"), hour.alias("metrictime")).agg(F.count("*").alias("value"))


def last_batches(batches: DataFrame, kind: str, order: str, n: int) -> DataFrame:
    """The last n batches of each kind."""
    newest = Window.partitionBy(kind).orderBy(F.desc(order))
    return batches.withColumn("_n", F.row_number().over(newest)).filter(F.col("_n") <= n).drop("_n")


def column_counters(events: DataFrame, statement: str, column: str | None = None) -> DataFrame:
    """How many rows a statement produced, in all or for each value of a column."""
    keys = [F.lit(statement).alias("statement")] + ([F.col(column)] if column else [])
    return events.groupBy(*keys).agg(F.count("*").alias("count"))
