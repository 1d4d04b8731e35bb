"""Routing: filters, renames, derived feeds, delivery to sinks, and what becomes of failed events."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The columns of the session feed and of the event feed, by their names in the events.
SESSION_FEED = {
    "ts": "trafficsource",
    "t": "site",
    "_cty": "city",
    "_rgn": "region",
    "_cn": "country",
    "_con": "continent",
    "_dd_bf": "browserfamily",
    "_dd_bv": "browserversion",
    "dd_df": "devicefamily",
    "_dd_dc": "deviceclass",
    "_dd_os": "osfamily",
    "_dd_osv": "osversion",
    "_snec": "_snec",
    "_sndn": "_sndn",
    "_snet": "_snet",
}
EVENT_FEED = {
    "si": "guid",
    "_cty": "city",
    "_rgn": "region",
    "_cn": "country",
    "_con": "continent",
    "_dd_bf": "browserfamily",
    "_dd_bv": "browserversion",
    "dd_df": "devicefamily",
    "_dd_dc": "deviceclass",
    "_dd_os": "osfamily",
    "_dd_osv": "osversion",
    "_dwell": "dwell",
    "ts": "trafficsource",
    "t": "site",
    **{c: c for c in ("tn", "ipv4", "itmP", "cap", "rf", "js_ev_mak", "itmT", "capG", "_lon", "_lat", "_tlcn", "url", "capQ", "ac", "ua", "et", "ct")},
}
EVENT_FEED_TENANT = "MP"


def where_equal(events: DataFrame, column: str, value: object) -> DataFrame:
    return events.filter(F.col(column) == F.lit(value))


def where_present(events: DataFrame, *columns: str) -> DataFrame:
    return events.dropna(subset=list(columns))


def split_by_presence(events: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Events that have the column, and those that don't."""
    return events.filter(F.col(column).isNotNull()), events.filter(F.col(column).isNull())


def renamed(events: DataFrame, names: Mapping[str, str], literals: Mapping[str, object] | None = None) -> DataFrame:
    """Exactly the named columns under their new names, and constant columns."""
    return events.select(*(F.lit(v).alias(k) for k, v in (literals or {}).items()), *(F.col(a).alias(b) for a, b in names.items()))


def session_feed(events: DataFrame) -> DataFrame:
    return renamed(events, SESSION_FEED)


def event_feed(events: DataFrame) -> DataFrame:
    return renamed(events, EVENT_FEED, {"tenant": EVENT_FEED_TENANT})


def as_messages(events: DataFrame, topic: str, key: Sequence[str] = ()) -> DataFrame:
    """Rows (topic, key, value) as a message sink takes them; the key's hash decides the partition."""
    return events.select(F.lit(topic).alias("topic"), (F.concat_ws("\x01", *key) if key else F.lit(None).cast("string")).alias("key"), F.to_json(F.struct("*")).alias("value"))


def with_affinity(events: DataFrame, *columns: str, partitions: int | None = None) -> DataFrame:
    """Deal events by a key, simple or composed. Needed only before stateful code outside Spark; groupBy deals by itself."""
    return events.repartition(partitions, *columns) if partitions else events.repartition(*columns)


def fan_out(feeds: Mapping[str, DataFrame], sinks: Mapping[str, Callable[[DataFrame], None]], routes: Mapping[str, Sequence[str]] | None = None) -> None:
    """Write each feed to the sinks it is routed to, by name; without a route, to all of them."""
    for name, feed in feeds.items():
        for sink in sinks if routes is None else routes.get(name, ()):
            sinks[sink](feed)


def delivering(feeds: Callable[[DataFrame], Mapping[str, DataFrame]], sinks, routes=None) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: a micro-batch is read once and its feeds go to their sinks."""

    def run(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            fan_out(feeds(kept), sinks, routes)
        finally:
            kept.unpersist()

    return run


def bypass(events: DataFrame, key: str, process) -> DataFrame:
    """Process the events that have the key; the others go on unchanged, with nulls in the columns that are added."""
    have, lack = split_by_presence(events, key)
    return process(have).unionByName(lack, allowMissingColumns=True)


def retry_topic(topic: Column) -> Column:
    return F.concat(F.lit("Replay-"), F.replace(topic, F.lit("/"), F.lit("-")))


def due_for_replay(failed: DataFrame, now_millis: Column, delay_millis: int = 60_000, keep_millis: int = 86_400_000) -> DataFrame:
    """Failed events whose delay has passed and whose first replay isn't too long ago, stamped for delivery."""
    first = F.coalesce("first_replay", now_millis)
    due = failed.filter((F.col("produced") + delay_millis <= now_millis) & (first + keep_millis >= now_millis))
    return due.withColumns({"first_replay": first, "last_replay": now_millis, "replayed": F.lit(True)}).drop("transport")


def dead_letters(events: DataFrame, problem: Column, topic: Column, produced: Column) -> tuple[DataFrame, DataFrame]:
    """Events that go on, and those with a problem as messages for their retry topic: topic, value, code, produced."""
    marked = events.withColumn("_code", problem)
    failed = marked.filter(F.col("_code").isNotNull())
    value = F.to_json(F.struct(*events.columns))
    return marked.filter(F.col("_code").isNull()).drop("_code"), failed.select(retry_topic(topic).alias("topic"), value.alias("value"), F.col("_code").alias("code"), produced.alias("produced"))


def due_batches(failed: DataFrame, batch: Sequence[str], order: Sequence[str], now_millis: Column, delay_millis: int = 60_000) -> DataFrame:
    """Failed events of the batches whose last event's delay has passed; a batch waits as a whole, and one whose last event
    has no time doesn't wait."""
    last = failed.groupBy(*batch).agg(F.max_by("produced", F.struct(*order)).alias("_last"))
    due = last.filter(F.col("_last").isNull() | (F.col("_last") + delay_millis <= now_millis)).drop("_last")
    return failed.join(due, list(batch), "left_semi")


def stop_alerts(advice: DataFrame, apart_millis: int = 300_000) -> DataFrame:
    """Of the times (``us``) at which a replay was told to stop, those that raise an alert: none less than so long after the
    one before."""
    from tidemark.operators.sessions import fold_starts

    rows = advice.withColumns({"_all": F.lit(0), "event_id": F.lit(0).cast("long")})
    return fold_starts(rows, ["_all"], None, max_active_millis=apart_millis, inclusive=True).select("us")
