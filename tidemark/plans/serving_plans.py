"""Queries on metric tables, and streams."""

from dataclasses import replace

from pyspark.sql import functions as F

from tidemark.operators import metrics, store
from tidemark.plans.base import events, query, raw
from tidemark.plans.metric_query import MetricQuery, as_json, totals, trend, with_tags
from tidemark.sources.readers import multiplied
from tidemark.sources.shared import shared_folder
from tidemark.streaming import pipelines

_T = 1_704_067_200_000 + 3 * 86_400_000


def _group(spark, d):
    """Visits by country in five minutes, as a stored group metric."""
    return metrics.metric(events(spark, d), metrics.BY_NAME["pgspercn"])


def _tagged(spark, d):
    return metrics.metric(events(spark, d), metrics.BY_NAME["pgspercnandbf"])


def _top(spark, d):
    return metrics.metric(events(spark, d), metrics.BY_NAME["viperitm"])


_END5 = "us // 300000000 * 300000 + 300000"
_GROUP = f", m AS (SELECT 'pgspercn' AS metricname, country AS groupid, {_END5} AS metrictime, count(*) AS value FROM ex WHERE country IS NOT NULL GROUP BY ALL) "
_TAGGED = f", m AS (SELECT 'pgspercnandbf' AS metricname, country AS groupid, {_END5} AS metrictime, browser AS tag_value, count(*) AS value FROM ex WHERE country IS NOT NULL GROUP BY ALL) "
_TOPS = ", m AS (SELECT 'viperitm' AS metricname, item AS groupid, us // 60000000 * 60000 + 60000 AS metrictime, count(*) AS value FROM ex GROUP BY ALL) "
_COUNTS = ", m AS (SELECT 'events' AS metricname, strftime(make_timestamp(us // 3600000000 * 3600000000 - 25200000000), '%Y-%m-%d') AS groupid, us // 3600000000 * 3600000 AS metrictime, count(*) AS value FROM raw GROUP BY ALL) "


@query("store_upsert_last_wins", ", m AS (SELECT et AS metricname, 'g' || CAST(k % 10 AS VARCHAR) AS groupid, ct AS metrictime, event_id AS value FROM raw) SELECT metricname, groupid, max(metrictime) AS metrictime, arg_max(value, metrictime * 1000000 + value) AS value FROM m GROUP BY metricname, groupid")
def store_upsert_last_wins(spark, d):
    rows = raw(spark, d).select(F.col("et").alias("metricname"), F.concat(F.lit("g"), (F.col("k") % 10).cast("string")).alias("groupid"), F.col("ct").alias("metrictime"), F.col("event_id").alias("value"))
    old, new = rows.filter("value % 2 = 0"), rows.filter("value % 2 = 1")
    return store.upserted(old, new, ["metricname", "groupid"], "metrictime")


@query("store_counter_merge", "SELECT et AS metricname, us // 3600000000 AS hour, count(*) AS value FROM raw GROUP BY ALL")
def store_counter_merge(spark, d):
    hourly = raw(spark, d).groupBy(F.col("et").alias("metricname"), F.expr("us div 3600000000").alias("hour"), (F.col("event_id") % 3).alias("batch")).agg(F.count("*").alias("value"))
    table, batch = (hourly.filter(c).drop("batch").groupBy("metricname", "hour").agg(F.sum("value").alias("value")) for c in ("batch = 0", "batch > 0"))
    return store.counted(table, batch, ["metricname", "hour"])


@query("store_ttl", _GROUP + f"SELECT * FROM m WHERE metrictime >= {_T} - 86400000")
def store_ttl(spark, d):
    return store.kept(_group(spark, d), F.lit(_T))


@query("store_multiplied", _GROUP + "SELECT metricname || CAST(i AS VARCHAR) AS metricname, groupid, metrictime, value FROM m, (VALUES (1), (2), (3)) AS t(i)")
def store_multiplied(spark, d):
    return multiplied(_group(spark, d), 3)


_COUNTRY = "NATION_10"
_RANGE = f"metrictime >= {_T} AND metrictime < {_T + 86_400_000}"
#: A time that the table has: the latest of the country.
_LAST = f"(SELECT max(metrictime) FROM m WHERE groupid = '{_COUNTRY}')"


def _ask(name: str, table, tables_sql: str, q: MetricQuery, condition: str, tail: str = "", last_of: str | None = None) -> None:
    def run(spark, d):
        rows = table(spark, d)
        if last_of is None:
            return q.run(rows)
        at = rows.filter(F.col("groupid") == last_of) if last_of else rows
        return replace(q, time=at.agg(F.max("metrictime")).first()[0]).run(rows)

    query(name, f"{tables_sql}SELECT * FROM m WHERE {condition}{tail}")(run)


_ask("q_group_all", _group, _GROUP, MetricQuery("group"), "true")
_ask("q_group_by_name", _group, _GROUP, MetricQuery("group", "pgspercn"), "metricname = 'pgspercn'")
_ask("q_group_range", _group, _GROUP, MetricQuery.from_parameters("group", {"metricName": "pgspercn", "startTime": str(_T + 59_999), "ENDTIME": str(_T + 86_400_001)}), f"metricname = 'pgspercn' AND {_RANGE}")
_ask("q_group_exact", _group, _GROUP, MetricQuery("group", "pgspercn"), f"metrictime = {_LAST}", last_of=_COUNTRY)
_ask("q_group_triple", _group, _GROUP, MetricQuery("group", "pgspercn", _COUNTRY, start=0, end=1), f"groupid = '{_COUNTRY}' AND metrictime = {_LAST}", last_of=_COUNTRY)
_ask("q_country_group_all", _tagged, _TAGGED, MetricQuery("country_group"), "true")
_ask("q_country_group", _tagged, _TAGGED, MetricQuery("country_group", "pgspercnandbf", _COUNTRY), f"groupid = '{_COUNTRY}'")
_ask("q_country_group_range", _tagged, _TAGGED, MetricQuery("country_group", "pgspercnandbf", _COUNTRY, start=_T, end=_T + 10 * 86_400_000), f"groupid = '{_COUNTRY}' AND metrictime >= {_T} AND metrictime < {_T + 10 * 86_400_000}")
_ask("q_country_group_exact", _tagged, _TAGGED, MetricQuery("country_group", "pgspercnandbf", _COUNTRY), f"groupid = '{_COUNTRY}' AND metrictime = {_LAST}", last_of=_COUNTRY)
_ask("q_topgroup_limit", _top, _TOPS, MetricQuery("top_group", "viperitm", limit=25), "metricname = 'viperitm'", " ORDER BY metrictime, value DESC, groupid LIMIT 25")
_ask("q_topgroup_range", _top, _TOPS, MetricQuery("top_group", "viperitm", start=_T, end=_T + 86_400_000), _RANGE, " ORDER BY metrictime, value DESC, groupid LIMIT 10")
_ask("q_topgroup_exact", _top, _TOPS, MetricQuery("top_group", "viperitm"), "metrictime = (SELECT max(metrictime) FROM m)", " ORDER BY metrictime, value DESC, groupid LIMIT 10", last_of="")
_ask("q_counters", lambda spark, d: metrics.hourly_audit(raw(spark, d), "events"), _COUNTS, MetricQuery("counters", "events", "2024-01-03"), "groupid = '2024-01-03'")


# Which condition holds when several could: name, group and time before a range, a range before a time.
_ask("q_precedence_range", _group, _GROUP, MetricQuery("group", "pgspercn", time=_T, start=_T, end=_T + 86_400_000), f"metricname = 'pgspercn' AND {_RANGE}")
_ask("q_precedence_country", _tagged, _TAGGED, MetricQuery("country_group", "pgspercnandbf", _COUNTRY, time=_T, start=_T, end=_T + 10 * 86_400_000), f"groupid = '{_COUNTRY}' AND metrictime >= {_T} AND metrictime < {_T + 10 * 86_400_000}")


@query("q_tags_folded", _TAGGED + "SELECT metricname, groupid, metrictime, value, tag_value AS tag FROM m")
def q_tags_folded(spark, d):
    return with_tags(_tagged(spark, d)).select("metricname", "groupid", "metrictime", "value", F.col("tags")["tag_value"].alias("tag"))


@query("q_json", _GROUP + "SELECT '{\"metricname\":\"' || metricname || '\",\"groupid\":\"' || groupid || '\",\"metrictime\":' || metrictime || ',\"value\":' || value || '}' AS json FROM m")
def q_json(spark, d):
    return as_json(_group(spark, d))


@query("rollup_reduce_sum", _TAGGED + "SELECT tag_value, CAST(sum(value) AS BIGINT) AS value FROM m GROUP BY tag_value")
def rollup_reduce_sum(spark, d):
    return totals(_tagged(spark, d), "tag_value")


@query("country_trend", _GROUP + f"SELECT * FROM m WHERE groupid = '{_COUNTRY}'")
def country_trend(spark, d):
    return trend(_group(spark, d), _COUNTRY)


_FAR = 4_102_444_800_000_000


def _streamed(spark, rows, name, build):
    """Run a stream over the rows and a far-off sentinel that closes every window; its own output is left out. The lateness
    spans the table, so no row is late in whatever order its files are read."""
    folder = shared_folder(spark, "stream")
    rows.write.parquet(f"{folder}/in/part=0")
    far = spark.createDataFrame([(-1, _FAR, "sentinel")], "event_id long, us long, si string").withColumn("ts", F.timestamp_micros("us"))
    far.write.parquet(f"{folder}/in/part=1")
    low, high = rows.agg(F.min("us"), F.max("us")).first()
    lateness = f"{((high or 0) - (low or 0)) // 1_000_000 + 600} seconds"
    stream = pipelines.event_stream(spark, f"{folder}/in/*", rows.schema, maxFilesPerTrigger="1000").withWatermark("ts", lateness)
    return pipelines.drained(build(stream), name, f"{folder}/checkpoint")


@query("stream_pageviews", "SELECT us // 300000000 * 300000 AS start, country, count(*) AS count FROM ex GROUP BY ALL")
def stream_pageviews(spark, d):
    out = _streamed(spark, events(spark, d).select("event_id", "us", "ts", "si", "et", "country"), "stream_pageviews_out", lambda s: pipelines.metric_stream(s, ["country"]))
    return out.filter(F.col("start") < _FAR // 1000 - 86_400_000)


@query("stream_sessions", """, f AS (SELECT *, CASE WHEN lag(us) OVER w IS NULL OR us >= lag(us) OVER w + 1800000000 THEN 1 ELSE 0 END AS f FROM raw WINDOW w AS (PARTITION BY si ORDER BY us, event_id)),
s AS (SELECT *, sum(f) OVER (PARTITION BY si ORDER BY us, event_id) AS no FROM f)
SELECT si, min(us) // 1000 AS snst_ms, max(us) // 1000 AS snet_ms, count(*) AS snec FROM s GROUP BY si, no""")
def stream_sessions(spark, d):
    out = _streamed(spark, raw(spark, d).select("event_id", "us", "ts", "si", "et"), "stream_sessions_out", lambda s: pipelines.session_stream(s, 1_800_000))
    return out.filter("si <> 'sentinel'")


@query("store_micro_batches", ", m AS (SELECT et AS metricname, us // 3600000000 * 3600000 AS metrictime, event_id % 3 AS b, max(event_id) AS value FROM raw GROUP BY ALL) SELECT metricname, metrictime, arg_max(value, b) AS value FROM m GROUP BY ALL")
def store_micro_batches(spark, d):
    """Three micro-batches merged into a stored table, the second one twice: the last write of a key wins."""
    kept = store.MetricStore(spark, shared_folder(spark, "store"))
    for batch_id in (0, 1, 1, 2):
        rows = raw(spark, d).filter(F.col("event_id") % 3 == batch_id)
        batch = rows.groupBy(F.col("et").alias("metricname"), F.expr("us div 3600000000 * 3600000").alias("metrictime")).agg(F.max("event_id").alias("value"))
        kept.merge("events", batch, batch_id, ["metricname", "metrictime"])
    return kept.read("events")


@query("store_stream", "SELECT et AS metricname, us // 86400000000 * 86400000 AS metrictime, count(*) AS value FROM raw GROUP BY ALL")
def store_stream(spark, d):
    """A stream whose micro-batches are merged into stored counters."""
    folder = shared_folder(spark, "store-stream")
    rows = raw(spark, d).select("event_id", "us", "et")
    rows.repartitionByRange(3, "event_id").write.parquet(f"{folder}/in")
    stream = pipelines.event_stream(spark, f"{folder}/in", rows.schema, maxFilesPerTrigger="1")
    kept = store.MetricStore(spark, f"{folder}/tables")

    def merge(batch, batch_id):
        counts = batch.groupBy(F.col("et").alias("metricname"), F.expr("us div 86400000000 * 86400000").alias("metrictime")).agg(F.count("*").alias("value"))
        kept.merge("counters", counts, batch_id, ["metricname", "metrictime"], additive=True)

    pipelines.to_store(stream, merge, f"{folder}/checkpoint").awaitTermination()
    return kept.read("counters")
