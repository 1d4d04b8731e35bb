"""Queries on windowed metrics."""

from pyspark.sql import functions as F

from tidemark.operators import metrics
from tidemark.plans.base import ENDS_SQL, ends, events, query, raw
from tidemark.sources.readers import table

_END = "us // {0} * {0} // 1000 + {0} // 1000"


def _metric_sql(spec: metrics.MetricSpec) -> tuple[str, str]:
    micros = spec.minutes * 60_000_000
    end = _END.format(micros)
    source = "ex" if spec.source == "events" else "ends"
    present = " AND ".join(f"{k} IS NOT NULL" for k in spec.keys) or "true"
    group = spec.keys[0] if spec.keys else f"'{spec.name}'"
    tags = "".join(f", {k} AS {'tag_value' if len(spec.keys) == 2 else 'tag_' + k}" for k in spec.keys[1:])
    sql = f"SELECT '{spec.name}' AS metricname, {group} AS groupid, {end} AS metrictime{tags}, count(*) AS value FROM {source} WHERE {present} GROUP BY ALL HAVING count(*) > {spec.threshold}"
    if spec.top_n:
        sql = f"SELECT * FROM ({sql}) QUALIFY row_number() OVER (PARTITION BY metrictime ORDER BY value DESC, groupid) <= {spec.top_n}"
    return (f", {ENDS_SQL} {sql}" if source == "ends" else sql), "se" if source == "ends" else "ex"


_NAMES = {"pageviews": "pageviews_5min", "visitors": "visitors_5min", "pageviewspergeoanddevice": "geo_device_threshold", "viperitm": "item_top100_1min"}
for _a, _b in (("pgs", "pgs"), ("vists", "visits")):
    _NAMES |= {f"{_a}percn": f"{_b}_per_country", f"{_a}perbf": f"{_b}_per_browser", f"{_a}peros": f"{_b}_per_os", f"{_a}percnandcity": f"{_b}_country_city", f"{_a}percnandbf": f"{_b}_country_browser", f"{_a}percnandos": f"{_b}_country_os"}


def _register(spec: metrics.MetricSpec) -> None:
    sql, tables = _metric_sql(spec)
    query(_NAMES[spec.name], sql, tables)(lambda spark, d: metrics.metric((events if spec.source == "events" else ends)(spark, d), spec))


for _spec in metrics.METRICS:
    _register(_spec)

_ALL = [s for s in metrics.METRICS if s.source == "events" and s.minutes == 5]


@query("all_metrics_5min", "\nUNION ALL ".join(f"SELECT '{s.name}' AS metricname, {s.keys[0] if s.keys else repr(s.name)} AS groupid, {_END.format(300_000_000)} AS metrictime, {s.keys[1] if len(s.keys) > 1 else 'CAST(NULL AS VARCHAR)'} AS tag_value, count(*) AS value FROM ex WHERE {' AND '.join(k + ' IS NOT NULL' for k in s.keys) or 'true'} GROUP BY ALL" for s in _ALL))
def all_metrics_5min(spark, d):
    return metrics.all_metrics(events(spark, d), _ALL)


def _start(micros: int) -> str:
    return f"us // {micros} * {micros} // 1000"


@query("pageviews_10s", f'SELECT {_start(10_000_000)} AS start, {_END.format(10_000_000)} AS "end", count(*) AS count FROM raw GROUP BY ALL')
def pageviews_10s(spark, d):
    return metrics.live_counts(raw(spark, d))


for _column, _name in (("device", "device_count_10s"), ("os", "os_count_10s"), ("browser", "browser_count_10s")):
    query(_name, f"SELECT {_start(10_000_000)} AS start, {_column}, count(*) AS count FROM ex WHERE {_column} IS NOT NULL GROUP BY ALL")(lambda spark, d, c=_column: metrics.live_counts(events(spark, d), [c]).select("start", c, "count"))


@query("pageviews_partial_final", f"SELECT {_start(300_000_000)} AS start, country, count(*) AS count FROM ex WHERE country IS NOT NULL GROUP BY ALL")
def pageviews_partial_final(spark, d):
    """10-second partial counts, summed into five minutes: the two levels of a stream."""
    return metrics.roll_up(metrics.live_counts(events(spark, d), ["country"]), ["country"], 300_000)


_TOP = "SELECT * FROM (SELECT {start} AS start, {key}, count(*) AS count FROM {source} WHERE {key} IS NOT NULL GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY start ORDER BY count DESC, {key}) <= 10"


@query("top10_country_10s", _TOP.format(start=_start(10_000_000), key="country", source="ex"))
def top10_country_10s(spark, d):
    return metrics.top_n(metrics.live_counts(events(spark, d), ["country"]), ["start"], F.col("count"), ["country"], 10).select("start", "country", "count")


@query("top10_country_1day", _TOP.format(start=_start(86_400_000_000), key="country", source="ex"))
def top10_country_1day(spark, d):
    return metrics.top_n(metrics.live_counts(events(spark, d), ["country"], "1 day"), ["start"], F.col("count"), ["country"], 10).select("start", "country", "count")


@query("top10_lang", "SELECT lang, count(*) AS count FROM documents WHERE lang IS NOT NULL GROUP BY lang ORDER BY count DESC, lang LIMIT 10", "")
def top10_lang(spark, d):
    """A tweet-like source: the documents' languages, the ten most frequent (a top-k report)."""
    counted = table(spark, d, "documents").filter("lang IS NOT NULL").groupBy("lang").agg(F.count("*").alias("count"))
    return counted.orderBy(F.desc("count"), "lang").limit(10)


def _hashtags(spark, d):
    return raw(spark, d).select("event_id", "ts", F.concat_ws(",", "et", F.concat(F.lit("t"), (F.col("k") % 20).cast("string")), F.when(F.col("k") % 4 == 0, F.lit(""))).alias("hashtag"))


_TOKENS = "tokens AS (SELECT unnest(string_split(et || ',t' || CAST(k % 20 AS VARCHAR) || CASE WHEN k % 4 = 0 THEN ',' ELSE '' END, ',')) AS item, us FROM raw)"


@query("topk_hashtag_exact", f", {_TOKENS} SELECT item, count(*) AS count FROM tokens GROUP BY item ORDER BY count DESC, item LIMIT 20")
def topk_hashtag_exact(spark, d):
    return metrics.top_tokens(_hashtags(spark, d), "hashtag", ",", 20)


@query("topk_hashtag_approx", f", {_TOKENS} SELECT item, count(*) AS count FROM tokens GROUP BY item ORDER BY count DESC, item LIMIT 20")
def topk_hashtag_approx(spark, d):
    """By sketch; its capacity is above the number of different tokens, so it is exact here, and ties are ordered after it."""
    return metrics.approximate_top_tokens(_hashtags(spark, d), "hashtag", ",", 1000, 1000).orderBy(F.desc("count"), "item").limit(20)


@query("topk_merge", f", {_TOKENS}, day AS (SELECT us // 86400000000 AS day, item, count(*) AS n FROM tokens GROUP BY ALL), cut AS (SELECT * FROM day QUALIFY row_number() OVER (PARTITION BY day ORDER BY n DESC, item) <= 15) SELECT item, CAST(sum(n) AS BIGINT) AS count FROM cut GROUP BY item ORDER BY count DESC, item LIMIT 10")
def topk_merge(spark, d):
    """Top lists of fifteen for each day, merged with their counts as weights; what a list cuts off is lost."""
    daily = metrics.windowed_tokens(_hashtags(spark, d), "hashtag", ",", "1 day", 15)
    return metrics.merge_top(daily.groupBy("start").agg(F.collect_list(F.struct("item", "count")).alias("top")), 10)


def _tweets(spark, d):
    """Tweets made from the sample events: country, language by k, hashtags."""
    e = events(spark, d)
    tag = F.concat_ws(",", "et", F.concat(F.lit("t"), (F.col("k") % 20).cast("string")), F.when(F.col("k") % 4 == 0, F.lit("")))
    return e.select("ts", "us", "ct", "country", F.concat(F.lit("l"), (F.col("k") % 30).cast("string")).alias("lang"), F.col("si").alias("user"), tag.alias("hashtag"))


_TEN = _start(10_000_000)


@query("tweet_top_country_10s", _TOP.format(start=_TEN, key="country", source="ex"))
def tweet_top_country_10s(spark, d):
    return metrics.top_n(metrics.live_counts(_tweets(spark, d), ["country"]), ["start"], F.col("count"), ["country"], 10).select("start", "country", "count")


@query("tweet_top_lang_10s", _TOP.format(start=_TEN, key="lang", source="(SELECT *, 'l' || CAST(k % 30 AS VARCHAR) AS lang FROM raw)"))
def tweet_top_lang_10s(spark, d):
    return metrics.top_n(metrics.live_counts(_tweets(spark, d), ["lang"]), ["start"], F.col("count"), ["lang"], 10).select("start", "lang", "count")


@query("tweet_top_hashtag_10s", f", {_TOKENS} SELECT * FROM (SELECT {_TEN} AS start, item, count(*) AS count FROM tokens GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY start ORDER BY count DESC, item) <= 20")
def tweet_top_hashtag_10s(spark, d):
    return metrics.windowed_tokens(_tweets(spark, d), "hashtag", ",", "10 seconds", 20)


@query("tweet_count_10s", f"SELECT {_TEN} AS start, count(*) AS count FROM ex GROUP BY ALL")
def tweet_count_10s(spark, d):
    return metrics.live_counts(_tweets(spark, d)).select("start", "count")


# The statements of the second level: ten-second counts, summed once more in windows of their own, a day long here so that
# there is something to sum and to cut.
_DAY = 86_400_000
_SECOND = f"SELECT us // {_DAY}000 * {_DAY} AS context_id, {{key}}, count(*) AS value FROM {{source}} WHERE {{key}} IS NOT NULL GROUP BY ALL"
_LANG = "(SELECT *, 'l' || CAST(k % 30 AS VARCHAR) AS lang FROM raw)"


def _second(name: str, key: str, rows, source: str, top: int | None = None) -> None:
    sql = _SECOND.format(key=key, source=source)
    sql = f"SELECT * FROM ({sql}) QUALIFY row_number() OVER (PARTITION BY context_id ORDER BY value DESC, {key}) <= {top}" if top else sql
    query(name, sql)(lambda spark, d: metrics.second_level(metrics.live_counts(rows(spark, d), [key]), [key], _DAY, top))


_second("ui_metric", "et", raw, "raw")
_second("ui_device", "device", events, "ex")
_second("ui_os", "os", events, "ex")
_second("ui_browser", "browser", events, "ex")
_second("ui_top_country", "country", events, "ex", 10)
_second("ui_tweet_top_country", "country", _tweets, "ex", 10)
_second("ui_tweet_top_lang", "lang", _tweets, _LANG, 10)


@query("ui_tweet_count", f"SELECT us // {_DAY}000 * {_DAY} AS context_id, count(*) AS value FROM raw GROUP BY 1")
def ui_tweet_count(spark, d):
    return metrics.second_level(metrics.live_counts(_tweets(spark, d)), [], _DAY)


@query("ui_tweet_hashtags", f", {_TOKENS} SELECT * FROM (SELECT us // {_DAY}000 * {_DAY} AS context_id, item, count(*) AS value FROM tokens GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY context_id ORDER BY value DESC, item) <= 10")
def ui_tweet_hashtags(spark, d):
    """Lists of a thousand in ten seconds, merged into the ten largest."""
    tops = metrics.windowed_tokens(_tweets(spark, d), "hashtag", ",", "10 seconds", 1000)
    return metrics.second_level(tops, ["item"], _DAY, 10)


@query("pageviews_30min", f"SELECT 'pageviews' AS metricname, 'pageviews' AS groupid, {_END.format(1_800_000_000)} AS metrictime, count(*) AS value FROM ex GROUP BY ALL")
def pageviews_30min(spark, d):
    return metrics.metric(events(spark, d), metrics.MetricSpec("pageviews", minutes=30))


@query("blank_group_left_out", f"SELECT 'pgspercn' AS metricname, country AS groupid, {_END.format(300_000_000)} AS metrictime, count(*) AS value FROM ex WHERE country IS NOT NULL AND k % 3 <> 0 GROUP BY ALL")
def blank_group_left_out(spark, d):
    """Events whose group is blank aren't counted."""
    e = events(spark, d).withColumn("country", F.when(F.col("k") % 3 == 0, F.lit("  ")).otherwise(F.col("country")))
    return metrics.metric(e, metrics.BY_NAME["pgspercn"])


@query("named_counters", "SELECT 'click_count' AS metricname, CAST(sum(k) AS BIGINT) AS value FROM raw UNION ALL SELECT 'counted', CAST(sum(event_id) AS BIGINT) FROM raw")
def named_counters(spark, d):
    """Every column whose name contains "count" is a counter."""
    rows = raw(spark, d).select("si", F.col("k").alias("click_count"), F.col("event_id").alias("counted"))
    return metrics.multi_counters(rows, metrics.counter_names(rows.columns))


_LATEST = 1_704_067_200_000 + 20 * 86_400_000


@query("pipeline_audit_deltas", f"SELECT 'events' AS metricname, strftime(make_timestamp(us // 3600000000 * 3600000000 - 25200000000), '%Y-%m-%d') AS groupid, us // 3600000000 * 3600000 AS metrictime, us // 60000000 * 60000 AS flushed, count(*) AS delta FROM raw WHERE us // 3600000000 * 3600000 >= {_LATEST} - 86400000 GROUP BY ALL")
def pipeline_audit_deltas(spark, d):
    return metrics.audit_deltas(raw(spark, d), "events", F.lit(_LATEST))


@query("ui_sum_by_metric", "SELECT et AS metricname, count(*) AS count FROM raw GROUP BY et")
def ui_sum_by_metric(spark, d):
    partial = metrics.live_counts(raw(spark, d), ["et"])
    return partial.groupBy(F.col("et").alias("metricname")).agg(F.sum("count").alias("count"))


@query("zero_filled_counts", ", c AS (SELECT us // 60000000 * 60000 AS start, count(*) AS n FROM raw GROUP BY 1), s AS (SELECT unnest(generate_series(min(start), max(start), 60000)) AS start FROM c) SELECT s.start, coalesce(c.n, 0) AS count FROM s LEFT JOIN c ON s.start = c.start")
def zero_filled_counts(spark, d):
    return metrics.zero_filled(metrics.live_counts(raw(spark, d), (), "1 minute").select("start", "count"), 60_000)


@query("avg_counter", "SELECT et, CASE WHEN count(*) FILTER (WHERE k >= 0) = 0 THEN 0 ELSE CAST(sum(k) AS BIGINT) // count(*) END AS value FROM raw GROUP BY et")
def avg_counter(spark, d):
    return metrics.average_counter(raw(spark, d).withColumn("n", F.lit(1)), ["et"], "k", "n")


@query("multi_counters", "SELECT 'clicks' AS metricname, CAST(sum(CASE WHEN et = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS value FROM raw UNION ALL SELECT 'views', CAST(sum(CASE WHEN et = 'view' THEN 1 ELSE 0 END) AS BIGINT) FROM raw")
def multi_counters(spark, d):
    rows = raw(spark, d).select((F.col("et") == "click").cast("long").alias("clicks"), (F.col("et") == "view").cast("long").alias("views"))
    return metrics.multi_counters(rows, ["clicks", "views"])


@query("delta_counter", ", day AS (SELECT et, us // 86400000000 AS day, count(*) AS n FROM raw GROUP BY ALL), mark AS (SELECT et, day, CAST(sum(n) OVER (PARTITION BY et ORDER BY day) AS BIGINT) AS total FROM day) SELECT et, day, total, total - lag(total, 1, 0) OVER (PARTITION BY et ORDER BY day) AS delta FROM mark QUALIFY delta > 5")
def delta_counter(spark, d):
    from pyspark.sql import Window

    daily = raw(spark, d).groupBy("et", F.expr("us div 86400000000").alias("day")).agg(F.count("*").alias("n"))
    marks = daily.select("et", "day", F.sum("n").over(Window.partitionBy("et").orderBy("day")).alias("total"))
    return metrics.delta_counter(marks, ["et"], "day", "total", 5)


@query("pipeline_audit_hourly", "SELECT 'events' AS metricname, strftime(make_timestamp(us // 3600000000 * 3600000000 - 25200000000), '%Y-%m-%d') AS groupid, us // 3600000000 * 3600000 AS metrictime, count(*) AS value FROM raw GROUP BY ALL")
def pipeline_audit_hourly(spark, d):
    return metrics.hourly_audit(raw(spark, d), "events")


@query("last_n_batches", "SELECT * FROM (SELECT et, us // 60000000 * 60000 AS start, count(*) AS count FROM raw GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY et ORDER BY start DESC) <= 30")
def last_n_batches(spark, d):
    return metrics.last_batches(metrics.live_counts(raw(spark, d), ["et"], "1 minute").select("et", "start", "count"), "et", "start", 30)


@query("column_counters", "SELECT 'pageviews' AS statement, et, count(*) AS count FROM raw GROUP BY et")
def column_counters(spark, d):
    return metrics.column_counters(raw(spark, d), "pageviews", "et")
