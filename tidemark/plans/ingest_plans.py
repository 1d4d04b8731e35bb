"""Queries on ingest, enrichment and routing."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import device, geo, scalars
from tidemark.functions.sql import register
from tidemark.operators import ingest, routing, sessions
from tidemark.plans.base import events, numbered, query, raw
from tidemark.sources.shared import shared_folder

_EVENT = T.StructType([T.StructField("si", T.StringType()), T.StructField("ct", T.LongType()), T.StructField("et", T.StringType()), T.StructField("k", T.LongType())])


def _bodies(spark: SparkSession, d: str) -> DataFrame:
    """JSON bodies: every seventh lacks si, every eleventh has a null one, every thirteenth is broken."""
    e = raw(spark, d)
    event = F.to_json(F.struct("si", "ct", "et", "k"))
    without = F.to_json(F.struct("ct", "et", "k"))
    null = F.concat(F.lit('{"si":null,"ct":'), F.col("ct").cast("string"), F.lit("}"))
    body = F.when(F.col("event_id") % 13 == 0, F.lit("{broken")).when(F.col("event_id") % 11 == 0, null).when(F.col("event_id") % 7 == 0, without).otherwise(event)
    return e.select("event_id", body.alias("body"))


@query("ingest_validate_ok", "SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE si END AS si, ct, CASE WHEN event_id % 11 = 0 THEN NULL ELSE et END AS et FROM raw WHERE event_id % 13 <> 0 AND (event_id % 11 = 0 OR event_id % 7 <> 0)")
def ingest_validate_ok(spark, d):
    good = ingest.parse_events(ingest.accepted(_bodies(spark, d), ["si"]), _EVENT)
    return good.select("event_id", "event.si", "event.ct", "event.et")


@query("ingest_validate_rejects", "SELECT event_id, false AS success, CASE WHEN event_id % 13 = 0 THEN 'not a JSON object' ELSE 'si is mandatory' END AS detail FROM raw WHERE event_id % 13 = 0 OR (event_id % 7 = 0 AND event_id % 11 <> 0)")
def ingest_validate_rejects(spark, d):
    return ingest.rejected(_bodies(spark, d), ["si"]).select("event_id", "success", "detail")


@query("ingest_batch", "SELECT si, ct, et FROM raw")
def ingest_batch(spark, d):
    """Bodies that are JSON arrays, an array for each hundred events."""
    batches = raw(spark, d).groupBy((F.col("event_id") / 100).cast("long").alias("batch")).agg(F.to_json(F.collect_list(F.struct("si", "ct", "et"))).alias("body"))
    return ingest.parse_events(batches, _EVENT).select("event.si", "event.ct", "event.et")


def _batch_bodies(spark, d):
    """A JSON array for each hundred events, whose items lack si, have a null one, or aren't objects, as in ``_bodies``; every
    fourth batch is no array."""
    items = _bodies(spark, d).withColumn("body", F.when(F.col("event_id") % 13 == 0, F.lit("17")).otherwise(F.col("body")))
    listed = items.groupBy((F.col("event_id") / 100).cast("long").alias("batch")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("event_id", "body"))), lambda x: x["body"]), ",").alias("all"))
    return listed.select("batch", F.when(F.col("batch") % 4 == 3, F.lit("{broken")).otherwise(F.concat(F.lit("["), "all", F.lit("]"))).alias("body"))


_ITEMS = """, i AS (SELECT event_id // 100 AS batch, event_id, row_number() OVER (PARTITION BY event_id // 100 ORDER BY event_id) - 1 AS item,
                         CASE WHEN event_id % 13 = 0 THEN 'not a JSON object' WHEN event_id % 11 <> 0 AND event_id % 7 = 0 THEN 'si is mandatory' END AS detail FROM raw),
     b AS (SELECT batch, item, detail, event_id FROM i WHERE batch % 4 <> 3 UNION ALL SELECT DISTINCT batch, 0, 'not a JSON object', NULL FROM i WHERE batch % 4 = 3) """


@query("ingest_batch_items", _ITEMS + "SELECT batch, CAST(item AS INTEGER) AS item, CASE WHEN event_id % 11 = 0 THEN NULL ELSE si END AS si FROM b JOIN raw USING (event_id) WHERE detail IS NULL")
def ingest_batch_items(spark, d):
    """Batch ingest: the items that pass, one by one."""
    good = ingest.accepted(ingest.batch_items(_batch_bodies(spark, d)), ["si"])
    return ingest.parse_events(good, _EVENT).select("batch", "item", "event.si")


@query("ingest_batch_answers", _ITEMS + """SELECT batch, count(*) AS n_items, CASE WHEN count(detail) = 0 THEN 200 ELSE 400 END AS status,
    '[' || coalesce(string_agg('{"item":' || item || ',"success":false,"detail":"' || detail || '"}', ',' ORDER BY item) FILTER (WHERE detail IS NOT NULL), '') || ']' AS failures FROM b GROUP BY batch""")
def ingest_batch_answers(spark, d):
    return ingest.batch_answers(_batch_bodies(spark, d), "batch", ["si"])


@query("ingest_validators", "SELECT event_id, CASE WHEN event_id % 13 = 0 THEN 'not a JSON object' WHEN event_id % 7 = 0 AND event_id % 11 <> 0 THEN 'si is mandatory' ELSE 'not a view' END AS detail FROM raw WHERE event_id % 13 = 0 OR event_id % 11 = 0 OR event_id % 7 = 0 OR et <> 'view'")
def ingest_validators(spark, d):
    """A check besides the mandatory keys."""
    view = lambda body: F.when(~F.get_json_object(body, "$.et").eqNullSafe(F.lit("view")), F.lit("not a view"))
    return ingest.rejected(_bodies(spark, d), ["si"], validators=[view]).select("event_id", "detail")


@query("origin_event", "SELECT event_id, browser AS b, si AS origin_si, ct AS origin_ct FROM ex")
def origin_event(spark, d):
    """The original event as one column beside what is derived from it."""
    out = ingest.with_origin(events(spark, d), b=F.col("browser"))
    return out.select("originEvent.event_id", "b", F.col("originEvent.si").alias("origin_si"), F.col("originEvent.ct").alias("origin_ct"))


@query("ct_default", "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 1700000000000 ELSE ct END AS ct FROM raw")
def ct_default(spark, d):
    e = raw(spark, d).withColumn("ct", F.when(F.col("event_id") % 5 != 0, F.col("ct")))
    return ingest.with_event_time(e, F.lit(1_700_000_000_000)).select("event_id", "ct")


@query("enrich_project", "SELECT event_id, si, browser AS _dd_bf, os AS _dd_os, device AS _dd_d, city AS _cty, continent AS _con, country AS _cn FROM ex")
def enrich_project(spark, d):
    e = events(spark, d)
    null = F.lit(None).cast("string")
    e = e.withColumn("device", F.struct(null.alias("agent_version"), F.col("browser").alias("agent_family"), F.col("device").alias("agent_name"), null.alias("category"), "os", null.alias("os_version")))
    e = e.withColumn("geo", F.struct("city", "continent", "country", null.alias("region"), null.alias("longitude"), null.alias("latitude"), null.alias("postal")))
    return ingest.enriched(e.select("event_id", "si", "device", "geo")).select("event_id", "si", "_dd_bf", "_dd_os", "_dd_d", "_cty", "_con", "_cn")


_AGENTS = [
    ("Mozilla/5.0 (Windows NT 10.0; Win64) AppleWebKit/537 Chrome/120.0 Safari/537", "Windows", "Chrome", "120.0", "Personal computer"),
    ("Mozilla/5.0 (iPhone; CPU iPhone OS 17_1 like Mac OS X) Version/17.1 Mobile/1 Safari/604.1", "iOS", "Safari", "17.1", "Smartphone"),
    ("Mozilla/5.0 (X11; Linux x86_64; rv:121.0) Firefox/121.0", "Linux", "Firefox", "121.0", "Personal computer"),
    ("Mozilla/5.0 (compatible; Examplebot/2.1)", None, "Robot", "2.1", "Robot"),
]


def _literal(value) -> str:
    return "NULL" if value is None else f"'{value}'"


def _by_k(i: int) -> str:
    return "CASE k % 5 " + " ".join(f"WHEN {n} THEN {_literal(a[i])}" for n, a in enumerate(_AGENTS)) + " ELSE NULL END"


@query("enrich_device", f"SELECT event_id, {_by_k(1)} AS os, {_by_k(2)} AS agent_family, {_by_k(3)} AS agent_version, {_by_k(4)} AS category FROM raw")
def enrich_device(spark, d):
    agent = F.lit(None).cast("string")
    for n, a in enumerate(_AGENTS):
        agent = F.when(F.col("k") % 5 == n, F.lit(a[0])).otherwise(agent)
    e = raw(spark, d).withColumn("ua", agent).withColumn("device", device.device_info(F.col("ua")))
    return e.select("event_id", "device.os", "device.agent_family", "device.agent_version", "device.category")


_BLOCKS = [("10.0.0.0", "10.0.255.255", "Alba"), ("10.1.0.0", "10.3.15.255", "Borea"), ("10.3.16.0", "10.3.255.255", "Cana")]


def _number(ip: str) -> int:
    a, b, c, e = map(int, ip.split("."))
    return ((a * 256 + b) * 256 + c) * 256 + e


_BLOCK_SQL = ", ".join(f"({_number(a)}, {_number(b)}, '{c}')" for a, b, c in _BLOCKS)


@query("enrich_geo", f"SELECT event_id, b.country FROM raw LEFT JOIN (VALUES {_BLOCK_SQL}) AS b(lo, hi, country) ON CASE WHEN event_id % 9 = 0 THEN NULL ELSE ((10 * 256 + k % 6) * 256 + k % 32) * 256 + k END BETWEEN lo AND hi")
def enrich_geo(spark, d):
    blocks = spark.createDataFrame([(_number(a), _number(b), c) for a, b, c in _BLOCKS], "first long, last long, country string")
    ip = F.when(F.col("event_id") % 9 != 0, F.concat_ws(".", F.lit("10"), (F.col("k") % 6).cast("string"), (F.col("k") % 32).cast("string"), F.col("k").cast("string")))
    return geo.with_location(raw(spark, d).withColumn("ipv4", ip), blocks).select("event_id", "geo.country")


@query("route_mobile_eq", "SELECT event_id, si FROM raw WHERE et = 'purchase'")
def route_mobile_eq(spark, d):
    return routing.where_equal(raw(spark, d), "et", "purchase").select("event_id", "si")


@query("route_present", "SELECT event_id FROM ex WHERE country IS NOT NULL AND city IS NOT NULL AND device IS NOT NULL")
def route_present(spark, d):
    return routing.where_present(events(spark, d), "country", "city", "device").select("event_id")


@query("route_null_split", "SELECT event_id, CASE WHEN city IS NOT NULL THEN 'summing' ELSE 'store' END AS route FROM ex")
def route_null_split(spark, d):
    have, lack = routing.split_by_presence(events(spark, d), "city")
    return have.select("event_id", F.lit("summing").alias("route")).unionByName(lack.select("event_id", F.lit("store").alias("route")))


def _wired(e):
    """Enriched events under the names that feeds read, with made-up values for what the sample events lack."""
    known = {"_cty": "city", "_cn": "country", "_con": "continent", "_dd_bf": "browser", "_dd_os": "os", "_dd_dc": "device", "itmT": "item"}
    made = {"ts": "et", "t": "si", "_rgn": "city", "_dd_bv": "item", "dd_df": "device", "_dd_osv": "os", "_lon": "k", "_lat": "k", "_tlcn": "country", "tn": "si", "ipv4": "si", "itmP": "k", "cap": "et", "rf": "item", "js_ev_mak": "et", "capG": "et", "url": "item", "capQ": "et", "ac": "si", "ua": "browser", "_dwell": "dwell"}
    return e.select("event_id", "si", "et", "ct", *(F.col(c).alias(n) for n, c in {**known, **made}.items()))


@query("feed_session", ", e AS (SELECT si, session_no, min(us) // 1000 AS a, max(us) // 1000 AS b, count(*) AS n, " + ", ".join(f"arg_min_null({c}, event_no) AS {c}" for c in ("et", "city", "country", "continent", "browser", "item", "device", "os")) + """ FROM se GROUP BY si, session_no)
SELECT et AS trafficsource, si AS site, city, city AS region, country, continent, browser AS browserfamily, item AS browserversion, device AS devicefamily, device AS deviceclass, os AS osfamily, os AS osversion,
       n AS _snec, CASE WHEN n > 1 THEN b - a ELSE 0 END AS _sndn, b AS _snet FROM e""", "se")
def feed_session(spark, d):
    """The session feed with all its fifteen columns."""
    rows = numbered(spark, d)
    ends = sessions.end_events(rows, ["et", "city", "country", "continent", "browser", "item", "device", "os"])
    wired = {"ts": "et", "t": "si", "_cty": "city", "_rgn": "city", "_cn": "country", "_con": "continent", "_dd_bf": "browser", "_dd_bv": "item", "dd_df": "device", "_dd_dc": "device", "_dd_os": "os", "_dd_osv": "os"}
    return routing.session_feed(ends.select("_snec", "_sndn", "_snet", *(F.col(c).alias(n) for n, c in wired.items())))


@query("feed_event", """SELECT 'MP' AS tenant, si AS guid, city, city AS region, country, continent, browser AS browserfamily, item AS browserversion, device AS devicefamily, device AS deviceclass, os AS osfamily, os AS osversion,
       dwell, et AS trafficsource, si AS site, si AS tn, si AS ipv4, k AS itmP, et AS cap, item AS rf, et AS js_ev_mak, item AS itmT, et AS capG, k AS _lon, k AS _lat, country AS _tlcn, item AS url, et AS capQ, si AS ac, browser AS ua, et, ct FROM ex""")
def feed_event(spark, d):
    """The event feed with all its thirty-two columns."""
    return routing.event_feed(_wired(events(spark, d)))


@query("sink_fan_out", """SELECT 'kafka' AS sink, 'mobile' AS feed, count(*) AS n FROM raw WHERE et = 'purchase' UNION ALL SELECT 'kafka', 'event', count(*) FROM raw
UNION ALL SELECT 'metrics', 'event', count(*) FROM raw""")
def sink_fan_out(spark, d):
    """Two feeds delivered to the sinks they are routed to, dealt by key, and read back."""
    folder = shared_folder(spark, "sinks")
    e = routing.with_affinity(raw(spark, d).select("event_id", "si", "et"), "si")
    feeds = {"mobile": routing.where_equal(e, "et", "purchase").withColumn("feed", F.lit("mobile")), "event": e.withColumn("feed", F.lit("event"))}
    sinks = {s: (lambda df, s=s: df.write.mode("append").parquet(f"{folder}/{s}")) for s in ("kafka", "metrics")}
    routing.fan_out(feeds, sinks, {"mobile": ["kafka"], "event": ["kafka", "metrics"]})
    out = [spark.read.parquet(f"{folder}/{s}").groupBy(F.lit(s).alias("sink"), "feed").agg(F.count("*").alias("n")) for s in sinks]
    return out[0].unionByName(out[1])


@query("affinity_partitions", "SELECT 'column' AS kind, true AS whole UNION ALL SELECT 'dimension', true")
def affinity_partitions(spark, d):
    """Events of a key, simple or composed, are all in one partition."""
    e = events(spark, d).filter("country IS NOT NULL")
    out = []
    for kind, keys in (("column", ["si"]), ("dimension", ["country", "browser"])):
        dealt = routing.with_affinity(e, *keys, partitions=4).withColumn("p", F.spark_partition_id())
        out.append(dealt.groupBy(*keys).agg(F.count_distinct("p").alias("n")).agg((F.max("n") == 1).alias("whole")).select(F.lit(kind).alias("kind"), "whole"))
    return out[0].unionByName(out[1])


@query("messages", "SELECT 'sess/event' AS topic, si AS key, '{\"event_id\":' || event_id || ',\"si\":\"' || si || '\"}' AS value FROM raw")
def messages(spark, d):
    return routing.as_messages(raw(spark, d).select("event_id", "si"), "sess/event", ["si"])


@query("bypass_union", "SELECT event_id, CASE WHEN city IS NOT NULL THEN 'seen' END AS mark FROM ex")
def bypass_union(spark, d):
    return routing.bypass(events(spark, d).select("event_id", "city"), "city", lambda e: e.withColumn("mark", F.lit("seen"))).select("event_id", "mark")


@query("null_defaults", "SELECT event_id, coalesce(city, '') AS a, coalesce(city, 'none') AS b, CASE WHEN k % 3 = 0 THEN 0 ELSE k END AS c, CASE WHEN k % 3 = 0 THEN 7 ELSE k END AS d FROM ex")
def null_defaults(spark, d):
    k = F.when(F.col("k") % 3 != 0, F.col("k"))
    city = F.col("city")
    return events(spark, d).select("event_id", scalars.string_or_empty(city).alias("a"), scalars.string_or(city, "none").alias("b"), scalars.long_or_zero(k).alias("c"), scalars.long_or(k, 7).alias("d"))


@query("json_roundtrip", "SELECT event_id, si, ct, et, k FROM raw")
def json_roundtrip(spark, d):
    e = raw(spark, d).select("event_id", F.to_json(F.struct("si", "ct", "et", "k")).alias("j"))
    return e.select("event_id", F.from_json("j", _EVENT).alias("e")).select("event_id", "e.*")


_NOW = 1_704_067_200_000 + 15 * 86_400_000


@query("replay_delay_filter", f"SELECT event_id, CASE WHEN event_id % 2 = 0 THEN ct ELSE {_NOW} END AS first_replay FROM raw WHERE ct + 60000 <= {_NOW} AND (event_id % 2 = 1 OR ct + 86400000 >= {_NOW})")
def replay_delay_filter(spark, d):
    failed = raw(spark, d).select("event_id", F.col("ct").alias("produced"), F.when(F.col("event_id") % 2 == 0, F.col("ct")).alias("first_replay"), F.lit("x").alias("transport"))
    return routing.due_for_replay(failed, F.lit(_NOW)).select("event_id", "first_replay")


@query("replay_topic_name", "SELECT event_id, 'Replay-Trk-' || et || '-Event' AS topic FROM raw")
def replay_topic_name(spark, d):
    return raw(spark, d).select("event_id", routing.retry_topic(F.concat(F.lit("Trk/"), "et", F.lit("/Event"))).alias("topic"))


@query("dead_letters", "SELECT 'Replay-Trk-' || et AS topic, 'queue full' AS code, ct AS produced, '{\"event_id\":' || event_id || ',\"si\":\"' || si || '\"}' AS value FROM raw WHERE event_id % 5 = 0")
def dead_letters(spark, d):
    """Failed events as messages for their retry topics."""
    e = raw(spark, d)
    problem = F.when(F.col("event_id") % 5 == 0, F.lit("queue full"))
    _, failed = routing.dead_letters(e.select("event_id", "si", "et", "ct"), problem, F.concat(F.lit("Trk/"), "et"), F.col("ct"))
    return failed.select("topic", "code", "produced", F.to_json(F.from_json("value", "event_id BIGINT, si STRING")).alias("value"))


@query("replay_due_batches", f", l AS (SELECT event_id // 50 AS batch, max(event_id) AS last FROM raw GROUP BY 1) SELECT event_id FROM raw JOIN l ON event_id // 50 = batch WHERE batch IN (SELECT batch FROM l JOIN raw ON event_id = last WHERE event_id % 3 = 0 OR ct + 60000 <= {_NOW})")
def replay_due_batches(spark, d):
    """Batches are held until their last event is due; one whose last event has no time doesn't wait."""
    failed = raw(spark, d).select("event_id", F.expr("event_id div 50").alias("batch"), F.when(F.col("event_id") % 3 != 0, F.col("ct")).alias("produced"))
    return routing.due_batches(failed, ["batch"], ["event_id"], F.lit(_NOW)).select("event_id")


@query(
    "replay_stop_alerts",
    """, o AS (SELECT us, row_number() OVER (ORDER BY us) AS i FROM (SELECT DISTINCT us FROM raw WHERE event_id % 10 = 0)),
walk AS (SELECT i, us, us AS last FROM o WHERE i = 1 UNION ALL SELECT o.i, o.us, CASE WHEN o.us >= w.last + 86400000000 THEN o.us ELSE w.last END FROM walk w JOIN o ON o.i = w.i + 1)
SELECT DISTINCT last AS us FROM walk""",
)
def replay_stop_alerts(spark, d):
    """Alerts at least a day apart (with five minutes, sparse sample events would all raise one)."""
    return routing.stop_alerts(raw(spark, d).filter("event_id % 10 = 0").select("us").distinct(), 86_400_000)


@query("sql_functions", f"SELECT event_id, 'Replay-Trk-' || et AS topic, ct - ct % 60000 AS minute, si || lpad(lower(hex(ct)), 16, '0') AS sid FROM raw")
def sql_functions(spark, d):
    """Functions that SQL statements can name."""
    register(spark)
    raw(spark, d).createOrReplaceTempView("tidemark_raw_events")
    return spark.sql("SELECT event_id, retry_topic('Trk/' || et) AS topic, floor_millis(ct, 60000) AS minute, session_id(si, ct) AS sid FROM tidemark_raw_events")


@query("date_at_zone", "SELECT event_id, strftime(make_timestamp(us - 25200000000), '%Y-%m-%d %H:%M:%S') AS wall, ct // 1000 * 1000 AS again FROM raw")
def date_at_zone(spark, d):
    """A time as text seven hours behind UTC, and read back."""
    e = raw(spark, d).withColumn("wall", scalars.formatted_at_zone(F.col("ct"), "-07:00"))
    return e.select("event_id", "wall", scalars.parsed_at_zone(F.col("wall"), "-07:00").alias("again"))
