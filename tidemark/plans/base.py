"""The events of the sample tables as enriched events, in Spark and in SQL, and the register of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import epoch_micros
from tidemark.operators import sessions
from tidemark.sources.readers import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

BROWSERS, SYSTEMS, DEVICES = ["chrome", "firefox", "safari", "edge", "opera"], ["windows", "android", "ios"], ["phone", "tablet", "desktop", "tv", "watch", "console", "robot"]


def query(name: str, sql: str | None = None, tables: str = "ex"):
    """Register a query; ``sql`` may select from ex (enriched events) and, if named in ``tables``, from numbered sessions."""

    def add(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = (f"WITH RECURSIVE {EX}{NUMBERED if tables == 'se' else ''}\n" if tables else "") + sql
        return run

    return add


def _pick(values: list[str], k) -> F.Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(k, F.lit(len(values))) + 1).cast("int"))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with event time: us (microseconds), ct (milliseconds), ts (timestamp), the key si, the type et, k and dwell."""
    e = table(spark, sf_dir, "events")
    us = epoch_micros(F.col("ts"))
    k = F.get_json_object("props", "$.k").cast("long")
    return e.select("event_id", us.alias("us"), F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts) div 1000").alias("ct"), F.timestamp_micros(us).alias("ts"), "user_id", F.col("user_id").cast("string").alias("si"), F.col("event_type").alias("et"), F.col("value").alias("dwell"), k.alias("k"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a location (from the customer's nation and region) and synthetic city, browser, os, device and item.

    The dimension tables are joined as they come; Spark broadcasts them while they are small."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("nation"))
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation"), F.col("n_name").alias("country"), F.col("n_regionkey").alias("region"))
    r = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("region"), F.col("r_name").alias("continent"))
    out = raw(spark, sf_dir).join(c, "user_id", "left").join(n, "nation", "left").join(r, "region", "left")
    k = F.col("k")
    city = F.when(F.pmod(k, F.lit(10)) != 9, F.concat(F.lit("city"), F.pmod(k, F.lit(10)).cast("string")))
    return out.select("event_id", "us", "ct", "ts", "si", "et", "dwell", "k", "country", "continent", city.alias("city"), _pick(BROWSERS, k).alias("browser"), _pick(SYSTEMS, k).alias("os"), _pick(DEVICES, k).alias("device"), F.concat(F.lit("item"), k.cast("string")).alias("item"))


def _case(values: list[str]) -> str:
    return f"[{', '.join(repr(v) for v in values)}][CAST(k % {len(values)} AS INTEGER) + 1]"


EX = f"""raw AS (SELECT event_id, epoch_us(ts) AS us, epoch_us(ts) // 1000 AS ct, user_id, CAST(user_id AS VARCHAR) AS si, event_type AS et, value AS dwell,
               CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events),
     ex AS (SELECT event_id, us, ct, si, et, dwell, k, n_name AS country, r_name AS continent, CASE WHEN k % 10 <> 9 THEN 'city' || CAST(k % 10 AS VARCHAR) END AS city,
                   {_case(BROWSERS)} AS browser, {_case(SYSTEMS)} AS os, {_case(DEVICES)} AS device, 'item' || CAST(k AS VARCHAR) AS item
            FROM raw LEFT JOIN customer ON user_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""

#: Sessions of the queries on session state: six hours.
TTL = 6 * 3_600_000
METADATA = ("country", "browser", "os", "city", "device", "et")

NUMBERED = f""",
     g AS (SELECT *, CASE WHEN lag(us) OVER w IS NULL OR us >= lag(us) OVER w + {TTL * 1000} THEN 1 ELSE 0 END AS f FROM ex WINDOW w AS (PARTITION BY si ORDER BY us, event_id)),
     h AS (SELECT *, CAST(sum(f) OVER (PARTITION BY si ORDER BY us, event_id) AS BIGINT) AS session_no FROM g),
     se AS (SELECT *, row_number() OVER (PARTITION BY si, session_no ORDER BY us, event_id) AS event_no FROM h)"""


def numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.sessionized(events(spark, sf_dir), ["si"], TTL)


def ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session ends as events: their time is that of the session's last event."""
    n = numbered(spark, sf_dir)
    found = n.groupBy("si", "session_no").agg(F.max("us").alias("us"), F.min_by(F.struct(*METADATA), F.struct("us", "event_id")).alias("m"))
    return found.select("si", "us", F.timestamp_micros("us").alias("ts"), "m.*")


ENDS_SQL = "ends AS (SELECT si, max(us) AS us, " + ", ".join(f"arg_min_null({m}, event_no) AS {m}" for m in METADATA) + " FROM se GROUP BY si, session_no)"
