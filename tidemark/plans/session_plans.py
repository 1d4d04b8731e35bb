"""Queries on sessions."""

from pyspark.sql import functions as F

from tidemark.operators import sessions
from tidemark.plans.base import METADATA, TTL, events, numbered, query, raw

_TABLE = """, f AS (SELECT *, CASE WHEN lag(us) OVER w IS NULL OR us >= lag(us) OVER w + {ttl} THEN 1 ELSE 0 END AS f FROM raw WINDOW w AS (PARTITION BY si ORDER BY us, event_id)),
s AS (SELECT *, sum(f) OVER (PARTITION BY si ORDER BY us, event_id) AS no FROM f)
SELECT si, min(us) // 1000 AS snst_ms, max(us) // 1000 AS snet_ms, CASE WHEN count(*) > 1 THEN max(us) // 1000 - min(us) // 1000 ELSE 0 END AS sndn_ms, count(*) AS snec FROM s GROUP BY si, no"""

for _name, _millis in (("sessions_60s", 60_000), ("sessions_30m", 1_800_000), ("sessions_6h", TTL), ("sessions_24h", 86_400_000)):
    query(_name, _TABLE.format(ttl=_millis * 1000))(lambda spark, d, ttl=_millis: sessions.session_table(raw(spark, d), ttl))

_DAY = 86_400_000_000


@query(
    "sessions_max_active",
    f""", o AS (SELECT si, us, row_number() OVER (PARTITION BY si ORDER BY us, event_id) AS i FROM raw),
walk AS (SELECT si, i, us, us AS st, us AS en FROM o WHERE i = 1
         UNION ALL SELECT o.si, o.i, o.us, CASE WHEN o.us >= w.en + {_DAY} OR o.us > w.st + {_DAY} THEN o.us ELSE w.st END, o.us FROM walk w JOIN o ON o.si = w.si AND o.i = w.i + 1)
SELECT si, st // 1000 AS snst_ms, max(us) // 1000 AS snet_ms, CASE WHEN count(*) > 1 THEN max(us) // 1000 - st // 1000 ELSE 0 END AS sndn_ms, count(*) AS snec FROM walk GROUP BY si, st""",
)
def sessions_max_active(spark, d):
    return sessions.sessions_with_max_active(raw(spark, d), 86_400_000, 86_400_000)


_ID = "si || lpad(lower(hex({})), 16, '0')"
_FIRST = "min(us) // 1000"


@query("session_ids", f"SELECT DISTINCT {_ID.format('ct')} AS _snid FROM se WHERE event_no = 1", "se")
def session_ids(spark, d):
    return sessions.begin_events(numbered(spark, d), []).select("_snid").distinct()


@query("session_begin_feed", f"SELECT {_ID.format('ct')} AS _snid, ct AS _snst, si, {', '.join(METADATA)} FROM se WHERE event_no = 1", "se")
def session_begin_feed(spark, d):
    return sessions.begin_events(numbered(spark, d), METADATA)


_END = f"SELECT {_ID.format(_FIRST)} AS _snid, {_FIRST} AS _snst, max(us) // 1000 AS _snet, CASE WHEN count(*) > 1 THEN max(us) // 1000 - {_FIRST} ELSE 0 END AS _sndn, count(*) AS _snec, si"


@query("session_end_feed", _END + ", " + ", ".join(f"arg_min_null({m}, event_no) AS {m}" for m in METADATA) + " FROM se GROUP BY si, session_no", "se")
def session_end_feed(spark, d):
    return sessions.end_events(numbered(spark, d), METADATA)


@query("session_metadata_first", "SELECT si, session_no, arg_min_null(city, event_no) AS city, arg_min_null(browser, event_no) AS browser FROM se GROUP BY si, session_no", "se")
def session_metadata_first(spark, d):
    found = numbered(spark, d).groupBy("si", "session_no").agg(F.min_by(F.struct("city", "browser"), F.struct("us", "event_id")).alias("m"))
    return found.select("si", "session_no", "m.city", "m.browser")


@query("session_counters", "SELECT si, session_no, count(*) FILTER (WHERE et = 'click') AS clicks, count(*) FILTER (WHERE k < 5) AS robots FROM se GROUP BY si, session_no", "se")
def session_counters(spark, d):
    return sessions.counters(numbered(spark, d), {"clicks": F.col("et") == "click", "robots": F.col("k") < 5})


@query(
    "session_append_state",
    """, u AS (SELECT si, session_no, city, min(event_no) AS o FROM se WHERE city IS NOT NULL GROUP BY ALL),
n AS (SELECT *, row_number() OVER (PARTITION BY si, session_no ORDER BY o) AS i FROM u)
SELECT a.si, a.session_no, coalesce(string_agg(n.city, ',' ORDER BY o), '') AS cities FROM (SELECT DISTINCT si, session_no FROM se) a LEFT JOIN n ON a.si = n.si AND a.session_no = n.session_no GROUP BY ALL""",
    "se",
)
def session_append_state(spark, d):
    return sessions.appended_state(numbered(spark, d), F.col("city")).select("si", "session_no", F.array_join("values", ",").alias("cities"))


@query("session_append_last3", "SELECT si, session_no, string_agg(et, ',' ORDER BY us, event_id) AS last FROM (SELECT *, row_number() OVER (PARTITION BY si, session_no ORDER BY us DESC, event_id DESC) AS i FROM se) WHERE i <= 3 GROUP BY ALL", "se")
def session_append_last3(spark, d):
    return sessions.appended_state(numbered(spark, d), F.col("et"), unique=False, max_length=3).select("si", "session_no", F.array_join("values", ",").alias("last"))


@query("session_last_state", "SELECT si, session_no, arg_max_null(city, event_no) AS city, arg_max_null(et, event_no) AS et FROM se GROUP BY si, session_no", "se")
def session_last_state(spark, d):
    return sessions.last_state(numbered(spark, d), ["city", "et"])


_SUB = 3_600_000


@query(
    "subsessions",
    f""", a AS (SELECT *, CASE WHEN lag(us) OVER w IS NULL OR us >= lag(us) OVER w + {_SUB * 1000} THEN 1 ELSE 0 END AS sf FROM se WHERE browser IS NOT NULL WINDOW w AS (PARTITION BY si, session_no, browser ORDER BY us, event_id)),
b AS (SELECT *, sum(sf) OVER (PARTITION BY si, session_no, browser ORDER BY us, event_id) AS sub FROM a)
SELECT 'browser' AS name, si, session_no, browser AS identifier, si || browser || lpad(lower(hex({_FIRST})), 16, '0') AS _snid, {_FIRST} AS _snst, max(us) // 1000 AS _snet,
       CASE WHEN count(*) > 1 THEN max(us) // 1000 - {_FIRST} ELSE 0 END AS _sndn, count(*) AS _snec FROM b GROUP BY si, session_no, browser, sub""",
    "se",
)
def subsessions(spark, d):
    return sessions.sub_sessions(numbered(spark, d), sessions.SubSessionSpec("browser", "browser", _SUB))


@query(
    "session_stats",
    _TABLE.format(ttl=TTL * 1000).replace("SELECT si, min(us)", ", t AS (SELECT si, min(us)")
    + ") SELECT count(*) AS created, count(*) FILTER (WHERE snec = 1) AS single_click, count(*) FILTER (WHERE snec > 1 AND sndn_ms <= 1800000) AS short_sessions, count(*) FILTER (WHERE snec > 1 AND sndn_ms > 1800000) AS long_sessions, CASE WHEN count(*) FILTER (WHERE snec > 1) = 0 THEN 0 ELSE CAST(sum(sndn_ms) FILTER (WHERE snec > 1) AS BIGINT) // count(*) FILTER (WHERE snec > 1) END AS avg_duration_ms FROM t",
)
def session_stats(spark, d):
    return sessions.statistics(sessions.session_table(raw(spark, d), TTL))


@query("decorate_event", "SELECT event_id, si, si || lpad(lower(hex(first_value(ct) OVER w)), 16, '0') AS _snid, event_no AS events_so_far, array_to_string(list_sort(list_distinct(list(et) OVER w)), ',') AS kinds FROM se WINDOW w AS (PARTITION BY si, session_no ORDER BY us, event_id ROWS UNBOUNDED PRECEDING)", "se")
def decorate_event(spark, d):
    return sessions.decorated(numbered(spark, d))


@query(
    "session_dynamic_ttl",
    """, t AS (SELECT *, us + CASE WHEN et = 'purchase' THEN 43200000000 ELSE 3600000000 END AS expiry FROM raw),
f AS (SELECT *, CASE WHEN lag(expiry) OVER w IS NULL OR us >= lag(expiry) OVER w THEN 1 ELSE 0 END AS f FROM t WINDOW w AS (PARTITION BY si ORDER BY us, event_id))
SELECT event_id, si, CAST(sum(f) OVER (PARTITION BY si ORDER BY us, event_id) AS BIGINT) AS session_no FROM f""",
)
def session_dynamic_ttl(spark, d):
    """A rule that changes the time to live: twelve hours after a purchase, otherwise one."""
    ttl = F.when(F.col("et") == "purchase", F.lit(43_200_000)).otherwise(F.lit(3_600_000))
    return sessions.sessionized(raw(spark, d), ["si"], ttl).select("event_id", "si", "session_no")


@query("session_profiles", _TABLE.format(ttl=1_800_000_000).replace("SELECT si, min", "SELECT 'short' AS profile, si, min", 1) + " UNION ALL SELECT 'country', country, min(us) // 1000, max(us) // 1000, CASE WHEN count(*) > 1 THEN max(us) // 1000 - min(us) // 1000 ELSE 0 END, count(*) FROM (SELECT *, sum(f) OVER (PARTITION BY country ORDER BY us, event_id) AS no FROM (SELECT *, CASE WHEN lag(us) OVER w IS NULL OR us >= lag(us) OVER w + 600000000 THEN 1 ELSE 0 END AS f FROM ex WHERE country IS NOT NULL WINDOW w AS (PARTITION BY country ORDER BY us, event_id))) GROUP BY country, no")
def session_profiles(spark, d):
    """Two profiles over the same events: by user, and by country with ten minutes."""
    e = events(spark, d)
    short = sessions.session_table(e, 1_800_000).withColumn("profile", F.lit("short"))
    country = sessions.session_table(e.filter("country IS NOT NULL"), 600_000, "country").withColumnRenamed("country", "si").withColumn("profile", F.lit("country"))
    return short.unionByName(country)


# A profile: twelve hours, but not more idle time than six, which is what counts.
SPEC = sessions.SessionSpec(
    "users",
    ttl_millis=2 * TTL,
    max_idle_millis=TTL,
    metadata=("country", "browser", "os"),
    sub_sessions=(sessions.SubSessionSpec("browser", "browser", _SUB),),
    counters=(("clicks", "et = 'click'"), ("robots", "k < 5")),
    state=(("city", "et = 'view'", "city"), ("last_buy", "et = 'purchase'", "item")),
)


@query("session_spec_markers", f"""SELECT 'users' AS profile, si, session_no, 'begin' AS kind, NULL AS identifier, {_ID.format(_FIRST)} AS _snid, {_FIRST} AS _snst, NULL AS _snet, NULL AS _snec FROM se GROUP BY si, session_no
UNION ALL SELECT 'users', si, session_no, 'event', CAST(event_id AS VARCHAR), {_ID.format("first_value(ct) OVER w")}, first_value(ct) OVER w, NULL, event_no FROM se WINDOW w AS (PARTITION BY si, session_no ORDER BY us, event_id)
UNION ALL SELECT 'users', si, session_no, 'end', NULL, {_ID.format(_FIRST)}, {_FIRST}, max(us) // 1000, count(*) FROM se GROUP BY si, session_no""", "se")
def session_spec_markers(spark, d):
    """Begin markers, events and end markers of a profile."""
    out = sessions.feed_by_spec(events(spark, d), SPEC).filter("kind IN ('begin', 'event', 'end')")
    return out.select("profile", "si", "session_no", "kind", "identifier", "_snid", "_snst", "_snet", "_snec")


@query("session_spec_order", """, one AS (SELECT si, session_no, us, event_id, browser, min(us) OVER (PARTITION BY si, session_no) AS lo, max(us) OVER (PARTITION BY si, session_no) AS hi,
       CASE WHEN lag(us) OVER w IS NULL OR us >= lag(us) OVER w + 3600000000 THEN 1 ELSE 0 END AS sf FROM se WINDOW w AS (PARTITION BY si, session_no, browser ORDER BY us, event_id)),
sub AS (SELECT *, sum(sf) OVER (PARTITION BY si, session_no, browser ORDER BY us, event_id) AS sno FROM one),
subs AS (SELECT si, session_no, browser, sno, min(us) // 1000 * 1000 AS a, max(us) // 1000 * 1000 AS b FROM sub GROUP BY ALL),
out AS (SELECT DISTINCT si, session_no, lo AS t, 0 AS place FROM one UNION ALL SELECT si, session_no, a, 1 FROM subs UNION ALL SELECT si, session_no, us, 2 FROM one UNION ALL SELECT si, session_no, b, 3 FROM subs UNION ALL SELECT DISTINCT si, session_no, hi, 4 FROM one)
SELECT si, session_no, string_agg(CAST(place AS VARCHAR), '' ORDER BY t, place) AS places FROM out GROUP BY ALL""", "se")
def session_spec_order(spark, d):
    """The order in which a session's rows are emitted: begin, sub-session begins, events, sub-session ends, end."""
    out = sessions.feed_by_spec(events(spark, d), SPEC)
    return out.groupBy("si", "session_no").agg(F.array_join(F.transform(F.sort_array(F.collect_list("emitted")), lambda e: e["place"].cast("string")), "").alias("places"))


@query("session_spec_variables", """SELECT si, session_no, arg_min_null(country, event_no) AS country, coalesce(arg_max_null(city, event_no) FILTER (WHERE et = 'view'), '') AS city,
       arg_max_null(item, event_no) FILTER (WHERE et = 'purchase') IS NOT NULL AS bought, count(*) FILTER (WHERE et = 'click') AS clicks,
       len(list_filter([arg_min_null(browser, event_no), arg_min_null(os, event_no)], lambda x: x IS NOT NULL)) AS n_other FROM se GROUP BY si, session_no""", "se")
def session_spec_variables(spark, d):
    """Metadata, state, counters as variables: a name's value, whether there is one, and those with other names."""
    ends = sessions.feed_by_spec(events(spark, d), SPEC).filter("kind = 'end'")
    metadata, state = F.col("metadata"), F.col("state")
    others = F.size(sessions.with_prefix(metadata, "b")) + F.size(sessions.with_prefix(metadata, "o"))
    return ends.select("si", "session_no", F.try_element_at(metadata, F.lit("country")).alias("country"), F.coalesce(F.try_element_at(state, F.lit("city")), F.lit("")).alias("city"), sessions.contains(state, "last_buy").alias("bought"), sessions.as_long(F.col("counters"), "clicks").alias("clicks"), others.cast("long").alias("n_other"))


@query(
    "session_rule_ttl",
    """, o AS (SELECT si, us, event_id, CASE WHEN et = 'purchase' THEN 86400000 WHEN et = 'view' THEN 999999999999 END AS rule, row_number() OVER (PARTITION BY si ORDER BY us, event_id) AS i FROM raw),
walk AS (SELECT si, i, us, event_id, 1 AS no, CASE WHEN rule <= 172800000 THEN rule ELSE 3600000 END AS ttl FROM o WHERE i = 1
         UNION ALL SELECT o.si, o.i, o.us, o.event_id, CASE WHEN o.us >= w.us + w.ttl * 1000 THEN w.no + 1 ELSE w.no END,
                          CASE WHEN o.rule <= 172800000 THEN o.rule WHEN o.us >= w.us + w.ttl * 1000 THEN 3600000 ELSE w.ttl END FROM walk w JOIN o ON o.si = w.si AND o.i = w.i + 1)
SELECT event_id, si, CAST(no AS BIGINT) AS session_no FROM walk""",
)
def session_rule_ttl(spark, d):
    """A rule that sets the time to live for the rest of a session: a day after a purchase. What a view asks for is above the
    longest idle time, two days, and ignored."""
    spec = sessions.SessionSpec("rule", ttl_millis=3_600_000, max_idle_millis=172_800_000, duration="CASE WHEN et = 'purchase' THEN 86400000 WHEN et = 'view' THEN 999999999999 END")
    return sessions.numbered_by_spec(raw(spark, d), spec).select("event_id", "si", "session_no")


@query("session_spec_extension", f"SELECT event_id, CASE WHEN lag(us) OVER w IS NULL OR us >= lag(us) OVER w + {TTL * 1000} THEN 'first' ELSE 'later' END AS mark FROM raw WHERE et <> 'error' WINDOW w AS (PARTITION BY si ORDER BY us, event_id)")
def session_spec_extension(spark, d):
    """A profile with a condition, and an extension that adds a column to its numbered events."""
    spec = sessions.SessionSpec("marked", ttl_millis=TTL, max_idle_millis=TTL, condition="et <> 'error'", extensions=(lambda rows: rows.withColumn("mark", F.when(F.col("event_no") == 1, "first").otherwise("later")),))
    return sessions.numbered_by_spec(events(spark, d), spec).select("event_id", "mark")


@query("subsession_stats", """, a AS (SELECT *, CASE WHEN lag(us) OVER w IS NULL OR us >= lag(us) OVER w + 3600000000 THEN 1 ELSE 0 END AS sf FROM se WINDOW w AS (PARTITION BY si, session_no, browser ORDER BY us, event_id)),
b AS (SELECT *, sum(sf) OVER (PARTITION BY si, session_no, browser ORDER BY us, event_id) AS sub FROM a),
c AS (SELECT max(us) // 1000 - min(us) // 1000 AS n_ms, count(*) AS n FROM b GROUP BY si, session_no, browser, sub)
SELECT 'browser' AS name, count(*) AS created, count(*) FILTER (WHERE n = 1) AS single_click, CASE WHEN count(*) FILTER (WHERE n > 1) = 0 THEN 0 ELSE CAST(sum(n_ms) FILTER (WHERE n > 1) AS BIGINT) // count(*) FILTER (WHERE n > 1) END AS avg_duration_ms FROM c""", "se")
def subsession_stats(spark, d):
    return sessions.sub_statistics(sessions.sub_sessions(numbered(spark, d), sessions.SubSessionSpec("browser", "browser", _SUB)))


@query("lag_stats", "SELECT count(*) AS n, CAST(sum(k * 10) AS BIGINT) // count(*) AS avg_lag_ms, max(k * 10) AS max_lag_ms FROM raw")
def lag_stats(spark, d):
    return sessions.lag_statistics(raw(spark, d), F.col("ct"), F.col("ct") + F.col("k") * 10)
