"""Sessions: events of one key, each less than a time to live after the one before.

A gap equal to the time to live starts a new session. Time is event time, in epoch microseconds (``us``); ties are broken
by ``event_id``. All forms here run inside the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import session_id


@dataclass(frozen=True)
class SubSessionSpec:
    """Sessions inside sessions, by a second key; their time to live is at most that of the session."""

    name: str
    key: str
    ttl_millis: int


@dataclass(frozen=True)
class SessionSpec:
    """What makes a session. ``max_active_millis`` of 0 means no limit; otherwise an event that comes more than so long
    after the session's first begins a new one. ``duration`` is an SQL expression over an event that gives a new time to live
    in milliseconds, ``counters`` conditions to be counted, ``state`` updates (name, condition, value) of which the last holds
    and a null one removes the name, ``extensions`` functions from the numbered events to the same with more columns."""

    name: str
    key: str = "si"
    ttl_millis: int = 1_800_000
    max_idle_millis: int = 1_800_000
    max_active_millis: int = 0
    metadata: tuple[str, ...] = ()
    sub_sessions: tuple[SubSessionSpec, ...] = field(default=())
    condition: str = "true"
    duration: str | None = None
    counters: tuple[tuple[str, str], ...] = ()
    state: tuple[tuple[str, str, str], ...] = ()
    extensions: tuple[Callable[[DataFrame], DataFrame], ...] = ()

    @property
    def effective_ttl_millis(self) -> int:
        return min(self.ttl_millis, self.max_idle_millis)

    def validate(self) -> list[str]:
        """What is wrong with the specification; empty if nothing is."""
        names = [s.name for s in self.sub_sessions]
        checks = [
            (bool(self.name), "a session needs a name"),
            (bool(self.key), "a session needs a key"),
            (self.ttl_millis > 0, "the time to live must be positive"),
            (self.max_idle_millis > 0, "the longest idle time must be positive"),
            (self.max_active_millis >= 0, "the longest active time must not be negative"),
            (not self.max_active_millis or self.max_active_millis >= self.effective_ttl_millis, "the longest active time must not be below the time to live"),
            (len(set(self.metadata)) == len(self.metadata), "metadata names must differ"),
            (len(set(names)) == len(names), "sub-session names must differ"),
            (all(names), "a sub-session needs a name"),
            (all(s.key for s in self.sub_sessions), "a sub-session needs a key"),
            (all(s.ttl_millis > 0 for s in self.sub_sessions), "a sub-session's time to live must be positive"),
            (all(s.ttl_millis <= self.effective_ttl_millis for s in self.sub_sessions), "a sub-session's time to live must not be above the session's"),
            (self.name not in names, "a sub-session must not have the session's name"),
        ]
        return [message for ok, message in checks if not ok]


def sessionized(events: DataFrame, keys: Sequence[str], ttl_millis: int | Column, order: Sequence[str] = ("us", "event_id")) -> DataFrame:
    """Each event with its session's number within the key (``session_no``) and its own within the session (``event_no``).

    The time to live may be a Column of the earlier event, for rules that change it."""
    by_key = Window.partitionBy(*keys).orderBy(*order)
    ttl = F.lit(ttl_millis).cast("long") if isinstance(ttl_millis, int) else ttl_millis.cast("long")
    expiry = F.lag(F.col("us") + ttl * 1000).over(by_key)
    starts = events.withColumn("_new", (expiry.isNull() | (F.col("us") >= expiry)).cast("long"))
    numbered = starts.withColumn("session_no", F.sum("_new").over(by_key)).drop("_new")
    return numbered.withColumn("event_no", F.row_number().over(Window.partitionBy(*keys, "session_no").orderBy(*order)).cast("long"))


def _duration(first: Column, last: Column, n: Column) -> Column:
    return F.when(n > 1, last - first).otherwise(F.lit(0))


def session_table(events: DataFrame, ttl_millis: int, key: str = "si") -> DataFrame:
    """Rows (key, snst_ms, snet_ms, sndn_ms, snec), one for each session.

    session_window joins events whose gap equals its length, so its length is the time to live less a microsecond; it is
    aggregated before the shuffle, and needs no window function."""
    gap = f"{ttl_millis * 1000 - 1} microseconds"
    found = events.groupBy(key, F.session_window("ts", gap).alias("w")).agg(F.min("us").alias("lo"), F.max("us").alias("hi"), F.count("*").alias("snec"))
    first, last = (F.expr(f"{c} div 1000") for c in ("lo", "hi"))
    return found.select(key, first.alias("snst_ms"), last.alias("snet_ms"), _duration(first, last, F.col("snec")).alias("sndn_ms"), "snec")


def fold_starts(events: DataFrame, keys: Sequence[str], ttl_millis: int | None, max_active_millis: int = 0, rule: Column | None = None, max_ttl_millis: int | None = None, inclusive: bool = False) -> DataFrame:
    """Rows (keys, us, event_id) of the events that begin a session, where that depends on the session before.

    ``rule`` is a time to live that an event sets for the rest of its session; one above ``max_ttl_millis`` is ignored. Gaps
    that no time to live spans are cut first, with lag; only what lies between them is folded, in order, inside the JVM. The
    fold keeps where the session began, its last event and its time to live, and copies nothing but at a new session.
    ``inclusive``: an event exactly the longest active time after the first begins a new session too."""
    by_key = Window.partitionBy(*keys).orderBy("us", "event_id")
    longest = max_ttl_millis if rule is not None else ttl_millis
    rows = events.withColumn("_ttl", (F.when(rule <= max_ttl_millis, rule) if rule is not None else F.lit(None)).cast("long"))
    if longest is None:
        rows = rows.withColumn("_piece", F.lit(1).cast("long"))
    else:
        before = F.lag("us").over(by_key)
        cut = (before.isNull() | (F.col("us") >= before + F.lit(longest * 1000).cast("long"))).cast("long")
        rows = rows.withColumn("_cut", cut).withColumn("_piece", F.sum("_cut").over(by_key)).drop("_cut")
    ordered = F.sort_array(F.collect_list(F.struct("us", "event_id", "_ttl")))
    default = F.lit(None if ttl_millis is None else ttl_millis).cast("long")
    empty = F.struct(F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("last"), default.alias("ttl"), F.expr("cast(array() as array<struct<us:bigint,event_id:bigint>>)").alias("starts"))

    def step(so_far: Column, e: Column) -> Column:
        new = so_far["first"].isNull()
        if ttl_millis is not None:
            new |= e["us"] >= so_far["last"] + so_far["ttl"] * 1000
        if max_active_millis:
            limit = so_far["first"] + F.lit(max_active_millis * 1000).cast("long")
            new |= (e["us"] >= limit) if inclusive else (e["us"] > limit)
        begin = F.struct(e["us"].alias("us"), e["event_id"].cast("long").alias("event_id"))
        return F.struct(
            F.when(new, e["us"]).otherwise(so_far["first"]).alias("first"),
            e["us"].alias("last"),
            F.coalesce(e["_ttl"], F.when(new, default).otherwise(so_far["ttl"])).alias("ttl"),
            F.when(new, F.concat(so_far["starts"], F.array(begin))).otherwise(so_far["starts"]).alias("starts"),
        )

    folded = rows.groupBy(*keys, "_piece").agg(F.aggregate(ordered, empty, step, lambda x: x["starts"]).alias("s"))
    return folded.select(*keys, F.explode("s").alias("s")).select(*keys, "s.us", "s.event_id")


def numbered_by_starts(events: DataFrame, starts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each event with its session's number within the key and its own within the session."""
    marked = events.join(starts.withColumn("_new", F.lit(1)), [*keys, "us", "event_id"], "left")
    by_key = Window.partitionBy(*keys).orderBy("us", "event_id")
    numbered = marked.withColumn("session_no", F.count("_new").over(by_key)).drop("_new")
    return numbered.withColumn("event_no", F.row_number().over(Window.partitionBy(*keys, "session_no").orderBy("us", "event_id")).cast("long"))


def sessions_with_max_active(events: DataFrame, ttl_millis: int, max_active_millis: int, key: str = "si") -> DataFrame:
    """The same with a longest active time: strict, and checked when an event arrives."""
    found = numbered_by_starts(events, fold_starts(events, [key], ttl_millis, max_active_millis), [key])
    table = found.groupBy(key, "session_no").agg(F.min("us").alias("lo"), F.max("us").alias("hi"), F.count("*").alias("snec"))
    first, last = (F.expr(f"{c} div 1000") for c in ("lo", "hi"))
    return table.select(key, first.alias("snst_ms"), last.alias("snet_ms"), _duration(first, last, F.col("snec")).alias("sndn_ms"), "snec")


def numbered_by_spec(events: DataFrame, spec: SessionSpec) -> DataFrame:
    """The events that a specification selects (its condition, and a key), numbered by its times."""
    problems = spec.validate()
    if problems:
        raise ValueError("; ".join(problems))
    rows = events.filter(F.expr(spec.condition) & F.col(spec.key).isNotNull())
    if spec.duration is None and not spec.max_active_millis:
        found = sessionized(rows, [spec.key], spec.effective_ttl_millis)
    else:
        rule = F.expr(spec.duration).cast("long") if spec.duration else None
        longest = max(spec.max_idle_millis, spec.effective_ttl_millis)
        found = numbered_by_starts(rows, fold_starts(rows, [spec.key], spec.effective_ttl_millis, spec.max_active_millis, rule, longest), [spec.key])
    for extend in spec.extensions:
        found = extend(found)
    return found


def feed_by_spec(events: DataFrame, spec: SessionSpec) -> DataFrame:
    """All that a profile puts out, one row each: profile, key, session_no, kind, identifier, _snid, at, _snst, _snet, _sndn,
    _snec, metadata, counters, state; ``emitted`` orders a session's rows as they are emitted.

    A begin marker comes before the first event, an event after the begin and end of what it begins or ends, the ends of
    sub-sessions before that of the session. ``metadata`` (of the first event), ``counters`` and ``state`` (at the end) are
    maps; null values aren't in them."""
    rows = numbered_by_spec(events, spec)
    key = spec.key
    by_session = [key, "session_no"]
    text = lambda c: F.expr(c).cast("string")
    entries = lambda pairs: F.map_filter(F.map_from_arrays(F.array(*(F.lit(n) for n, _ in pairs)), F.array(*(c for _, c in pairs))), lambda _, v: v.isNotNull()) if pairs else F.expr("cast(map() as map<string,string>)")
    first = F.struct("us", "event_id")
    held = rows.groupBy(*by_session).agg(
        F.min("us").alias("lo"),
        F.max("us").alias("hi"),
        F.count("*").alias("_snec"),
        entries([(m, F.min_by(text(m), first)) for m in spec.metadata]).alias("metadata"),
        entries([(n, F.count_if(F.expr(c)).cast("string")) for n, c in spec.counters]).alias("counters"),
        # the last update of each name holds, whether it is null or not
        entries([(n, F.max_by(text(v), F.when(F.expr(c), first))) for n, c, v in spec.state]).alias("state"),
    )
    none = F.expr("cast(null as map<string,string>)")
    start, end = F.expr("lo div 1000"), F.expr("hi div 1000")
    identity = session_id(F.col(key), start)
    null = F.lit(None).cast("long")
    columns = lambda kind, place, at, ident, snid, *rest: [F.lit(spec.name).alias("profile"), F.col(key), F.col("session_no"), F.lit(kind).alias("kind"), F.struct(at.alias("at"), F.lit(place).alias("place")).alias("emitted"), ident.alias("identifier"), snid.alias("_snid"), *(c.alias(n) for c, n in zip(rest, ("_snst", "_snet", "_sndn", "_snec", "metadata", "counters", "state"), strict=True))]
    begins = held.select(*columns("begin", 0, F.col("lo"), F.lit(None).cast("string"), identity, start, null, null, null, F.col("metadata"), none, none))
    ends = held.select(*columns("end", 4, F.col("hi"), F.lit(None).cast("string"), identity, start, end, _duration(start, end, F.col("_snec")), F.col("_snec"), F.col("metadata"), F.col("counters"), F.col("state")))
    plain = rows.join(held.select(*by_session, "lo"), by_session)
    events_out = plain.select(*columns("event", 2, F.col("us"), F.col("event_id").cast("string"), identity, start, null, null, F.col("event_no"), none, none, none))
    out = begins.unionByName(events_out).unionByName(ends)
    for sub in spec.sub_sessions:
        found = sub_sessions(rows, sub, key)
        begin, finish = (F.expr(f"{c} * 1000") for c in ("_snst", "_snet"))
        ident = F.concat_ws(":", F.lit(sub.name), F.col("identifier").cast("string"))
        out = out.unionByName(found.select(*columns("sub_begin", 1, begin, ident, F.col("_snid"), F.col("_snst"), null, null, null, none, none, none)))
        out = out.unionByName(found.select(*columns("sub_end", 3, finish, ident, F.col("_snid"), F.col("_snst"), F.col("_snet"), F.col("_sndn"), F.col("_snec"), none, none, none)))
    return out


def contains(variables: Column, name: str) -> Column:
    """Whether a session's variables have a name."""
    return F.map_contains_key(variables, name)


def with_prefix(variables: Column, prefix: str) -> Column:
    """The variables whose names begin so."""
    return F.map_filter(variables, lambda k, _: k.startswith(prefix))


def as_long(variables: Column, name: str) -> Column:
    return F.try_element_at(variables, F.lit(name)).try_cast("long")


def begin_events(numbered: DataFrame, metadata: Sequence[str], key: str = "si") -> DataFrame:
    """The begin marker of each session: its id, its start, and the metadata of its first event."""
    ct = F.expr("us div 1000")
    return numbered.filter("event_no = 1").select(session_id(F.col(key), ct).alias("_snid"), ct.alias("_snst"), key, *metadata)


def end_events(numbered: DataFrame, metadata: Sequence[str], key: str = "si") -> DataFrame:
    """The end marker of each session: also its end, duration and number of events. Nulls of the first event stay null."""
    first = F.min_by(F.struct(*metadata), F.struct("us", "event_id")) if metadata else F.lit(None)
    found = numbered.groupBy(key, "session_no").agg(F.expr("min(us) div 1000").alias("_snst"), F.expr("max(us) div 1000").alias("_snet"), F.count("*").alias("_snec"), first.alias("m"))
    n = F.col("_snec")
    return found.select(session_id(F.col(key), F.col("_snst")).alias("_snid"), "_snst", "_snet", _duration(F.col("_snst"), F.col("_snet"), n).alias("_sndn"), "_snec", key, *(F.col(f"m.{c}").alias(c) for c in metadata))


def counters(numbered: DataFrame, conditions: Mapping[str, Column], key: str = "si") -> DataFrame:
    """For each session how many events meet each condition."""
    return numbered.groupBy(key, "session_no").agg(*(F.count_if(c).alias(n) for n, c in conditions.items()))


def last_state(numbered: DataFrame, attributes: Sequence[str], key: str = "si") -> DataFrame:
    """For each session the attributes of its last event."""
    found = numbered.groupBy(key, "session_no").agg(F.max_by(F.struct(*attributes), F.struct("us", "event_id")).alias("m"))
    return found.select(key, "session_no", *(F.col(f"m.{a}").alias(a) for a in attributes))


def appended_state(numbered: DataFrame, value: Column, unique: bool = True, max_length: int = 0, key: str = "si") -> DataFrame:
    """For each session the list of a value in order; nulls are ignored; unique keeps first occurrences; beyond the
    longest length the oldest go.

    Only what stays is gathered: a value's first occurrence, and of these the last ``max_length``."""
    order = F.struct("us", "event_id")
    rows = numbered.select(key, "session_no", order.alias("o"), value.cast("string").alias("v"))
    some = rows.filter(F.col("v").isNotNull())
    if unique:
        some = some.groupBy(key, "session_no", "v").agg(F.min("o").alias("o"))
    if max_length:
        newest = Window.partitionBy(key, "session_no").orderBy(F.desc("o"))
        some = some.withColumn("_i", F.row_number().over(newest)).filter(F.col("_i") <= max_length).drop("_i")
    lists = some.groupBy(key, "session_no").agg(F.transform(F.sort_array(F.collect_list(F.struct("o", "v"))), lambda x: x["v"]).alias("values"))
    return rows.select(key, "session_no").distinct().join(lists, [key, "session_no"], "left").withColumn("values", F.coalesce("values", F.expr("cast(array() as array<string>)")))


def sub_sessions(numbered: DataFrame, spec: SubSessionSpec, key: str = "si") -> DataFrame:
    """Sessions by a second key inside each session; they end with it at the latest."""
    inner = numbered.filter(F.col(spec.key).isNotNull()).drop("event_no").withColumnRenamed("session_no", "main_no")
    found = sessionized(inner, [key, "main_no", spec.key], spec.ttl_millis)
    found = found.groupBy(key, "main_no", F.col(spec.key), "session_no").agg(F.expr("min(us) div 1000").alias("first"), F.expr("max(us) div 1000").alias("last"), F.count("*").alias("n"))
    identity = session_id(F.concat(F.col(key), F.col(spec.key)), F.col("first"))
    return found.select(F.lit(spec.name).alias("name"), key, F.col("main_no").alias("session_no"), F.col(spec.key).alias("identifier"), identity.alias("_snid"), F.col("first").alias("_snst"), F.col("last").alias("_snet"), _duration(F.col("first"), F.col("last"), F.col("n")).alias("_sndn"), F.col("n").alias("_snec"))


def statistics(sessions: DataFrame, long_millis: int = 1_800_000) -> DataFrame:
    """One row over a session table: how many, how many of one event, short and long, and the mean duration of the others."""
    single = F.col("snec") == 1
    many = F.count_if(~single)
    return sessions.agg(
        F.count("*").alias("created"),
        F.count_if(single).alias("single_click"),
        F.count_if(~single & (F.col("sndn_ms") <= long_millis)).alias("short_sessions"),
        F.count_if(~single & (F.col("sndn_ms") > long_millis)).alias("long_sessions"),
        F.coalesce(F.expr("sum(CASE WHEN snec > 1 THEN sndn_ms END)"), F.lit(0)).alias("_sum"),
        many.alias("_many"),
    ).select("created", "single_click", "short_sessions", "long_sessions", F.expr("CASE WHEN _many = 0 THEN 0 ELSE _sum div _many END").alias("avg_duration_ms"))


def sub_statistics(subs: DataFrame) -> DataFrame:
    """How many sub-sessions of each name there are, how many of one event, and the mean duration of the others."""
    many = F.count_if(F.col("_snec") > 1)
    found = subs.groupBy("name").agg(F.count("*").alias("created"), F.count_if(F.col("_snec") == 1).alias("single_click"), F.coalesce(F.sum(F.when(F.col("_snec") > 1, F.col("_sndn"))), F.lit(0)).alias("_sum"), many.alias("_many"))
    return found.select("name", "created", "single_click", F.expr("CASE WHEN _many = 0 THEN 0 ELSE _sum div _many END").alias("avg_duration_ms"))


def lag_statistics(events: DataFrame, produced_millis: Column, received_millis: Column) -> DataFrame:
    """One row: the mean and the longest time between an event's making and its arrival."""
    lag = received_millis - produced_millis
    return events.agg(F.count(lag).alias("n"), F.coalesce(F.sum(lag), F.lit(0)).alias("_sum"), F.max(lag).alias("max_lag_ms")).select("n", F.expr("CASE WHEN n = 0 THEN 0 ELSE _sum div n END").alias("avg_lag_ms"), "max_lag_ms")


def decorated(numbered: DataFrame, key: str = "si") -> DataFrame:
    """Each event with its session's id and, so far, its number of events and the kinds of events met, joined by commas."""
    so_far = Window.partitionBy(key, "session_no").orderBy("us", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    start = F.expr("us div 1000")
    first = F.first(start).over(so_far)
    kinds = F.array_join(F.sort_array(F.collect_set("et").over(so_far)), ",")
    return numbered.select("event_id", key, session_id(F.col(key), first).alias("_snid"), F.col("event_no").alias("events_so_far"), kinds.alias("kinds"))
