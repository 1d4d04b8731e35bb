"""Boundary, property and streaming tests of the event engine."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import device, geo, scalars
from tidemark.operators import ingest, metrics, routing, sessions, store
from tidemark.plans.metric_query import MetricQuery
from tidemark.sources import readers
from tidemark.streaming import pipelines

SECOND = 1_000_000


def frame(spark, rows):
    df = spark.createDataFrame([(k, us, i) for i, (k, us) in enumerate(rows)], "si string, us long, event_id long")
    return df.withColumn("ts", F.timestamp_micros("us"))


def plain(rows, ttl, most=None):
    """Sessions by a loop: (key, first, last, number)."""
    out = []
    for key in sorted({k for k, _ in rows}):
        for us in sorted(us for k, us in rows if k == key):
            last = out[-1] if out and out[-1][0] == key else None
            if last is None or us >= last[2] + ttl or most is not None and us > last[1] + most:
                out.append([key, us, us, 1])
            else:
                last[2], last[3] = us, last[3] + 1
    return sorted((k, a // 1000, b // 1000, n) for k, a, b, n in out)


def table(df):
    return sorted((r.si, r.snst_ms, r.snet_ms, r.snec) for r in df.collect())


def test_gap_equal_to_ttl_starts_a_session(spark):
    rows = [("a", 0), ("a", 60 * SECOND - 1), ("a", 120 * SECOND - 1), ("b", 5)]
    assert table(sessions.session_table(frame(spark, rows), 60_000)) == plain(rows, 60 * SECOND) == [("a", 0, 59999, 2), ("a", 119999, 119999, 1), ("b", 0, 0, 1)]


def test_max_active_is_strict_and_checked_on_arrival(spark):
    rows = [("a", n * 10 * SECOND) for n in range(8)]
    got = table(sessions.sessions_with_max_active(frame(spark, rows), 60_000, 30_000))
    assert got == plain(rows, 60 * SECOND, 30 * SECOND) and [r[3] for r in got] == [4, 4]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 600).map(lambda n: n * SECOND // 3)), min_size=1, max_size=40))
def test_three_forms_agree(spark, rows):
    df = frame(spark, rows)
    want = plain(rows, 20 * SECOND)
    assert table(sessions.session_table(df, 20_000)) == want
    assert table(sessions.sessions_with_max_active(df, 20_000, 10**9)) == want
    numbered = sessions.sessionized(df, ["si"], 20_000)
    assert sorted((r.si, r._snst, r._snet, r._snec) for r in sessions.end_events(numbered, []).collect()) == want


def test_session_id_and_duration(spark):
    rows = [("u", 1_704_067_200_123_000), ("u", 1_704_067_201_123_000)]
    end = sessions.end_events(sessions.sessionized(frame(spark, rows), ["si"], 60_000), []).first()
    assert end._snid == "u" + f"{1_704_067_200_123:016x}" and end._sndn == 1000
    single = sessions.end_events(sessions.sessionized(frame(spark, rows[:1]), ["si"], 60_000), []).first()
    assert single._sndn == 0 and single._snec == 1


def test_appended_state_evicts_the_oldest(spark):
    df = sessions.sessionized(frame(spark, [("a", n) for n in range(6)]), ["si"], 60_000)
    value = F.element_at(F.array(*map(F.lit, ["x", "y", "x", None, "z", "w"])), (F.col("event_id") + 1).cast("int"))
    assert sessions.appended_state(df, value, True, 2).first()["values"] == ["z", "w"]
    assert sessions.appended_state(df, value, False, 0).first()["values"] == ["x", "y", "x", "z", "w"]


def test_spec_validation():
    sub = sessions.SubSessionSpec("s", "k", 60_000)
    assert sessions.SessionSpec("m", sub_sessions=(sub,)).validate() == []
    wrong = sessions.SessionSpec("", "", 0, -1, -5, ("a", "a"), (sub, sub, sessions.SubSessionSpec("", "", 0)))
    assert len(wrong.validate()) >= 10


def test_mandatory_key_may_be_null(spark):
    bodies = spark.createDataFrame([('{"si":null}',), ('{"x":1}',), ("[1",), ('{"si":"a","ct":5}',)], "body string")
    assert ingest.accepted(bodies, ["si"]).count() == 2
    assert sorted(r.detail for r in ingest.rejected(bodies, ["si"]).collect()) == ["not a JSON object", "si is mandatory"]


def test_device_and_geo(spark):
    agents = spark.createDataFrame([("Mozilla/5.0 (iPad; CPU OS 16_2 like Mac OS X) Version/16.2 Mobile/1 Safari/604",), (None,), ("curl",)], "ua string")
    got = [r.d.asDict() for r in agents.select(device.device_info(F.col("ua")).alias("d")).collect()]
    assert got[0]["category"] == "Tablet" and got[0]["os"] == "iOS" and got[0]["os_version"] == "16.2" and got[0]["agent_family"] == "Safari"
    assert got[1]["os"] is None and got[2]["agent_family"] is None
    blocks = spark.createDataFrame([(10 << 24, (10 << 24) + 70000, "A")], "first long, last long, country string")
    rows = spark.createDataFrame([("10.0.0.0",), ("10.1.17.111",), ("10.1.17.113",), (None,), ("x",)], "ipv4 string")
    got = {r.ipv4: r.geo for r in geo.with_location(rows, blocks).collect()}
    assert got["10.0.0.0"].country == "A" == got["10.1.17.111"].country and got["10.1.17.113"] is None
    assert got[None].country is None and got[None] is not None and got["x"] is None


def test_literal_split_keeps_empty_tokens(spark):
    df = spark.createDataFrame([("a.b..",)], "s string")
    assert df.select(scalars.split_literal(F.col("s"), ".").alias("p")).first().p == ["a", "b", "", ""]


def test_threshold_loses_the_remainder(spark):
    marks = spark.createDataFrame([("m", 1, 1), ("m", 2, 2), ("m", 3, 5)], "metricname string, t int, total long")
    assert [r.delta for r in metrics.delta_counter(marks, ["metricname"], "t", "total", 1).collect()] == [3]


def test_replay_rules(spark):
    failed = spark.createDataFrame([(1, 0, None, "x"), (2, 90_000, None, "x"), (3, 0, -90_000_000, "x")], "id int, produced long, first_replay long, transport string")
    due = routing.due_for_replay(failed, F.lit(100_000)).collect()
    assert [(r.id, r.first_replay, r.replayed) for r in due] == [(1, 100_000, True)] and "transport" not in due[0]


def test_query_dispatch():
    assert MetricQuery("country_group", "n").condition() is None
    with pytest.raises(ValueError):
        MetricQuery("top_group").condition()
    with pytest.raises(ValueError):
        MetricQuery("geo_device", "n").run(None)
    q = MetricQuery.from_parameters("group", {"METRICNAME": "m", "startTime": "61000", "endtime": "180001", "metrictime": "61000"})
    assert (q.start, q.end, q.time) == (60_000, 180_000, 61_000)


def test_store_merges_a_batch_once(spark, tmp_path):
    s = store.MetricStore(spark, str(tmp_path))
    batch = spark.createDataFrame([("a", 1, 5)], "metricname string, metrictime long, value long")
    assert s.merge("t", batch, 0, ["metricname", "metrictime"], additive=True)
    assert not s.merge("t", batch, 0, ["metricname", "metrictime"], additive=True)
    assert s.merge("t", batch, 1, ["metricname", "metrictime"], additive=True)
    assert s.read("t").collect()[0].value == 10 and s.read("none") is None


def test_generator_is_repeatable(spark):
    a, b = (sorted(map(tuple, readers.generated(spark, 50).collect())) for _ in range(2))
    assert a == b and len({r[0] for r in a}) > 5
    assert readers.volume(0) == 2 and readers.volume(30) > readers.volume(10)


def test_json_source_keeps_broken_lines(spark, tmp_path):
    (tmp_path / "e.json").write_text(json.dumps({"si": "a", "ct": 1}) + "\n{oops\n")
    from tidemark.schemas import RAW_EVENT

    rows = readers.json_events(spark, str(tmp_path / "e.json"), RAW_EVENT).collect()
    assert sorted(r._corrupt_record or "" for r in rows) == ["", "{oops"]


def test_streams_equal_batch(spark, tmp_path):
    from tidemark.plans import base, catalog

    d = "/root/testdata/sf0.001"
    events = base.events(spark, d)
    got = sorted((r.start, str(r.country), r["count"]) for r in catalog.queries()["stream_pageviews"](spark, d).collect())
    want = metrics.roll_up(metrics.live_counts(events.fillna("None", ["country"]), ["country"]), ["country"], 300_000)
    assert got == sorted((r.start, r.country, r["count"]) for r in want.collect())
    got = table(catalog.queries()["stream_sessions"](spark, d))
    assert got == table(sessions.session_table(events, 1_800_000))


def test_bounded_stream_equals_batch(spark, tmp_path):
    start = 1_700_000_000 * SECOND
    rows = [("a", start + n * 7 * SECOND) for n in range(30)] + [("b", start + n * 25 * SECOND) for n in range(5)]
    frame(spark, rows).write.parquet(str(tmp_path / "in/part=0"))
    frame(spark, [("z", 4 * 10**9 * SECOND)]).write.parquet(str(tmp_path / "in/part=1"))
    stream = spark.readStream.schema("si string, us long, event_id long, ts timestamp").option("maxFilesPerTrigger", 100).parquet(str(tmp_path / "in/*")).withWatermark("ts", "1 second")
    out = pipelines.drained(pipelines.bounded_session_stream(stream, 20_000, 60_000), "bounded_out", str(tmp_path / "cp"))
    assert table(out.filter("si <> 'z'")) == plain(rows, 20 * SECOND, 60 * SECOND)


def test_a_stream_puts_its_rows_into_files_and_not_into_the_driver(spark, tmp_path):
    rows = [("a", n * 7 * SECOND) for n in range(30)] + [("b", n * 25 * SECOND) for n in range(5)]
    run = lambda: pipelines.drained(pipelines.session_stream(spark.readStream.schema("si string, us long, event_id long, ts timestamp").parquet(str(tmp_path / "in/*")).withWatermark("ts", "1 second"), 20_000), "files_out", str(tmp_path / "cp"))
    frame(spark, rows).write.parquet(str(tmp_path / "in/part=0"))
    run()
    frame(spark, [("z", 4 * 10**9 * SECOND)]).write.parquet(str(tmp_path / "in/part=1"))
    out = run()  # goes on from the checkpoint
    assert out.columns == ["si", "snst_ms", "snet_ms", "snec"] and out.inputFiles()
    assert table(out.filter("si <> 'z'")) == plain(rows, 20 * SECOND)


def test_last_write_wins_across_batches(spark, tmp_path):
    s = store.MetricStore(spark, str(tmp_path))
    write = lambda value, batch_id, day=0: s.merge("t", spark.createDataFrame([("a", day * store.DAY_MILLIS + 1, value)], "metricname string, metrictime long, value long"), batch_id, ["metricname", "metrictime"])
    assert write(5, 0) and write(3, 1) and not write(9, 1)
    assert s.read("t").collect()[0].value == 3
    assert write(7, 2, day=4) and write(4, 3) and write(2, 4)
    assert sorted(r.value for r in s.read("t").collect()) == [2, 7]
    assert len(s._names("t", "days", "0")) == 2 and s._names("t", "days", "4") == ["v2"]  # only touched days are written
    (tmp_path / "t/days/0/v9").mkdir()  # a version of a batch that was never committed
    assert sorted(r.value for r in s.read("t").collect()) == [2, 7]
    s.expire("t", 2 * store.DAY_MILLIS)
    assert [r.value for r in s.read("t").collect()] == [7]


def test_batch_bodies(spark):
    bodies = spark.createDataFrame([(1, '[{"si":"a"},{"x":1},5,null]'), (2, '{"si":"b"}'), (3, "[oops"), (4, "[]"), (5, None)], "id int, body string")
    items = ingest.accepted(ingest.batch_items(bodies), ["si"]).collect()
    assert sorted((r.id, r.item, json.loads(r.body)["si"]) for r in items) == [(1, 0, "a"), (2, 0, "b")]
    answers = {r.id: r for r in ingest.batch_answers(bodies, "id", ["si"]).collect()}
    assert [answers[i].status for i in (1, 2, 3, 5)] == [400, 200, 400, 400] and 4 not in answers
    assert [f["item"] for f in json.loads(answers[1].failures)] == [1, 2, 3]


def test_one_key_with_many_events_folds_in_linear_time(spark):
    import time

    def run(n):
        rows = spark.range(n).select(F.lit("a").alias("si"), (F.col("id") * 10 * SECOND).alias("us"), F.col("id").alias("event_id"))
        start = time.time()
        got = sessions.sessions_with_max_active(rows, 60_000, 1_000_000).agg(F.sum("snec"), F.count("*")).first()
        assert got[0] == n and got[1] == -(-n // 101)
        return time.time() - start

    run(1000)
    assert run(200_000) < 60


def test_spec_rejects_what_is_wrong(spark):
    with pytest.raises(ValueError):
        sessions.numbered_by_spec(frame(spark, [("a", 1)]), sessions.SessionSpec("x", ttl_millis=0))


def test_rule_above_the_longest_is_ignored(spark):
    df = frame(spark, [("a", 0), ("a", 30 * SECOND), ("a", 80 * SECOND)]).withColumn("rule", F.when(F.col("event_id") == 0, F.lit(40_000)).when(F.col("event_id") == 1, F.lit(10**9)))
    starts = sessions.fold_starts(df, ["si"], 20_000, rule=F.col("rule"), max_ttl_millis=60_000)
    assert sorted(r.us for r in starts.collect()) == [0, 80 * SECOND]  # the first event's 40 s hold on


def test_stop_alerts_are_apart(spark):
    df = spark.createDataFrame([(n * 100 * SECOND,) for n in range(8)], "us long")
    assert sorted(r.us // SECOND for r in routing.stop_alerts(df).collect()) == [0, 300, 600]


def test_addresses_are_checked(spark):
    got = spark.createDataFrame([("1.2.3.4",), ("999.1.1.1",), ("1.2.3",), (None,)], "ip string").select(geo.ip_number(F.col("ip")).alias("n")).collect()
    assert [r.n for r in got] == [16909060, None, None, None]


def test_feeds_have_all_columns():
    assert len(routing.SESSION_FEED) == 15 and len(routing.EVENT_FEED) + 1 == 32


def test_delivery_of_a_micro_batch(spark, tmp_path):
    got = []
    sinks = {"a": lambda df: got.append(("a", df.count())), "b": lambda df: got.append(("b", df.count()))}
    deliver = routing.delivering(lambda batch: {"all": batch, "some": batch.filter("id > 7")}, sinks, {"all": ["a", "b"], "some": ["b"]})
    deliver(spark.range(10).toDF("id"), 0)
    assert got == [("a", 10), ("b", 10), ("b", 2)]
    routing.fan_out({"x": spark.range(3).toDF("id")}, sinks)
    assert got[3:] == [("a", 3), ("b", 3)]


def test_sources_of_tweets_and_rates(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps({"country": "X", "lang": "en", "user": "u", "hashtag": "a,b", "ct": 5, "text": "t"}))
    assert readers.tweets(spark, str(tmp_path / "t.json")).first().hashtag == "a,b"
    load = readers.load(spark, 0, 60).collect()
    assert len(load) == sum(int(readers.volume(s)) for s in range(60)) and len({r.ct // 1000 for r in load}) == 60


def test_shared_folder_needs_a_local_master(spark):
    from types import SimpleNamespace

    from tidemark.sources.shared import shared_folder

    far = SimpleNamespace(sparkContext=SimpleNamespace(master="yarn", applicationId="x", getConf=lambda: SimpleNamespace(get=lambda *a: None)))
    with pytest.raises(ValueError):
        shared_folder(far, "x")
