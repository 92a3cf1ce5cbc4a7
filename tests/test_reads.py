"""Paged reads, plans and streams over stored tables."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from skyledger.operators import analysis, dedupe, reads
from skyledger.sources.tables import EVENT_SCHEMA, Tables
from skyledger.streaming.intake_stream import file_stream, message_stream

START = dt.datetime(2026, 9, 1, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """5,000 events of 25 devices, one a minute."""
    store = Tables(spark, str(tmp_path_factory.mktemp("store")))
    i = F.col("id")
    rows = spark.range(5000).select(
        F.concat(F.lit("evt-"), i).alias("event_id"), F.lit("derived").alias("id_kind"),
        F.concat(F.lit("DRONE-"), F.lpad((i % 25 + 1).cast("string"), 3, "0")).alias("drone_id"),
        (F.lit(START) + F.make_dt_interval(mins=i.cast("int"))).alias("event_time"),
        F.lit("SENSOR_READING").alias("event_type"), F.lit(200).alias("status_code"),
        F.when(i % 20 == 0, "error").when(i % 7 == 0, "warning").otherwise("info").alias("severity"),
        (100 - (i * 3) % 95).cast("decimal(5,2)").alias("battery_pct"),
        F.lit(54.5).alias("latitude"), F.lit(-5.9).alias("longitude"),
        F.concat(F.lit('{"altitudeM":'), 40 + i % 90, F.lit(',"tags":["a",{"n":'), i % 3, F.lit("}]}")).alias("telemetry"),
        F.lit("{}").alias("raw"), F.lit("s").alias("source"), F.lit("b").alias("batch_id"), F.lit(0).cast("bigint").alias("batch_seq"),
    )
    store.write_events(rows, "seed", F.lit(START))
    return store


def walk(read, *args, **kwargs):
    seen, cursor, pages = [], None, 0
    while True:
        page = reads.page(read, *args, cursor=cursor, **kwargs)
        seen += [(r.event_time, r.event_id) for r in page.items]
        cursor, pages = page.next_cursor, pages + 1
        if cursor is None:
            return seen, pages


def test_pages_cover_everything_once(tables):
    seen, pages = walk(reads.device_events, tables.events(), "DRONE-007", limit=60)
    assert len(seen) == len(set(seen)) == 200 and pages == 4
    assert seen == sorted(seen, reverse=True)


def test_errors_window_and_bad_cursors(tables):
    assert reads.errors_in_window(tables.events(), limit=1000).count() == 250
    end = START + dt.timedelta(minutes=200)
    rows = reads.errors_in_window(tables.events(), start=START + dt.timedelta(minutes=20), end=end, limit=1000).collect()
    assert [r.event_id for r in rows] == [f"evt-{i}" for i in range(180, 0, -20)]
    assert rows[0].battery_pct == 35.0 and json.loads(rows[0].telemetry)["altitudeM"] == 40
    for bad in ("", "%%%", "abc", "bm90YWRhdGV8MQ", reads.Cursor(START, "x").encode()[:10]):
        assert reads.Cursor.decode(bad) is None
    odd = reads.Cursor(START, "a|b/+é" * 20)
    assert reads.Cursor.decode(odd.encode()) == odd


def test_plans(tables):
    spark = tables.spark

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    cursor = reads.Cursor(START + dt.timedelta(days=2), "evt-9")
    text = plan(reads.device_events(tables.events(), "DRONE-001", cursor=cursor, limit=51))
    assert "TakeOrderedAndProject" in text and "EqualTo(drone_id,DRONE-001)" in text
    assert "Or(LessThan(event_time" in text and "PartitionFilters" in text and "raw" not in text.split("ReadSchema")[1]
    text = plan(reads.errors_in_window(tables.events(), start=START, end=START + dt.timedelta(days=1)))
    filters = text.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "severity" in filters and "event_date" in filters
    rows = spark.range(10).select(F.lit("k").alias("event_id"), F.struct("id").alias("ord"))
    assert "Window" not in plan(dedupe.across_batches(rows))


def test_containment(tables):
    events = tables.events()
    assert reads.containing(events, {"altitudeM": 40}).count() == 56
    assert reads.containing(events, {"altitudeM": "40"}).count() == 0
    assert reads.containing(events, {"tags": [{"n": 1}]}).count() == 1667
    assert reads.containing(events, {"tags": ["a", "b"]}).count() == 0
    assert reads.containing(events, {}).count() == analysis.event_count(events).collect()[0].n == 5000


def test_hot_key_is_reduced_before_the_shuffle(spark):
    rows = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("event_id"),
        F.struct("id").alias("ord"),
    )
    out = dedupe.across_batches(rows)
    assert out.count() == 20_001 and out.where("event_id = 'hot'").collect()[0].ord.id == 0


RECORD = {"timestamp": "2026-09-01T10:00:00Z", "eventType": "TAKEOFF"}


def test_streams_store_once_over_restarts(spark, tmp_path, now):
    store = Tables(spark, str(tmp_path / "store"))
    drop, bodies = tmp_path / "drop", tmp_path / "bodies"
    drop.mkdir()
    bodies.mkdir()

    def run(writer):
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()

    def files():
        run(file_stream(spark, str(drop), store, "files", str(tmp_path / "cp1"), clock=lambda: now))

    (drop / "a b.csv").write_text("droneId,timestamp,eventType\nD1,2026-09-01T10:00:00Z,TAKEOFF\nD2,x,TAKEOFF\n")
    files()
    (drop / "c.ndjson").write_text("".join(json.dumps({**RECORD, "droneId": d}) + "\n" for d in ("D1", "D3")))
    files()
    assert {r.drone_id for r in store.events().collect()} == {"D1", "D3"}

    body = json.dumps([{**RECORD, "droneId": "D3"}, {**RECORD, "droneId": "D4"}])
    (bodies / "m.json").write_text(json.dumps({"message_id": "m", "body": body}) + "\n")
    stream = spark.readStream.schema("message_id string, body string").json(str(bodies))
    run(message_stream(stream, store, "queue", str(tmp_path / "cp2"), clock=lambda: now))
    assert store.events().count() == 3
    out = {r.ingest_batch: (r.received, r.inserted, r.duplicates, r.quarantined) for r in store.outcomes().collect()}
    assert out == {"files-0": (2, 1, 0, 1), "files-1": (2, 1, 1, 0), "queue-0": (2, 1, 1, 0)}


def test_empty_store_has_its_columns(spark, tmp_path):
    store = Tables(spark, str(tmp_path / "none"))
    assert store.events().columns == spark.createDataFrame([], EVENT_SCHEMA).columns
    assert analysis.failing_fields(store.quarantine().withColumnRenamed("raw_payload", "p")).count() == 0


def test_containment_of_odd_keys_and_large_integers(spark):
    rows = [
        ('{"é":1}', {"é": 1}, True), ('{"a\\"b":[1]}', {'a"b': [1]}, True), ('{"$.x":{"[0]":null}}', {"$.x": {"[0]": None}}, True),
        ('{"n":9007199254740993}', {"n": 9007199254740992}, False), ('{"n":9007199254740993}', {"n": 9007199254740993}, True),
        ('{"n":2.0}', {"n": 2}, True), ('{"n":2.5}', {"n": 2}, False), ('{"n":true}', {"n": 1}, False), ('{"n":[1,{"m":false}]}', {"n": [{"m": False}, 1]}, True),
    ]
    for text, wanted, found in rows:
        df = spark.createDataFrame([(text,)], "telemetry string")
        assert (reads.containing(df, wanted).count() == 1) is found, (text, wanted)


def test_a_failed_message_is_tried_again(spark, tmp_path, now):
    """One file comes late, one never does."""
    from skyledger.operators.accounting import dead_letters

    store = Tables(spark, str(tmp_path / "store"))
    record = {"droneId": "U1", "timestamp": "2026-09-01T10:00:00Z", "eventType": "TAKEOFF"}
    notice = lambda key: json.dumps({"Records": [{"s3": {"bucket": {"name": "in"}, "object": {"key": key}}}]})
    (tmp_path / "in").mkdir()
    drop = str(tmp_path / "drop")
    schema = "message_id string, body string"

    def run(*messages):
        spark.createDataFrame(messages, schema).write.mode("append").parquet(drop)
        stream = spark.readStream.schema(schema).parquet(drop)
        writer = message_stream(stream, store, "s", str(tmp_path / "ck"), template=f"{tmp_path}/{{bucket}}/{{key}}", clock=lambda: now)
        writer.trigger(availableNow=True).start().awaitTermination()

    run(("late", notice("late.ndjson")), ("never", notice("never.ndjson")))
    assert store.events().count() == 0
    (tmp_path / "in" / "late.ndjson").write_text(json.dumps(record) + "\n")
    run(("x1", json.dumps({**record, "droneId": "U2"})))
    assert store.events().count() == 2 and dead_letters(store.outcomes()).count() == 0
    for i in (2, 3):
        run((f"x{i}", json.dumps({**record, "droneId": f"V{i}"})))
    assert [r.batch_id for r in dead_letters(store.outcomes()).collect()] == ["never"]
    assert store.outcomes().where("batch_id = 'never'").count() == 3


def put(store, batch, rows=6, days=3):
    """Write events of a batch, as an intake does."""
    made = store.spark.range(rows).select(
        F.concat(F.lit(f"e{batch}-"), F.col("id")).alias("event_id"), F.lit("derived").alias("id_kind"), F.lit("D").alias("drone_id"),
        (F.lit(START) + F.make_dt_interval(days=(F.col("id") % days).cast("int"))).alias("event_time"),
        F.lit("TAKEOFF").alias("event_type"), F.lit(1).alias("status_code"), F.lit("info").alias("severity"),
        F.lit(None).cast("decimal(5,2)").alias("battery_pct"), F.lit(None).cast("double").alias("latitude"), F.lit(None).cast("double").alias("longitude"),
        F.lit("{}").alias("telemetry"), F.lit("{}").alias("raw"), F.lit("s").alias("source"), F.lit("b").alias("batch_id"), F.lit(0).cast("bigint").alias("batch_seq"),
    )
    store.heal(batch)
    store.announce(batch)
    store.write_events(made, batch, F.lit(START))
    store.index_batch(batch)


def event_ids(store):
    return sorted(r.event_id for r in store.events().select("event_id").collect())


def indexed_ids(store):
    return sorted({r.event_id for r in store.ids().rows().select("event_id").collect()})


def test_compaction_keeps_ids_and_counts(spark, tmp_path):
    store = Tables(spark, str(tmp_path / "store"))
    for batch in range(4):
        put(store, f"b{batch}")
    ids = sorted(r.event_id for r in store.events().select("event_id").collect())
    for _ in range(2):
        store.compact(dt.date(2026, 9, 3))
        assert sorted(r.event_id for r in store.events().select("event_id").collect()) == ids
        batches = {(str(r.event_date), r.ingest_batch.split("-")[0]) for r in store.events().select("event_date", "ingest_batch").distinct().collect()}
        assert batches == {("2026-09-01", "compacted"), ("2026-09-02", "compacted")} | {("2026-09-03", f"b{i}") for i in range(4)}


class Broken(Exception):
    pass


@pytest.mark.parametrize("step", ["written", "listed", "first move", "moved", "indexed", "first delete", "deleted"])
def test_a_compaction_that_breaks_off_loses_nothing(spark, tmp_path, monkeypatch, step):
    """Break off at each step, store late events of the same dates, and go on."""
    from skyledger.sources.folders import Folders

    store = Tables(spark, str(tmp_path / "store"))
    put(store, "b0")
    put(store, "b1")
    wanted = event_ids(store)
    real = {name: getattr(Folders, name) for name in ("write_lines", "move", "delete")}
    seen = {"moves": 0, "deletes": 0}

    def write_lines(self, path, lines):
        if step == "written" and path.endswith("/replaces"):
            raise Broken
        real["write_lines"](self, path, lines)
        if step == "listed" and path.endswith("/replaces"):
            raise Broken

    def move(self, source, target):
        real["move"](self, source, target)
        if target.startswith("telemetry_events/"):
            seen["moves"] += 1
            if step == "first move" or step == "moved" and seen["moves"] == 2:
                raise Broken

    def delete(self, path):
        if step == "indexed" and path.startswith("_unindexed/"):
            raise Broken
        real["delete"](self, path)
        if path.startswith("telemetry_events/") and "part-" in path:
            seen["deletes"] += 1
            if step == "first delete" or step == "deleted" and seen["deletes"] == 4:
                raise Broken

    for name, value in (("write_lines", write_lines), ("move", move), ("delete", delete)):
        monkeypatch.setattr(Folders, name, value)
    with pytest.raises(Broken):
        store.compact(dt.date(2026, 9, 3))
    monkeypatch.undo()
    put(store, "late")
    wanted = sorted(wanted + [f"elate-{i}" for i in range(6)])
    assert event_ids(store) == wanted
    store.compact(dt.date(2026, 9, 3))
    assert event_ids(store) == indexed_ids(store) == wanted
    per_place = store.events().where("event_date < '2026-09-03'").groupBy("event_date").agg(F.countDistinct("ingest_batch").alias("n"))
    assert {r.n for r in per_place.collect()} == {1}
    assert not (tmp_path / "store" / "_compaction").exists() or not list((tmp_path / "store" / "_compaction").iterdir())


def test_a_staged_set_whose_batch_was_written_again_is_thrown_away(spark, tmp_path, monkeypatch):
    from skyledger.sources.folders import Folders

    store = Tables(spark, str(tmp_path / "store"))
    put(store, "b0")
    put(store, "b1")
    real = Folders.write_lines

    def write_lines(self, path, lines):
        real(self, path, lines)
        if path.endswith("/replaces"):
            raise Broken

    monkeypatch.setattr(Folders, "write_lines", write_lines)
    with pytest.raises(Broken):
        store.compact(dt.date(2026, 9, 3))
    monkeypatch.undo()
    monkeypatch.setattr(Tables, "heal", lambda *_: None)
    put(store, "b1", rows=9)  # with another writer's rows in its place
    wanted = event_ids(store)
    monkeypatch.undo()
    store.compact(dt.date(2026, 9, 3))
    assert event_ids(store) == wanted and len(wanted) == 15


def test_known_ids_come_from_the_index(spark, tmp_path):
    store = Tables(spark, str(tmp_path / "store"))
    for batch in ("b0", "b1"):
        put(store, batch, rows=40)
    incoming = spark.createDataFrame(
        [("eb0-1", "derived"), ("eb0-2", "supplied"), ("eb1-3", "supplied"), ("new", "supplied"), ("new2", "derived")], "event_id string, id_kind string"
    )
    days = [dt.date(2026, 9, 1)]
    assert {r.event_id for r in store.ids().known(incoming, "x", days).collect()} == {"eb0-1", "eb0-2", "eb1-3"}
    assert {r.event_id for r in store.ids().known(incoming, "b1", days).collect()} == {"eb0-1", "eb0-2"}
    assert {r.event_id for r in store.ids().known(incoming, "x", []).collect()} == {"eb0-2", "eb1-3"}


def test_known_ids_shuffle_no_stored_row(spark, tmp_path, monkeypatch):
    import skyledger.sources.id_index as module

    store = Tables(spark, str(tmp_path / "store"), id_buckets=16)
    put(store, "b0", rows=400)
    incoming = spark.range(400).select(F.concat(F.lit("eb0-"), "id").alias("event_id"), F.when(F.col("id") % 2 == 0, "supplied").otherwise("derived").alias("id_kind"))
    monkeypatch.setattr(module, "NAMED_IDS", 10)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        known = store.ids().known(incoming, "x", [dt.date(2026, 9, 1)])
        plan = known._jdf.queryExecution().executedPlan().toString()
        assert known.distinct().count() == 400
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Bucketed: true") == 2
    lines = plan.splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    for at, line in enumerate(lines):
        if "FileScan parquet" in line:  # no exchange between a join and its scan of the index
            above = next(i for i in range(at, -1, -1) if "Join" in lines[i] and depth(lines[i]) < depth(line))
            assert not any("Exchange" in x for x in lines[above:at])
    # A few supplied ids are looked up in their buckets only.
    some = store.ids().rows().where(F.col("event_id").isin(["eb0-1", "eb0-2"]))
    read = {p.rsplit("_", 1)[1].split(".")[0] for p in some.select(F.input_file_name().alias("f")).distinct().toPandas().f}
    assert len(read) <= 2 and some.count() == 2
    scan = some._jdf.queryExecution().executedPlan().toString()
    assert "In(event_id" in scan


def test_batches_without_ids_are_indexed_before_the_next_write(spark, tmp_path, now):
    """A batch that broke off between its events and their ids, and a store from before there was an index."""
    from skyledger.sources.folders import Folders

    store = Tables(spark, str(tmp_path / "store"))
    put(store, "b0")
    real, store_index = Tables.index_batch, Tables.index_batch
    Tables.index_batch = lambda *_: None
    try:
        put(store, "broken")
    finally:
        Tables.index_batch = store_index
    assert real is store_index and "ebroken-1" not in indexed_ids(store)
    put(store, "b2")
    assert indexed_ids(store) == event_ids(store)
    files = Folders(spark, store.root)
    files.delete(files.glob("event_ids_b*")[0])
    put(store, "b3")
    assert indexed_ids(store) == event_ids(store)


def test_a_failed_message_is_tried_again_after_a_time(spark, tmp_path, now):
    """On a stream that stays quiet after its first messages."""
    import time

    from skyledger.operators.accounting import dead_letters
    from skyledger.streaming.intake_stream import message_stream

    store, drop, raw = Tables(spark, str(tmp_path / "store")), str(tmp_path / "drop"), tmp_path / "raw"
    raw.mkdir()
    record = json.dumps({"droneId": "D1", "timestamp": "2026-09-01T10:00:00Z", "eventType": "TAKEOFF", "telemetryData": {}})
    (raw / "soon.ndjson").write_text(record + "\n")

    def notice(key):
        return json.dumps({"Records": [{"s3": {"bucket": {"name": "b"}, "object": {"key": key}}}]})

    schema = "message_id string, body string"
    spark.createDataFrame([(k, notice(k)) for k in ("soon.ndjson", "late.ndjson", "never.ndjson")], schema).write.parquet(drop)
    stream = spark.readStream.schema(schema).parquet(drop)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    writer = message_stream(stream, store, "timed", str(tmp_path / "check"), template=f"{raw}/{{key}}", clock=lambda: now, retry_after=dt.timedelta(seconds=2))
    query = writer.trigger(processingTime="1 second").start()
    try:
        end = time.time() + 150
        while time.time() < end and query.exception() is None:
            rows = store.outcomes().groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.max("inserted").alias("inserted")).collect()
            found = {r.batch_id: (r.n, r.inserted) for r in rows}
            if found.get("late.ndjson") == (1, 0):
                (raw / "late.ndjson").write_text(record.replace("D1", "D2") + "\n")
            if found.get("never.ndjson", (0,))[0] == 3:
                break
            time.sleep(0.5)
        time.sleep(3)  # nothing more comes
        assert query.exception() is None
    finally:
        query.stop()
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    rows = store.outcomes().groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.max("inserted").alias("inserted")).collect()
    found = {r.batch_id: (r.n, r.inserted) for r in rows}
    assert found["soon.ndjson"] == (1, 1) and found["never.ndjson"] == (3, 0)
    assert found["late.ndjson"][0] in (2, 3) and found["late.ndjson"][1] == 1
    assert [r.batch_id for r in dead_letters(store.outcomes()).collect()] == ["never.ndjson"]
    assert store.events().count() == 2


def test_pages_open_the_newest_dates_only(spark, tmp_path):
    store = Tables(spark, str(tmp_path / "store"))
    put(store, "b", rows=120, days=40)
    dates = store.event_dates()
    assert len(dates) == 40 and dates == sorted(dates)
    page = reads.device_events(store.events(), "D", limit=5, dates=dates)
    assert [r.event_id for r in page.collect()] == [r.event_id for r in reads.device_events(store.events(), "D", limit=5).collect()]
    opened = store.events().join(page.select("event_id"), "event_id", "left_semi").select("event_date").distinct().count()
    filters = page._jdf.queryExecution().executedPlan().toString().split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert opened == 2 and ">= 2026-10-08" in filters  # one date, then two more
    nobody = reads.device_events(store.events(), "other", limit=5, dates=dates)
    assert nobody.count() == 0
    older = reads.device_events(store.events(), "D", limit=5, dates=dates, cursor=reads.Cursor(START + dt.timedelta(days=10), "a"))
    assert [r.event_id for r in older.collect()] == [r.event_id for r in reads.device_events(store.events(), "D", limit=5, cursor=reads.Cursor(START + dt.timedelta(days=10), "a")).collect()]


def test_alarms_of_a_stream_over_restarts_and_late_outcomes(spark, tmp_path):
    from skyledger.operators.accounting import failure_windows
    from skyledger.streaming.alarm_stream import alarm_stream, stored_windows

    store, drop = Tables(spark, str(tmp_path / "store")), str(tmp_path / "drop")
    minute = lambda m: START + dt.timedelta(minutes=m)
    fail = lambda m, n: [("failed", minute(m)) for _ in range(n)]
    schema = "status string, finished_at timestamp"
    sent = [
        fail(0, 6) + fail(6, 3) + [("processed", minute(7))],  # one bad window
        fail(8, 4),  # a late outcome makes the second one bad: a run, one alarm
        fail(11, 9) + fail(31, 6) + fail(41, 6),  # the run grows; two lone bad windows
        fail(36, 7),  # late: joins the lone windows to a run of three
        fail(16, 2) + fail(26, 6),  # more windows of that run, before it
    ]
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    alarms = []
    try:
        for rows in sent:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(drop)
            stream = spark.readStream.schema(schema).parquet(drop)
            writer = alarm_stream(stream, store, "a", str(tmp_path / "check"), late="2 hours")
            writer.trigger(availableNow=True).start().awaitTermination()
            alarms.append(sorted(int((r.window_start.replace(tzinfo=dt.timezone.utc) - START).total_seconds() // 60) for r in store.alarms().collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert alarms == [[], [5], [5], [5, 35], [5, 35]]
    everything = spark.read.schema(schema).parquet(drop)
    key = lambda df: sorted((r.window_start, r.failures) for r in df.collect())
    assert key(stored_windows(store, "a")) == key(failure_windows(everything))


def test_alarms_of_runs_over_many_dates_and_of_outcomes_weeks_behind(spark, tmp_path):
    from skyledger.operators.accounting import failure_windows
    from skyledger.streaming.alarm_stream import alarm_stream, stored_windows

    store, drop = Tables(spark, str(tmp_path / "store")), str(tmp_path / "drop")
    schema = "status string, finished_at timestamp"
    sent = [range(10), range(10, 11), range(11, 20), range(-100, -90), range(-90, -89), range(20, 21)]  # bad windows, of six hours each
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    alarms = []
    try:
        for places in sent:
            rows = [("failed", START + dt.timedelta(hours=6 * k)) for k in places for _ in range(6)]
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(drop)
            stream = spark.readStream.schema(schema).parquet(drop)
            writer = alarm_stream(stream, store, "a", str(tmp_path / "check"), window="6 hours", in_a_row=11)
            writer.trigger(availableNow=True).start().awaitTermination()
            found = store.alarms().collect()
            alarms.append(sorted(tuple((t.replace(tzinfo=dt.timezone.utc) - START) // dt.timedelta(hours=6) for t in (r.run_start, r.window_start)) for r in found))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert alarms == [[]] + [[(0, 10)]] * 3 + [[(-100, -90), (0, 10)]] * 2
    everything = spark.read.schema(schema).parquet(drop)
    key = lambda df: sorted((r.window_start, r.failures) for r in df.collect())
    assert key(stored_windows(store, "a")) == key(failure_windows(everything))


def test_alarms_of_the_feed_are_one_for_each_run(spark, tmp_path):
    from skyledger.plans.catalogue import q_alarm_stream

    def alarms(hours, name):
        times = [dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(hours=h) for h in hours for _ in range(6)]
        rows = [(i, "error", t) for i, t in enumerate([*times, None])]
        spark.createDataFrame(rows, "event_id long, event_type string, ts timestamp").write.parquet(str(tmp_path / name / "events.parquet"))
        return sorted((r.run_start, r.window_start) for r in q_alarm_stream(spark, str(tmp_path / name)).collect())

    years_before = 12 * 366 * 24
    assert alarms([*range(150), 151, 153, 154, -years_before, 1 - years_before], "runs") == [
        ("2011-12-23T00:00:00.000Z", "2011-12-23T01:00:00.000Z"),
        ("2024-01-01T00:00:00.000Z", "2024-01-01T01:00:00.000Z"),
        ("2024-01-07T09:00:00.000Z", "2024-01-07T10:00:00.000Z"),
    ]
    assert alarms([], "no times") == []


def test_kept_sums_follow_batches_and_compactions(spark, tmp_path):
    from skyledger.sources.kept_sums import KeptSums

    store = Tables(spark, str(tmp_path / "store"))
    kept = KeptSums(store)
    rows = lambda df: sorted(map(tuple, df.collect()))

    def same():
        assert kept.event_count().collect() == analysis.event_count(store.events()).collect()
        assert rows(kept.error_share()) == rows(analysis.error_share(store.events()))

    put(store, "b0")
    put(store, "b1", rows=9)
    assert kept.refresh() == 6
    same()
    assert kept.refresh() == 0
    put(store, "b1", rows=12)  # the batch is written again
    assert kept.refresh() == 3
    same()
    store.compact(dt.date(2026, 9, 3))
    assert kept.refresh() == 2
    same()
    assert kept.event_count().collect()[0].n == 18


def telemetry_rows(spark, texts, kind="derived"):
    i = F.col("i")
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, telemetry string")
    return rows.select(
        F.concat(F.lit("t-"), i).alias("event_id"), F.lit(kind).alias("id_kind"), F.lit("D").alias("drone_id"),
        (F.lit(START) + F.make_dt_interval(days=(i % 4).cast("int"))).alias("event_time"), F.lit("TAKEOFF").alias("event_type"),
        F.lit(200).alias("status_code"), F.lit("info").alias("severity"), F.lit(None).cast("decimal(5,2)").alias("battery_pct"),
        F.lit(None).cast("double").alias("latitude"), F.lit(None).cast("double").alias("longitude"), "telemetry",
        F.lit("{}").alias("raw"), F.lit("s").alias("source"), F.lit("b").alias("batch_id"), F.lit(0).cast("bigint").alias("batch_seq"),
    )


ODD = [
    None, "{}", "[]", "7", '{"é":1}', '{"a\\"b":[1]}', '{"$.x":{"[0]":null}}', '{"n":9007199254740993}', '{"n":9007199254740992}',
    '{"n":2.0}', '{"n":2}', '{"n":2.5}', '{"n":true}', '{"n":"2"}', '{"n":-0.0}', '{"n":0}', '{"n":[1,{"m":false}]}', '{"n":[[1],{"m":null}]}',
    '{"a":{"b":{"c":{"d":{"e":5}}}}}', '{"a":{"b":{"c":{"d":{"e":6}}}}}', '{"a":{"b":{"c":[]}}}', '{"n":123456789012345678901234567890}', '{"s":""}',
    '{"n":4503599627370496.5}', '{"n":1e300}',
]
ASKED = [
    {}, {"é": 1}, {'a"b': [1]}, {"$.x": {"[0]": None}}, {"n": 9007199254740993}, {"n": 9007199254740992}, {"n": 2}, {"n": 2.0}, {"n": 2.5},
    {"n": True}, {"n": "2"}, {"n": 0}, {"n": -0.0}, {"n": [{"m": False}, 1]}, {"n": [[1]]}, {"n": []}, {"a": {"b": {"c": {"d": {"e": 5}}}}},
    {"a": {"b": {"c": {}}}}, {"a": {"b": {"c": []}}}, {"n": 123456789012345678901234567890}, {"s": ""}, {"n": 4503599627370497}, {"n": 1e300},
    {"n": float("nan")}, {"absent": 1}, {"n": [1, 1.0]},
]


def test_leaf_index_finds_what_a_scan_finds(spark, tmp_path, monkeypatch):
    from skyledger.sources import leaf_index

    store = Tables(spark, str(tmp_path / "store"))
    index = leaf_index.LeafIndex(store)
    ids = lambda df: sorted((r.event_id, r.ingest_batch) for r in df.select("event_id", "ingest_batch").collect())

    def same(asked):
        for wanted in asked:
            assert ids(index.containing(wanted)) == ids(reads.containing(store.events(), wanted)), wanted

    store.write_events(telemetry_rows(spark, ODD), "b/0", F.lit(START))
    same(ASKED[:2])
    assert index.refresh() == 4 and index.refresh() == 0
    same(ASKED)
    few = [{"n": 2}, {"a": {"b": {"c": {"d": {"e": 5}}}}}]
    store.write_events(telemetry_rows(spark, ODD[5:15], "supplied"), "b1", F.lit(START))  # not indexed yet
    same(few)
    assert index.refresh() == 4
    store.write_events(telemetry_rows(spark, ODD[9:20], "supplied"), "b1", F.lit(START))  # written again
    same(few)
    assert index.refresh() == 4
    same(few)
    monkeypatch.setattr(leaf_index, "NAMED_IDS", 2)
    same(few)
    store.write_events(telemetry_rows(spark, ODD[:9]), "b2", F.lit(START))
    index.refresh()
    store.compact(dt.date(2026, 9, 3))
    same(few)
    index.refresh()
    same(few)


def test_containment_by_leaves_reaches_the_scan(spark, tmp_path):
    from skyledger.sources.leaf_index import LeafIndex

    store = Tables(spark, str(tmp_path / "store"))
    index = LeafIndex(store)
    assert index.containing({"k": 1}).count() == 0  # an empty store
    store.write_events(telemetry_rows(spark, [f'{{"k":{i},"even":{str(i % 2 == 0).lower()}}}' for i in range(2_000)]), "b", F.lit(START))
    index.refresh()
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    found = index.containing({"k": 17})
    text = plan(found)
    assert "In(event_id" in text or "EqualTo(event_id,t-17)" in text, text
    assert "event_date" in text.split("PartitionFilters:")[1].split("PushedFilters")[0] and "Exchange" not in text
    assert [r.event_id for r in found.collect()] == ["t-17"]
    text = plan(index.candidates([5]))
    assert "EqualTo(leaf,5)" in text and "telemetry" not in text
    assert index.containing({"even": True}).count() == 1_000 and index.containing({"even": True, "k": 4}).count() == 1


def dated_rows(spark, days, prefix="t"):
    texts = [f'{{"k":{i}}}' for i in range(days)]
    rows = telemetry_rows(spark, texts).withColumn("event_time", F.lit(START) + F.make_dt_interval(days=F.regexp_extract("event_id", r"(\d+)$", 1).cast("int")))
    return rows.withColumn("event_id", F.concat(F.lit(prefix), "event_id"))


def test_leaves_and_sums_make_no_folder_for_each_date(spark, tmp_path):
    """What is kept beside the events follows the batches, not the dates; before, each date had files of its own."""
    from skyledger.sources.kept_sums import KeptSums
    from skyledger.sources.leaf_index import LeafIndex

    store = Tables(spark, str(tmp_path / "store"))
    index, kept = LeafIndex(store), KeptSums(store)
    store.write_events(dated_rows(spark, 40), "b0", F.lit(START))
    assert index.refresh() == 40 and kept.refresh() == 40
    for name in ("batch_event_leaves", "batch_event_sums"):
        assert [p.name for p in (tmp_path / "store" / name).iterdir() if "=" in p.name] == ["ingest_batch=b0"]
    assert kept.event_count().collect()[0].n == 40 and [r.event_id for r in index.containing({"k": 7}).collect()] == ["tt-7"]


def test_a_refresh_that_breaks_off_is_done_again(spark, tmp_path, monkeypatch):
    from skyledger.sources.batch_mirror import BatchMirror
    from skyledger.sources.folders import Folders
    from skyledger.sources.kept_sums import KeptSums

    store = Tables(spark, str(tmp_path / "store"))
    kept = KeptSums(store)
    store.write_events(dated_rows(spark, 3, "a"), "b0", F.lit(START))
    store.write_events(dated_rows(spark, 3, "b"), "b1", F.lit(START))

    def breaks(*_):
        raise InterruptedError

    with monkeypatch.context() as patch:
        patch.setattr(Folders, "write_lines", breaks)
        with pytest.raises(InterruptedError):
            kept.refresh()
    assert all(not parts for parts in BatchMirror(kept.files, "telemetry_events", ("id_kind",), "batch_event_sums").kept().values())
    store.compact(dt.date(2026, 9, 3))  # takes partitions from the batches without a list
    kept.refresh()
    assert kept.event_count().collect()[0].n == 6
    assert kept.refresh() == 0


def test_events_are_put_in_place_by_folder(spark, tmp_path, monkeypatch):
    """New dates are moved whole, also several at once; a batch written again replaces its folders alone."""
    from skyledger.sources.folders import Folders

    store, deepest = Tables(spark, str(tmp_path / "store")), []
    real = Folders.put_in_place
    monkeypatch.setattr(Folders, "put_in_place", lambda self, source, target, depth: (deepest.append(depth), real(self, source, target, depth))[1])
    ids = lambda: sorted((r.event_id, r.ingest_batch) for r in store.events().select("event_id", "ingest_batch").collect())
    store.write_events(dated_rows(spark, 5), "b/0", F.lit(START))
    store.write_events(dated_rows(spark, 8, "u"), "b1", F.lit(START))
    store.write_events(dated_rows(spark, 2), "b/0", F.lit(START))
    assert deepest == [4, 4, 4]
    assert ids() == sorted([(f"tt-{i}", "b/0") for i in range(5)] + [(f"ut-{i}", "b1") for i in range(8)])
    assert not (tmp_path / "store" / "_staged").exists()
    # A write that broke off leaves nothing that is read, and is cleared by the next.
    monkeypatch.setattr(Folders, "put_in_place", lambda *_: (_ for _ in ()).throw(InterruptedError()))
    with pytest.raises(InterruptedError):
        store.write_events(dated_rows(spark, 3, "x"), "b2", F.lit(START))
    monkeypatch.setattr(Folders, "put_in_place", real)
    assert len(ids()) == 13
    store.write_events(dated_rows(spark, 3, "x"), "b2", F.lit(START))
    assert len(ids()) == 16 and not (tmp_path / "store" / "_staged").exists()


def test_events_are_written_by_more_tasks_than_cores(spark, tmp_path):
    """Adaptive execution would put them together to one task a core."""
    key = "spark.sql.adaptive.coalescePartitions.minPartitionNum"
    seen, store = [], Tables(spark, str(tmp_path / "store"))
    rows = dated_rows(spark, 3)
    from skyledger.sources import tables as module

    real = module.with_setting
    module.with_setting = lambda session, name, value: (seen.append((name, int(value))), real(session, name, value))[1]
    try:
        store.write_events(rows, "b", F.lit(START))
    finally:
        module.with_setting = real
    assert seen == [(key, 3 * spark.sparkContext.defaultParallelism)] and spark.conf.get(key, None) is None


def test_a_stream_numbers_its_messages_once(spark):
    from skyledger.sources.messages import classified, numbered_deliveries

    sent = spark.createDataFrame([("m", '{"a":1}'), ("m", '{"a":2}'), ("n", "[]")], "message_id string, body string")
    told = numbered_deliveries(sent)
    plan = classified(told, numbered=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 1
    key = lambda df: sorted((r.message_id, r.message_seq, r.body, r.role) for r in df.select("message_id", "message_seq", "body", "role").collect())
    assert key(classified(told, numbered=True)) == key(classified(sent))
