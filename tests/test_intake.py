"""Whole runs: accounting, replay, messages and files together."""

import json

import pytest
from pyspark.sql import functions as F

from skyledger.plans.intake import ingest_files, ingest_messages
from skyledger.sources.tables import Tables

HEADER = "droneId,timestamp,eventType,statusCode,batteryPct,lat,lon,altitudeM,speedMps"
RECORD = {
    "droneId": "DRONE-001",
    "timestamp": "2026-09-01T10:00:00Z",
    "eventType": "DELIVERY_COMPLETED",
    "statusCode": 200,
    "telemetryData": {"batteryPct": 80, "lat": 54.6, "lon": -5.9},
}


def mixed_csv():
    good = "2026-09-02T09:0{}:00Z,TAKEOFF,200,78.5,54.5,-5.9,85,9.4"
    rows = [HEADER]
    rows += [f"D{i},{good.format(i)}" for i in range(6)]
    rows += [
        f",{good.format(1)}",
        f"D7,someday,{good.format(1).split(',', 1)[1]}",
        f"D8,{good.format(1).replace('78.5', '4000')}",
        f"D9,{good.format(1).replace('54.5', '999')}",
        "D10,2026-09-02T09:05:00Z,LANDING",
        f"D11,{good.format(1).replace('2026', '2041')}",
        rows[1],
    ]
    return "\n".join(rows) + "\n"


def counts(outcome):
    row = outcome.collect()[0]
    assert row.received == row.valid + row.quarantined + row.duplicates_in_batch
    assert row.valid == row.inserted + row.duplicates
    return (row.received, row.inserted, row.duplicates, row.duplicates_in_batch, row.quarantined)


def test_first_load_reload_and_other_format(spark, tmp_path, now):
    tables = Tables(spark, str(tmp_path / "store"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "mixed.csv").write_text(mixed_csv())
    (tmp_path / "nd").mkdir()
    fields = HEADER.split(",")
    with open(tmp_path / "nd" / "same.ndjson", "w") as out:
        for line in mixed_csv().splitlines()[1:7]:
            cells = dict(zip(fields, line.split(",")))
            top = {k: cells.pop(k) for k in ("droneId", "timestamp", "eventType")}
            top["statusCode"] = int(cells.pop("statusCode"))
            # Same facts: other key order, numbers instead of text, other layout.
            tel = {k: float(v) for k, v in reversed(list(cells.items()))}
            out.write(json.dumps({"telemetryData": tel, **top}) + "\n")

    assert counts(ingest_files(spark, tables, str(tmp_path / "in"), now=now)) == (13, 6, 0, 1, 6)
    assert counts(ingest_files(spark, tables, str(tmp_path / "in"), now=now)) == (13, 0, 6, 1, 6)
    replay = ingest_files(spark, tables, str(tmp_path), now=now, scan={"pathGlobFilter": "*.ndjson"})
    assert counts(replay) == (6, 0, 6, 0, 0)
    assert tables.events().count() == 6

    reasons = {
        r.source.rsplit("#", 1)[1]: [(e.path, e.code) for e in r.errors]
        for r in tables.quarantine().collect()
    }
    assert reasons == {
        "L8": [("droneId", "too_small")],
        "L9": [("timestamp", "invalid_type")],
        "L10": [("telemetryData.batteryPct", "too_big")],
        "L11": [("telemetryData.lat", "too_big")],
        "L12": [("(root)", "parse_error")],
        "L13": [("timestamp", "custom")],
    }


def test_a_batch_run_again_replaces_itself(spark, tmp_path, now):
    tables = Tables(spark, str(tmp_path / "store"))
    (tmp_path / "mixed.csv").write_text(mixed_csv())
    for _ in range(2):
        got = counts(
            ingest_files(spark, tables, str(tmp_path / "mixed.csv"), batch_id="b1", now=now)
        )
        assert got == (13, 6, 0, 1, 6)
    assert tables.events().count() == 6
    assert tables.quarantine().count() == 6
    assert tables.outcomes().count() == 1


def notice(*keys, bucket="raw"):
    return json.dumps(
        {"Records": [{"s3": {"bucket": {"name": bucket}, "object": {"key": k}}} for k in keys]}
    )


def test_messages(spark, tmp_path, now):
    tables = Tables(spark, str(tmp_path / "store"))
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "night run [a].csv").write_text(
        "droneId,timestamp,eventType\nF1,2026-09-01T10:00:00Z,TAKEOFF\nF2,2026-09-01T10:00:00Z,TAKEOFF\n"
    )
    (raw / "same.ndjson").write_text(json.dumps(RECORD) + "\n{\"open\":\n")
    bodies = {
        "record": json.dumps(RECORD),
        "array": json.dumps([{**RECORD, "droneId": "A1"}, {**RECORD, "droneId": "A2"}, 7]),
        "one": json.dumps([{**RECORD, "droneId": "A3"}]),
        "text": "no braces here",
        "test": json.dumps({"Service": "Amazon S3", "Event": "s3:TestEvent", "Bucket": "raw"}),
        "file": notice("night+run+%5Ba%5D.csv"),
        "twice": notice("same.ndjson", "same.ndjson"),
        "gone": notice("same.ndjson", "missing.csv"),
        "badkey": notice("%zz.csv"),
        "empty": "",
        "null": "null",
        "none": "[]",
        "norecords": '{"Records":[]}',
        "nokey": '{"Records":[{"s3":{}}]}',
        "again": json.dumps(RECORD),
        "allbad": json.dumps({"droneId": "", "timestamp": "nope"}),
    }
    messages = spark.createDataFrame(
        [(k, v, i) for i, (k, v) in enumerate(bodies.items())],
        "message_id string, body string, message_seq bigint",
    )
    out = ingest_messages(
        spark, tables, messages, ingest_batch="m1", now=now, template=f"{tmp_path}/{{bucket}}/{{key}}"
    )
    rows = {r.batch_id: r for r in out.collect()}
    got = {
        k: (r.status, r.received, r.inserted, r.duplicates, r.duplicates_in_batch, r.quarantined)
        for k, r in rows.items()
    }
    assert got == {
        "record": ("processed", 1, 1, 0, 0, 0),
        "array": ("processed", 3, 2, 0, 0, 1),
        "one": ("processed", 1, 1, 0, 0, 0),
        "text": ("processed", 1, 0, 0, 0, 1),
        "test": ("skipped", 0, 0, 0, 0, 0),
        "file": ("processed", 2, 2, 0, 0, 0),
        "twice": ("processed", 4, 0, 1, 1, 2),
        "gone": ("failed", 0, 0, 0, 0, 0),
        "badkey": ("failed", 0, 0, 0, 0, 0),
        "empty": ("processed", 1, 0, 0, 0, 1),
        "null": ("processed", 1, 0, 0, 0, 1),
        "none": ("processed", 0, 0, 0, 0, 0),
        "norecords": ("processed", 1, 0, 0, 0, 1),
        "nokey": ("processed", 1, 0, 0, 0, 1),
        "again": ("processed", 1, 0, 1, 0, 0),
        "allbad": ("processed", 1, 0, 0, 0, 1),
    }
    assert "not found" in rows["gone"].error and "decoded" in rows["badkey"].error
    assert rows["allbad"].contract_smell and not rows["array"].contract_smell
    assert {e.path for e in rows["allbad"].sample_errors} == {"droneId", "timestamp", "eventType"}

    sources = {r.source for r in tables.events().collect()}
    assert sources == {
        "sqs:record", "sqs:array#0", "sqs:array#1", "sqs:one",
        "s3://raw/night run [a].csv#L2", "s3://raw/night run [a].csv#L3",
    }
    bad = {r.source: r.raw_payload for r in tables.quarantine().collect() if r.source.startswith("sqs")}
    assert bad["sqs:text"] == "no braces here"
    assert bad["sqs:array#2"] == "7"
    assert {r.raw_payload for r in tables.quarantine().where("source like 's3://%'").collect()} == {'{"open":'}


def test_supplied_ids_match_on_any_day_and_kind(spark, tmp_path, now):
    tables = Tables(spark, str(tmp_path / "store"))

    def send(name, *records):
        df = spark.createDataFrame([(name, json.dumps(list(records)))], "message_id string, body string")
        return counts(ingest_messages(spark, tables, df, ingest_batch=name, now=now))

    assert send("a", RECORD, {**RECORD, "eventId": "x1"}) == (2, 2, 0, 0, 0)
    derived = tables.events().where("id_kind = 'derived'").collect()[0].event_id
    later = {**RECORD, "timestamp": "2026-10-01T10:00:00Z"}
    # The same supplied id with another time, and a derived id sent back as a supplied one.
    assert send("b", {**later, "eventId": "x1"}, {**later, "eventId": derived}) == (2, 0, 2, 0, 0)
    assert send("c", RECORD, later) == (2, 1, 1, 0, 0)


def test_stored_rows_are_checked(spark, tmp_path, now):
    from skyledger.sources.tables import checked

    base = spark.sql(
        "select 'e' event_id, 'd' drone_id, timestamp'2026-09-01 00:00:00' event_time, 'TAKEOFF' event_type,"
        " 'info' severity, cast(50 as decimal(5,2)) battery_pct, 1.0D latitude, 1.0D longitude"
    )
    assert checked(base).count() == 1
    for column, value in (
        ("battery_pct", F.lit(900).cast("decimal(5,2)")),
        ("latitude", F.lit(999.0)),
        ("severity", F.lit("dreadful")),
        ("event_id", F.lit(None).cast("string")),
    ):
        with pytest.raises(Exception, match="stored event breaks"):
            checked(base.withColumn(column, value)).collect()


def test_a_message_delivered_twice_at_once(spark, tmp_path, now):
    tables = Tables(spark, str(tmp_path / "store"))
    body = json.dumps(RECORD)
    for columns, rows in (("message_id string, body string", [("a", body)] * 2), ("message_id string, body string, message_seq int", [("b", body, 4)] * 2)):
        out = ingest_messages(spark, tables, spark.createDataFrame(rows, columns), ingest_batch=rows[0][0], now=now)
        got = sorted((r.batch_seq, r.received, r.inserted, r.duplicates, r.duplicates_in_batch) for r in out.collect())
        fresh = rows[0][0] == "a"
        assert [g[1:] for g in got] == [(1, int(fresh), int(not fresh), 0), (1, 0, 1, 0)]
    assert tables.events().count() == 1


def test_hostile_values_leave_their_neighbours_alone(spark, tmp_path, now):
    tables = Tables(spark, str(tmp_path / "store"))
    hostile = [{"statusCode": "0x" + "F" * 40}, {"timestamp": 1e16}, {"telemetryData": {"lat": "9" * 500}}, {"statusCode": 1e300}]
    bodies = [json.dumps({**RECORD, **h}) for h in hostile] + [json.dumps(RECORD)]
    messages = spark.createDataFrame([(f"m{i}", b) for i, b in enumerate(bodies)], "message_id string, body string")
    out = {r.batch_id: (r.inserted, r.quarantined) for r in ingest_messages(spark, tables, messages, now=now).collect()}
    assert out == {"m0": (0, 1), "m1": (0, 1), "m2": (0, 1), "m3": (0, 1), "m4": (1, 0)}


def test_what_a_cap_cuts_off_is_reported(spark, tmp_path, now):
    tables = Tables(spark, str(tmp_path / "store"))
    (tmp_path / "mixed.csv").write_text(mixed_csv())
    row = ingest_files(spark, tables, str(tmp_path / "mixed.csv"), now=now, max_records=5).collect()[0]
    assert (row.received, row.truncated) == (5, 8)
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "mixed.csv").write_text(mixed_csv())
    sent = spark.createDataFrame([("n", notice("mixed.csv"))], "message_id string, body string")
    row = ingest_messages(spark, tables, sent, now=now, template=f"{tmp_path}/{{bucket}}/{{key}}", max_records=4).collect()[0]
    assert (row.status, row.received, row.truncated) == ("processed", 4, 9)


def test_scratch_is_removed_also_after_a_failure(spark, tmp_path, now):
    import glob

    folder = spark.conf.get("spark.checkpoint.dir")
    (tmp_path / "mixed.csv").write_text(mixed_csv())
    before = set(glob.glob(f"{folder}/skyledger/*"))
    ingest_files(spark, Tables(spark, str(tmp_path / "store")), str(tmp_path / "mixed.csv"), now=now)
    with pytest.raises(Exception):
        ingest_files(spark, Tables(spark, "nowhere://x"), str(tmp_path / "mixed.csv"), now=now)
    assert set(glob.glob(f"{folder}/skyledger/*")) == before


def test_known_ids_read_the_batch_dates_only(spark, tmp_path, now):
    from skyledger.operators.dedupe import known_ids

    tables = Tables(spark, str(tmp_path / "store"))
    sent = spark.createDataFrame([("m", json.dumps(RECORD))], "message_id string, body string")
    ingest_messages(spark, tables, sent, now=now)
    days = [r[0] for r in tables.events().select("event_date").collect()]
    known = known_ids(tables.events(), tables.events(), days=days, any_supplied=False)
    plan = known._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert any("id_kind" in f.split("PartitionFilters")[1] and "event_date" in f.split("PartitionFilters")[1] for f in filters)


def test_an_unreadable_file_fails_its_own_message(spark, tmp_path, now, monkeypatch):
    import skyledger.sources.json_parts as module

    tables = Tables(spark, str(tmp_path / "store"))
    raw = tmp_path / "raw"
    (raw / "folder.ndjson").mkdir(parents=True)
    (raw / "long.json").write_text(json.dumps([{**RECORD, "droneId": f"L{i}"} for i in range(40)]))
    (raw / "good.ndjson").write_text(json.dumps(RECORD) + "\n")
    monkeypatch.setattr(module, "SPLIT_ABOVE", 1000)
    sent = [(k, notice(f"{k}")) for k in ("folder.ndjson", "long.json", "good.ndjson")]
    out = ingest_messages(
        spark, tables, spark.createDataFrame(sent, "message_id string, body string"), now=now,
        template=f"{tmp_path}/{{bucket}}/{{key}}",
    )
    got = {r.batch_id: (r.status, r.inserted, (r.error or "").split(":")[0]) for r in out.collect()}
    assert got == {
        "folder.ndjson": ("failed", 0, "object cannot be read"), "long.json": ("processed", 40, ""),
        "good.ndjson": ("processed", 1, ""),
    }


def test_a_replay_goes_on_where_it_stopped(spark, tmp_path, now, monkeypatch):
    import skyledger.plans.intake as module

    tables, folder = Tables(spark, str(tmp_path / "store")), tmp_path / "in"
    folder.mkdir()
    for i in range(6):
        (folder / f"f{i}.ndjson").write_text(json.dumps({**RECORD, "droneId": f"D{i}"}) + "\n")
    size = sum(p.stat().st_size for p in folder.iterdir())
    read, real = [], module.ingest_files

    def ingest(*args, **kwargs):
        if len(read) == 1:
            raise InterruptedError
        read.append(set(args[2]))
        return real(*args, **kwargs)

    monkeypatch.setattr(module, "ingest_files", ingest)
    with pytest.raises(InterruptedError):
        module.replay(spark, tables, str(folder), "r", now=now, batch_bytes=size // 3)
    first = read.pop()
    assert 0 < len(first) < 6 and tables.events().count() == len(first) == tables.ledger().count()
    monkeypatch.setattr(module, "ingest_files", lambda *a, **k: read.append(set(a[2])) or real(*a, **k))
    out = module.replay(spark, tables, str(folder), "r", now=now, batch_bytes=size // 3)
    assert not first & set().union(*read) and len(first | set().union(*read)) == 6
    assert tables.events().count() == 6 and out.agg(F.sum("inserted")).collect()[0][0] == 6
    read.clear()
    module.replay(spark, tables, str(folder), "r", now=now, batch_bytes=size // 3)
    assert read == []  # nothing is opened again
    (folder / "f1.ndjson").write_text(json.dumps({**RECORD, "droneId": "new"}) + "\n" * 2)
    module.replay(spark, tables, str(folder), "r", now=now, batch_bytes=size // 3)
    assert [{p.rsplit("/", 1)[1] for p in x} for x in read] == [{"f1.ndjson"}] and tables.events().count() == 7
