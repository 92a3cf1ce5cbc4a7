"""Field rules as one table of (record, expected), judged in a single job."""

import hashlib
import json

from pyspark.sql import functions as F

from skyledger.functions import json_text
from skyledger.functions.numbers import number_from_text, number_to_text
from skyledger.functions.text import trimmed
from skyledger.plans.intake import judge
from skyledger.sources.json_docs import NOT_JSON, with_parsed
from skyledger.sources.payloads import delivered

VALID = {
    "droneId": "UNIT-7",
    "timestamp": "2026-09-01T10:00:00.000Z",
    "eventType": "DELIVERY_COMPLETED",
    "statusCode": 200,
    "telemetryData": {"batteryPct": 66.5, "lat": 48.208, "lon": 16.37},
}
DROP = object()


def record(**changes):
    merged = {**VALID, **changes}
    return json.dumps({k: v for k, v in merged.items() if v is not DROP})


def judged_texts(spark, texts, now):
    df = spark.createDataFrame(list(enumerate(texts)), "pos bigint, raw_text string")
    df = with_parsed(df, "raw_text", "bad").withColumns({"raw_json": F.col("raw_text"), "source": F.lit("s")})
    rows = judge(delivered(df, F.lit("b"), F.lit(0), F.lit("")), now)
    return [r for _, r in sorted((r.ord.pos, r) for r in rows.collect())]


T = "telemetryData"
ACCEPTED = [
    ({}, {"severity": "info", "telemetry": '{"batteryPct":66.5,"lat":48.208,"lon":16.37}', "battery_pct": 66.5}),
    ({"statusCode": "404", T: {"batteryPct": "61.25", "lat": "48.2"}}, {"status_code": 404, "severity": "warning", "telemetry": '{"batteryPct":61.25,"lat":48.2}'}),
    ({T: ' {"altitudeM":120,"batteryPct":50} '}, {"telemetry": '{"altitudeM":120,"batteryPct":50}'}),
    ({"timestamp": 1777777777000}, {"time": "2026-05-03T03:09:37"}),
    ({"timestamp": 1788000000}, {"time": "2026-08-29T10:40:00"}),
    ({"timestamp": " 1777777777000 "}, {"time": "2026-05-03T03:09:37"}),
    ({"timestamp": "2026-09-01T12:00:00.123456+02:00"}, {"time": "2026-09-01T10:00:00.123000"}),
    ({"timestamp": "2026-09-01T10:00Z"}, {"time": "2026-09-01T10:00:00"}),
    ({"timestamp": "2026-09-01"}, {"time": "2026-09-01T00:00:00"}),
    ({"timestamp": "2026-02-30"}, {"time": "2026-03-02T00:00:00"}),
    ({"timestamp": "2026-12-02T00:00:00Z"}, {}),
    ({"statusCode": "", T: {"batteryPct": "", "lat": " ", "lon": None, "x": ""}}, {"status_code": None, "battery_pct": None, "telemetry": '{"x":""}'}),
    ({"eventType": " delivery completed "}, {"event_type": "DELIVERY_COMPLETED"}),
    ({"eventType": "battery-low"}, {"event_type": "BATTERY_LOW", "severity": "warning"}),
    ({"eventType": "ROTOR_SWAPPED"}, {"event_type": "UNKNOWN"}),
    ({T: {"gustKmh": 4.2, "boxClosed": "true"}}, {"telemetry": '{"boxClosed":true,"gustKmh":4.2}'}),
    ({T: DROP, "statusCode": DROP}, {"telemetry": "{}", "status_code": None}),
    ({T: None}, {"telemetry": "{}"}),
    ({T: "  "}, {"telemetry": "{}"}),
    ({T: {"a": "120", "b": "0.0", "c": "-5.93", "d": " false\t", "e": "48.20830"}}, {"telemetry": '{"a":120,"b":0,"c":-5.93,"d":false,"e":48.2083}'}),
    ({T: {"firmware": "007", "ref": "1e5", "route": "N4-S11"}}, {"telemetry": '{"firmware":"007","ref":"1e5","route":"N4-S11"}'}),
    ({T: {"m": [{"rpm": "4200"}, {"rpm": "x,\"12\","}], "12": "1"}}, {"telemetry": '{"12":1,"m":[{"rpm":4200},{"rpm":"x,\\"12\\","}]}'}),
    ({T: {"batteryPct": "1e1", "lat": "+5."}}, {"battery_pct": 10.0, "severity": "warning", "telemetry": '{"batteryPct":10,"lat":5}'}),
    ({"eventType": "MOTOR_FAULT", "statusCode": DROP}, {"severity": "error"}),
    ({"statusCode": 503}, {"severity": "error"}),
    ({T: {"batteryPct": 15}}, {"severity": "warning"}),
    ({T: {"batteryPct": 15.004}}, {"severity": "info", "battery_pct": 15.0}),
    ({"eventId": "  firmware-id "}, {"event_id": "firmware-id", "id_kind": "supplied"}),
    ({"eventId": " "}, {"id_kind": "derived"}),
]
REJECTED = [
    ({"droneId": DROP}, [("droneId", "invalid_type", "droneId is required")]),
    ({"droneId": 7}, [("droneId", "invalid_type", "droneId is required")]),
    ({"droneId": "  "}, [("droneId", "too_small", "droneId must not be empty")]),
    ({"droneId": "x" * 129}, [("droneId", "too_big", "droneId is unreasonably long")]),
    ({"eventId": 5}, [("eventId", "invalid_type", "Invalid input: expected string, received number")]),
    ({"timestamp": "around noon"}, [("timestamp", "invalid_type", None)]),
    ({"timestamp": "10:00"}, [("timestamp", "invalid_type", None)]),
    ({"timestamp": ""}, [("timestamp", "invalid_type", None)]),
    ({"timestamp": True}, [("timestamp", "invalid_type", None)]),
    ({"timestamp": "2041-07-09T00:00:00Z"}, [("timestamp", "custom", "timestamp is more than 24 hours in the future")]),
    ({"timestamp": "1994-01-01T00:00:00Z"}, [("timestamp", "custom", None)]),
    ({"timestamp": "2026"}, [("timestamp", "custom", None)]),
    ({"eventType": " "}, [("eventType", "invalid_type", "eventType is required")]),
    ({"statusCode": "abc"}, [("statusCode", "invalid_type", "Invalid input: expected number, received string")]),
    ({"statusCode": "5f"}, [("statusCode", "invalid_type", None)]),
    ({"statusCode": 404.5}, [("statusCode", "invalid_type", "statusCode must be a whole number")]),
    ({"statusCode": 3000000000}, [("statusCode", "too_big", None)]),
    ({T: {"batteryPct": 4000}}, [("telemetryData.batteryPct", "too_big", "batteryPct must be between 0 and 100")]),
    ({T: {"batteryPct": True}}, [("telemetryData.batteryPct", "invalid_type", "Invalid input: expected number, received boolean")]),
    ({T: {"lat": 999, "lon": -400}}, [("telemetryData.lat", "too_big", "lat must be between -90 and 90"), ("telemetryData.lon", "too_small", "Too small: expected number to be >=-180")]),
    ({T: "just words"}, [("telemetryData", "invalid_type", "Invalid input: expected object, received string")]),
    ({T: "[1]"}, [("telemetryData", "invalid_type", "Invalid input: expected object, received array")]),
    ({T: 5}, [("telemetryData", "invalid_type", "Invalid input: expected object, received number")]),
    ({"droneId": "", "timestamp": "nope", "eventType": ""}, [("droneId", "too_small", None), ("timestamp", "invalid_type", None), ("eventType", "invalid_type", None)]),
]
NO_RECORDS = {'"words alone"': "string", "null": "null", "42": "number", "[{}]": "array", "true": "boolean"}


def test_rules(spark, now):
    texts = [record(**c) for c, _ in ACCEPTED] + [record(**c) for c, _ in REJECTED] + list(NO_RECORDS)
    rows = judged_texts(spark, texts, now)
    for (changes, want), row in zip(ACCEPTED, rows):
        assert row.valid, (changes, row.issues)
        got = row.asDict() | {"time": row.event_time.isoformat()}
        got["battery_pct"] = None if row.battery_pct is None else float(row.battery_pct)
        assert {k: got[k] for k in want} == want, changes
        if row.id_kind == "derived":
            iso = row.event_time.isoformat(timespec="milliseconds") + "Z"
            status = "" if row.status_code is None else str(row.status_code)
            text = "|".join([row.drone_id, iso, row.event_type, status, row.telemetry])
            assert row.event_id == hashlib.sha256(text.encode()).hexdigest()[:32]
    for (changes, want), row in zip(REJECTED, rows[len(ACCEPTED) :]):
        assert [(i.path, i.code) for i in row.issues] == [w[:2] for w in want], changes
        for i, w in zip(row.issues, want):
            assert w[2] is None or i.message == w[2]
    for kind, row in zip(NO_RECORDS.values(), rows[len(ACCEPTED) + len(REJECTED) :]):
        message = f"Invalid input: expected object, received {kind}"
        assert [tuple(i) for i in row.issues] == [("(root)", "invalid_type", message)]


def test_golden_id(spark, now):
    """A known id: the same reading with other key order and as text cells."""
    reading = {"batteryPct": "78.5", "lat": "54.59730", "lon": "-5.93010", "altitudeM": "85", "speedMps": "9.4"}
    fact = {"droneId": "DRONE-001", "timestamp": "2026-09-02T09:00:00Z", "eventType": "DELIVERY_COMPLETED", "statusCode": "200"}
    as_numbers = {k: float(v) for k, v in reversed(reading.items())}
    rows = judged_texts(spark, [json.dumps({**fact, T: reading}), json.dumps({T: as_numbers, **fact, "statusCode": 200.0})], now)
    assert {r.event_id for r in rows} == {"8cece77149196e6d0ab22709c1cfaa08"}


def test_number_text(spark):
    writes = {
        "1e5": "100000", "1e-7": "1e-7", "0.000001": "0.000001", "123e-20": "1.23e-18", "1e21": "1e+21", "1e20": "100000000000000000000",
        "-0.0": "0", "0.1": "0.1", "1e23": "1e+23", "9007199254740993": "9007199254740992", "0.30000000000000004": "0.30000000000000004",
        "12345678901234567890": "12345678901234567000", "-2.50": "-2.5", "1.7976931348623157e308": "1.7976931348623157e+308",
    }
    df = spark.createDataFrame([(k,) for k in writes], "t string")
    got = {r.t: r.n for r in df.select("t", number_to_text(F.col("t").try_cast("double")).alias("n")).collect()}
    assert got == writes
    reads = {"1d": None, "NaN": None, "Infinity": float("inf"), ".5": 0.5, "5.": 5.0, "+1e2": 100.0, "0x1F": 31.0, "0b101": 5.0, "0o17": 15.0, "": None, "1 2": None, " 7\n": 7.0}
    df = spark.createDataFrame([(k,) for k in reads], "t string")
    got = {r.t: r.n for r in df.select("t", number_from_text(trimmed(F.col("t"))).alias("n")).collect()}
    assert got == reads


def test_canonical_text(spark):
    cases = {
        '{"b":1,"a":{"d":2,"c":[3,1]}}': '{"a":{"c":[3,1],"d":2},"b":1}',
        '{"a":1e5,"b":1e-7,"c":12345678901234567890,"d":80.0,"s":"1e5 [12345678901234567890"}': '{"a":100000,"b":1e-7,"c":12345678901234567000,"d":80,"s":"1e5 [12345678901234567890"}',
        '{"a":"\\u001f\\u000b \\\\\\\\u001F é","x":1,"x":2}': '{"a":"\\u001f\\u000b \\\\\\\\u001F é","x":2}',
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    out = df.select("t", json_text.canonical(F.to_json(json_text.parsed(F.col("t")))).alias("c"))
    assert {r.t: r.c for r in out.collect()} == cases


def test_values_of_any_length_are_judged(spark, now):
    """No value fails the job, and none is judged by a part of it."""
    cases = [
        ({"statusCode": "0x" + "F" * 20}, [("statusCode", "too_big")]),
        ({"statusCode": "0x" + "F" * 400}, [("statusCode", "invalid_type")]),
        ({"statusCode": "0b" + "0" * 90 + "11"}, []),
        ({T: {"lat": "0x" + "0" * 64 + "zz"}}, [("telemetryData.lat", "invalid_type")]),
        ({T: {"lat": "0x" + "0" * 80 + "1f"}}, []),
        ({"statusCode": 1e300}, [("statusCode", "too_big")]),
        ({"statusCode": -(2**60)}, [("statusCode", "too_small")]),
        ({"timestamp": 316516896000000}, [("timestamp", "custom")]),
        ({"timestamp": 9e15}, [("timestamp", "invalid_type")]),
        ({"timestamp": "2026-02-30T10:00:00." + "1" * 60 + "+05:00"}, []),
        ({T: {"n": "1" * 305}}, []),
        ({T: {"n": "7" * 450, "f": "0." + "3" * 450}}, []),
    ]
    rows = judged_texts(spark, [record(**c) for c, _ in cases], now)
    for (changes, want), row in zip(cases, rows):
        assert [(i.path, i.code) for i in row.issues] == want, changes
    assert rows[2].status_code == 3
    assert rows[4].latitude == 31.0
    assert rows[9].event_time.isoformat() == "2026-03-02T05:00:00.111000"
    assert rows[10].telemetry == '{"n":1.1111111111111112e+304}'
    assert rows[11].telemetry == '{"f":0.3333333333333333,"n":null}'


def test_only_the_columns_asked_for_are_written(spark, now):
    text = '{"droneId":"D","timestamp":"2026-11-30T10:00:00Z","eventType":"TAKEOFF","telemetryData":{"batteryPct":50}}'
    lines = spark.createDataFrame([(text, 0), ("{}", 1)], "raw_text string, pos bigint")
    rows = with_parsed(lines, "raw_text", NOT_JSON).withColumns({"raw_json": F.col("raw_text"), "source": F.lit("s")})
    candidates = delivered(rows, F.lit("b"), F.lit(0), F.lit(""))
    some = judge(candidates, now, ["event_id", "valid"])
    assert some.columns == ["event_id", "valid"] == [f.name for f in spark.read.parquet(*some.inputFiles()).schema]
    assert sorted(map(repr, some.collect())) == sorted(map(repr, judge(candidates, now).select("event_id", "valid").collect()))
