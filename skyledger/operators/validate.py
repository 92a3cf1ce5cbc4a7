"""Validation: candidates to typed fields plus every issue found.

A candidate frame has the columns of :data:`CANDIDATE_COLUMNS`. Validation never
drops or fails a row; it adds the typed fields and an ``issues`` array, which is
empty for a valid record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import instants, json_text
from skyledger.functions.numbers import number_from_text
from skyledger.functions.text import WHITE_SPACE_CLASS, is_continued, trimmed, utf16_length

#: ``ord`` is the arrival order, STRUCT<batch_seq, batch_id, file_pos, pos>.
CANDIDATE_COLUMNS = (
    "batch_id",
    "batch_seq",
    "ord",
    "source",
    "raw_text",
    "raw_json",
    "value",
    "root_kind",
    "parse_error",
)

# Event types with a meaning of their own.
KNOWN_EVENT_TYPES = (
    "TAKEOFF",
    "LANDING",
    "DELIVERY_COMPLETED",
    "DELIVERY_FAILED",
    "ROUTE_ADJUSTED",
    "SENSOR_READING",
    "BATTERY_LOW",
    "BATTERY_CRITICAL",
    "MOTOR_FAULT",
    "GPS_SIGNAL_LOST",
)
UNKNOWN_EVENT_TYPE = "UNKNOWN"
MAX_ID_LENGTH = 128
INT_MIN, INT_MAX = -(2**31), 2**31 - 1
SAFE_INTEGER = 2**53 - 1

# The readings that become columns, with their inclusive ranges.
READINGS = {
    "batteryPct": ("battery_pct", 0.0, 100.0),
    "lat": ("latitude", -90.0, 90.0),
    "lon": ("longitude", -180.0, 180.0),
}
# Message texts.
BATTERY_RANGE = "batteryPct must be between 0 and 100"
READING_MESSAGES = {
    "batteryPct": (BATTERY_RANGE, BATTERY_RANGE),
    "lat": ("Too small: expected number to be >=-90", "lat must be between -90 and 90"),
    "lon": ("Too small: expected number to be >=-180", "lon must be between -180 and 180"),
}

ISSUES_TYPE = "array<struct<path:string,code:string,message:string>>"


#: The code of a further part of a record too long for one value.
CONTINUED_CODE = "continued"


def first_parts(judged: DataFrame) -> DataFrame:
    """The rows that stand for a record each, without further parts."""
    return judged.where(~F.exists("issues", lambda e: e["code"] == CONTINUED_CODE))


def issue(path: str, code: str, message: str | Column) -> Column:
    text = F.lit(message) if isinstance(message, str) else message
    return F.struct(
        F.lit(path).alias("path"), F.lit(code).alias("code"), text.alias("message")
    )


def _expected(what: str, received: Column) -> Column:
    return F.concat(F.lit(f"Invalid input: expected {what}, received "), received)


def _string(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _double(value: Column) -> Column:
    return F.try_variant_get(value, "$", "double")


def normalise_event_type(text: Column) -> Column:
    """Upper case, separators to ``_``; anything not known becomes ``UNKNOWN``.

    The text must be trimmed.
    """
    name = F.regexp_replace(F.upper(text), rf"[{WHITE_SPACE_CLASS}-]+", "_")
    known = F.array(*[F.lit(t) for t in KNOWN_EVENT_TYPES])
    position = F.array_position(known, name)
    return F.coalesce(F.get(known, (position - 1).cast("int")), F.lit(UNKNOWN_EVENT_TYPE))


def _with_kinds(df: DataFrame, names: list[str]) -> DataFrame:
    """Type names ``_k_x`` and trimmed string values ``_t_x`` of VARIANT columns ``_v_x``."""
    df = df.withColumns({f"_s_{n}": F.schema_of_variant(f"_v_{n}") for n in names})
    return df.withColumns(
        {f"_k_{n}": json_text.kind_of_schema(F.col(f"_s_{n}")) for n in names}
        | {
            f"_t_{n}": F.when(F.col(f"_s_{n}") == "STRING", trimmed(_string(F.col(f"_v_{n}"))))
            for n in names
        }
    ).drop(*[f"_s_{n}" for n in names])


def coerced_number(name: str) -> Column:
    """DOUBLE of a numeric VARIANT or of numeric text, else NULL."""
    return F.when(F.col(f"_k_{name}") == "number", _double(F.col(f"_v_{name}"))).otherwise(
        number_from_text(F.col(f"_t_{name}"))
    )


def absent(name: str) -> Column:
    """Missing, null and blank text all count as absent."""
    return F.col(f"_k_{name}").isin("undefined", "null") | F.coalesce(
        F.col(f"_t_{name}") == "", F.lit(False)
    )


def _with_telemetry(df: DataFrame) -> DataFrame:
    """Telemetry as an object with unquoted scalars: ``_tel`` VARIANT, ``_tel_text``.

    ``_tel_kind`` tells what it is when it is no object.
    """
    raw = F.col("_v_tel")
    df = df.withColumn("_raw_text", F.to_json(raw))
    df = df.withColumn("_raw_mark", F.left("_raw_text", F.lit(1)))
    is_text = F.col("_raw_mark") == '"'
    df = df.withColumn("_inner", F.when(is_text, trimmed(_string(raw))))
    empty = F.col("_raw_mark").isNull() | (F.col("_raw_mark") == "n") | (F.col("_inner") == "")
    df = df.withColumn(
        "_tel",
        F.when(empty, F.parse_json(F.lit("{}")))
        .when(is_text, json_text.parsed(F.col("_inner")))
        .otherwise(raw),
    )
    df = df.withColumn(
        "_tel_text",
        F.when(empty, "{}").when(is_text, F.to_json("_tel")).otherwise(F.col("_raw_text")),
    )
    # Text that is no JSON stays a string, which the object check rejects.
    mark = F.coalesce(F.left("_tel_text", F.lit(1)), F.lit('"'))
    df = df.withColumns(
        {"_tel_mark": mark, "_quoted": json_text.has_quoted_scalar(F.col("_tel_text"))}
    )
    return df.withColumn("_tel_kind", json_text.kind_of_mark(F.col("_tel_mark"))).withColumn(
        "_tel",
        F.when(F.col("_tel_mark") != "{", None)
        .when(F.col("_quoted"), F.try_parse_json(json_text.unquote_scalars(F.col("_tel_text"))))
        .otherwise(F.col("_tel")),
    )


def _with_readings(df: DataFrame) -> DataFrame:
    """The modelled readings as DOUBLEs, and the canonical telemetry text."""
    df = df.withColumns({f"_v_{n}": json_text.field(F.col("_tel"), n) for n in READINGS})
    df = _with_kinds(df, list(READINGS))
    df = df.withColumns({column: coerced_number(n) for n, (column, _, _) in READINGS.items()})
    # A reading given as text or null is replaced or removed in the object itself,
    # since the object is what the identity hash is taken over.
    untidy = F.lit(False)
    for n in READINGS:
        untidy = untidy | F.col(f"_k_{n}").isin("string", "null")
    members = F.try_variant_get(F.col("_tel"), "$", "map<string,variant>")
    others = F.map_filter(members, lambda k, _: ~k.isin(*READINGS))
    readings = F.map_filter(
        F.create_map(
            *[
                part
                for n, (column, _, _) in READINGS.items()
                for part in (F.lit(n), F.col(column).cast("variant"))
            ]
        ),
        lambda _, v: v.isNotNull(),
    )
    rebuilt = F.to_json(F.parse_json(F.to_json(F.map_concat(others, readings))))
    df = df.withColumn(
        "_sorted",
        F.when(untidy, rebuilt)
        .when(F.col("_quoted"), F.to_json("_tel"))
        .otherwise(F.col("_tel_text")),
    )
    return df.withColumn("telemetry", json_text.canonical(F.col("_sorted")))


def _too_long(text: Column) -> Column:
    return (F.octet_length(text) > MAX_ID_LENGTH) & (utf16_length(text) > MAX_ID_LENGTH)


def _field_rules(now: Column) -> list[tuple[Column, Column]]:
    """(broken, issue) per rule, in field order."""
    infinity = float("inf")
    drone, time, status = F.col("drone_id"), F.col("event_time"), F.col("_status")
    whole = status == F.rint(status)

    status_message = F.when(
        F.abs(status) > SAFE_INTEGER, "statusCode must be a whole number"
    ).otherwise("statusCode must fit a 32-bit integer")
    rules = [
        (
            ~absent("id") & (F.col("_k_id") != "string"),
            issue("eventId", "invalid_type", _expected("string", F.col("_k_id"))),
        ),
        (
            _too_long(F.col("supplied_id")),
            issue("eventId", "too_big", "Too big: expected string to have <=128 characters"),
        ),
        (drone.isNull(), issue("droneId", "invalid_type", "droneId is required")),
        (drone == "", issue("droneId", "too_small", "droneId must not be empty")),
        (_too_long(drone), issue("droneId", "too_big", "droneId is unreasonably long")),
        (
            time.isNull(),
            issue("timestamp", "invalid_type", "timestamp must be an ISO 8601 date or an epoch value"),
        ),
        (
            instants.too_old(time),
            issue(
                "timestamp",
                "custom",
                "timestamp is implausibly old, which usually indicates a firmware clock fault",
            ),
        ),
        (
            instants.too_new(time, now),
            issue("timestamp", "custom", "timestamp is more than 24 hours in the future"),
        ),
        (
            F.col("event_type").isNull(),
            issue("eventType", "invalid_type", "eventType is required"),
        ),
        (
            ~absent("status") & (status.isNull() | (F.abs(status) == infinity)),
            issue("statusCode", "invalid_type", _expected("number", F.col("_k_status"))),
        ),
        (
            ~whole & (F.abs(status) < infinity),
            issue("statusCode", "invalid_type", "statusCode must be a whole number"),
        ),
        (
            whole & (status > INT_MAX) & (status < infinity),
            issue("statusCode", "too_big", status_message),
        ),
        (
            whole & (status < INT_MIN) & (status > -infinity),
            issue("statusCode", "too_small", status_message),
        ),
        (
            F.col("_tel_mark") != "{",
            issue("telemetryData", "invalid_type", _expected("object", F.col("_tel_kind"))),
        ),
    ]
    for n, (column, low, high) in READINGS.items():
        path, value = f"telemetryData.{n}", F.col(column)
        low_message, high_message = READING_MESSAGES[n]
        rules += [
            (
                ~absent(n) & (value.isNull() | (F.abs(value) == infinity)),
                issue(path, "invalid_type", _expected("number", F.col(f"_k_{n}"))),
            ),
            ((value < low) & (value > -infinity), issue(path, "too_small", low_message)),
            ((value > high) & (value < infinity), issue(path, "too_big", high_message)),
        ]
    return rules


def _with_issues(df: DataFrame, now: Column) -> DataFrame:
    rules = _field_rules(now)
    broken = F.col("parse_error").isNotNull() | F.coalesce(
        F.col("root_kind") != "object", F.lit(False)
    )
    for rule, _ in rules:
        broken = broken | F.coalesce(rule, F.lit(False))
    # The list is built for broken records only; most records have none.
    found = F.array_compact(F.array(*[F.when(rule, what) for rule, what in rules]))
    listed = (
        F.when(~F.col("_broken"), F.array())
        .when(is_continued(F.col("parse_error")), F.array(issue("(root)", CONTINUED_CODE, F.col("parse_error"))))
        .when(
            F.col("parse_error").isNotNull(),
            F.array(issue("(root)", "parse_error", F.col("parse_error"))),
        )
        .when(
            F.col("root_kind") != "object",
            F.array(issue("(root)", "invalid_type", _expected("object", F.col("root_kind")))),
        )
        .otherwise(found)
    )
    return df.withColumn("_broken", broken).withColumn("issues", listed.cast(ISSUES_TYPE))


def validated(candidates: DataFrame, now: Column | None = None) -> DataFrame:
    """Add the typed fields and ``issues`` to a candidate frame.

    ``now`` bounds future timestamps; pass a literal to make a run repeatable.
    Each step is a column of its own, so that nothing is computed twice per row.
    """
    now = F.current_timestamp() if now is None else now
    value = F.col("value")
    fields = {
        "id": "eventId",
        "drone": "droneId",
        "ts": "timestamp",
        "type": "eventType",
        "status": "statusCode",
    }
    df = candidates.withColumns(
        {f"_v_{n}": json_text.field(value, key) for n, key in fields.items()}
        | {"_v_tel": json_text.field(value, "telemetryData")}
    )
    df = _with_kinds(df, list(fields))
    df = df.withColumns(
        {
            "supplied_id": F.nullif(F.col("_t_id"), F.lit("")),
            "drone_id": F.col("_t_drone"),
            "event_time": F.when(
                F.col("_k_ts") == "number", instants.from_epoch(_double(F.col("_v_ts")))
            ).otherwise(instants.from_text(F.col("_t_ts"))),
            "event_type": F.when(
                F.col("_t_type") != "", normalise_event_type(F.col("_t_type"))
            ),
            "_status": coerced_number("status"),
        }
    )
    df = df.withColumn(
        "status_code",
        F.when(
            (F.col("_status") == F.rint("_status")) & F.col("_status").between(INT_MIN, INT_MAX),
            F.col("_status").cast("int"),
        ),
    )
    df = _with_issues(_with_readings(_with_telemetry(df)), now)
    return df.select(
        *[c for c in candidates.columns if c != "value"],
        "supplied_id",
        "drone_id",
        "event_time",
        "event_type",
        "status_code",
        "telemetry",
        *[column for column, _, _ in READINGS.values()],
        "issues",
    )
