"""Transformation: valid records to the rows that are stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.instants import iso_millis

# The severity rules, in order of precedence.
ERROR_EVENT_TYPES = ("DELIVERY_FAILED", "MOTOR_FAULT", "GPS_SIGNAL_LOST", "BATTERY_CRITICAL")
WARNING_EVENT_TYPES = ("BATTERY_LOW", "ROUTE_ADJUSTED")
ERROR_STATUS = 500
WARNING_STATUS = 400
LOW_BATTERY_PCT = 15
SEVERITIES = ("info", "warning", "error")
# Length of a derived id, in hexadecimal digits.
DERIVED_ID_LENGTH = 32


def severity(event_type: Column, status_code: Column, battery_pct: Column) -> Column:
    return (
        F.when(event_type.isin(*ERROR_EVENT_TYPES) | (status_code >= ERROR_STATUS), "error")
        .when(status_code >= WARNING_STATUS, "warning")
        .when(event_type.isin(*WARNING_EVENT_TYPES), "warning")
        .when(battery_pct <= LOW_BATTERY_PCT, "warning")
        .otherwise("info")
    )


def derived_id(
    drone_id: Column, event_time: Column, event_type: Column, status_code: Column, telemetry: Column
) -> Column:
    """Content hash: the same fact gets the same id in every format and delivery."""
    material = F.concat_ws(
        "|",
        drone_id,
        iso_millis(event_time),
        event_type,
        F.coalesce(status_code.cast("string"), F.lit("")),
        telemetry,
    )
    return F.left(F.sha2(material, 256), F.lit(DERIVED_ID_LENGTH))


def is_valid() -> Column:
    return F.size("issues") == 0


def judged(validated: DataFrame) -> DataFrame:
    """Every validated row with its verdict.

    Valid rows get ``event_id``, ``id_kind`` and ``severity``; ``payload`` is the
    received value of a valid row and the original text of a rejected one.
    """
    valid = is_valid()
    derived = derived_id(
        F.col("drone_id"),
        F.col("event_time"),
        F.col("event_type"),
        F.col("status_code"),
        F.col("telemetry"),
    )
    return validated.select(
        "batch_id",
        "batch_seq",
        "ord",
        "source",
        valid.alias("valid"),
        "issues",
        F.when(valid, F.col("raw_json")).otherwise(F.col("raw_text")).alias("payload"),
        F.when(valid, F.coalesce(F.col("supplied_id"), derived)).alias("event_id"),
        F.when(valid, F.when(F.col("supplied_id").isNull(), "derived").otherwise("supplied")).alias(
            "id_kind"
        ),
        "drone_id",
        "event_time",
        "event_type",
        "status_code",
        F.when(
            valid, severity(F.col("event_type"), F.col("status_code"), F.col("battery_pct"))
        ).alias("severity"),
        F.when(valid, F.col("battery_pct").cast("decimal(5,2)")).alias("battery_pct"),
        F.when(valid, F.col("latitude")).alias("latitude"),
        F.when(valid, F.col("longitude")).alias("longitude"),
        F.when(valid, F.col("telemetry")).alias("telemetry"),
    )
