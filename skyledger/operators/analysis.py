"""Fleet questions over the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.operators.validate import CONTINUED_CODE


def failing_fields(quarantine: DataFrame) -> DataFrame:
    """How often each field fails, most frequent first; a record in parts fails once."""
    return (
        quarantine.select(F.explode("errors").alias("issue"))
        .where(F.col("issue.code") != CONTINUED_CODE)
        .groupBy(F.col("issue.path").alias("path"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "path")
    )


def event_count(events: DataFrame) -> DataFrame:
    return events.agg(F.count(F.lit(1)).alias("n"))


def battery_by_altitude(events: DataFrame, altitude_key: str = "altitudeM") -> DataFrame:
    """Battery level against altitude, per device."""
    telemetry = F.col("telemetry")
    if dict(events.dtypes)["telemetry"] == "string":
        telemetry = F.try_parse_json(telemetry)
    readings = events.select(
        "drone_id",
        F.col("battery_pct").cast("double").alias("battery"),
        F.try_variant_get(telemetry, f"$.{altitude_key}", "double").alias("altitude"),
    ).where(F.col("battery").isNotNull() & F.col("altitude").isNotNull())
    return readings.groupBy("drone_id").agg(
        F.count(F.lit(1)).alias("readings"),
        F.corr("battery", "altitude").alias("correlation"),
        F.regr_slope("battery", "altitude").alias("slope"),
        F.avg("battery").alias("avg_battery"),
        F.min("battery").alias("min_battery"),
        F.max("battery").alias("max_battery"),
    )


def quarantine_rate(received: DataFrame, window: str = "5 minutes") -> DataFrame:
    """Share of rejected records per time window; ``received`` has ``(at, rejected)``."""
    return (
        received.groupBy(F.window("at", window).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("received"),
            F.count_if(F.col("rejected")).alias("quarantined"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            "received",
            "quarantined",
            (F.col("quarantined") / F.col("received")).alias("rate"),
        )
    )


def quarantine_rate_of_outcomes(outcomes: DataFrame, window: str = "5 minutes") -> DataFrame:
    """Share of rejected records per time window of the stored outcomes."""
    return (
        outcomes.groupBy(F.window("finished_at", window).alias("w"))
        .agg(F.sum("received").alias("received"), F.sum("quarantined").alias("quarantined"))
        .where(F.col("received") > 0)
        .select(
            F.col("w.start").alias("window_start"),
            "received",
            "quarantined",
            (F.col("quarantined") / F.col("received")).alias("rate"),
        )
    )


def error_share(events: DataFrame) -> DataFrame:
    """Share of error events per day."""
    return (
        events.groupBy(F.to_date("event_time").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count_if(F.col("severity") == "error").alias("errors"),
        )
        .withColumn("share", F.col("errors") / F.col("events"))
    )
