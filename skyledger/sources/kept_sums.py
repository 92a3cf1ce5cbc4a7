"""Kept sums: what fleet questions need of the stored rows, summed up once for each partition that holds them.

The sums of a batch stand in one folder: those of events hold one row a partition and device, those of rejected rows one row a
partition and failing field. Bringing them up to date sums up the batches that have no sums yet or of which a partition is gone
(see :mod:`skyledger.sources.batch_mirror`), so batches, late rows and compactions cost what they changed. A batch that is
written again first drops its own sums. Sums merge: counts, sums, sums of squares and of products, extremes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.validate import CONTINUED_CODE
from skyledger.sources.batch_mirror import BatchMirror
from skyledger.sources.folders import Folders
from skyledger.sources.tables import EVENT_PARTITIONS, EVENT_SUMS, ISSUE_SUMS, QUARANTINE_PARTITIONS, Tables

EVENT_SUMS_SCHEMA = """
    drone_id string, events bigint, readings bigint, battery double, altitude double, battery_squares double,
    altitude_squares double, products double, min_battery double, max_battery double,
    id_kind string, event_date date, severity string, ingest_batch string
"""
ISSUE_SUMS_SCHEMA = "path string, n bigint, failed_date date, ingest_batch string"


def _summed_events(events: DataFrame, altitude_key: str) -> DataFrame:
    battery = F.col("battery_pct").cast("double")
    rows = events.select(*EVENT_PARTITIONS, "drone_id", battery.alias("b"), F.try_variant_get("telemetry", f"$.{altitude_key}", "double").alias("a"))
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    b, a = F.when(both, F.col("b")), F.when(both, F.col("a"))
    return rows.groupBy(*EVENT_PARTITIONS, "drone_id").agg(
        F.count(F.lit(1)).alias("events"), F.count(b).alias("readings"), F.sum(b).alias("battery"), F.sum(a).alias("altitude"),
        F.sum(b * b).alias("battery_squares"), F.sum(a * a).alias("altitude_squares"), F.sum(a * b).alias("products"),
        F.min(b).alias("min_battery"), F.max(b).alias("max_battery"),
    )


def _summed_issues(quarantine: DataFrame) -> DataFrame:
    issues = quarantine.select(*QUARANTINE_PARTITIONS, F.explode("errors").alias("issue")).where(F.col("issue.code") != CONTINUED_CODE)
    return issues.groupBy(*QUARANTINE_PARTITIONS, F.col("issue.path").alias("path")).agg(F.count(F.lit(1)).alias("n"))


class KeptSums:
    def __init__(self, tables: Tables, altitude_key: str = "altitudeM") -> None:
        self.tables, self.altitude_key = tables, altitude_key
        self.spark: SparkSession = tables.spark
        self.files = Folders(tables.spark, tables.root)

    def refresh(self) -> int:
        """Bring the sums up to date; returns how many partitions are new in them."""

        def events(batches: list[str]) -> None:
            rows = self.tables.events().where(F.col("ingest_batch").isin(batches))
            self.tables.write_sums(_summed_events(rows, self.altitude_key), EVENT_SUMS, EVENT_SUMS_SCHEMA)

        def issues(batches: list[str]) -> None:
            rows = self.tables.quarantine().where(F.col("ingest_batch").isin(batches))
            self.tables.write_sums(_summed_issues(rows), ISSUE_SUMS, ISSUE_SUMS_SCHEMA)

        done = BatchMirror(self.files, "telemetry_events", EVENT_PARTITIONS, EVENT_SUMS).refresh(events)
        return done + BatchMirror(self.files, "telemetry_quarantine", QUARANTINE_PARTITIONS, ISSUE_SUMS).refresh(issues)

    def events(self) -> DataFrame:
        return self.tables.sums(EVENT_SUMS, EVENT_SUMS_SCHEMA)

    def event_count(self) -> DataFrame:
        return self.events().agg(F.coalesce(F.sum("events"), F.lit(0)).alias("n"))

    def error_share(self) -> DataFrame:
        """As :func:`skyledger.operators.analysis.error_share`."""
        errors = F.sum(F.when(F.col("severity") == "error", F.col("events")).otherwise(0))
        days = self.events().groupBy(F.col("event_date").alias("day")).agg(F.sum("events").alias("events"), errors.alias("errors"))
        return days.withColumn("share", F.col("errors") / F.col("events"))

    def failing_fields(self) -> DataFrame:
        """As :func:`skyledger.operators.analysis.failing_fields`."""
        rows = self.tables.sums(ISSUE_SUMS, ISSUE_SUMS_SCHEMA).groupBy("path").agg(F.sum("n").alias("n"))
        return rows.orderBy(F.desc("n"), "path")

    def battery_by_altitude(self) -> DataFrame:
        """As :func:`skyledger.operators.analysis.battery_by_altitude`."""
        names = ("readings", "battery", "altitude", "battery_squares", "altitude_squares", "products")
        by_device = self.events().where("readings > 0").groupBy("drone_id").agg(
            *[F.sum(n).alias(n) for n in names], F.min("min_battery").alias("min_battery"), F.max("max_battery").alias("max_battery")
        )
        n = F.col("readings")
        spread = lambda x, y, product: F.col(product) - F.col(x) * F.col(y) / n
        bb, aa = spread("battery", "battery", "battery_squares"), spread("altitude", "altitude", "altitude_squares")
        ab = spread("battery", "altitude", "products")
        return by_device.select(
            "drone_id", "readings", F.try_divide(ab, F.sqrt(aa * bb)).alias("correlation"), F.try_divide(ab, aa).alias("slope"),
            (F.col("battery") / n).alias("avg_battery"), "min_battery", "max_battery",
        )
