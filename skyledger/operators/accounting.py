"""Counting: every received record is an event, a rejection or a duplicate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.operators.validate import ISSUES_TYPE, first_parts

#: A delivery: a message id, and its place in the order of arrival.
DELIVERY = ("batch_id", "batch_seq")
# Attempts after which a message counts as dead.
MAX_ATTEMPTS = 3
# Alarm rules: window length, failures above which a window is bad, windows in a row.
ALARM_WINDOW = "300 seconds"
ALARM_FAILURES = 5
ALARM_WINDOWS = 2


def batch_counters(judged: DataFrame) -> DataFrame:
    """received / valid / quarantined / duplicates_in_batch / contract_smell per delivery.

    ``valid`` is counted after in-batch deduplication. Copies are first counted per
    id, so no distinct count has to gather a delivery's ids in one place. Of a record
    in parts only the first counts.
    """
    per_id = first_parts(judged).groupBy(*DELIVERY, "event_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("valid")).alias("n_valid")
    )
    valid = F.count_if(F.col("n_valid") > 0)
    return (
        per_id.groupBy(*DELIVERY)
        .agg(
            F.sum("n").alias("received"),
            valid.alias("valid"),
            (F.sum("n") - F.sum("n_valid")).alias("quarantined"),
            (F.sum("n_valid") - valid).alias("duplicates_in_batch"),
        )
        .withColumn("contract_smell", contract_smell())
    )


def contract_smell() -> Column:
    """A delivery in which nothing was valid points at a contract problem."""
    return (F.col("received") > 0) & (F.col("valid") == 0)


def sample_errors(judged: DataFrame) -> DataFrame:
    """The first rejected record's issues of each delivery."""
    return (
        first_parts(judged.where(~F.col("valid")))
        .groupBy(*DELIVERY)
        .agg(F.min_by("issues", "ord").alias("sample_errors"))
    )


def outcomes(
    deliveries: DataFrame,
    counters: DataFrame,
    inserted: DataFrame,
    samples: DataFrame | None = None,
    truncated: DataFrame | None = None,
) -> DataFrame:
    """One row per delivery ``(batch_id, batch_seq, status, error)`` with its counts.

    ``inserted`` is ``(batch_id, batch_seq, inserted)``; what was valid but not inserted had
    been stored before. ``truncated`` is ``(batch_id, batch_seq, truncated)``: records that a
    cap cut off unread, which ``received`` does not count.
    """
    key = list(DELIVERY)
    df = deliveries.join(counters, key, "left").join(inserted, key, "left")
    if truncated is None:
        df = df.withColumn("truncated", F.lit(0))
    else:
        df = df.join(truncated, key, "left")
    if samples is None:
        df = df.withColumn("sample_errors", F.lit(None).cast(ISSUES_TYPE))
    else:
        df = df.join(samples, key, "left")
    done = F.col("status") == "processed"

    def count(name: str):
        return F.when(done, F.coalesce(F.col(name), F.lit(0))).otherwise(0).cast("bigint")

    return df.select(
        *DELIVERY,
        "status",
        count("received").alias("received"),
        count("valid").alias("valid"),
        count("inserted").alias("inserted"),
        (count("valid") - count("inserted")).alias("duplicates"),
        count("duplicates_in_batch").alias("duplicates_in_batch"),
        count("quarantined").alias("quarantined"),
        count("truncated").alias("truncated"),
        F.coalesce("contract_smell", F.lit(False)).alias("contract_smell"),
        F.when(F.col("contract_smell"), F.col("sample_errors")).alias("sample_errors"),
        "error",
    )


def dead_letters(outcome_rows: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Messages that failed ``max_attempts`` times or more and never went through."""
    return (
        outcome_rows.groupBy("batch_id")
        .agg(
            F.count_if(F.col("status") == "failed").alias("failures"),
            F.bool_or(F.col("status") != "failed").alias("settled"),
            F.max("finished_at").alias("last_attempt"),
        )
        .where((F.col("failures") >= max_attempts) & ~F.col("settled"))
        .drop("settled")
    )


def failure_windows(outcome_rows: DataFrame, window: str = ALARM_WINDOW) -> DataFrame:
    """Failed outcomes per time window. Windows without outcomes have no row."""
    return (
        outcome_rows.groupBy(F.window("finished_at", window).alias("w"))
        .agg(F.count_if(F.col("status") == "failed").alias("failures"))
        .select(F.col("w.start").alias("window_start"), "failures")
    )


def failure_alarms(
    outcome_rows: DataFrame,
    window: str = ALARM_WINDOW,
    failures: int = ALARM_FAILURES,
    in_a_row: int = ALARM_WINDOWS,
) -> DataFrame:
    """Windows closing a run of ``in_a_row`` adjacent windows with too many failures.

    Bad windows are matched with their predecessors by key, a join instead of a
    window function over all of time in one task.
    """
    bad = failure_windows(outcome_rows, window).where(F.col("failures") > failures)
    result = bad
    for step in range(1, in_a_row):
        earlier = bad.select(
            (F.col("window_start") + step * F.expr(f"INTERVAL {window}")).alias("window_start"),
            F.col("failures").alias(f"failures_{step}_before"),
        )
        result = result.join(earlier, "window_start")
    return result


def dead_letter_alarm(dead: DataFrame, window: str = ALARM_WINDOW) -> DataFrame:
    """Windows in which any message became a dead letter."""
    return (
        dead.groupBy(F.window("last_attempt", window).alias("w"))
        .agg(F.count(F.lit(1)).alias("dead_letters"))
        .select(F.col("w.start").alias("window_start"), "dead_letters")
    )
