"""Alarms while the outcomes come in: failures per window, corrected by late outcomes, and one alarm for each run of bad windows.

A streaming aggregate counts the failures of each window, of all outcomes however late they come. Its state holds one row a
window; given ``late``, it is let go when the watermark has passed the window, and outcomes for it are not counted any more.
Each micro-batch stores the windows that changed, under its own number, so a batch that is run again replaces itself, and a
restarted stream goes on with the counts of its checkpoint. The newest row of a window holds its count.

A run is a row of adjacent bad windows, at least ``in_a_row`` of them. It is found again around the windows that
changed, on the stored windows (one row a window) from its first one on, however far back that is, and raises an alarm
unless one of its windows has raised one before: a late outcome may make a run longer, or join two, without a second alarm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from skyledger.operators.accounting import ALARM_FAILURES, ALARM_WINDOW, ALARM_WINDOWS, failure_windows
from skyledger.session import configure
from skyledger.sources.tables import Tables


def stored_windows(tables: Tables, name: str) -> DataFrame:
    """``(window_start, failures)`` as far as the stream ``name`` has counted them."""
    rows = tables.failure_windows().where(F.col("stream") == name)
    return rows.groupBy("window_start", "window_date").agg(F.max_by("failures", "version").alias("failures"))


def whole_runs(windows: DataFrame, day: int, window: str, failures: int) -> DataFrame:
    """``windows`` ``(window_start, window_date, failures)`` of the date ``day`` (its number) and after, and of those before it
    as many as their runs of bad windows take.

    A run that is cut would look like a new one, or a shorter one. So dates are added, twice as many each time, until no
    run goes on before the first of them.
    """
    days = 1
    while True:
        first = F.date_from_unix_date(F.lit(day - days))
        second = first.cast("timestamp") + F.expr(f"INTERVAL {window}")
        near = windows.where(F.col("window_date") >= first)
        # The first window alone can follow one of an earlier date; its date, too, is asked for, so no other one is opened.
        opens = (F.col("window_date") <= F.to_date(second)) & (F.col("window_start") < second)
        if near.where(opens & (F.col("failures") > failures)).isEmpty():
            return near
        days *= 2


def bad_runs(windows: DataFrame, window: str, failures: int, in_a_row: int) -> DataFrame:
    """``(run_start, run_end)`` of each run of bad windows in ``windows`` ``(window_start, failures)``.

    The window function runs over the bad windows alone, of which there are few, and none for each outcome.
    """
    bad = windows.where(F.col("failures") > failures).select("window_start")
    in_time = Window.orderBy("window_start")
    step = F.expr(f"INTERVAL {window}")
    opens = F.coalesce(F.lag("window_start").over(in_time) + step != F.col("window_start"), F.lit(True))
    runs = bad.withColumn("run", F.sum(opens.cast("long")).over(in_time)).groupBy("run")
    found = runs.agg(F.min("window_start").alias("run_start"), F.max("window_start").alias("run_end"), F.count(F.lit(1)).alias("n"))
    return found.where(F.col("n") >= in_a_row).select("run_start", "run_end")


def alarm_stream(
    outcomes: DataFrame,
    tables: Tables,
    name: str,
    checkpoint: str,
    *,
    window: str = ALARM_WINDOW,
    failures: int = ALARM_FAILURES,
    in_a_row: int = ALARM_WINDOWS,
    late: str | None = None,
) -> DataStreamWriter:
    """Writer for a stream of outcomes ``(status, finished_at)``; given ``late``, outcomes further behind are not counted."""
    configure(tables.spark)

    def store(batch: DataFrame, number: int) -> None:
        changed = batch.withColumns({"version": F.lit(number).cast("long"), "window_date": F.to_date("window_start")})
        tables.write_failure_windows(changed, name, number)
        day = batch.agg(F.min(F.unix_date(F.to_date("window_start"))).alias("low")).collect()[0]["low"]
        if day is None:
            return
        runs = bad_runs(whole_runs(stored_windows(tables, name), day, window, failures), window, failures, in_a_row)
        raised = tables.alarms().where((F.col("stream") == name) & (F.col("version") != number))
        raised = raised.select("window_start").distinct()
        # Each window of a run is looked up by its own time, so the join is on equal times.
        windows = runs.select("run_start", F.explode(F.sequence("run_start", "run_end", F.expr(f"INTERVAL {window}"))).alias("window_start"))
        known = windows.join(raised, "window_start").select("run_start").distinct()
        new = runs.join(known, "run_start", "left_anti")
        tables.write_alarms(new.select((F.col("run_start") + (in_a_row - 1) * F.expr(f"INTERVAL {window}")).alias("window_start"), "run_start"), name, number)

    counts = failure_windows(outcomes.withWatermark("finished_at", late) if late else outcomes, window)
    return (
        counts.writeStream.queryName(name)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
    )
