"""Intake: candidates to stored events, quarantine rows and outcomes.

Batch jobs and streams run this same function on each set of deliveries.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.accounting import DELIVERY, batch_counters, outcomes, sample_errors
from skyledger.operators.dedupe import winners, winning_rows
from skyledger.operators.transform import judged
from skyledger.operators.validate import validated
from skyledger.session import configure, scratch_scope, written
from skyledger.sources.lines import literal_path
from skyledger.sources.messages import resolved
from skyledger.sources.payloads import as_batch, read_payloads
from skyledger.sources.tables import Tables


def instant(now: datetime | None) -> Column:
    """One clock reading for a whole run, so every task judges alike."""
    now = datetime.now(timezone.utc) if now is None else now
    if now.tzinfo is None:
        now = now.replace(tzinfo=timezone.utc)
    return F.lit(now)


def judge(candidates: DataFrame, now: datetime | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Candidates with their verdict; see :func:`skyledger.operators.transform.judged`.

    The rows are written once to the shared folder and read back. Everything that
    follows reads the few columns it needs from there, instead of parsing again, and
    no later filter is pushed into the validation steps, where it would be computed
    a second time. Of a run that needs few ``columns`` only those are written.
    """
    rows = judged(validated(candidates, instant(now)))
    return written(rows if columns is None else rows.select(*columns), "judged")


def run_intake(
    tables: Tables,
    candidates: DataFrame,
    deliveries: DataFrame,
    ingest_batch: str,
    now: datetime | None = None,
    truncated: DataFrame | None = None,
) -> DataFrame:
    """Store one set of deliveries and return their outcome rows.

    Events are written before quarantine rows, so a run that
    breaks in between leaves no rejected record without its accepted neighbours,
    and running it again finds the events in place. Known ids come from the index of
    ids, which is written right after the events; a batch that breaks in between is
    indexed before the next one is judged.
    """
    at = instant(now)
    rows = judge(candidates, now)
    valid = rows.where("valid")

    tables.heal(ingest_batch)
    # The accepted range of event times bounds the number of days.
    days = [r[0] for r in valid.select(F.to_date("event_time")).distinct().collect()]
    known = tables.ids().known(valid.select("event_id", "id_kind"), ingest_batch, days)
    fresh = winners(valid.select("event_id", "ord")).join(known, "event_id", "left_anti")
    wide = valid.drop("valid", "issues").withColumnRenamed("payload", "raw")
    tables.announce(ingest_batch)
    tables.write_events(winning_rows(wide, fresh), ingest_batch, at)
    stored = tables.events().where(F.col("ingest_batch") == ingest_batch)  # one listing of its folders for both uses
    tables.index_batch(ingest_batch, stored)
    tables.write_quarantine(rows.where(~F.col("valid")), ingest_batch, at)

    inserted = stored.groupBy(*DELIVERY).agg(F.count(F.lit(1)).alias("inserted"))
    result = outcomes(deliveries, batch_counters(rows), inserted, sample_errors(rows), truncated)
    tables.write_outcomes(result, ingest_batch, at)
    return tables.outcomes().where(F.col("ingest_batch") == ingest_batch)


def one_delivery(spark: SparkSession, batch_id: str) -> DataFrame:
    return spark.createDataFrame(
        [(batch_id, 0, "processed", None)],
        "batch_id string, batch_seq bigint, status string, error string",
    )


def ingest_files(
    spark: SparkSession,
    tables: Tables,
    paths: str | Sequence[str],
    *,
    batch_id: str | None = None,
    now: datetime | None = None,
    max_records: int | None = None,
    scan: dict[str, str] | None = None,
) -> DataFrame:
    """Store every file under ``paths`` as one delivery.

    Running it again over an archive is a replay: what is stored already counts as
    a duplicate and changes nothing. ``scan`` narrows the files by the options of
    Spark's file sources, such as ``modifiedAfter`` or ``pathGlobFilter``.
    """
    configure(spark)
    batch_id = batch_id or f"files-{uuid.uuid4().hex}"
    with scratch_scope(spark):
        files, cut = read_payloads(spark, paths, max_records, scan)
        if cut is not None:
            cut = cut.agg(F.sum("truncated").alias("truncated")).select(
                F.lit(batch_id).alias("batch_id"), F.lit(0).cast("bigint").alias("batch_seq"), "truncated"
            )
        return run_intake(tables, as_batch(files, batch_id), one_delivery(spark, batch_id), batch_id, now, cut)


#: Bytes of files that a replay stores as one batch, about.
REPLAY_BYTES = 64 << 30


def replay(
    spark: SparkSession,
    tables: Tables,
    paths: str | Sequence[str],
    name: str,
    *,
    now: datetime | None = None,
    scan: dict[str, str] | None = None,
    batch_bytes: int = REPLAY_BYTES,
) -> DataFrame:
    """Store an archive in batches of files, and go on where an earlier call of this ``name`` stopped.

    A ledger holds every file, with its length and time, once its batch is stored. Files in it are not opened
    again; one that was changed since is. Which batch a file belongs to follows from its path and the size of the
    whole archive, so a batch that broke off is run again as it was and replaces itself. Returns the outcomes of the replay.
    """
    configure(spark)
    with scratch_scope(spark):
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").options(**(scan or {}))
        # Names and sizes only: the content is a column of its own, which is not read.
        files = found.load(paths if isinstance(paths, str) else list(paths)).select("path", "length", F.col("modificationTime").alias("modified"))
        files = written(files, "archive")
        total = files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).collect()[0]["n"]
        batches = max(1, -(-total // batch_bytes))
        todo = files.join(tables.ledger(), ["path", "length", "modified"], "left_anti")
        todo = written(todo.withColumn("number", F.pmod(F.xxhash64("path"), F.lit(batches))), "archive-left")
        for number in sorted(r["number"] for r in todo.select("number").distinct().collect()):
            own = todo.where(F.col("number") == number)
            batch = f"{name}-{batches}-{number}"
            ingest_files(spark, tables, [literal_path(r["path"]) for r in own.select("path").collect()], batch_id=batch, now=now)
            tables.write_ledger(own, batch)
    return tables.outcomes().where(F.col("ingest_batch").startswith(f"{name}-"))


def ingest_messages(
    spark: SparkSession,
    tables: Tables,
    messages: DataFrame,
    *,
    ingest_batch: str | None = None,
    now: datetime | None = None,
    template: str = "s3a://{bucket}/{key}",
    max_records: int | None = None,
    numbered: bool = False,
) -> DataFrame:
    """Store the records of messages ``(message_id, body[, message_seq])``, told apart already if ``numbered``."""
    configure(spark)
    with scratch_scope(spark):
        found = resolved(spark, messages, template, max_records, numbered)
        return run_intake(
            tables,
            found.candidates,
            found.deliveries,
            ingest_batch or f"messages-{uuid.uuid4().hex}",
            now,
            found.truncated,
        )
