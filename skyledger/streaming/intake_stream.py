"""Continuous intake with Structured Streaming.

Each micro-batch goes through the batch intake. Duplicates are looked up in the
stored events instead of in streaming state, so a fact is recognised however late it
comes again; there is no watermark and late data is accepted with its own time.

A failed message is tried again with the next micro-batch, or after a set time: then the
stream also follows the table of failed messages, keeps each in state under a timer, and
hands it on when that runs out, also while no new message comes.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta
from typing import Any, Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from skyledger.operators.accounting import MAX_ATTEMPTS
from skyledger.plans.intake import ingest_files, ingest_messages
from skyledger.session import configure, scratch_scope, written
from skyledger.sources.lines import literal_path
from skyledger.sources.messages import numbered_deliveries
from skyledger.sources.tables import Tables

#: What comes out of state when a message is due.
DUE_SCHEMA = "message_id string, message_seq bigint, body string, attempts int"
#: The attempts of a message are forgotten so long after its last change.
FORGET_AFTER = timedelta(days=14)
_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

Clock = Callable[[], datetime | None]


def _no_clock() -> None:
    return None


class Waiting(StatefulProcessor):
    """Holds a failed message until its time has come. One message is one key, so no state grows with the stream.

    An attempt that comes in twice (a micro-batch that was run again writes its failures again) is held once.
    """

    def __init__(self, delay: timedelta) -> None:
        self.delay_ms = int(delay.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        ttl = int(FORGET_AFTER.total_seconds() * 1000)
        self.held = handle.getValueState("held", "body string, attempts int", ttl)

    def handleInputRows(self, key: Any, rows: Iterator[Any], timerValues: Any) -> Iterator[Any]:
        held = self.held.get() if self.held.exists() else None
        body, attempts = held if held else (None, -1)
        for frame in rows:
            for new_body, new_attempts in zip(frame["body"], frame["attempts"], strict=True):
                if new_attempts > attempts:
                    body, attempts = new_body, int(new_attempts)
        if held is None or attempts > held[1]:
            self.held.update((body, attempts))
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.delay_ms)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Any]:
        import pandas as pd

        if self.held.exists():
            body, attempts = self.held.get()
            yield pd.DataFrame({"message_id": [key[0]], "message_seq": [key[1]], "body": [body], "attempts": [attempts]})

    def close(self) -> None:
        pass


def due_messages(tables: Tables, name: str, retry_after: timedelta) -> DataFrame:
    """A stream of the messages that the stream ``name`` failed to store, each ``retry_after`` its failure."""
    spark = tables.spark
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _STATE_STORE)
    failed = tables.retry_stream().where(F.col("ingest_batch").startswith(f"{name}-"))
    return failed.groupBy("message_id", "message_seq").transformWithStateInPandas(
        statefulProcessor=Waiting(retry_after), outputStructType=DUE_SCHEMA, outputMode="append", timeMode="ProcessingTime"
    )


def message_stream(
    messages: DataFrame,
    tables: Tables,
    name: str,
    checkpoint: str,
    *,
    template: str = "s3a://{bucket}/{key}",
    clock: Clock = _no_clock,
    max_attempts: int = MAX_ATTEMPTS,
    retry_after: timedelta | None = None,
) -> DataStreamWriter:
    """Writer for a stream of ``(message_id, body[, message_seq])``.

    A micro-batch run again after a failure carries the same batch number and so
    replaces its own partitions. A message that fails, because its file is not there
    yet or cannot be opened, is kept and tried again, up to ``max_attempts`` times in
    all; its outcomes then make it a dead letter. It is tried again with the next
    micro-batch, or, given ``retry_after``, when so much time has passed, whether or
    not other messages come (with a trigger that goes on, such as ``processingTime``).
    """
    if "message_seq" not in messages.columns:
        messages = messages.withColumn("message_seq", F.lit(0).cast("bigint"))
    arriving = messages.select("message_id", "message_seq", "body", F.lit(0).alias("attempts"))
    if retry_after is not None:
        arriving = arriving.unionByName(due_messages(tables, name, retry_after))

    def store(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        ingest_batch = f"{name}-{number}"
        with scratch_scope(spark):
            if retry_after is None:
                waiting = tables.retries().where(F.col("ingest_batch") == f"{name}-{number - 1}").drop("ingest_batch")
                batch = batch.unionByName(waiting)
            tried = written(numbered_deliveries(batch), "tried")
            if retry_after is not None and tried.isEmpty():
                return  # a micro-batch that only looked at the timers
            outcomes = ingest_messages(
                spark,
                tables,
                tried.select("message_id", "body", "message_seq"),
                ingest_batch=ingest_batch,
                now=clock(),
                template=template,
                numbered=True,
            )
            failed = outcomes.where("status = 'failed'").select(
                F.col("batch_id").alias("message_id"), F.col("batch_seq").alias("message_seq")
            )
            again = tried.join(failed, ["message_id", "message_seq"], "left_semi").withColumn("attempts", F.col("attempts") + 1)
            tables.write_retries(
                again.where(F.col("attempts") < max_attempts).select("message_id", "body", "message_seq", "attempts"),
                ingest_batch,
            )

    return (
        arriving.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
    )


def file_stream(
    spark: SparkSession,
    folder: str,
    tables: Tables,
    name: str,
    checkpoint: str,
    *,
    max_files: int = 1000,
    clock: Clock = _no_clock,
) -> DataStreamWriter:
    """Writer that stores the files dropped into ``folder``.

    The stream itself carries names only. Each micro-batch reads its files with the
    batch reader, which splits large ones; ``max_files`` bounds the names per batch.
    """
    configure(spark)
    names = (
        spark.readStream.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", str(max_files))
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .load(folder)
        .select("path")
    )

    def store(batch: DataFrame, number: int) -> None:
        paths = [literal_path(row["path"]) for row in batch.select("path").collect()]
        if paths:
            ingest_files(
                batch.sparkSession, tables, paths, batch_id=f"{name}-{number}", now=clock()
            )

    return (
        names.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
    )
