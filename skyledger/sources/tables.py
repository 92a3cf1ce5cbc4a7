"""The stored tables: events, quarantine and outcomes, as partitioned Parquet."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date
from urllib.parse import quote, unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.transform import SEVERITIES
from skyledger.operators.validate import ISSUES_TYPE
from skyledger.session import with_setting
from skyledger.sources.batch_mirror import batch_folders, batch_name
from skyledger.sources.folders import Folders
from skyledger.sources.id_index import IdIndex
from skyledger.sources.lines import literal_path

EVENT_SCHEMA = """
    event_id string, drone_id string, event_time timestamp, event_type string,
    status_code int, battery_pct decimal(5,2), latitude double, longitude double,
    telemetry variant, raw string, source string, batch_id string, batch_seq bigint,
    ingested_at timestamp, id_kind string, event_date date, severity string, ingest_batch string
"""
#: ``id_kind`` first: an id supplied by a device may come on any date, a derived one holds its date.
EVENT_PARTITIONS = ("id_kind", "event_date", "severity", "ingest_batch")
QUARANTINE_SCHEMA = f"""
    source string, raw_payload string, errors {ISSUES_TYPE}, batch_id string, batch_seq bigint,
    failed_at timestamp, failed_date date, ingest_batch string
"""
QUARANTINE_PARTITIONS = ("failed_date", "ingest_batch")
RETRY_SCHEMA = "message_id string, body string, message_seq bigint, attempts int, ingest_batch string"
OUTCOME_SCHEMA = f"""
    batch_id string, batch_seq bigint, status string, received bigint, valid bigint,
    inserted bigint, duplicates bigint, duplicates_in_batch bigint, quarantined bigint, truncated bigint,
    contract_smell boolean, sample_errors {ISSUES_TYPE}, error string, finished_at timestamp,
    ingest_batch string
"""


LEDGER_SCHEMA = "path string, length bigint, modified timestamp, ingest_batch string"
#: What is kept of the stored rows, in one folder for each batch.
EVENT_SUMS, ISSUE_SUMS, EVENT_LEAVES = "batch_event_sums", "batch_issue_sums", "batch_event_leaves"
WINDOW_SCHEMA = "window_start timestamp, failures bigint, stream string, window_date date, version bigint"
ALARM_SCHEMA = "window_start timestamp, run_start timestamp, stream string, version bigint"
#: Events of a batch are written by so many tasks a core or more, unless there are few.
TASKS_A_CORE = 3
#: Folders of work in progress: batches whose ids are not in the index yet, staged compactions and staged events.
_UNINDEXED, _COMPACTION, _STAGED = "_unindexed", "_compaction", "_staged"


def checked(events: DataFrame) -> DataFrame:
    """Fail the write on a row no stored event may have, as a second defence."""

    def within(column: str, low: int, high: int):
        return F.col(column).isNull() | F.col(column).between(low, high)

    rules = {
        "event_id_not_null": F.col("event_id").isNotNull(),
        "drone_id_not_null": F.col("drone_id").isNotNull(),
        "event_time_not_null": F.col("event_time").isNotNull(),
        "event_type_not_null": F.col("event_type").isNotNull(),
        "severity_check": F.coalesce(F.col("severity").isin(*SEVERITIES), F.lit(False)),
        "battery_range": within("battery_pct", 0, 100),
        "latitude_range": within("latitude", -90, 90),
        "longitude_range": within("longitude", -180, 180),
    }
    broken = F.lit(None).cast("string")
    for name, rule in rules.items():
        broken = F.when(~rule, name).otherwise(broken)
    return events.where(
        F.when(
            broken.isNotNull(), F.raise_error(F.concat(F.lit("stored event breaks "), broken))
        ).otherwise(True)
    )


@dataclass(frozen=True)
class Tables:
    """The three tables under one root folder.

    Every write goes to partitions named after ``ingest_batch`` and replaces them,
    so a batch that is run again replaces itself. There must be one writer at a time.
    ``id_buckets`` is the number of buckets of a new store's index of ids.
    """

    spark: SparkSession
    root: str
    id_buckets: int | None = None

    def _read(self, name: str, schema: str) -> DataFrame:
        path = f"{self.root.rstrip('/')}/{name}"
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def events(self) -> DataFrame:
        return self._read("telemetry_events", EVENT_SCHEMA)

    def quarantine(self) -> DataFrame:
        return self._read("telemetry_quarantine", QUARANTINE_SCHEMA)

    def event_dates(self) -> list[date]:
        """The dates of stored events, from the names of the partitions."""
        return self._dates("telemetry_events/id_kind=*/event_date=*")

    def quarantine_dates(self) -> list[date]:
        return self._dates("telemetry_quarantine/failed_date=*")

    def _dates(self, pattern: str) -> list[date]:
        return sorted({date.fromisoformat(p.rsplit("=", 1)[1]) for p in self._folders().glob(pattern)})

    def outcomes(self) -> DataFrame:
        return self._read("ingest_outcomes", OUTCOME_SCHEMA)

    def retries(self) -> DataFrame:
        """Messages that failed and may be tried again, under the batch that failed them."""
        return self._read("message_retries", RETRY_SCHEMA)

    def retry_stream(self) -> DataFrame:
        """The same as a stream of what is added."""
        self._folders().make("message_retries")
        return self.spark.readStream.schema(RETRY_SCHEMA).parquet(f"{self.root.rstrip('/')}/message_retries")

    def write_retries(self, rows: DataFrame, ingest_batch: str) -> None:
        self._write(rows.withColumn("ingest_batch", F.lit(ingest_batch)), "message_retries", "ingest_batch")

    def sums(self, name: str, schema: str) -> DataFrame:
        return self._read(name, schema)

    def write_sums(self, rows: DataFrame, name: str, schema: str) -> None:
        self._write(rows.select(*self.spark.createDataFrame([], schema).columns), name, "ingest_batch")

    def _drop_sums(self, name: str, ingest_batch: str) -> None:
        """Sums, or index rows, of a batch that is about to be written again."""
        files = self._folders()
        for path in batch_folders(files, name):
            if batch_name(path) == ingest_batch:
                files.delete(path)

    def ledger(self) -> DataFrame:
        """Files that a replay has stored whole."""
        return self._read("file_ledger", LEDGER_SCHEMA)

    def write_ledger(self, files: DataFrame, ingest_batch: str) -> None:
        self._write(files.select("path", "length", "modified", F.lit(ingest_batch).alias("ingest_batch")), "file_ledger", "ingest_batch")

    def failure_windows(self) -> DataFrame:
        """Counts of failures per window, one row for each micro-batch that changed one."""
        return self._read("failure_windows", WINDOW_SCHEMA)

    def write_failure_windows(self, rows: DataFrame, stream: str, version: int) -> None:
        rows = rows.select("window_start", "failures", F.lit(stream).alias("stream"), "window_date", F.lit(version).cast("long").alias("version"))
        # One file for each date, which holds few windows: a long run is read whole.
        self._write(rows.repartition("window_date"), "failure_windows", "stream", "window_date", "version")

    def alarms(self) -> DataFrame:
        return self._read("failure_alarms", ALARM_SCHEMA)

    def write_alarms(self, rows: DataFrame, stream: str, version: int) -> None:
        rows = rows.select("window_start", "run_start", F.lit(stream).alias("stream"), F.lit(version).cast("long").alias("version"))
        self._write(rows, "failure_alarms", "stream", "version")

    def _write(self, df: DataFrame, name: str, *partitions: str) -> None:
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partitions)
            .parquet(f"{self.root.rstrip('/')}/{name}")
        )

    def write_events(self, rows: DataFrame, ingest_batch: str, ingested_at) -> None:
        """Write rows already known to be absent.

        The rebalance gathers each date and severity into few files and splits one
        that holds much of the data over several tasks; the sort lets row-group
        statistics serve reads of one device.
        """
        shaped = rows.withColumns(
            {
                "telemetry": F.parse_json("telemetry"),
                "event_date": F.to_date("event_time"),
                "ingest_batch": F.lit(ingest_batch),
                "ingested_at": ingested_at,
            }
        ).select(*self.spark.createDataFrame([], EVENT_SCHEMA).columns)
        laid_out = (
            checked(shaped)
            .hint("rebalance", "id_kind", "event_date", "severity")
            .sortWithinPartitions("id_kind", "event_date", "severity", "drone_id", "event_time")
        )
        self._drop_sums(EVENT_SUMS, ingest_batch)
        self._drop_sums(EVENT_LEAVES, ingest_batch)
        # Thousands of folders of a date: Spark's own replacement would move them one after the other.
        files, stage = self._folders(), f"{_STAGED}/{uuid.uuid4().hex}"
        files.delete(_STAGED)  # of a write that broke off
        staged = laid_out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*EVENT_PARTITIONS)
        # Nearly all time of a task goes to opening its files, so one task more than cores would make a second round.
        tasks = TASKS_A_CORE * self.spark.sparkContext.defaultParallelism
        with with_setting(rows.sparkSession, "spark.sql.adaptive.coalescePartitions.minPartitionNum", str(tasks)):
            staged.parquet(f"{files.root}/{stage}")
        files.put_in_place(stage, "telemetry_events", len(EVENT_PARTITIONS))
        files.delete(_STAGED)

    def write_quarantine(self, rows: DataFrame, ingest_batch: str, failed_at) -> None:
        shaped = rows.select(
            "source",
            F.col("payload").alias("raw_payload"),
            F.col("issues").alias("errors"),
            "batch_id",
            "batch_seq",
            failed_at.alias("failed_at"),
            F.to_date(failed_at).alias("failed_date"),
            F.lit(ingest_batch).alias("ingest_batch"),
        )
        self._drop_sums(ISSUE_SUMS, ingest_batch)
        self._write(shaped, "telemetry_quarantine", *QUARANTINE_PARTITIONS)

    def write_outcomes(self, rows: DataFrame, ingest_batch: str, finished_at) -> None:
        shaped = rows.withColumns(
            {"finished_at": finished_at, "ingest_batch": F.lit(ingest_batch)}
        )
        self._write(shaped, "ingest_outcomes", "ingest_batch")

    # --- the index of ids ------------------------------------------------------

    def ids(self) -> IdIndex:
        return IdIndex(self.spark, self.root, self.id_buckets)

    def heal(self, ingest_batch: str | None = None) -> None:
        """Finish what broke off before: a compaction in place, batches whose events stand without their ids.

        Batches other than ``ingest_batch``, which is about to be written anyway. Every write begins with this.
        """
        self.finish_compaction()
        index = self.ids()
        if index.new and self._folders().exists("telemetry_events"):
            index.put(self._id_rows(self.events()))
        for path in self._folders().children(_UNINDEXED):
            name = unquote(path.rsplit("/", 1)[1])
            if name != ingest_batch and not name.endswith(".part"):
                self.index_batch(name)

    def announce(self, ingest_batch: str) -> None:
        """Note that events of this batch are about to be written, until :meth:`index_batch` has their ids."""
        self._folders().write_lines(f"{_UNINDEXED}/{quote(ingest_batch, safe='')}", [])

    def index_batch(self, ingest_batch: str, stored: DataFrame | None = None) -> None:
        """Put the ids of the stored events of one batch in the index; ``stored`` are those events, if listed already."""
        stored = self.events().where(F.col("ingest_batch") == ingest_batch) if stored is None else stored
        self.ids().put(self._id_rows(stored))
        self._folders().delete(f"{_UNINDEXED}/{quote(ingest_batch, safe='')}")

    @staticmethod
    def _id_rows(events: DataFrame) -> DataFrame:
        return events.select("event_id", "id_kind", "event_date", "ingest_batch")

    def _folders(self) -> Folders:
        return Folders(self.spark, self.root)

    # --- compaction --------------------------------------------------------------

    def compact(self, before: date) -> None:
        """Put the event files of the dates before ``before`` together, whatever batches they came with.

        Ids, rows and the other partitions stay as they are; the rows now stand under a batch named
        ``compacted-...``. Only folders of a date and severity that hold several batches are touched.

        The new files are staged first, with a list of exactly the files they stand for. Putting them in place moves
        them in and then deletes the listed files, and nothing else. A call that broke off is finished by the next one,
        or by the next write of a batch; if any listed file is no longer there (a batch was written again), a staged
        set of which nothing was moved is thrown away. Like any write, it must be the only one at a time.
        """
        self.finish_compaction()
        files, name = self._folders(), f"compacted-{uuid.uuid4().hex}"
        by_place: dict[str, list[str]] = {}
        for folder in files.glob("telemetry_events/id_kind=*/event_date=*/severity=*/ingest_batch=*"):
            if folder.split("event_date=", 1)[1].split("/", 1)[0] < before.isoformat():
                by_place.setdefault(folder.rsplit("/", 1)[0], []).append(folder)
        old = [folder for group in by_place.values() if len(group) > 1 for folder in group]
        if old:
            replaced = [path for folder in old for path in files.children(folder)]
            reader = self.spark.read.schema(EVENT_SCHEMA).option("basePath", f"{files.root}/telemetry_events")
            rows = reader.parquet(*[literal_path(f"{files.root}/{folder}") for folder in old]).withColumn("ingest_batch", F.lit(name))
            laid_out = rows.hint("rebalance", "id_kind", "event_date", "severity").sortWithinPartitions(
                "id_kind", "event_date", "severity", "drone_id", "event_time"
            )
            staged = laid_out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*EVENT_PARTITIONS)
            staged.parquet(f"{files.root}/{_COMPACTION}/{name}/events")
            files.write_lines(f"{_COMPACTION}/{name}/replaces", replaced)
            self.finish_compaction()
        self.ids().compact(before, name)

    def finish_compaction(self) -> None:
        files = self._folders()
        for folder in files.children(_COMPACTION):
            name = folder.rsplit("/", 1)[1]
            if not files.exists(f"{folder}/replaces"):
                files.delete(folder)  # broke off before it was whole
                continue
            replaced = files.read_lines(f"{folder}/replaces")
            if not files.exists(f"{folder}/moving"):
                if not all(map(files.exists, replaced)):
                    files.delete(folder)
                    continue
                files.write_lines(f"{folder}/moving", [])
            for part in files.glob(f"{folder}/events/id_kind=*/event_date=*/severity=*/ingest_batch=*"):
                files.move(part, f"telemetry_events/{part.split('/events/', 1)[1]}")
            self.index_batch(name)
            for path in replaced:
                files.delete(path)
            for place in sorted({path.rsplit("/", 1)[0] for path in replaced}):
                if not files.children(place):
                    files.delete(place)
            files.delete(folder)
