"""The ids of all stored events, bucketed by their hash: known ids are found without a scan or a shuffle of the store.

The index is a bucketed Parquet table at ``<root>/event_ids_b<buckets>``, with one section for supplied ids and one for each
month of derived ones, and in each the batches that stored them. A lookup of many ids joins them bucket by bucket: only the
incoming side is shuffled. A lookup of few names them in the filter, so that only the files of their buckets are opened, and
of those the row groups whose statistics and Bloom filters let one of them be there.

A derived id holds its event time, so it can only be stored in the section of its month, or have been supplied.

Rows are a set: an id that stands in two batches, for instance while the index is compacted, is known all the same. Spark
keeps the declaration of a bucketed table in its session catalog; it is made again in each session from the folder's name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.sources.folders import Folders

#: So many supplied ids are looked up by name; more are joined.
NAMED_IDS = 500
SUPPLIED = "supplied"
_PARTITION_SETTING = "spark.sql.hive.manageFilesourcePartitions"


class IdIndex:
    """A new index gets ``buckets``, or as many as the session shuffles with: each is one task of a lookup, and they stay."""

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None) -> None:
        self.spark, self.files = spark, Folders(spark, root)
        found = self.files.glob("event_ids_b*")
        self.new = not found
        self.buckets = int(found[0].rsplit("_b", 1)[1]) if found else buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.folder = f"{self.files.root}/event_ids_b{self.buckets}"
        self.name = f"skyledger_ids_{hashlib.sha256(self.folder.encode()).hexdigest()[:24]}"

    def _declare(self) -> None:
        # Partitions are found in the folder, not registered one by one in the catalog.
        before = self.spark.conf.get(_PARTITION_SETTING)
        self.spark.conf.set(_PARTITION_SETTING, "false")
        try:
            self.spark.sql(f"""
                create table if not exists {self.name} (event_id string, section string, ingest_batch string) using parquet
                options ('parquet.bloom.filter.enabled#event_id' = 'true')
                partitioned by (section, ingest_batch)
                clustered by (event_id) sorted by (event_id) into {self.buckets} buckets
                location '{self.folder}'""")
        finally:
            self.spark.conf.set(_PARTITION_SETTING, before)

    def rows(self) -> DataFrame:
        """``(event_id, section, ingest_batch)`` of all stored events."""
        self._declare()
        self.spark.sql(f"refresh table {self.name}")
        return self.spark.table(self.name)

    def put(self, events: DataFrame) -> None:
        """Set the ids of the batches of ``events`` ``(event_id, id_kind, event_date, ingest_batch)``."""
        self._declare()
        section = F.when(F.col("id_kind") == SUPPLIED, SUPPLIED).otherwise(F.date_format("event_date", "yyyy-MM"))
        rows = events.select("event_id", section.alias("section"), "ingest_batch")
        # The partitioning of the shuffle is that of the buckets, so each task writes the files of one bucket.
        rows.repartition(self.buckets, "event_id").write.insertInto(self.name, overwrite=True)

    def known(self, incoming: DataFrame, besides: str, days: Iterable[date]) -> DataFrame:
        """The ids of ``incoming`` ``(event_id, id_kind, ...)`` that batches other than ``besides`` stored.

        ``days`` are the event dates of the incoming rows with derived ids.
        """
        stored = self.rows().where(F.col("ingest_batch") != besides)
        sections = sorted({SUPPLIED} | {f"{day:%Y-%m}" for day in days})
        derived = incoming.where(F.col("id_kind") != SUPPLIED).select("event_id")
        found = [stored.where(F.col("section").isin(sections)).select("event_id").join(derived, "event_id", "left_semi")]
        supplied = incoming.where(F.col("id_kind") == SUPPLIED).select("event_id").distinct()
        some = [row["event_id"] for row in supplied.limit(NAMED_IDS + 1).collect()]
        if len(some) > NAMED_IDS:
            found.append(stored.select("event_id").join(supplied, "event_id", "left_semi"))
        elif some:
            found.append(stored.where(F.col("event_id").isin(some)).select("event_id"))
        return reduce(DataFrame.unionByName, found)

    def compact(self, before: date, name: str) -> None:
        """Put the batches of the sections before the month of ``before`` together, under the batch ``name``.

        The new files are there before an old one goes, and an id that stands in both is known once.
        """
        old = [p for p in self.files.glob(f"event_ids_b{self.buckets}/section=*/ingest_batch=*") if f"{before:%Y-%m}" > _section(p)]
        if len(old) <= len({_section(p) for p in old}):
            return
        self._declare()
        months = sorted({_section(p) for p in old})
        rows = self.rows().where(F.col("section").isin(months)).select("event_id", "section").distinct()
        rows = rows.withColumn("ingest_batch", F.lit(name)).select("event_id", "section", "ingest_batch")
        rows.repartition(self.buckets, "event_id").write.insertInto(self.name, overwrite=True)
        for path in old:
            self.files.delete(path)


def _section(path: str) -> str:
    return path.split("section=", 1)[1].split("/", 1)[0]
