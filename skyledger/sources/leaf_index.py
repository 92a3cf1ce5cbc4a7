"""An inverted index of telemetry leaves: containment finds the events that may match without reading every telemetry value.

A leaf is a plain value with the path to it: object keys by name, array items without their number, so that a wanted value
implies the same leaves wherever its items stand. The index holds 64-bit hashes of leaves with the id and date of their event,
batch by batch, sorted by leaf, with Bloom filters. Equal hashes of different leaves only let
more events through to the exact test, which always decides.

A search names the wanted leaves in the filter of the index. Up to ``NAMED_IDS`` candidates are then named in the filter of the
events; of more, only their dates are opened. Batches that the index does not hold whole are searched as a whole, so results are
whole at any time; :meth:`LeafIndex.refresh` indexes the batches that changed and drops those that are gone. Leaves deeper than
``DEPTH`` steps are not indexed and do not narrow a search, nor do empty objects and arrays.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.reads import containing
from skyledger.sources.batch_mirror import BatchMirror, batch_name
from skyledger.sources.folders import Folders
from skyledger.sources.id_index import NAMED_IDS
from skyledger.sources.tables import EVENT_LEAVES, EVENT_PARTITIONS, Tables

LEAF_SCHEMA = "leaf bigint, event_id string, id_kind string, event_date date, severity string, ingest_batch string"
EVENTS = "telemetry_events"
DEPTH = 4
#: Numbers from here on share one leaf for each path: as doubles, neighbours may be equal.
EXACT_BELOW = 2**52


def _member(path: Column, key: Column) -> Column:
    return F.xxhash64(path, F.lit("."), key)


def _item(path: Column) -> Column:
    return F.xxhash64(path, F.lit("[]"))


def _leaf(path: Column, kind: str, value: Column | None = None) -> Column:
    return F.xxhash64(path, F.lit(kind), *([] if value is None else [value]))


def leaves(telemetry: Column, depth: int = DEPTH) -> Column:
    """Hashes of the leaves of a VARIANT, each once."""
    return F.array_distinct(_below(F.lit(0).cast("long"), telemetry, depth))


def _below(path: Column, value: Column, depth: int) -> Column:
    members = F.transform(
        F.map_entries(F.try_variant_get(value, "$", "map<string,variant>")),
        lambda e: F.struct(_member(path, e["key"]).alias("path"), e["value"].alias("value")),
    )
    items = F.transform(F.try_variant_get(value, "$", "array<variant>"), lambda v: F.struct(_item(path).alias("path"), v.alias("value")))

    def found(node: Column) -> Column:
        inside, v = node["path"], node["value"]
        kind = F.schema_of_variant(v)
        number = F.try_variant_get(v, "$", "double") + F.lit(0.0)  # one zero
        leaf = (
            F.when(kind == "STRING", _leaf(inside, "s", F.try_variant_get(v, "$", "string")))
            .when(kind == "BOOLEAN", _leaf(inside, "b", F.try_variant_get(v, "$", "boolean")))
            .when(kind == "VOID", _leaf(inside, "z"))
            .when(kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL"), _leaf(inside, "n", F.when(F.abs(number) < EXACT_BELOW, number)))
        )
        one = F.array_compact(F.array(leaf))
        return one if depth == 1 else F.when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), _below(inside, v, depth - 1)).otherwise(one)

    return F.flatten(F.transform(F.coalesce(members, items), found))


def wanted_leaves(wanted: Any, depth: int = DEPTH) -> list[Column]:
    """The leaves that an event must have to contain ``wanted``."""
    return _wanted(F.lit(0).cast("long"), wanted, depth)


def _wanted(path: Column, wanted: Any, depth: int) -> list[Column]:
    if isinstance(wanted, (dict, list, tuple)):
        if depth == 0:
            return []
        inner = [(_member(path, F.lit(k)), v) for k, v in wanted.items()] if isinstance(wanted, dict) else [(_item(path), v) for v in wanted]
        return [leaf for below, v in inner for leaf in _wanted(below, v, depth - 1)]
    if wanted is None:
        return [_leaf(path, "z")]
    if isinstance(wanted, bool):
        return [_leaf(path, "b", F.lit(wanted))]
    if isinstance(wanted, (int, float)):
        if wanted != wanted:
            return []
        exact = abs(wanted) < EXACT_BELOW
        return [_leaf(path, "n", F.lit(float(wanted) + 0.0) if exact else F.lit(None).cast("double"))]
    return [_leaf(path, "s", F.lit(str(wanted)))]


class LeafIndex:
    def __init__(self, tables: Tables) -> None:
        self.tables = tables
        self.spark: SparkSession = tables.spark
        self.files = Folders(tables.spark, tables.root)
        self.mirror = BatchMirror(self.files, EVENTS, EVENT_PARTITIONS, EVENT_LEAVES)

    def refresh(self) -> int:
        """Index the batches of events that changed; returns how many partitions are new."""

        def index(batches: list[str]) -> None:
            events = self.tables.events().where(F.col("ingest_batch").isin(batches))
            rows = events.select(F.explode(leaves(F.col("telemetry"))).alias("leaf"), "event_id", *EVENT_PARTITIONS)
            # Each task sorts the leaves of the events it has read; none is shuffled.
            laid_out = rows.sortWithinPartitions("ingest_batch", "leaf")
            writer = laid_out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ingest_batch")
            writer.option("parquet.bloom.filter.enabled#leaf", "true").parquet(f"{self.files.root}/{EVENT_LEAVES}")

        return self.mirror.refresh(index)

    def candidates(self, wanted: list[int]) -> DataFrame:
        """(event_id, event_date) of the indexed events that have all the leaves."""
        rows = self.spark.read.schema(LEAF_SCHEMA).parquet(f"{self.files.root}/{EVENT_LEAVES}")
        if len(wanted) == 1:
            return rows.where(F.col("leaf") == wanted[0]).select("event_id", "event_date")
        found = rows.where(F.col("leaf").isin(wanted)).groupBy("event_id", *EVENT_PARTITIONS).agg(F.count(F.lit(1)).alias("n"))
        return found.where(F.col("n") == len(wanted)).select("event_id", "event_date")

    def containing(self, wanted: dict[str, Any]) -> DataFrame:
        """The stored events whose telemetry contains ``wanted``, as :func:`skyledger.operators.reads.containing` finds them."""
        events, tokens = self.tables.events(), wanted_leaves(wanted)
        kept = self.mirror.kept()
        if not tokens or not any(kept.values()):
            return containing(events, wanted)
        hashes = self.spark.range(1).select(F.array_distinct(F.array(*tokens))).head()[0]
        hits = self.candidates(hashes)
        some = hits.limit(NAMED_IDS + 1).collect()
        if len(some) <= NAMED_IDS:
            dates = {r.event_date for r in some}
            near = F.col("event_id").isin([r.event_id for r in some]) & F.col("event_date").isin(sorted(dates))
        else:
            # As many as there are days of events at most.
            near = F.col("event_date").isin(sorted(r.event_date for r in hits.select("event_date").distinct().collect()))
        found = containing(events.where(near) if some else events.where(F.lit(False)), wanted)
        missing = sorted(batch_name(b) for b, parts in self.mirror.stored().items() if not parts <= kept.get(b, set()))
        if not missing:
            return found
        rest = containing(events.where(F.col("ingest_batch").isin(missing)), wanted)
        return found.where(~F.col("ingest_batch").isin(missing)).unionByName(rest)
