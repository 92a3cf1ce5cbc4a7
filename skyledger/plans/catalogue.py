"""Named queries over the driver tables, and the same results in plain SQL."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions import instants, json_text
from skyledger.functions.numbers import number_from_text
from skyledger.functions.text import trimmed
from skyledger.operators import accounting, analysis, dedupe, reads
from skyledger.operators.transform import severity
from skyledger.operators.validate import normalise_event_type
from skyledger.plans.feed import (
    delivered_rows,
    events_table,
    feed,
    feed_candidates,
    record_text,
)
from skyledger.plans.intake import ingest_files, ingest_messages, judge, one_delivery, replay, run_intake
from skyledger.session import configure, scratch_path, scratch_scope, written
from skyledger.sources.csv_rows import csv_candidates
from skyledger.sources.folders import Folders
from skyledger.sources.json_docs import json_candidates, ndjson_candidates
from skyledger.sources.json_parts import json_files
from skyledger.sources.kept_sums import KeptSums
from skyledger.sources.leaf_index import LeafIndex
from skyledger.sources.lines import sniffed_formats, text_lines
from skyledger.sources.messages import classified, decoded_key, direct_candidates, notice_entries
from skyledger.sources.payloads import as_batch
from skyledger.sources.tables import Tables
from skyledger.streaming.alarm_stream import alarm_stream
from skyledger.streaming.intake_stream import file_stream, message_stream

#: The clock of every registered query, so results do not depend on the day.
NOW = dt.datetime(2026, 12, 1, tzinfo=dt.timezone.utc)
WINDOW = (dt.datetime(2024, 1, 10, tzinfo=dt.timezone.utc), dt.datetime(2024, 1, 20, tzinfo=dt.timezone.utc))
DEVICE = "DRONE-042"
PAGE_CURSOR = reads.Cursor(dt.datetime(2024, 1, 15, tzinfo=dt.timezone.utc), "~")
#: Rows per derived file: files of one size, and several of them, whatever the table holds.
FILE_ROWS = 4096


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(feed_candidates(spark, sf_dir), NOW)


def _valid(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return judge(feed_candidates(spark, sf_dir), NOW, [*columns, "valid"]).where("valid").select(*columns)


#: Where the feed of a folder is stored, for each application.
_STORES: dict[tuple[str, str], Tables] = {}


def _store(spark: SparkSession, sf_dir: str) -> Tables:
    """The tables after an intake of all deliveries of the feed; made once for each application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORES or not Folders(spark, _STORES[key].root).exists("ingest_outcomes"):
        tables = Tables(spark, scratch_path(spark, "feed-store"))
        candidates = feed_candidates(spark, sf_dir)
        deliveries = delivered_rows(feed(spark, sf_dir)).select(*accounting.DELIVERY).distinct().select(
            *accounting.DELIVERY, F.lit("processed").alias("status"), F.lit(None).cast("string").alias("error")
        )
        with scratch_scope(spark):
            run_intake(tables, candidates, deliveries, "feed", NOW)
        _STORES[key] = tables
    return _STORES[key]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return _store(spark, sf_dir).events()


def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows; the time of rejection follows the place in the feed."""
    rejected = _judged(spark, sf_dir).where(~F.col("valid"))
    return rejected.select(
        "source",
        F.col("payload").alias("raw_payload"),
        F.col("issues").alias("errors"),
        _clock(F.col("ord.pos")).alias("failed_at"),
    )


def _clock(pos: Column) -> Column:
    return F.timestamp_seconds(F.lit(1704067200) + (pos % 1_000_000) * 10)


def _shown(df: DataFrame) -> DataFrame:
    """Timestamps as text and decimals as doubles, equal in every engine."""
    for name, kind in df.dtypes:
        if kind == "timestamp":
            df = df.withColumn(name, instants.iso_millis(F.col(name)))
        elif kind.startswith("decimal"):
            df = df.withColumn(name, F.col(name).cast("double"))
    return df


# --- scalar rules -----------------------------------------------------------


def q_severity(spark, sf_dir):
    typed = feed(spark, sf_dir).select(
        "seq",
        normalise_event_type(trimmed(F.col("event_type_raw"))).alias("event_type"),
        number_from_text(trimmed(F.col("status_text"))).cast("int").alias("status_code"),
        "battery_pct",
    )
    return typed.select(
        "seq",
        "event_type",
        "status_code",
        severity(F.col("event_type"), F.col("status_code"), F.col("battery_pct")).alias("severity"),
    )


def q_timestamp_coerce(spark, sf_dir):
    at = instants.from_text(trimmed(F.col("timestamp_text")))
    rows = feed(spark, sf_dir).select("seq", at.alias("at"))
    return rows.select(
        "seq",
        instants.iso_millis(F.col("at")).alias("event_time"),
        instants.too_old(F.col("at")).alias("too_old"),
        instants.too_new(F.col("at"), F.lit(dt.datetime(2024, 1, 20, tzinfo=dt.timezone.utc))).alias("too_new"),
    )


def _number_text() -> Column:
    n = F.col("event_id").cast("string")
    shapes = [
        n,
        F.concat(F.lit(" "), n, F.lit(".50\t")),
        F.concat(F.lit("1e"), F.col("event_id") % 5),
        F.concat(n, F.lit("f")),
        F.lit("  "),
        F.concat(F.lit("."), n),
        F.concat(F.lit("0x"), F.lower(F.hex("event_id"))),
        F.lit("NaN"),
        F.concat(F.lit("+"), n, F.lit(".")),
    ]
    text = F.lit(None).cast("string")
    for i, shape in enumerate(shapes):
        text = F.when(F.col("event_id") % len(shapes) == i, shape).otherwise(text)
    return text


def q_numeric_coerce(spark, sf_dir):
    rows = events_table(spark, sf_dir).select("event_id", _number_text().alias("text"))
    number = number_from_text(trimmed(F.col("text")))
    return rows.select(
        F.col("event_id").alias("seq"),
        number.alias("number"),
        (number == F.floor(number)).alias("whole"),
        number.between(0, 100).alias("in_range"),
    )


def q_event_type(spark, sf_dir):
    """Counts per normalised type."""
    name = normalise_event_type(trimmed(F.col("event_type_raw")))
    blank = trimmed(F.col("event_type_raw")) == ""
    return (
        feed(spark, sf_dir)
        .select(F.when(~blank, name).alias("event_type"))
        .groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def q_canonical_json(spark, sf_dir):
    """Key order, quoted scalars, exponents and blanks all come to one canonical text."""
    text = F.concat(
        F.lit('{"z":{"b":"'), F.col("event_id"), F.lit('","a":[true,"false","007"]},"v":'),
        F.col("value").cast("string"), F.lit('00,"e":'), F.col("event_id"), F.lit('e3,"t":"1e5"}'),
    )
    rows = events_table(spark, sf_dir).select(F.col("event_id").alias("seq"), text.alias("text"))
    plain = json_text.unquote_scalars(F.to_json(json_text.parsed(F.col("text"))))
    rows = rows.withColumn("plain", F.to_json(F.try_parse_json(plain)))
    return rows.select("seq", json_text.canonical(F.col("plain")).alias("canonical"))


def q_url_decode(spark, sf_dir):
    key = F.concat(
        F.lit("2024%2F"), F.col("event_type"), F.lit("+batch+"), F.col("event_id"), F.lit("%20%C3%A9.csv")
    )
    return events_table(spark, sf_dir).select(
        F.col("event_id").alias("seq"), decoded_key(key).alias("object_key")
    )


# --- validation and identity -------------------------------------------------


def q_validate_issues(spark, sf_dir):
    return (
        _judged(spark, sf_dir)
        .select("batch_id", F.col("ord.pos").alias("pos"), F.explode("issues").alias("issue"))
        .select("batch_id", "pos", "issue.path", "issue.code", "issue.message")
    )


def q_event_id(spark, sf_dir):
    found = _valid(
        spark, sf_dir, "batch_id", "ord", "event_id", "id_kind", "drone_id",
        "event_time", "event_type", "status_code", "severity", "battery_pct", "latitude", "longitude", "telemetry",
    )
    columns = [F.col("ord.pos").alias("pos") if c == "ord" else F.col(c) for c in found.columns]
    return _shown(found.select(*columns))


# --- duplicates ---------------------------------------------------------------


def q_dedup_in_batch(spark, sf_dir):
    rows = _valid(spark, sf_dir, "batch_id", "batch_seq", "event_id", "ord")
    return dedupe.in_batch(rows).select("batch_id", "event_id", F.col("ord.pos").alias("pos"))


def q_first_wins(spark, sf_dir):
    rows = _valid(spark, sf_dir, "batch_id", "event_id", "ord", "source")
    return dedupe.across_batches(rows).select("event_id", "batch_id", "source")


def _incoming_and_stored(spark, sf_dir):
    """Two shares of the feed that overlap: the deliveries, and what is stored already."""
    valid = _valid(spark, sf_dir, "event_id", "batch_id", "batch_seq", "ord", "drone_id")
    return (
        dedupe.across_batches(valid),
        valid.where(F.substring("drone_id", 7, 3).try_cast("int") % 3 == 0).select("event_id").distinct(),
    )


def q_insert_if_absent(spark, sf_dir):
    incoming, stored = _incoming_and_stored(spark, sf_dir)
    return dedupe.insert_if_absent(incoming, stored).select("event_id", "batch_id", "drone_id")


def q_redeliveries(spark, sf_dir):
    incoming, stored = _incoming_and_stored(spark, sf_dir)
    return dedupe.redeliveries(incoming, stored).select("event_id", "batch_id", "drone_id")


# --- accounting ---------------------------------------------------------------


def q_batch_counters(spark, sf_dir):
    return accounting.batch_counters(_judged(spark, sf_dir)).drop("batch_seq")


def _outcome_rows(spark, sf_dir):
    """Stored outcome rows of the feed."""
    configure(spark)
    return _store(spark, sf_dir).outcomes()


def q_outcomes(spark, sf_dir):
    return _outcome_rows(spark, sf_dir).select(
        "batch_id", "status", "received", "valid", "inserted", "duplicates",
        "duplicates_in_batch", "quarantined", "contract_smell",
    )


def _attempts(spark, sf_dir):
    """Delivery attempts: one per event, a message being four events in a row."""
    return events_table(spark, sf_dir).select(
        F.concat(F.lit("m"), F.floor(F.col("event_id") / 4)).alias("batch_id"),
        F.when(F.col("event_type").isin("error", "view"), "failed").otherwise("processed").alias("status"),
        F.col("ts").cast("timestamp").alias("finished_at"),
    )


def q_dead_letters(spark, sf_dir):
    return _shown(accounting.dead_letters(_attempts(spark, sf_dir), 3))


def q_alarm_windows(spark, sf_dir):
    return _shown(accounting.failure_alarms(_attempts(spark, sf_dir), "1 hour", 5, 2))


def _in_time(rows: DataFrame, parts: int) -> list[DataFrame]:
    """``rows`` in up to ``parts`` parts, those that finished first in the first one; rows without a time are in the last."""
    at = F.unix_micros("finished_at")
    ends = rows.agg(F.percentile_approx(at, [k / parts for k in range(1, parts)])).collect()[0][0] or []
    part = F.coalesce(*(F.when(at <= end, k) for k, end in enumerate(ends)), F.lit(len(ends)))
    return [rows.where(part == k) for k in range(len(ends) + 1)]


def q_alarm_stream(spark, sf_dir):
    """Alarms of a stream of outcomes that comes in parts, in the order of time: one for each run of bad hours."""
    configure(spark)
    tables, drop = Tables(spark, scratch_path(spark, "store")), scratch_path(spark, "outcome-drop")
    rows, checkpoint = _attempts(spark, sf_dir).select("status", "finished_at"), scratch_path(spark, "stream")
    # A stream takes files by their time of writing, which is any order for those of one write; so a part is taken before the next is written.
    for part in _in_time(rows, 3):
        part.write.mode("append").parquet(drop)
        stream = spark.readStream.schema("status string, finished_at timestamp").parquet(drop)
        writer = alarm_stream(stream, tables, "alarms", checkpoint, window="1 hour")
        writer.trigger(availableNow=True).start().awaitTermination()
    return _shown(tables.alarms().select("run_start", "window_start"))


def q_dead_letter_alarm(spark, sf_dir):
    dead = accounting.dead_letters(_attempts(spark, sf_dir), 3)
    return _shown(accounting.dead_letter_alarm(dead, "1 hour"))


# --- reads ----------------------------------------------------------------------


def q_device_events(spark, sf_dir):
    return _shown(reads.device_events(_events(spark, sf_dir), DEVICE, limit=20)).drop("source", "ingested_at")


def q_device_events_page2(spark, sf_dir):
    return _shown(
        reads.device_events(_events(spark, sf_dir), DEVICE, cursor=PAGE_CURSOR, limit=20)
    ).drop("source", "ingested_at")


def q_errors_window(spark, sf_dir):
    start, end = WINDOW
    return _shown(
        reads.errors_in_window(_events(spark, sf_dir), start=start, end=end, limit=100)
    ).drop("source", "ingested_at")


def q_cursors(spark, sf_dir):
    """The paging cursor of every stored event."""
    return _events(spark, sf_dir).select("event_id", reads.cursor_column().alias("next_cursor"))


def q_quarantine_latest(spark, sf_dir):
    latest = reads.latest_quarantine(_quarantine(spark, sf_dir), 50)
    return _shown(latest.select("source", "failed_at", F.size("errors").alias("n_errors")))


def q_device_dates(spark, sf_dir):
    """The device page read from the newest dates that fill it."""
    tables = _store(spark, sf_dir)
    found = reads.device_events(tables.events(), DEVICE, limit=20, dates=tables.event_dates())
    return _shown(found).drop("source", "ingested_at")


def q_device_walk(spark, sf_dir):
    """All pages of one device, one after the other."""
    tables = _store(spark, sf_dir)
    dates, walked = tables.event_dates(), []
    for number, page in enumerate(reads.pages(reads.device_events, tables.events(), DEVICE, limit=100, dates=dates)):
        walked += [(number, at, item["event_id"]) for at, item in enumerate(page.items)]
    return spark.createDataFrame(walked, "page int, place int, event_id string")


def q_quarantine_stored(spark, sf_dir):
    """The latest rejected rows as they are stored, with the text that was received."""
    tables = _store(spark, sf_dir)
    latest = reads.latest_quarantine(tables.quarantine(), 200, tables.quarantine_dates())
    return latest.select("source", "raw_payload", F.size("errors").alias("n_errors"))


def q_sample_errors(spark, sf_dir):
    """The issues kept as a sample of deliveries in which nothing was valid; here each event is a delivery."""
    configure(spark)
    candidates = feed_candidates(spark, sf_dir)
    alone = F.concat(F.lit("e"), F.col("ord.pos"))
    rows = judge(candidates, NOW, ["batch_id", "batch_seq", "ord", "event_id", "valid", "issues"]).withColumn("batch_id", alone)
    smelly = accounting.batch_counters(rows).where("contract_smell").select(*accounting.DELIVERY)
    found = accounting.sample_errors(rows).join(smelly, list(accounting.DELIVERY))
    return found.select("batch_id", F.array_join(F.transform("sample_errors", lambda e: F.concat(e["path"], F.lit(":"), e["code"])), ",").alias("sample"))


def q_containment(spark, sf_dir):
    found = reads.containing(_events(spark, sf_dir), {"k": 7})
    return found.select("event_id", F.to_json("telemetry").alias("telemetry"))


def q_containment_nested(spark, sf_dir):
    """Arrays match item by item in any order; keys may hold any character."""
    wanted = {"motor": {"rpm": [None, 3, True], "é": "x"}}
    return reads.containing(_events(spark, sf_dir), wanted).select("event_id", F.to_json("telemetry").alias("telemetry"))


def q_containment_indexed(spark, sf_dir):
    """The same containment by the index of leaves, brought up to date first."""
    configure(spark)
    index = LeafIndex(_store(spark, sf_dir))
    index.refresh()
    wanted = {"motor": {"rpm": [None, 3, True], "é": "x"}}
    return index.containing(wanted).select("event_id", F.to_json("telemetry").alias("telemetry"))


def q_event_count(spark, sf_dir):
    return analysis.event_count(_events(spark, sf_dir))


# --- analysis ---------------------------------------------------------------------


def q_failing_fields(spark, sf_dir):
    return analysis.failing_fields(_quarantine(spark, sf_dir))


def q_battery_altitude(spark, sf_dir):
    found = analysis.battery_by_altitude(_events(spark, sf_dir), "k")
    rounded = {c: F.round(c, 6) for c in ("correlation", "slope", "avg_battery")}
    # Over so few readings engines do not agree on these two.
    few = {c: F.when(F.col("readings") > 2, F.col(c)) for c in ("correlation", "slope")}
    return found.withColumns(rounded).withColumns(few)


def q_quarantine_rate(spark, sf_dir):
    received = _judged(spark, sf_dir).select(
        _clock(F.col("ord.pos")).alias("at"), (~F.col("valid")).alias("rejected")
    )
    rate = analysis.quarantine_rate(received, "5 minutes")
    return _shown(rate.withColumn("rate", F.round("rate", 6)))


def _sums(spark, sf_dir):
    """Kept sums of the stored feed, brought up to date."""
    configure(spark)
    kept = KeptSums(_store(spark, sf_dir), "k")
    kept.refresh()
    return kept


def q_kept_battery(spark, sf_dir):
    """Battery against altitude from the kept sums."""
    found = _sums(spark, sf_dir).battery_by_altitude()
    rounded = {c: F.round(c, 6) for c in ("correlation", "slope", "avg_battery")}
    few = {c: F.when(F.col("readings") > 2, F.col(c)) for c in ("correlation", "slope")}
    return found.withColumns(rounded).withColumns(few)


def q_kept_failing_fields(spark, sf_dir):
    return _sums(spark, sf_dir).failing_fields()


def q_kept_error_share(spark, sf_dir):
    share = _sums(spark, sf_dir).error_share()
    return share.select(F.col("day").cast("string").alias("day"), "events", "errors", F.round("share", 6).alias("share"))


def q_error_share(spark, sf_dir):
    share = analysis.error_share(_events(spark, sf_dir))
    return share.select(
        F.col("day").cast("string").alias("day"), "events", "errors", F.round("share", 6).alias("share")
    )


# --- files, messages and streams derived from the feed ------------------------------


def _write_text(rows: DataFrame, head: str | None, name: str) -> str:
    """Write ``(chunk, at, text)`` as one text file per chunk, in order of ``at``."""
    path = scratch_path(rows.sparkSession, name)
    if head is not None:
        heads = rows.select("chunk").distinct().select("chunk", F.lit(-1).alias("at"), F.lit(head).alias("text"))
        rows = rows.unionByName(heads)
    (
        rows.repartition("chunk")
        .sortWithinPartitions("chunk", "at")
        .select("chunk", "text")
        .write.partitionBy("chunk")
        .text(path)
    )
    return path


def _chunk() -> Column:
    return F.floor(F.col("seq") / FILE_ROWS).cast("bigint")


def _chunk_of(file: str) -> Column:
    return F.regexp_extract(file, r"chunk=(\d+)", 1).cast("bigint")


def _csv_cells() -> Column:
    """A feed row as CSV; some cells are quoted, some hold a newline or lack a column."""
    note = F.when(F.col("seq") % 17 == 0, F.concat(F.lit('"two\nlines, ""'), F.col("seq"), F.lit('"""'))).otherwise(
        F.concat(F.lit("n"), F.col("seq"))
    )
    full = F.concat_ws(
        ",", "drone_id", "timestamp_text", "event_type_raw", "status_text",
        F.col("battery_pct").cast("string"), note,
    )
    return F.when(F.col("broken"), F.concat_ws(",", "drone_id", "timestamp_text")).otherwise(full)


CSV_HEAD = "droneId,timestamp,eventType,statusCode,batteryPct,note"


def q_csv_rows(spark, sf_dir):
    rows = feed(spark, sf_dir).select(_chunk().alias("chunk"), F.col("seq").alias("at"), _csv_cells().alias("text"))
    found = csv_candidates(text_lines(spark, _write_text(rows, CSV_HEAD, "csv")))
    value = F.col("value")
    return found.select(
        _chunk_of("file").alias("chunk"),
        F.col("pos").alias("line"),
        F.try_variant_get(value, "$.droneId", "string").alias("drone_id"),
        F.try_variant_get(value, "$.telemetryData.batteryPct", "double").alias("battery_pct"),
        F.try_variant_get(value, "$.telemetryData.note", "string").alias("note"),
        "parse_error",
    )


def q_ndjson_rows(spark, sf_dir):
    rows = feed(spark, sf_dir).select(
        _chunk().alias("chunk"), F.col("seq").alias("at"),
        F.when(F.col("seq") % 19 == 0, F.concat(F.lit("\n"), record_text())).otherwise(record_text()).alias("text"),
    )
    found = ndjson_candidates(text_lines(spark, _write_text(rows, None, "ndjson")))
    return found.select(
        _chunk_of("file").alias("chunk"),
        F.col("pos").alias("line"),
        F.try_variant_get("value", "$.droneId", "string").alias("drone_id"),
        F.col("parse_error").isNotNull().alias("rejected"),
    )


def _json_documents(rows: DataFrame) -> DataFrame:
    """Documents of twenty records: an array each, spread over several lines; a broken record breaks its document."""
    grouped = rows.select(
        F.floor(F.col("seq") / 20).alias("doc"), "seq", record_text().alias("record")
    )
    return grouped.groupBy("doc").agg(
        F.concat(
            F.lit("[\n"), F.expr("listagg(record, ',\n') within group (order by seq)"), F.lit("\n]")
        ).alias("text")
    )


def q_json_rows(spark, sf_dir):
    docs = _json_documents(feed(spark, sf_dir)).select(
        F.concat(F.lit("doc-"), F.col("doc")).alias("file"), "text"
    )
    return json_candidates(docs).select(
        "source", F.try_variant_get("value", "$.droneId", "string").alias("drone_id"), "root_kind",
        F.col("parse_error").isNotNull().alias("rejected"),
    )


def q_json_pieces(spark, sf_dir):
    """Arrays of thousands of records on one line each, read in pieces and cut into their items."""
    rows = feed(spark, sf_dir).where("not broken").select(_chunk().alias("chunk"), "seq", record_text().alias("record"))
    arrays = rows.groupBy("chunk").agg(
        F.concat(F.lit("["), F.expr("listagg(record, ',') within group (order by seq)"), F.lit("]")).alias("text")
    )
    files = _write_text(arrays.withColumn("at", F.lit(0)), None, "json")
    found = json_files(spark, files, split_above=1 << 10)
    return found.select(
        _chunk_of("file").alias("chunk"), "pos", F.try_variant_get("value", "$.droneId", "string").alias("drone_id"),
        F.try_variant_get("value", "$.statusCode", "string").alias("status_text"), "root_kind",
    )


def q_formats(spark, sf_dir):
    """Format by content, of files whose names tell nothing."""
    shape = F.col("seq") % 4
    text = (
        F.when(shape == 0, F.concat(F.lit('  {"a":'), F.col("seq"), F.lit('}\n\n {"a":1}')))
        .when(shape == 1, F.concat(F.lit('{\n"a":'), F.col("seq"), F.lit("}")))
        .when(shape == 2, F.concat(F.lit("\n[1,"), F.col("seq"), F.lit("]")))
        .otherwise(F.concat(F.lit("droneId,"), F.col("seq")))
    )
    events = events_table(spark, sf_dir).select(F.col("event_id").alias("seq"))
    lines = (
        events.select("seq", F.posexplode(F.split(text, "\n")).alias("at", "text"))
        .select(
            F.concat(F.lit("f"), F.col("seq")).alias("file"), F.lit(0).alias("block"),
            F.lit(0).alias("stretch"), "at", "text",
        )
    )
    return sniffed_formats(lines)


def _messages(spark, sf_dir) -> DataFrame:
    """Feed rows as message bodies of every kind."""
    record = record_text()
    notice = F.concat(
        F.lit('{"Records":[{"s3":{"bucket":{"name":"raw"},"object":{"key":"d%2F'),
        F.col("seq"), F.lit('+a.csv"}}},{"s3":{"bucket":{"name":"raw"},"object":{"key":"b.csv","size":3}}}]}'),
    )
    body = (
        F.when(F.col("seq") % 8 == 0, F.concat(F.lit("["), record, F.lit(", 7]")))
        .when(F.col("seq") % 8 == 1, F.concat(F.lit("["), record, F.lit("]")))
        .when(F.col("seq") % 8 == 2, notice)
        .when(F.col("seq") % 8 == 3, '{"Service":"Amazon S3","Event":"s3:TestEvent","Bucket":"raw"}')
        .when(F.col("seq") % 8 == 4, F.concat(record, F.lit("] trailing")))
        .otherwise(record)
    )
    rows = feed(spark, sf_dir).select(
        F.concat(F.lit("m"), F.col("seq")).alias("message_id"), body.alias("body"), F.col("seq").alias("message_seq")
    )
    return written(rows, "bodies")


def q_messages(spark, sf_dir):
    found = direct_candidates(written(classified(_messages(spark, sf_dir)), "messages"))
    return found.select(
        "batch_id", "source",
        F.try_variant_get("value", "$.droneId", "string").alias("drone_id"),
        F.coalesce("root_kind", F.lit("none")).alias("root_kind"),
        "parse_error",
    )


def q_notices(spark, sf_dir):
    entries = notice_entries(classified(_messages(spark, sf_dir)), "s3a://{bucket}/{key}")
    return entries.select("message_id", "entry_pos", "bucket", "key", "path")


def q_message_roles(spark, sf_dir):
    roles = classified(_messages(spark, sf_dir))
    return roles.groupBy("role").agg(F.count(F.lit(1)).alias("n"))


def _stored_summary(tables: Tables) -> DataFrame:
    return tables.events().groupBy("severity").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("event_id").alias("ids"),
        F.sum(F.coalesce("status_code", F.lit(0))).alias("status_sum"),
    )


def _feed_files(spark, sf_dir) -> str:
    rows = feed(spark, sf_dir).select(
        _chunk().alias("chunk"), F.col("seq").alias("at"), record_text().alias("text")
    )
    return _write_text(rows, None, "feed")


def q_intake_replay(spark, sf_dir):
    """Files stored twice: the second load only finds duplicates."""
    tables = Tables(spark, scratch_path(spark, "store"))
    files = _feed_files(spark, sf_dir)
    first = _named(spark, tables, files, "load-1")
    second = _named(spark, tables, files, "load-2")
    columns = ["batch_id", "received", "valid", "inserted", "duplicates", "duplicates_in_batch", "quarantined"]
    return first.unionByName(second).select(*columns)


def _named(spark, tables, files, name):
    candidates = as_batch(ndjson_candidates(text_lines(spark, files)), name)
    return run_intake(tables, candidates, one_delivery(spark, name), name, NOW)


def q_insert_supplied(spark, sf_dir):
    """Ids found in the index of ids: the records of every second device are stored, then all of them are sent."""
    tables = Tables(spark, scratch_path(spark, "store"))
    candidates = written(feed_candidates(spark, sf_dir), "candidates")
    device = F.try_variant_get("value", "$.droneId", "string")
    even = F.substring(device, 7, 3).try_cast("int") % 2 == 0
    for name, rows in (("half", candidates.where(even)), ("all", candidates)):
        with scratch_scope(spark):
            run_intake(tables, rows, one_delivery(spark, name), name, NOW)
    return tables.events().groupBy("ingest_batch", "id_kind").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("event_id").alias("ids")
    )


class _Breaking(Tables):
    """Tables whose batch breaks off between its events and its rejected rows."""

    def write_quarantine(self, *_) -> None:
        raise InterruptedError


def q_batch_breaks(spark, sf_dir):
    """A batch that breaks off after its events, and the same batch run again."""
    root = scratch_path(spark, "store")
    tables, states = Tables(spark, root), []
    candidates = written(feed_candidates(spark, sf_dir), "candidates")
    for name, target in (("broken", _Breaking(spark, root)), ("again", tables)):
        try:
            with scratch_scope(spark):
                run_intake(target, candidates, one_delivery(spark, "b"), "b", NOW)
        except InterruptedError:
            pass
        counts = tables.events().agg(F.count(F.lit(1)).alias("events")).join(
            tables.quarantine().agg(F.count(F.lit(1)).alias("quarantined"))
        )
        states.append(written(counts.withColumn("state", F.lit(name)), "state"))
    return states[0].unionByName(states[1])


class _Stopping(Tables):
    """Tables of a replay that stops after its first batch."""

    def write_ledger(self, files, ingest_batch) -> None:
        super().write_ledger(files, ingest_batch)
        raise InterruptedError


def q_replay_resumes(spark, sf_dir):
    """A replay that stops after one batch of files, and its second call, which reads only the rest."""
    root = scratch_path(spark, "store")
    tables, files, states = Tables(spark, root), _feed_files(spark, sf_dir), []
    sizes = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(files).agg(F.sum("length")).collect()[0][0]
    for name, target in (("stopped", _Stopping(spark, root)), ("resumed", tables), ("done", tables)):
        try:
            replay(spark, target, files, "r", now=NOW, batch_bytes=max(1, -(-sizes // 2)))
        except InterruptedError:
            pass
        read = tables.outcomes().agg(F.sum("received").alias("received"), F.sum("inserted").alias("inserted"), F.sum("quarantined").alias("quarantined"))
        states.append(written(read.withColumn("state", F.lit(name)), "state"))
    whole = states[1].unionByName(states[2])
    some = states[0].select("state", ((F.col("received") > 0)).alias("any"))
    return whole.join(some.select("any")).select("state", "received", "inserted", "quarantined", "any")


def q_stream_intake(spark, sf_dir):
    """The feed as a stream of messages, some sent twice, stored once."""
    tables = Tables(spark, scratch_path(spark, "store"))
    path = scratch_path(spark, "message-drop")
    sent = delivered_rows(feed(spark, sf_dir)).select(
        F.concat("batch_id", F.lit("-"), "pos").alias("message_id"),
        record_text().alias("body"), F.col("pos").alias("message_seq"),
    )
    sent.write.parquet(path)
    stream = spark.readStream.schema("message_id string, body string, message_seq bigint").parquet(path)
    query = (
        message_stream(stream, tables, "feed", scratch_path(spark, "stream"), clock=lambda: NOW)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return _stored_summary(tables)


def q_file_stream(spark, sf_dir):
    """The feed as files dropped into a folder, stored by a stream."""
    tables = Tables(spark, scratch_path(spark, "store"))
    files = _feed_files(spark, sf_dir)
    query = (
        file_stream(spark, files, tables, "files", scratch_path(spark, "stream"), clock=lambda: NOW)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return _stored_summary(tables)


def q_stream_retry(spark, sf_dir):
    """Notices of files, every second one of which comes later, and one of a file that never comes."""
    tables = Tables(spark, scratch_path(spark, "store"))
    folder, aside, drop = (scratch_path(spark, name) for name in ("early", "late", "notice-drop"))
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    rows = feed(spark, sf_dir).select(_chunk().alias("chunk"), F.col("seq").alias("at"), record_text().alias("text"))
    staged = path(_write_text(rows, None, "feed"))
    files = staged.getFileSystem(conf)
    files.rename(staged, path(folder))
    keys = [
        f"{part.getPath().getParent().getName()}/{part.getPath().getName()}"
        for part in files.globStatus(path(f"{folder}/chunk=*/part-*"))
    ]
    late = [key for key in keys if int(key.split("/")[0].removeprefix("chunk=")) % 2 == 1]
    for key in late:
        files.mkdirs(path(f"{aside}/{key}").getParent())
        files.rename(path(f"{folder}/{key}"), path(f"{aside}/{key}"))

    def notice(key: str) -> str:
        return f'{{"Records":[{{"s3":{{"bucket":{{"name":"drop"}},"object":{{"key":"{key}"}}}}}}]}}'

    checkpoint, schema = scratch_path(spark, "stream"), "message_id string, body string"
    sent = [[(key, notice(key)) for key in [*keys, "never"]], [("go-1", "[]")], [("go-2", "[]")]]
    for turn, messages in enumerate(sent):
        spark.createDataFrame(messages, schema).write.mode("append").parquet(drop)
        stream = spark.readStream.schema(schema).parquet(drop)
        writer = message_stream(stream, tables, "retry", checkpoint, template=f"{folder}/{{key}}", clock=lambda: NOW)
        writer.trigger(availableNow=True).start().awaitTermination()
        if turn == 0:
            for key in late:
                files.rename(path(f"{aside}/{key}"), path(f"{folder}/{key}"))
    outcomes = tables.outcomes()
    counts = outcomes.agg(
        F.sum("received").alias("received"), F.sum("inserted").alias("inserted"),
        F.count_if(F.col("status") == "failed").alias("failures"),
    )
    dead = accounting.dead_letters(outcomes).agg(F.count(F.lit(1)).alias("dead"))
    return counts.join(dead).join(analysis.event_count(tables.events()).withColumnRenamed("n", "events"))


def q_timed_retry(spark, sf_dir):
    """Notices that each name three files; a file of every second notice comes late, one never, and no message follows."""
    tables = Tables(spark, scratch_path(spark, "store"))
    folder, aside, drop = (scratch_path(spark, name) for name in ("early", "late", "notice-drop"))
    rows = feed(spark, sf_dir).select((F.col("seq") % 12).alias("chunk"), F.col("seq").alias("at"), record_text().alias("text"))
    made = Folders(spark, _write_text(rows, None, "feed"))
    parts = made.glob("chunk=*/part-*")
    names = {part.split("/")[0].removeprefix("chunk="): part for part in parts}
    early, late = Folders(spark, folder), Folders(spark, aside)
    groups = [sorted(names, key=int)[i : i + 3] for i in range(0, len(names), 3)]
    delayed = [group[-1] for group in groups[1::2]]
    for key, part in names.items():
        made.copy(part, (late if key in delayed else early).root + f"/{key}.ndjson")

    def notice(keys: list[str]) -> str:
        named = ",".join(f'{{"s3":{{"bucket":{{"name":"drop"}},"object":{{"key":"{key}.ndjson"}}}}}}' for key in keys)
        return f'{{"Records":[{named}]}}'

    schema = "message_id string, body string"
    sent = [(f"n{i}", notice(group)) for i, group in enumerate(groups)] + [("never", notice(["never"]))]
    spark.createDataFrame(sent, schema).write.parquet(drop)
    stream = spark.readStream.schema(schema).parquet(drop)
    writer = message_stream(
        stream, tables, "timed", scratch_path(spark, "stream"), template=f"{folder}/{{key}}", clock=lambda: NOW, retry_after=dt.timedelta(seconds=1)
    )
    query = writer.trigger(processingTime="500 milliseconds").start()
    try:
        moved = False
        while query.isActive:
            failures = {r.batch_id: r.n for r in tables.outcomes().where("status = 'failed'").groupBy("batch_id").agg(F.count(F.lit(1)).alias("n")).collect()}
            if failures and not moved:
                for key in delayed:
                    late.copy(f"{key}.ndjson", f"{folder}/{key}.ndjson")
                moved = True
            if failures.get("never") == accounting.MAX_ATTEMPTS:
                break
            time.sleep(0.3)
        if query.exception():
            raise query.exception()
    finally:
        query.stop()
    outcomes = tables.outcomes()
    done = outcomes.where("status = 'processed'").agg(F.count(F.lit(1)).alias("notices"), F.sum("received").alias("received"), F.sum("inserted").alias("inserted"))
    dead = accounting.dead_letters(outcomes).agg(F.count(F.lit(1)).alias("dead"))
    return done.join(dead).join(analysis.event_count(tables.events()).withColumnRenamed("n", "events"))


def q_redelivered_outcomes(spark, sf_dir):
    """Every record a message; every third message is delivered twice at once."""
    tables = Tables(spark, scratch_path(spark, "store"))
    sent = feed(spark, sf_dir).select(
        "seq", F.concat(F.lit("m"), F.col("seq")).alias("message_id"), record_text().alias("body")
    )
    sent = written(sent.unionByName(sent.where(F.col("seq") % 3 == 0)).drop("seq"), "redelivered")
    out = ingest_messages(spark, tables, sent, ingest_batch="twice", now=NOW)
    return out.select(
        "batch_id", F.when(F.col("batch_seq") > 0, 1).otherwise(0).alias("delivery"), "received", "valid",
        "inserted", "duplicates", "duplicates_in_batch", "quarantined",
    )


def q_record_cap(spark, sf_dir):
    """A ceiling of records per file: what is cut is counted."""
    tables = Tables(spark, scratch_path(spark, "store"))
    files = _feed_files(spark, sf_dir)
    out = ingest_files(spark, tables, files, batch_id="capped", now=NOW, max_records=1000)
    return out.select("received", "truncated")


def q_outcome_rate(spark, sf_dir):
    rate = analysis.quarantine_rate_of_outcomes(_outcome_rows(spark, sf_dir), "1 day")
    return _shown(rate.withColumn("rate", F.round("rate", 6)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: value for name, value in dict(globals()).items() if name.startswith("q_")
}
