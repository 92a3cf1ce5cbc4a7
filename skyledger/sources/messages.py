"""Queue messages to candidates.

A message body is a telemetry record, an array of records, a notice that files were
dropped, or the test notice a bucket sends once. A body that is not JSON becomes one
rejected record. Bodies are never read as CSV or NDJSON.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.functions import json_text
from skyledger.session import written
from skyledger.sources.json_docs import _shown, with_parsed
from skyledger.sources.lines import literal_path, source_name
from skyledger.sources.payloads import delivered, read_payloads

NOT_JSON_BODY = "message body is not valid JSON"
BAD_KEY = "object key cannot be decoded"
# The test notice.
TEST_SERVICE, TEST_EVENT = "Amazon S3", "s3:TestEvent"


@dataclass(frozen=True)
class Resolved:
    """Candidates of a set of messages, and one row per message."""

    candidates: DataFrame
    #: (batch_id, batch_seq, status, error)
    deliveries: DataFrame
    #: (batch_id, batch_seq, truncated) where ``max_records`` cut something off, or None
    truncated: DataFrame | None = None


def decoded_key(key: Column) -> Column:
    """Object key of a notice: ``+`` is a space, ``%xx`` a byte; NULL when malformed."""
    return F.try_url_decode(key)


#: A delivery that repeats both id and number of another comes so much later.
LATER_DELIVERY = 1 << 40


def numbered_deliveries(messages: DataFrame) -> DataFrame:
    """Make ``(message_id, message_seq)`` tell deliveries apart, also of a message sent twice.

    The window runs over the deliveries of one message.
    """
    seq = F.col("message_seq").cast("bigint") if "message_seq" in messages.columns else F.lit(0).cast("bigint")
    same = Window.partitionBy("message_id", "message_seq").orderBy("body")
    return messages.withColumn("message_seq", seq).withColumn(
        "message_seq", F.col("message_seq") + (F.row_number().over(same) - 1) * F.lit(LATER_DELIVERY)
    )


def classified(messages: DataFrame, numbered: bool = False) -> DataFrame:
    """Add the parsed body and ``role``: rejected, test, notice or records.

    Messages that come from :func:`numbered_deliveries` are ``numbered``; the others are numbered here, which shuffles their bodies.
    """
    df = with_parsed(messages if numbered else numbered_deliveries(messages), "body", NOT_JSON_BODY)
    value = F.col("value")
    is_object = F.col("root_kind") == "object"

    def text_at(name: str) -> Column:
        member = json_text.field(value, name)
        return F.when(
            json_text.kind(member) == "string", F.try_variant_get(member, "$", "string")
        )

    entries = F.when(is_object, F.try_variant_get(value, "$.Records", "array<variant>"))

    def well_formed(entry: Column) -> Column:
        def kind_at(path: str) -> Column:
            return json_text.kind(F.try_variant_get(entry, path, "variant"))

        return (
            (kind_at("$.s3.bucket.name") == "string")
            & (kind_at("$.s3.object.key") == "string")
            & kind_at("$.s3.object.size").isin("undefined", "number")
        )

    df = df.withColumn("_entries", entries)
    notice = (F.size("_entries") > 0) & F.forall("_entries", well_formed)
    test = is_object & (text_at("Service") == TEST_SERVICE) & (text_at("Event") == TEST_EVENT)
    return df.withColumn(
        "role",
        F.when(F.col("parse_error").isNotNull(), "rejected")
        .when(test, "test")
        .when(notice, "notice")
        .otherwise("records"),
    )


def direct_candidates(classified_messages: DataFrame) -> DataFrame:
    """Candidates of bodies that are telemetry themselves, or no JSON at all."""
    df = classified_messages.where(F.col("role").isin("rejected", "records"))
    name = F.concat(F.lit("sqs:"), F.col("message_id"))
    is_array = F.coalesce(F.col("root_kind") == "array", F.lit(False))
    single = df.where(~is_array).select(
        "message_id",
        "message_seq",
        F.lit(0).cast("bigint").alias("pos"),
        name.alias("source"),
        _shown(F.col("value"), F.col("root_kind"), F.col("body")).alias("raw_text"),
        F.col("body").alias("raw_json"),
        "value",
        "root_kind",
        "parse_error",
    )
    items = (
        json_text.array_items(df.where(is_array).drop("value"), "body", "_items")
        .select("message_id", "message_seq", "_items", F.posexplode("_items").alias("_pos", "_item"))
        .select(
            "message_id",
            "message_seq",
            F.col("_pos").cast("bigint").alias("pos"),
            F.when(F.size("_items") > 1, F.concat(name, F.lit("#"), F.col("_pos")))
            .otherwise(name)
            .alias("source"),
            F.col("_item.text").alias("raw_text"),
            F.col("_item.text").alias("raw_json"),
            F.col("_item.value").alias("value"),
            json_text.kind(F.col("_item.value")).alias("root_kind"),
            F.lit(None).cast("string").alias("parse_error"),
        )
    )
    return delivered(
        single.unionByName(items), F.col("message_id"), F.col("message_seq"), F.lit("")
    )


def notice_entries(classified_messages: DataFrame, template: str) -> DataFrame:
    """One row per file named by a notice, in the order named."""
    entry = F.posexplode("_entries").alias("entry_pos", "entry")
    df = classified_messages.where(F.col("role") == "notice").select(
        "message_id", "message_seq", entry
    )
    df = df.select(
        "message_id",
        "message_seq",
        "entry_pos",
        F.try_variant_get("entry", "$.s3.bucket.name", "string").alias("bucket"),
        decoded_key(F.try_variant_get("entry", "$.s3.object.key", "string")).alias("key"),
    )
    pieces = re.split(r"(\{bucket\}|\{key\})", template)
    parts = {"{bucket}": F.col("bucket"), "{key}": F.col("key")}
    path = F.concat(*[parts.get(piece, F.lit(piece)) for piece in pieces])
    return df.withColumn("path", path)


def _path_key(path: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(path, "^s3[an]://", "s3://"), "^file:/+", "/")


#: Files that one set of messages may name; more are refused, as their names pass through the driver.
MAX_FILES = 100_000
#: File systems are asked about so many paths at once.
PROBES = 32


def unreadable_paths(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """Why a path cannot be read, for those that cannot: each is opened once before the read."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def trouble(path: str) -> str | None:
        try:
            p = jvm.org.apache.hadoop.fs.Path(path)
            files = p.getFileSystem(conf)
            if not files.exists(p):
                return "object not found: "
            files.open(p).close()
        except Py4JJavaError:
            return "object cannot be read: "
        return None

    with ThreadPoolExecutor(PROBES) as pool:
        found = dict(zip(paths, pool.map(trouble, paths), strict=True))
    return {path: f"{why}{path}" for path, why in found.items() if why}


def resolved(
    spark: SparkSession,
    messages: DataFrame,
    template: str = "s3a://{bucket}/{key}",
    max_records: int | None = None,
    numbered: bool = False,
) -> Resolved:
    """Candidates of all messages, files included.

    ``messages`` is ``(message_id, body[, message_seq])``. A message naming a file
    that is missing or cannot be opened, or a key that cannot be decoded, fails as a
    whole and leaves its neighbours alone. The driver handles the names of the files, as it does for
    any read, never their content.
    """
    seen = classified(messages, numbered)
    # Of arrays and notices only the items are used.
    single = (F.col("role") == "records") & (F.col("root_kind") != "array")
    # Written with what was parsed: a filter on the kind or the role would otherwise parse every body again.
    seen = written(seen.withColumn("value", F.when(single, F.col("value"))), "messages")
    direct = direct_candidates(seen)
    entries = written(notice_entries(seen, template), "notice-entries")
    named = entries.select("path").where("path is not null").distinct().limit(MAX_FILES + 1)
    paths = [r["path"] for r in named.collect()]
    if len(paths) > MAX_FILES:
        raise ValueError(f"the messages name more than {MAX_FILES} files; hand them over in smaller sets")
    troubles = unreadable_paths(spark, paths)
    readable = [p for p in paths if p not in troubles]

    broken = spark.createDataFrame(list(troubles.items()), "path string, trouble string")
    failed = (
        entries.join(broken, "path", "left")
        .withColumn("error", F.when(F.col("key").isNull(), F.lit(BAD_KEY)).otherwise(F.col("trouble")))
        .where(F.col("error").isNotNull())
        .groupBy("message_id", "message_seq")
        .agg(F.min_by("error", "entry_pos").alias("error"))
    )
    deliveries = seen.join(failed, ["message_id", "message_seq"], "left").select(
        F.col("message_id").alias("batch_id"),
        F.col("message_seq").cast("bigint").alias("batch_seq"),
        F.when(F.col("error").isNotNull(), "failed")
        .when(F.col("role") == "test", "skipped")
        .otherwise("processed")
        .alias("status"),
        "error",
    )
    if not readable:
        return Resolved(direct, deliveries)

    usable = entries.join(failed, ["message_id", "message_seq"], "left_anti").withColumn(
        "path_key", _path_key(F.col("path"))
    )
    files, cut = read_payloads(spark, [literal_path(p) for p in readable], max_records)
    files = files.withColumn("path_key", _path_key(source_name(F.col("file"))))
    if cut is not None:
        cut = cut.withColumn("path_key", _path_key(source_name(F.col("file")))).join(usable, "path_key")
        cut = cut.groupBy(
            F.col("message_id").alias("batch_id"), F.col("message_seq").cast("bigint").alias("batch_seq")
        ).agg(F.sum("truncated").alias("truncated"))
    rows = files.join(usable, "path_key")
    suffix = F.substring(F.col("source"), F.char_length(source_name(F.col("file"))) + 1, 64)
    rows = rows.withColumn(
        "source", F.concat(F.lit("s3://"), F.col("bucket"), F.lit("/"), F.col("key"), suffix)
    )
    from_files = delivered(
        rows, F.col("message_id"), F.col("message_seq"), F.format_string("%010d", F.col("entry_pos"))
    )
    return Resolved(direct.unionByName(from_files), deliveries, cut)
