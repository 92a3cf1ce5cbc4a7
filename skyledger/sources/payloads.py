"""Dropped files of any supported format to candidates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.functions.text import is_continued
from skyledger.session import written
from skyledger.sources.csv_rows import csv_candidates
from skyledger.sources.json_docs import ndjson_candidates
from skyledger.sources.json_parts import json_files
from skyledger.sources.lines import STRETCH_KEY, sniffed_formats, stretch_order, text_lines

FORMATS = ("csv", "ndjson", "json")


def read_payloads(
    spark: SparkSession,
    paths: str | Sequence[str],
    max_records: int | None = None,
    scan: dict[str, str] | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Candidates of every file under ``paths``; the format is found per file.

    Also ``(file, truncated)`` if ``max_records`` is given: how many it cut off.

    The extension decides; content is looked at only where it says nothing. Each
    format is one branch over its own files.
    """
    sniffed = written(sniffed_formats(text_lines(spark, paths, "unknown", scan)), "sniffed")
    found = {row["format"] for row in sniffed.select("format").distinct().collect()}

    def of_format(form: str, read) -> DataFrame:
        named = read(spark, paths, form, scan)
        if form not in found:
            return named
        files = sniffed.where(F.col("format") == form).select("file")
        others = read(spark, paths, "unknown", scan).join(files, "file", "left_semi")
        return named.unionByName(others)

    def json_of() -> DataFrame:
        named = json_files(spark, paths, "json", scan)
        if "json" not in found:
            return named
        files = sniffed.where(F.col("format") == "json").select("file")
        return named.unionByName(json_files(spark, paths, "unknown", scan, files))

    branches = [
        csv_candidates(of_format("csv", text_lines)),
        ndjson_candidates(of_format("ndjson", text_lines)),
        json_of(),
    ]
    result = branches[0].unionByName(branches[1]).unionByName(branches[2])
    return (result, None) if max_records is None else capped(result, max_records)


def capped(candidates: DataFrame, max_records: int) -> tuple[DataFrame, DataFrame]:
    """The first ``max_records`` candidates of each file, and ``(file, truncated)``.

    An option for callers who want a ceiling per file; nothing is capped unless
    asked. Counts per stretch locate the boundary, so only the one stretch that
    holds it is ranked row by row. A record in parts counts once, and all its parts stay or go.
    """
    counted = F.when(is_continued(F.col("parse_error")), 0).otherwise(1)
    candidates = written(candidates, "uncapped")
    counts = written(
        candidates.groupBy(*STRETCH_KEY)
        .agg(F.sum(counted).alias("n"))
        .withColumn(
            "before", F.coalesce(F.sum("n").over(stretch_order(before=True)), F.lit(0))
        ),
        "record-counts",
    )
    key = list(STRETCH_KEY)
    whole = counts.where(F.col("before") + F.col("n") <= max_records)
    split = counts.where(
        (F.col("before") <= max_records) & (F.col("before") + F.col("n") > max_records)
    )
    upto = Window.partitionBy(*key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rank = F.sum(counted).over(upto)
    boundary = (
        candidates.join(split.select(*key, "before"), key)
        .withColumn("rank", F.col("before") + rank)
        .where(F.col("rank") <= max_records)
    )
    kept = candidates.join(whole.select(*key), key, "left_semi").unionByName(
        boundary.select(*candidates.columns)
    )
    truncated = counts.groupBy("file").agg(
        F.greatest(F.sum("n") - max_records, F.lit(0)).alias("truncated")
    )
    return kept, truncated


def delivered(candidates: DataFrame, batch_id: Column, batch_seq: Column, file_pos: Column) -> DataFrame:
    """Give candidates their delivery and their place in the order of arrival."""
    seq = batch_seq.cast("bigint")
    return candidates.select(
        batch_id.alias("batch_id"),
        seq.alias("batch_seq"),
        F.struct(
            seq.alias("batch_seq"),
            batch_id.alias("batch_id"),
            file_pos.cast("string").alias("file_pos"),
            F.col("pos").cast("bigint").alias("pos"),
        ).alias("ord"),
        "source",
        "raw_text",
        "raw_json",
        "value",
        "root_kind",
        "parse_error",
    )


def as_batch(candidates: DataFrame, batch_id: str = "files", batch_seq: int = 0) -> DataFrame:
    """Treat all files read together as one delivery, in file name order."""
    return delivered(candidates, F.lit(batch_id), F.lit(batch_seq), F.col("file"))
