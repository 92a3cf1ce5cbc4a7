"""NDJSON lines and JSON documents to candidates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions import json_text
from skyledger.functions.text import is_blank
from skyledger.sources.lines import (
    STRETCH_KEY,
    format_of_name,
    numbered_lines,
    source_name,
    text_lines,
)

NOT_JSON = "invalid JSON: the text is not one JSON value"


def with_parsed(df: DataFrame, text: str, error: str) -> DataFrame:
    """Add ``value``, ``root_kind`` and ``parse_error`` for a text column."""
    wrapped = json_text.wrapped(F.col(text))
    ok = json_text.is_one_value(F.col(text), F.col("_wrapped"))
    return (
        df.withColumn("_wrapped", wrapped)
        .withColumns({"_ok": ok, "_mark": json_text.first_mark(F.col(text))})
        .withColumns(
            {
                "value": F.when(F.col("_ok"), F.try_variant_get("_wrapped", "$[0]", "variant")),
                "root_kind": F.when(F.col("_ok"), json_text.kind_of_mark(F.col("_mark"))),
                "parse_error": F.when(~F.col("_ok"), error),
            }
        )
        .drop("_wrapped", "_ok", "_mark")
    )


def ndjson_candidates(lines: DataFrame) -> DataFrame:
    """One candidate per line that is not blank; a bad line stands alone."""
    rows = (
        numbered_lines(lines)
        .withColumn("raw_text", F.regexp_replace("text", "\r$", ""))
        .where(~is_blank(F.col("raw_text")))
    )
    return with_parsed(rows, "raw_text", NOT_JSON).select(
        *STRETCH_KEY,
        F.col("line").alias("pos"),
        F.concat(source_name(F.col("file")), F.lit("#L"), F.col("line")).alias("source"),
        "raw_text",
        F.col("raw_text").alias("raw_json"),
        "value",
        "root_kind",
        "parse_error",
    )


def exploded_documents(df: DataFrame, text: str, error: str) -> DataFrame:
    """Candidates of JSON texts: the items of an array, or the one value.

    Adds ``pos`` (item index), ``n_items`` (NULL unless an array), ``raw_text``,
    ``raw_json``, ``value``, ``root_kind`` and ``parse_error``. An empty array
    gives no rows.
    """
    df = json_text.array_items(df, text, "_items")
    single = with_parsed(df.where(F.col("_items").isNull()), text, error).withColumns(
        {
            "pos": F.lit(0).cast("bigint"),
            "n_items": F.lit(None).cast("int"),
            "raw_text": _shown(F.col("value"), F.col("root_kind"), F.col(text)),
            "raw_json": F.col(text),
        }
    )
    items = (
        df.where(F.col("_items").isNotNull())
        .withColumn("n_items", F.size("_items"))
        .select("*", F.posexplode("_items").alias("_pos", "_item"))
        .withColumns(
            {
                "pos": F.col("_pos").cast("bigint"),
                "raw_text": F.col("_item.text"),
                "raw_json": F.col("_item.text"),
                "value": F.col("_item.value"),
                "root_kind": json_text.kind(F.col("_item.value")),
                "parse_error": F.lit(None).cast("string"),
            }
        )
        .drop("_pos", "_item")
    )
    return single.unionByName(items).drop("_items")


def _shown(value: Column, root_kind: Column, text: Column) -> Column:
    """Text kept for diagnosis: a string value without its quotes, else as received."""
    return F.when(root_kind == "string", F.try_variant_get(value, "$", "string")).otherwise(text)


def json_candidates(documents: DataFrame) -> DataFrame:
    """Candidates of whole documents ``(file, text)``."""
    text = F.regexp_replace("text", "^\\ufeff", "")
    rows = exploded_documents(documents.withColumn("doc", text).drop("text"), "doc", NOT_JSON)
    name = source_name(F.col("file"))
    return rows.select(
        "file",
        F.lit(0).cast("bigint").alias("block"),
        F.lit(0).cast("bigint").alias("stretch"),
        "pos",
        F.when(F.col("n_items").isNotNull(), F.concat(name, F.lit("#"), F.col("pos")))
        .otherwise(name)
        .alias("source"),
        "raw_text",
        "raw_json",
        "value",
        "root_kind",
        "parse_error",
    )


def documents(
    spark: SparkSession,
    paths: str | Sequence[str],
    only_format: str | None = None,
    scan: dict[str, str] | None = None,
    max_bytes: int | None = None,
    min_bytes: int | None = None,
) -> DataFrame:
    """Whole files as ``(file, text)``: one JSON document is one value.

    Files of more than ``max_bytes``, or of ``min_bytes`` and less, are not opened.
    """
    df = (
        spark.read.option("recursiveFileLookup", "true")
        .options(**(scan or {}))
        .text(paths if isinstance(paths, str) else list(paths), wholetext=True)
    )
    if only_format is not None:
        found = F.coalesce(format_of_name(F.col("_metadata.file_name")), F.lit("unknown"))
        df = df.where(found == only_format)
    if max_bytes is not None:
        df = df.where(F.col("_metadata.file_size") <= max_bytes)
    if min_bytes is not None:
        df = df.where(F.col("_metadata.file_size") > min_bytes)
    return df.select(
        F.col("_metadata.file_path").alias("file"), F.make_valid_utf8("value").alias("text")
    )


def read_ndjson(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return ndjson_candidates(text_lines(spark, paths))
