"""Physical lines of text files, with their line numbers, read in parallel.

A large file is read in splits, so a line's number is not known where it is read.
Lines inside one split are read in order, though, which gives every line its place
inside a *stretch*: at most ``2**18`` consecutive lines of one split of one file. A
small table with one row per stretch then turns places into line numbers. No step
needs a whole file in one task.

Where splits begin depends on the number of cores, which may change while a job runs.
So lines are written once, together with their places, before anything counts them;
all that follows reads the written places.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.functions.text import is_blank, trimmed
from skyledger.session import written

STRETCH_BITS = 18
#: Numbered lines are dealt over so many tasks for each core.
TASKS_PER_CORE = 3

#: A stretch is named by its file, the split's offset, and the running number above.
STRETCH_KEY = ("file", "block", "stretch")

EXTENSIONS = {"csv": ("csv",), "ndjson": ("ndjson", "jsonl"), "json": ("json",)}


def format_of_name(name: Column) -> Column:
    """Format by file extension, whatever its case; NULL when it tells nothing."""
    lower = F.lower(name)
    result = F.lit(None).cast("string")
    for form, endings in EXTENSIONS.items():
        for ending in endings:
            result = F.when(lower.endswith(f".{ending}"), form).otherwise(result)
    return result


def source_name(file: Column) -> Column:
    """Readable provenance from a scan's percent-encoded path."""
    plain = F.coalesce(F.try_url_decode(F.replace(file, F.lit("+"), F.lit("%2B"))), file)
    return F.regexp_replace(plain, "^s3[an]://", "s3://")


def literal_path(path: str) -> str:
    """A path whose own pattern characters are not taken for a glob."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def text_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    only_format: str | None = None,
    scan: dict[str, str] | None = None,
) -> DataFrame:
    """Lines as ``(file, block, stretch, at, text)``; ``at`` orders lines of a stretch.

    ``only_format`` keeps the files whose extension names that format, or those
    without a telling extension for ``"unknown"``; the test is on file metadata,
    so other files are not opened.
    """
    df = (
        spark.read.option("lineSep", "\n")
        .option("recursiveFileLookup", "true")
        .options(**(scan or {}))
        .text(paths if isinstance(paths, str) else list(paths))
    )
    if only_format is not None:
        found = F.coalesce(format_of_name(F.col("_metadata.file_name")), F.lit("unknown"))
        df = df.where(found == only_format)
    return df.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.make_valid_utf8("value").alias("text"),
    ).withColumn("stretch", F.shiftright("at", STRETCH_BITS))


def stretch_stats(lines: DataFrame, *extra: Column) -> DataFrame:
    """One row per stretch: where it starts and how many lines it has."""
    return lines.groupBy(*STRETCH_KEY).agg(
        F.min("at").alias("first_at"), F.count(F.lit(1)).alias("n_lines"), *extra
    )


def stretch_order(*, before: bool = False) -> Window:
    """Stretches of a file from its start up to this one (or the one before).

    One row per stretch, so even a file holding most of the data has few rows here.
    """
    w = Window.partitionBy("file").orderBy("block", "stretch")
    return w.rowsBetween(Window.unboundedPreceding, -1 if before else 0)


def with_base_line(stats: DataFrame) -> DataFrame:
    """Add ``base``: the number of lines of the file before this stretch."""
    return stats.withColumn(
        "base", F.coalesce(F.sum("n_lines").over(stretch_order(before=True)), F.lit(0))
    )


def numbered_lines(lines: DataFrame) -> DataFrame:
    """Add the physical ``line`` number, from 1, of every line in its file.

    The planner broadcasts the counts or not by their written size. The lines are dealt out evenly
    at the end: written lines are small beside what is made of them, so they are read back in about as many splits
    as there are cores, and one split more would keep a single core busy while the others wait.
    """
    lines = written(lines, "lines")
    bases = written(with_base_line(stretch_stats(lines)).drop("n_lines"), "line-bases")
    numbered = lines.join(bases, list(STRETCH_KEY)).withColumn(
        "line", F.col("base") + F.col("at") - F.col("first_at") + 1
    )
    return numbered.repartition(TASKS_PER_CORE * lines.sparkSession.sparkContext.defaultParallelism, "file", "line")


def sniffed_formats(lines: DataFrame) -> DataFrame:
    """``(file, format)`` from content, for files whose names tell nothing.

    The first character decides between an array, an object and CSV. An object
    file is NDJSON when some line ending in ``}`` is followed, blank lines apart,
    by a line starting with ``{``. Files without any visible text are CSV.
    """
    text = trimmed(F.col("text"))
    shown = lines.select(
        *STRETCH_KEY,
        "at",
        F.left(text, F.lit(1)).alias("head"),
        (F.right(text, F.lit(1)) == "}").alias("closes"),
        is_blank(F.col("text")).alias("blank"),
    ).where(~F.col("blank"))
    within = Window.partitionBy(*STRETCH_KEY).orderBy("at")
    seams = (F.col("head") == "{") & F.col("before")
    by_stretch = (
        shown.withColumn("before", F.lag("closes", 1, False).over(within))
        .groupBy(*STRETCH_KEY)
        .agg(
            F.min_by("head", "at").alias("head"),
            F.max_by("closes", "at").alias("closes"),
            F.bool_or(seams).alias("seam"),
        )
    )
    across = Window.partitionBy("file").orderBy("block", "stretch")
    joined = by_stretch.withColumn("before", F.lag("closes", 1, False).over(across))
    by_file = joined.groupBy("file").agg(
        F.min_by("head", F.struct("block", "stretch")).alias("head"),
        F.bool_or(F.col("seam") | seams).alias("seam"),
    )
    return by_file.select(
        "file",
        F.when(F.col("head") == "[", "json")
        .when((F.col("head") == "{") & F.col("seam"), "ndjson")
        .when(F.col("head") == "{", "json")
        .otherwise("csv")
        .alias("format"),
    )
