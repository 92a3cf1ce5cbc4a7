"""JSON arrays too large for one value, read in splits by many tasks and cut into their items.

A file is read in *pieces* that end at a ``}``, as lines end at a line feed, so any split of it can be read alone. What a
piece does to the reading of what follows is small and can be composed: whether it holds an odd number of quotes, and
by how much it changes the depth of brackets if it begins outside a string, or inside one. Effects are summed up within
stretches (at most 2^18 pieces of one split), the stretches' sums are added up along the file, and so every piece
learns the state it begins in.

A ``}`` outside strings that brings the depth back to one ends an item of the array. The pieces from one such place to the
next are one *group*: an item, and plain values before it if there are any. Its text is put together and parsed alone;
counts of items give each its number. Only the pieces' numbers pass through windows, never their texts.

An array is valid if every group parses, follows a comma, and the depth ends at zero outside strings. Else the file is
one rejected record, as a small one is, which shows the first group at fault; the whole text does not fit a value.
Plain values in a row longer than a value (2 GB without any ``}``) cannot be read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.functions import json_text
from skyledger.functions.text import WHITE_SPACE_CLASS
from skyledger.session import written
from skyledger.sources.json_docs import NOT_JSON, documents, json_candidates
from skyledger.sources.lines import STRETCH_BITS, STRETCH_KEY, format_of_name, source_name, stretch_order

#: Longer files are read in pieces.
SPLIT_ABOVE = 256 << 20
TOO_LARGE = "invalid JSON: one value of more than 2 GB"
#: One value cannot be longer.
MAX_VALUE_BYTES = 2**31 - 1

_SPACE = f"[{WHITE_SPACE_CLASS}]*"
_PLACE = ("block", "at")


def _scan(spark: SparkSession, paths: str | Sequence[str], only_format: str | None, scan: dict[str, str] | None, above: int) -> DataFrame:
    """The pieces of large files as ``(file, block, at, text)``; smaller files are not opened."""
    df = (
        spark.read.option("lineSep", "}")
        .option("recursiveFileLookup", "true")
        .options(**(scan or {}))
        .text(paths if isinstance(paths, str) else list(paths))
        .where(F.col("_metadata.file_size") > above)
    )
    if only_format is not None:
        df = df.where(F.coalesce(format_of_name(F.col("_metadata.file_name")), F.lit("unknown")) == only_format)
    return df.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.make_valid_utf8("value").alias("text"),
    )


def _effects(text: Column) -> list[Column]:
    """``odd``: whether a piece changes between inside and outside of strings; ``d0``, ``d1``: what it does to the depth,
    its ``}`` included, if it begins outside or inside."""
    # Without escapes a string is a quote, other characters, and a quote.
    plain = F.regexp_replace(text, r"(?s)\\.", "")
    odd = (F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))) % 2 == 1

    def depth(outside: Column, ends_outside: Column) -> Column:
        bare = F.regexp_replace(outside, '"[^"]*(?:"|$)', "")
        opens = F.length(F.regexp_replace(bare, r"[^\[{]", ""))
        closes = F.length(F.regexp_replace(bare, r"[^\]]", ""))
        return (opens - closes - ends_outside.cast("int")).cast("long")

    inside = F.regexp_replace(plain, '^[^"]*(?:"|$)', "")
    return [odd.alias("odd"), depth(plain, ~odd).alias("d0"), depth(inside, odd).alias("d1")]


def _placed(pieces: DataFrame) -> DataFrame:
    """``(file, block, stretch, at, last, ended, depth, group)`` of every piece: whether strings are closed after it, the depth
    after it, and the number of its group. Of the last piece, ``depth`` counts a ``}`` that is not there."""
    effects = written(pieces.select(*STRETCH_KEY, "at", *_effects(F.col("text"))), "json-effects")
    within = Window.partitionBy(*STRETCH_KEY).orderBy("at")
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    flips = F.coalesce(F.sum(F.col("odd").cast("long")).over(before), F.lit(0)) % 2 == 1
    run = effects.withColumn("flipped", flips)
    # Depths after each piece, for either state at the stretch's start.
    a0, a1 = (F.when(F.col("flipped"), F.col(x)).otherwise(F.col(y)) for x, y in (("d1", "d0"), ("d0", "d1")))
    run = run.withColumns({"a0": F.sum(a0).over(within), "a1": F.sum(a1).over(within)})
    run = written(run.select(*STRETCH_KEY, "at", (F.col("flipped") != F.col("odd")).alias("turned"), "a0", "a1"), "json-runs")

    stats = run.groupBy(*STRETCH_KEY).agg(F.max_by("turned", "at").alias("turned"), F.max_by("a0", "at").alias("a0"), F.max_by("a1", "at").alias("a1"), F.max("at").alias("last_at"))
    so_far = stretch_order(before=True)
    stats = stats.withColumn("starts_inside", F.coalesce(F.sum(F.col("turned").cast("long")).over(so_far), F.lit(0)) % 2 == 1)
    own = F.when(F.col("starts_inside"), F.col("a1")).otherwise(F.col("a0"))
    stats = stats.withColumn("depth_before", F.coalesce(F.sum(own).over(so_far), F.lit(0)))
    end = F.max(F.struct("block", "stretch", "last_at")).over(Window.partitionBy("file"))
    stats = written(stats.select(*STRETCH_KEY, "starts_inside", "depth_before", end.alias("end")), "json-stretches")

    depth = F.col("depth_before") + F.when(F.col("starts_inside"), F.col("a1")).otherwise(F.col("a0"))
    last = F.struct("block", "stretch", "at") == F.struct("end.block", "end.stretch", "end.last_at")
    placed = run.join(stats, list(STRETCH_KEY)).select(
        *STRETCH_KEY, "at", last.alias("last"), (F.col("turned") == F.col("starts_inside")).alias("ended"), depth.alias("depth")
    )
    closes = F.col("ended") & (F.col("depth") == 1) & ~F.col("last")
    placed = written(placed.withColumn("closes", closes.cast("long")), "json-depths")
    bases = placed.groupBy(*STRETCH_KEY).agg(F.sum("closes").alias("n"))
    bases = bases.select(*STRETCH_KEY, F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("groups_before"))
    number = F.col("groups_before") + F.coalesce(F.sum("closes").over(before), F.lit(0))
    return placed.join(written(bases, "json-group-bases"), list(STRETCH_KEY)).withColumn("group", number).drop("groups_before", "closes")


def array_candidates(pieces: DataFrame) -> DataFrame:
    """Candidates of the arrays whose ``pieces`` ``(file, block, stretch, at, text)`` are given, as of
    :func:`skyledger.sources.json_docs.json_candidates`."""
    placed = written(_placed(pieces), "json-placed")
    ended = placed.where("last").select("file", (F.col("ended") & (F.col("depth") == -1)).alias("closed"))
    part = F.struct("block", "at", "text")
    texts = pieces.join(placed, [*STRETCH_KEY, "at"]).groupBy("file", "group").agg(F.sort_array(F.collect_list(part)).alias("parts"), F.bool_or("last").alias("last"))
    joined = F.array_join(F.transform("parts", lambda p: p["text"]), "}")
    texts = texts.select("file", "group", "last", F.concat(joined, F.when(F.col("last"), "").otherwise("}")).alias("text"))
    # What stands around the items of a group: the bracket that opens the array or a comma, and the one that closes it.
    head = F.when(F.col("group") == 0, F.lit(rf"^\ufeff?{_SPACE}\[")).otherwise(F.lit(f"^{_SPACE},"))
    bare = F.when(F.col("last"), F.regexp_replace("text", rf"\]{_SPACE}$", "")).otherwise(F.col("text"))
    ends = ~F.col("last") | F.regexp_like("text", F.lit(rf"\]{_SPACE}$"))
    # Behind the last item there may be nothing but the bracket.
    nothing = F.col("last") & F.regexp_like(bare, F.when(F.col("group") == 0, F.lit(rf"^\ufeff?{_SPACE}\[{_SPACE}$")).otherwise(F.lit(f"^{_SPACE}$")))
    body = F.when(nothing, "").when(ends & F.regexp_like(bare, head), F.regexp_replace(bare, head, ""))
    groups = texts.withColumn("doc", F.concat(F.lit("["), body, F.lit("]")))
    parsed = json_text.array_items(groups, "doc", "items")
    # A group that is not the end of the array holds an item.
    size = F.size("items")
    fine = F.col("items").isNotNull() & (F.col("last") | (size > 0)) & (nothing | (size > 0))
    rows = written(parsed.select("file", "group", fine.alias("fine"), F.when(fine, size).otherwise(0).alias("n"), F.when(fine, F.col("items")).alias("items"), F.when(~fine, F.col("text")).alias("text")), "json-groups")

    verdict = rows.groupBy("file").agg(F.bool_and("fine").alias("fine"), F.min(F.when(~F.col("fine"), F.col("group"))).alias("bad"))
    verdict = written(verdict.join(ended, "file").select("file", (F.col("fine") & F.col("closed")).alias("valid"), F.coalesce("bad", F.lit(0)).alias("bad")), "json-verdicts")
    rows = rows.withColumn("run", F.shiftright("group", STRETCH_BITS))
    runs = rows.groupBy("file", "run").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = written(runs.select("file", "run", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")), "json-run-bases")
    in_run = Window.partitionBy("file", "run").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    numbers = rows.select("file", "run", "group", "n").withColumn("within", F.coalesce(F.sum("n").over(in_run), F.lit(0)))
    numbers = numbers.join(runs, ["file", "run"]).select("file", "group", (F.col("base") + F.col("within")).alias("first"))
    good = rows.join(verdict.where("valid").select("file"), "file", "left_semi").where("n > 0").join(numbers, ["file", "group"])
    name = source_name(F.col("file"))
    items = good.select("file", "run", "first", F.posexplode("items").alias("i", "item")).select(
        "file",
        F.lit(0).cast("bigint").alias("block"),
        F.col("run").alias("stretch"),
        (F.col("first") + F.col("i")).alias("pos"),
        F.concat(name, F.lit("#"), F.col("first") + F.col("i")).alias("source"),
        F.col("item.text").alias("raw_text"),
        F.col("item.text").alias("raw_json"),
        F.col("item.value").alias("value"),
        json_text.kind(F.col("item.value")).alias("root_kind"),
        F.lit(None).cast("string").alias("parse_error"),
    )
    bad = rows.join(verdict.where("not valid").select("file", F.col("bad").alias("group")), ["file", "group"]).select("file", F.col("text").alias("raw_text"))
    return items.unionByName(_rejected(bad, NOT_JSON))


def _rejected(files: DataFrame, error: str) -> DataFrame:
    """One rejected candidate for each file ``(file, raw_text)``."""
    zero = F.lit(0).cast("bigint")
    return files.select(
        "file", zero.alias("block"), zero.alias("stretch"), zero.alias("pos"), source_name(F.col("file")).alias("source"),
        "raw_text", F.col("raw_text").alias("raw_json"), F.lit(None).cast("variant").alias("value"), F.lit(None).cast("string").alias("root_kind"),
        F.lit(error).alias("parse_error"),
    )


def json_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    only_format: str | None = None,
    scan: dict[str, str] | None = None,
    files: DataFrame | None = None,
    split_above: int | None = None,
) -> DataFrame:
    """Candidates of JSON files of any size, of the ``files`` ``(file)`` only if given.

    Files of more than ``split_above`` bytes are read in pieces.
    """
    above = SPLIT_ABOVE if split_above is None else split_above

    def wanted(df: DataFrame) -> DataFrame:
        return df if files is None else df.join(files, "file", "left_semi")

    small = json_candidates(wanted(documents(spark, paths, only_format, scan, max_bytes=above)))
    large = _scan(spark, paths, only_format, scan, above)
    if large.limit(1).isEmpty():
        return small
    pieces = written(wanted(large).withColumn("stretch", F.shiftright("at", STRETCH_BITS)), "json-pieces")
    first = pieces.groupBy("file", "file_size").agg(F.min_by("text", F.struct(*_PLACE)).alias("text"))
    heads = written(first.select("file", "file_size", (json_text.first_mark(F.regexp_replace("text", "^\ufeff", "")) == "[").alias("array"), "text"), "json-heads")
    arrays = array_candidates(pieces.drop("file_size").join(heads.where("array").select("file"), "file", "left_semi"))
    whole = heads.where(~F.coalesce("array", F.lit(False)))
    result = small.unionByName(arrays).unionByName(_rejected(whole.where(F.col("file_size") > MAX_VALUE_BYTES).select("file", F.col("text").alias("raw_text")), TOO_LARGE))
    # One value that is no array cannot be cut; it is read whole if it fits.
    others = [literal for (literal,) in whole.where(F.col("file_size") <= MAX_VALUE_BYTES).select("file").collect()]
    return result if not others else result.unionByName(json_candidates(documents(spark, paths, only_format, scan, min_bytes=above).where(F.col("file").isin(others))))


def read_json(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return json_files(spark, paths)
