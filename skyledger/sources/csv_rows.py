"""CSV files to candidates: quoted cells, embedded newlines, line numbers, ragged rows.

A quoted cell may hold newlines, so whether a line starts a row depends on every
line before it. Each line is therefore reduced to what it does to the reading state
(outside or inside quotes), and those effects are combined per stretch of lines and
then along the stretches of a file. Stretches in which every line is a whole row need
nothing more and are never shuffled. Only the others have their lines put together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.functions.text import CONTINUED, WHITE_SPACE_CLASS, trimmed
from skyledger.session import written
from skyledger.sources.lines import (
    STRETCH_KEY,
    source_name,
    stretch_order,
    stretch_stats,
    text_lines,
    with_base_line,
)

# The columns that stay at the top level of a record.
TOP_LEVEL_COLUMNS = ("eventId", "droneId", "timestamp", "eventType", "statusCode", "telemetryData")

#: Bytes of lines that one task sorts, about; the lines of a stretch are never dealt over several.
SORTED_BYTES = 64 << 20
#: What a line takes beside its text: its place, its file and its effects.
LINE_BYTES = 256
#: A row longer than this cannot be one cell value; its text is kept in parts.
MAX_ROW_CHARS = 256 * 1024 * 1024

# A carriage return outside quotes is dropped, so a field may start with some.
_LEAD = r'(?:\r*+""(?=\r++"))*+\r*+'
_QUOTED = r'"(?:[^"]++|"")*+'
_CLOSED_FIELD = rf'{_LEAD}(?:{_QUOTED}"[^,]*+|(?!")[^,]*+)'
#: A line, starting outside quotes, that ends inside them.
ENDS_INSIDE = rf"^(?:{_CLOSED_FIELD},)*+{_LEAD}{_QUOTED}\z"
#: One field with the comma before it.
FIELD = rf',({_LEAD}(?:{_QUOTED}(?:"[^,]*+)?|[^,]*+))'
#: A row of one cell that holds white space only.
BLANK_ROW = (
    rf'^(?:{_LEAD}"[{WHITE_SPACE_CLASS}]*+(?:"[{WHITE_SPACE_CLASS}]*+)?|[{WHITE_SPACE_CLASS}]*+)\z'
)
_QUOTED_PARTS = r'^\r*+"((?:[^"]++|"")*+)"?((?s:.*))$'


def cells_of(row: Column) -> Column:
    """Cells of one logical row, unquoted."""

    def cell(raw: Column) -> Column:
        bare = F.regexp_replace(raw, r'^(?:\r*+""(?=\r++"))++', "")
        inside = F.replace(F.regexp_extract(bare, _QUOTED_PARTS, 1), F.lit('""'), F.lit('"'))
        after = F.replace(F.regexp_extract(bare, _QUOTED_PARTS, 2), F.lit("\r"), F.lit(""))
        return (
            F.when(~F.contains(raw, F.lit('"')), F.replace(raw, F.lit("\r"), F.lit("")))
            .when(bare.rlike(r'^\r*+"'), F.concat(inside, after))
            .otherwise(F.replace(raw, F.lit("\r"), F.lit("")))
        )

    simple = ~row.rlike('["\r]')
    return F.when(simple, F.split(row, ",", -1)).otherwise(
        F.transform(F.regexp_extract_all(F.concat(F.lit(","), row), F.lit(FIELD), F.lit(1)), cell)
    )


def _with_effects(lines: DataFrame) -> DataFrame:
    """``opens``: ends inside quotes if started outside; ``stays``: if started inside."""
    quoted = F.contains(F.col("text"), F.lit('"'))
    return lines.withColumns(
        {
            "opens": quoted & F.col("text").rlike(ENDS_INSIDE),
            "stays": ~quoted | F.concat(F.lit('"x'), F.col("text")).rlike(ENDS_INSIDE),
        }
    )


def _skeleton(lines: DataFrame) -> DataFrame:
    """One row per stretch: base line, state at its start, whether it is ``plain``,
    and the file's header line.

    A line either keeps the state, swaps it, or sets it. The state after a stretch
    is the last one set, swapped by the swaps after it, or else the state before the
    stretch, swapped by all its swaps. The list of swaps is bounded by the stretch.
    """
    opens, stays, at = F.col("opens"), F.col("stays"), F.col("at")
    visible = opens | ~F.col("text").rlike(BLANK_ROW)
    stats = stretch_stats(
        lines,
        F.max(F.when(opens == stays, at)).alias("set_at"),
        F.max(F.when((opens == stays) & opens, at)).alias("set_inside_at"),
        F.collect_list(F.when(opens & ~stays, at)).alias("swaps"),
        F.bool_or(opens).alias("any_opens"),
        F.sum(F.octet_length("text") + F.lit(LINE_BYTES).cast("bigint")).alias("bytes"),
        F.min(F.when(visible, at)).alias("head_at"),
        F.min_by(F.when(visible, F.col("text")), F.when(visible, at)).alias("head_text"),
        F.min_by(F.when(visible, opens), F.when(visible, at)).alias("head_opens"),
    )
    last_set = F.col("set_at")
    odd = F.size(F.filter("swaps", lambda s: last_set.isNull() | (s > last_set))) % 2 == 1
    # NULL-safe: a stretch that never sets the state only swaps what it is given.
    set_inside = F.when(
        last_set.isNotNull(), F.coalesce(F.col("set_inside_at") == last_set, F.lit(False))
    )
    stats = stats.withColumns(
        {"ends_fixed": F.when(set_inside.isNotNull(), set_inside != odd), "odd": odd}
    ).drop("swaps", "set_at", "set_inside_at")
    # Along the file: count swaps since the last stretch that fixed the state.
    along = Window.partitionBy("file").orderBy("block", "stretch")
    before, upto = stretch_order(before=True), stretch_order()
    free_swap = F.when(F.col("ends_fixed").isNull() & F.col("odd"), 1).otherwise(0)
    stats = stats.withColumn("swapped", F.sum(free_swap).over(upto))
    fixed_here = F.when(F.col("ends_fixed").isNotNull(), F.struct("ends_fixed", "swapped"))
    last_fixed = F.last(fixed_here, ignorenulls=True).over(before)
    swaps_before = F.coalesce(F.lag("swapped").over(along), F.lit(0))
    since = (swaps_before - F.coalesce(last_fixed["swapped"], F.lit(0))) % 2 == 1
    stats = stats.withColumn(
        "starts_inside", F.coalesce(last_fixed["ends_fixed"], F.lit(False)) != since
    )
    head = F.first(
        F.when(
            F.col("head_at").isNotNull(),
            F.struct(
                (F.col("base") + F.col("head_at") - F.col("first_at") + 1).alias("line"),
                F.col("head_text").alias("text"),
                F.col("head_opens").alias("opens"),
            ),
        ),
        ignorenulls=True,
    ).over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return with_base_line(stats).withColumn("head", head).select(
        *STRETCH_KEY,
        "first_at",
        "base",
        "starts_inside",
        (~F.col("any_opens") & ~F.col("starts_inside")).alias("plain"),
        "bytes",
        "head",
    )


def _assembled_rows(lines: DataFrame, skeleton: DataFrame, max_row_chars: int, tasks: int) -> DataFrame:
    """Rows of the stretches that are not plain, as (file, block, stretch, line, text).

    Lines are first put together inside their stretch, then over stretches, so
    no group is larger than a stretch or a single row. A line that is a whole row is in no
    group. A row too long for one value comes out in ``part`` pieces, all of its text kept.

    The stretches are dealt over ``tasks``, a number that grows with the lines: left to itself, the
    session would sort however many lines in a fixed number of tasks.
    """
    mixed = skeleton.where(~F.col("plain")).select(*STRETCH_KEY, "first_at", "base", "starts_inside")
    lines = (
        lines.join(mixed, list(STRETCH_KEY))
        .withColumn("line", F.col("base") + F.col("at") - F.col("first_at") + 1)
        .repartition(tasks, *STRETCH_KEY)
    )
    w = Window.partitionBy(*STRETCH_KEY).orderBy("at")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    sets = F.col("opens") == F.col("stays")
    lines = lines.withColumn(
        "n_swaps", F.sum(F.when(F.col("opens") & ~F.col("stays"), 1).otherwise(0)).over(upto)
    )
    last_set = F.last(
        F.when(sets, F.struct(F.col("opens").alias("to"), "n_swaps")), ignorenulls=True
    ).over(upto)
    state_after = F.coalesce(last_set["to"], F.col("starts_inside")) != (
        (F.col("n_swaps") - F.coalesce(last_set["n_swaps"], F.lit(0))) % 2 == 1
    )
    lines = lines.withColumn("ends_inside", state_after)
    lines = lines.withColumn(
        "begins", ~F.coalesce(F.lag("ends_inside").over(w), F.col("starts_inside"))
    )
    lines = lines.withColumn(
        "row_line",
        F.last(F.when(F.col("begins"), F.col("line")), ignorenulls=True).over(upto),
    )
    lines = written(lines.select(*STRETCH_KEY, "at", "line", "row_line", "text", "begins", "ends_inside"), "csv-placed")
    single = F.col("begins") & ~F.col("ends_inside")
    # Lines before the first row start of a stretch continue an earlier stretch's row.
    pieces = (
        lines.where(~single)
        .groupBy(*STRETCH_KEY, "row_line")
        .agg(
            F.expr("listagg(text, '\n') within group (order by at)").alias("text"),
            F.min("line").alias("first_line"),
        )
        .withColumn("chars", F.char_length("text").cast("bigint"))
    )
    last_starts = lines.groupBy(*STRETCH_KEY).agg(F.max("row_line").alias("last_start"))
    carried = last_starts.withColumn(
        "carry", F.last("last_start", ignorenulls=True).over(stretch_order(before=True))
    ).drop("last_start")
    pieces = pieces.join(carried, list(STRETCH_KEY)).withColumn(
        "row_line", F.coalesce("row_line", "carry")
    )
    pieces = written(pieces, "csv-pieces")
    row_key = ["file", "row_line"]
    sizes = pieces.groupBy(*row_key).agg(F.sum("chars").alias("chars"))
    oversize = sizes.where(F.col("chars") > max_row_chars).select(*row_key)
    start = F.min_by(F.struct("block", "stretch"), "first_line")
    whole = (
        pieces.join(oversize, row_key, "left_anti")
        .groupBy(*row_key)
        .agg(
            start.alias("start"),
            F.expr("listagg(text, '\n') within group (order by first_line)").alias("text"),
        )
        .select(
            "file", "start.block", "start.stretch", F.col("row_line").alias("line"), "text",
            F.lit(None).cast("bigint").alias("part"),
        )
    )
    parts = pieces.join(oversize, row_key, "left_semi").select(
        *STRETCH_KEY, F.col("row_line").alias("line"), "text", F.col("first_line").alias("part")
    )
    too_long = F.char_length("text") > max_row_chars
    alone = lines.where(single).select(
        *STRETCH_KEY, "line", "text", F.when(too_long, F.col("line")).cast("bigint").alias("part")
    )
    return alone.unionByName(whole).unionByName(parts)


def logical_rows(lines: DataFrame, max_row_chars: int = MAX_ROW_CHARS) -> DataFrame:
    """Data rows with their header: (file, block, stretch, line, text, part, header).

    The lines are written once with their places and effects. The skeleton, one row per
    stretch, decides whether a row-assembling branch is needed at all.
    """
    lines = written(_with_effects(lines), "csv-lines")
    skeleton = written(_skeleton(lines), "csv-skeleton")
    open_head = F.col("head.opens")
    mixed_bytes = skeleton.where(~F.col("plain")).agg(F.sum("bytes").alias("n")).head()["n"]
    some_mixed = mixed_bytes is not None
    if not some_mixed:
        known = skeleton.withColumn("header_text", F.col("head.text"))
    else:
        tasks = max(lines.sparkSession.sparkContext.defaultParallelism, -(-mixed_bytes // SORTED_BYTES))
        rows = _assembled_rows(lines, skeleton, max_row_chars, tasks)
        heads = skeleton.where(open_head).select("file", F.col("head.line").alias("line")).distinct()
        long_heads = rows.where(F.col("part").isNull()).join(heads, ["file", "line"]).select(
            "file", F.col("text").alias("long_head")
        )
        known = skeleton.join(long_heads, "file", "left").withColumn(
            "header_text", F.when(open_head, F.col("long_head")).otherwise(F.col("head.text"))
        )
        known = written(known.drop("long_head"), "csv-skeleton")
    known = known.select(
        *STRETCH_KEY, "first_at", "base", "plain", "head.line", "header_text"
    ).withColumnRenamed("line", "header_line")
    plain = (
        lines.join(known.where("plain"), list(STRETCH_KEY))
        .withColumn("line", F.col("base") + F.col("at") - F.col("first_at") + 1)
        .withColumn("part", F.lit(None).cast("bigint"))
    )
    columns = [*STRETCH_KEY, "line", "text", "part", "header_line", "header_text"]
    result = plain.select(*columns)
    if some_mixed:
        headers = known.select(*STRETCH_KEY, "header_line", "header_text")
        result = result.unionByName(rows.join(headers, list(STRETCH_KEY)).select(*columns))
    header = F.transform(cells_of(F.col("header_text")), trimmed)
    return (
        result.where(F.col("line") > F.col("header_line"))
        .withColumn("header", header)
        .drop("header_line", "header_text")
    )


def shaped(header: Column, cells: Column) -> Column:
    """JSON text of a flat row: other columns nested under ``telemetryData``.

    A column named twice keeps its last cell, unnamed columns are left out, and
    a ``telemetryData`` column wins over the nested ones even when empty.
    """
    members = F.map_from_arrays(header, cells)
    top = F.map_filter(members, lambda k, _: k.isin(*TOP_LEVEL_COLUMNS))
    nested = F.map_filter(members, lambda k, _: ~k.isin(*TOP_LEVEL_COLUMNS) & (k != ""))
    top_text, nested_text = F.to_json(top), F.to_json(nested)
    nest = (F.size(nested) > 0) & ~F.map_contains_key(top, "telemetryData")
    return F.when(
        nest,
        F.concat(
            F.left(top_text, F.char_length(top_text) - 1),
            F.when(F.size(top) > 0, ",").otherwise(""),
            F.lit('"telemetryData":'),
            nested_text,
            F.lit("}"),
        ),
    ).otherwise(top_text)


def csv_candidates(lines: DataFrame, max_row_chars: int = MAX_ROW_CHARS) -> DataFrame:
    """Candidates of CSV text: one per row that is not blank.

    A row over ``max_row_chars`` is one record, rejected, whose text comes in parts: the first stands for it and
    the others say that they continue it.
    """
    rows = (
        logical_rows(lines, max_row_chars)
        .where(F.col("part").isNotNull() | ~F.col("text").rlike(BLANK_ROW))
        .withColumn("cells", F.when(F.col("part").isNull(), cells_of(F.col("text"))))
    )
    ragged = F.size("cells") != F.size("header")
    error = F.when(
        F.col("part").isNotNull(),
        F.concat(
            F.when(F.col("part") > F.col("line"), CONTINUED).otherwise(""),
            F.format_string(
                f"malformed CSV row: longer than {max_row_chars} characters, text from line %d",
                F.col("part"),
            ),
        ),
    ).when(
        ragged,
        F.format_string(
            "malformed CSV row: expected %d columns, found %d", F.size("header"), F.size("cells")
        ),
    )
    rows = rows.withColumn("parse_error", error).withColumn(
        "raw_json",
        F.when(F.col("parse_error").isNull(), shaped(F.col("header"), F.col("cells"))),
    )
    return rows.select(
        *STRETCH_KEY,
        F.col("line").alias("pos"),
        F.concat(source_name(F.col("file")), F.lit("#L"), F.col("line")).alias("source"),
        F.col("text").alias("raw_text"),
        "raw_json",
        F.try_parse_json("raw_json").alias("value"),
        F.when(F.col("parse_error").isNull(), "object").alias("root_kind"),
        "parse_error",
    )


def read_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return csv_candidates(text_lines(spark, paths))
