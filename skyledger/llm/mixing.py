"""Mixing sources to target weights by entropy balancing.

Each source gets a share of all words by its weight; no target exceeds ``MOST_COPIES`` times the source's own
words, and what is cut off is shared out by weight among the rest. Of all ways to take words from documents that
meet the targets, the one closest to the corpus (in relative entropy) takes from document d the rate
exp(lambda of its source). The multipliers minimise a convex dual, sum of words * exp(lambda) - target * lambda,
by Newton steps. The dual needs the corpus only through its words by source, so it is summed up once, and every
source then takes its steps where its row lies.

Rates become whole copies: everybody gets the whole part, and the rest is dealt from the largest documents of a
source to the smallest, each size carrying on the words by which the sizes before missed their share. That runs
over (source, size, documents of this size), so a task holds at most one row for each distinct size of a source,
however many documents it has. Among documents of one size, those whose ids hash lowest get the extra copy; they are
ranked in sub-buckets of about ``BUCKET_ROWS`` rows, so a hot size is not sorted in one task.

A null text has size 0, a null source is a source of its own (the last). Documents of size 0 take no words. Rows
repeated in full count each; which of them gets a copy does not change the result. No rows in, no rows out.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.common import table
from skyledger.session import written

MOST_COPIES = 3
NEWTON_STEPS = 60
BUCKET_ROWS = 1000
#: Fixed value: a word.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(place: Column) -> Column:
    """1, 2, 3, 1, 2, 3, ... by place among the sources (from 0)."""
    return place % 3 + 1


def source_targets(sources: DataFrame, weigh: Callable[[Column], Column] = cyclic_weights, most: int = MOST_COPIES) -> DataFrame:
    """Add ``target`` to (source, source_size): shares by weight, none above ``most`` times its size.

    The windows run over one row a source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rows = sources.withColumn("weight", weigh(F.row_number().over(by_name) - 1).cast("double"))
    rows = rows.withColumn("limit", (most * F.col("source_size")).cast("double"))
    # Sources reach their limits in the order of limit / weight; before each, what is left is shared by weight.
    whole = Window.partitionBy()
    filling = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = lambda c: F.coalesce(F.sum(c).over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rows = rows.withColumn("turn", F.row_number().over(filling))
    rows = rows.withColumn("level", (F.sum("source_size").over(whole) - before("limit")) / (F.sum("weight").over(whole) - before("weight")))
    full = F.col("limit") / F.col("weight") < F.col("level")
    rows = rows.withColumn("level", F.min_by("level", F.when(~full, F.col("turn"))).over(whole))
    return rows.select("source", "source_size", F.least("limit", F.col("weight") * F.coalesce("level", F.lit(0.0))).alias("target"))


def dual_rate(words: Column, target: Column, most: int = MOST_COPIES) -> Column:
    """exp(lambda) at the minimum of words * exp(lambda) - target * lambda."""
    step = lambda m, _: m + F.least(F.greatest(target / (words * F.exp(m)) - 1, F.lit(-1.0)), F.lit(1.0))
    multiplier = F.aggregate(F.sequence(F.lit(1), F.lit(NEWTON_STEPS)), F.lit(0.0), step)
    return F.when((words > 0) & (target > 0), F.least(F.exp(multiplier), F.lit(float(most)))).otherwise(0.0)


def _deal(rows: pa.Table) -> pa.Table:
    """Extra copies for each size of one source, from the largest size on."""
    rows = rows.sort_by([("size", "descending")])
    extra, missed = [], 0.0
    for size, n, rate in zip(*(rows.column(c).to_pylist() for c in ("size", "n", "rate")), strict=True):
        wanted = (rate - int(rate)) * n * size + missed
        k = min(n, max(0, round(wanted / size))) if size else 0
        missed = wanted - k * size
        extra.append(k)
    return rows.append_column("extra", pa.array(extra, pa.int64()))


def mix(docs: DataFrame, weigh: Callable[[Column], Column] = cyclic_weights, most: int = MOST_COPIES) -> DataFrame:
    """All columns of ``docs`` but those of the same names, with size, source_size, target, rate and copies."""
    made = ["size", "source_size", "target", "rate", "copies"]
    return _mixed(docs.select(*[c for c in docs.columns if c not in made]).withColumn("size", word_count()), weigh, most)


def _mixed(rows: DataFrame, weigh: Callable[[Column], Column], most: int) -> DataFrame:
    """``rows`` has doc_id, source and size, and is read twice."""
    sizes = written(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-sizes")
    sources = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    rated = source_targets(sources, weigh, most).withColumn("rate", dual_rate(F.col("source_size"), F.col("target"), most))
    cells = sizes.join(rated.withColumnRenamed("source", "of_source"), F.col("source").eqNullSafe(F.col("of_source")))
    cells = cells.select("source", "size", "n", "rate", "source_size", "target")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cells.schema.fields)
    cells = cells.groupBy("source").applyInArrow(_deal, f"{kinds}, extra long")
    cells = written(cells.select(F.col("source").alias("of_source"), F.col("size").alias("of_size"), "n", "rate", "source_size", "target", "extra"), "mix-cells")

    joined = rows.join(cells, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("size") == F.col("of_size"))).drop("of_source", "of_size")
    # Only where some documents of a size get an extra copy and others do not, they are ranked.
    clear = joined.where("extra = 0 or extra = n").withColumn("taken_extra", F.when(F.col("extra") > 0, 1).otherwise(0))
    split = joined.where("extra > 0 and extra < n").withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("n") / BUCKET_ROWS)))
    key = ["source", "size", "bucket"]
    counts = split.groupBy(*key).agg(F.count(F.lit(1)).alias("in_bucket"))
    earlier = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*[F.col(c).alias(f"of_{c}") for c in key], F.coalesce(F.sum("in_bucket").over(earlier), F.lit(0)).alias("before"))
    split = split.join(counts, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("size") == F.col("of_size")) & (F.col("bucket") == F.col("of_bucket")))
    rank = F.col("before") + F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64("doc_id"), "doc_id"))
    split = split.withColumn("taken_extra", F.when(rank <= F.col("extra"), 1).otherwise(0)).drop("bucket", "before", *[f"of_{c}" for c in key])
    both = clear.unionByName(split).withColumn("copies", (F.floor("rate") + F.col("taken_extra")).cast("int"))
    return both.drop("n", "extra", "taken_extra")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = written(docs.select("doc_id", "source", word_count().alias("size")), "mix-documents")
    mixed = _mixed(sized, cyclic_weights, MOST_COPIES)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "rate", "copies")
