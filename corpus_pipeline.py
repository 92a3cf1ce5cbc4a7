"""The corpus pipeline: each stage takes (spark, docs, sf_dir) and returns the next one's documents.

Documents are judged by the quality classifier, one of each group of near copies stays, secrets are masked, sources
are mixed to their target weights (a document may then appear up to three times, or not at all), and what is left
becomes token ids. Stages but the last return the columns of ``documents``; null and empty texts pass all of them
(an empty text has no near copies), rows repeated in full are copies of each other, and an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.bpe import default_path, encode
from skyledger.llm.common import table
from skyledger.llm.jaccard import one_of_each
from skyledger.llm.mixing import mix
from skyledger.llm.quality import score, trained
from skyledger.llm.secrets import mask_secrets
from skyledger.session import written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return score(docs, trained(spark, docs, sf_dir)).where("keep").select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by sets of five-word shingles of similarity 0.8 or more, the one with the smallest id stays."""
    return one_of_each(docs.select(*COLUMNS), n=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    clean = mask_secrets(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    mixed = mix(docs.select(*COLUMNS))
    # A text without words weighs nothing in the mix and is passed on once.
    times = F.when(F.col("size") == 0, 1).otherwise(F.col("copies"))
    return mixed.withColumn("copy", F.explode(F.array_repeat(F.lit(0), times))).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to exactly this text."""
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    rows = docs.select("doc_id", "lang", "source", digest.alias("text_sha256"), "text")
    ids = encode(rows, default_path(), ("doc_id", "lang", "source", "text_sha256"))
    exact = F.sha2("decoded", 256) == F.col("text_sha256")
    return ids.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", exact.alias("exact"))


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_copies),
    ("secret scans", secrets),
    ("mixing sources to target weights", mixing),
    ("BPE encoding and decoding", tokens),
]
#: Neither a fitted classifier nor the rounding of copies nor BPE can be put in SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
