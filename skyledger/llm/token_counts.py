"""Token counts with a digest cache: texts whose counts are stored are joined to them, only distinct misses are encoded.

A text becomes its *content*, which the tokenizer cannot tell from the text, and the SHA-256 of the content. A tokenizer
becomes its *version*: the SHA-256 of its file, of the library's name and version, and of the settings used. The cache
is a Parquet folder with one row per content and version. A run
1. writes the digests of all rows (a few bytes a row),
2. joins the distinct digests to the counts stored for this version; those without one are the misses,
3. fetches one content for each miss, encodes it, and appends the counts to the cache,
4. joins all rows to stored and new counts by digest (one row a digest, so that hot digests of rows can be split).
Few misses (by their counted size) are broadcast, so no text is shuffled. Otherwise contents are grouped by digest: each
task first reduces its copies to one, and one content per digest and task is shuffled.

A run that breaks off leaves whole appended files or none, and what was appended is used by the next one. Two runs at
once may append a content twice; reading takes one row of a digest. Workers check that their tokenizer file is the one
whose version is being counted.

Content: null counts as empty. A tokenizer that lower-cases and joins white space itself (read from its file) gets
texts of ASCII letters in lower case, with white space joined and none at the ends, unless they hold a ``<|`` (special
tokens are matched in the text as it is). Other texts are their own content.

Counting: where a tokenizer drops white space, no token crosses a blank, so a text's count is the sum over the
stretches between blanks. Workers ask the library once for each stretch and remember up to ``MEMO`` of them; they never
hold the tokens of a long text. Other tokenizers are given whole texts.

Repeated rows and rows of one id are rows of their own; an empty table gives an empty one; other columns are not read
and may have any names.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import map_texts, small_batches, table
from skyledger.session import scratch_path, written

#: Stretches whose counts a worker remembers, in two generations.
MEMO = 1 << 18
#: Longer stretches are not remembered.
MEMO_LENGTH = 64
#: So many misses at most (32 bytes each) are broadcast.
FEW_MISSES = 1 << 16
TOKEN_LIMIT = 2048
#: A conf setting that names the cache of registered queries; where unset, each run begins with an empty one.
CACHE_SETTING = "skyledger.tokenCounts.dir"
CACHE_SCHEMA = "digest binary, n_tokens long, version string"

_BLANKS = re.compile("[ \t\n\r]+")


def _file(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _folds(stated: dict) -> bool:
    """Whether a tokenizers file lower-cases, joins white space and drops it between pieces."""
    steps = (stated.get("normalizer") or {}).get("normalizers", [])
    joins = any(s["type"] == "Replace" and s["pattern"] == {"Regex": r"\s+"} and s["content"] == " " for s in steps)
    lowers = any(s["type"] == "Lowercase" for s in steps)
    cut = [p for p in (stated.get("pre_tokenizer") or {}).get("pretokenizers", []) if p["type"] == "Split"]
    drops = bool(cut) and cut[0]["behavior"] == "Removed" and cut[0]["invert"] and r"|[^\s\p{L}\p{N}]+" in cut[0]["pattern"]["Regex"]
    return joins and lowers and drops


class TokenCounter:
    """Counts of one tokenizer: a ``.json`` file of tokenizers or a ``.model`` file of sentencepiece."""

    def __init__(self, path: str) -> None:
        data = _file(path)
        self.folds = False
        if path.endswith(".model"):
            import sentencepiece as library

            model = library.SentencePieceProcessor(model_proto=data)
            self.lengths = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
        elif path.endswith(".json"):
            import tokenizers as library

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            model = library.Tokenizer.from_buffer(data)
            model.no_truncation()
            model.no_padding()
            self.folds = _folds(json.loads(data))
            self.lengths = lambda texts: [len(e) for e in model.encode_batch_fast(texts, add_special_tokens=False)]
        else:
            raise ValueError(f"a tokenizer file ends in .json or .model: {path}")
        settings = f"{library.__name__} {library.__version__} folds={self.folds} no-specials-added"
        self.version = hashlib.sha256(hashlib.sha256(data).digest() + settings.encode()).hexdigest()
        self.memo: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def counts(self, texts: list[str]) -> list[int]:
        if not self.folds:
            return [n for text in texts for n in self.lengths([text])] if texts else []
        return [self._sum(Counter(_BLANKS.split(text))) for text in texts]

    def _sum(self, stretches: Counter[str]) -> int:
        memo, older = self.memo, self.older
        new = [s for s in stretches if s not in memo]
        asked = [s for s in new if s not in older]
        found = {s: older[s] for s in new if s in older} | dict(zip(asked, self.lengths(asked), strict=True))
        total = sum(n * (found[s] if s in found else memo[s]) for s, n in stretches.items())
        memo.update((s, n) for s, n in found.items() if len(s) <= MEMO_LENGTH)
        if len(memo) > MEMO // 2:
            self.memo, self.older = {}, memo
        return total


@lru_cache(2)
def load(path: str) -> TokenCounter:
    """The tokenizer, read once by each Python worker."""
    return TokenCounter(path)


def content(text: Column, folds: bool) -> Column:
    """What the tokenizer sees of a text."""
    whole = F.coalesce(text, F.lit(""))
    if not folds:
        return whole
    plain = ~whole.contains("<|") & ~F.regexp_like(whole, F.lit(r"[^\x00-\x7F]"))
    return F.when(plain, F.trim(F.regexp_replace(F.lower(whole), "[ \t\n\r]+", " "))).otherwise(whole)


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def stored(spark: SparkSession, cache: str, version: str) -> DataFrame | None:
    """One row per digest of this version; None while nothing is stored."""
    try:
        rows = spark.read.schema(CACHE_SCHEMA).parquet(f"{cache}/version={version}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def _encoded(contents: DataFrame, path: str, version: str) -> DataFrame:
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counter = load(path)
        if counter.version != version:
            raise RuntimeError(f"{path} is another tokenizer here than on the driver")
        n = counter.counts(batch.column(1).to_pylist())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], ["digest", "n_tokens"])

    return map_texts(contents.select("digest", "content"), 1, work, "digest binary, n_tokens long")


def counts_of(rows: DataFrame, digests: DataFrame, text: str, tokenizer: str, cache: str) -> DataFrame:
    """One row with its count for each distinct digest of ``rows``; those not stored are encoded and appended."""
    counter = load(tokenizer)
    known = stored(rows.sparkSession, cache, counter.version)
    asked = digests.distinct()
    asked = written(asked.withColumn("n_tokens", F.lit(None).cast("long")) if known is None else asked.join(known, "digest", "left"), "token-known")
    misses = asked.where(F.col("n_tokens").isNull()).select("digest")
    wanted = misses.count()
    if not wanted:
        return asked
    contents = rows.select(content(F.col(text), counter.folds).alias("content")).select(digest(F.col("content")).alias("digest"), "content")
    if wanted <= FEW_MISSES:
        contents = contents.join(F.broadcast(misses), "digest", "left_semi")
    contents = contents.groupBy("digest").agg(F.first("content").alias("content"))
    if wanted > FEW_MISSES and known is not None:
        contents = contents.join(misses, "digest", "left_semi")
    encoded = written(_encoded(contents, tokenizer, counter.version), "token-encoded")
    encoded.hint("rebalance").write.mode("append").parquet(f"{cache}/version={counter.version}")
    return asked.where(F.col("n_tokens").isNotNull()).union(encoded)


def token_counts(docs: DataFrame, tokenizer: str, cache: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The ``keep`` columns, ``n_bytes`` (UTF-8) and ``n_tokens`` of every row; ``cache`` gains what it lacked."""
    small_batches(docs.sparkSession)
    # Columns are renamed while they travel, so that they cannot clash with the operator's own.
    kept = [f"_{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(k) for c, k in zip(keep, kept, strict=True)], F.col(text).alias("text"))
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes")
    keys = written(rows.select(*kept, size, digest(content(F.col("text"), load(tokenizer).folds)).alias("digest")), "token-keys")
    found = keys.join(counts_of(rows, keys.select("digest"), "text", tokenizer, cache), "digest")
    return found.select(*[F.col(k).alias(c) for k, c in zip(kept, keep, strict=True)], "n_bytes", "n_tokens")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    cache = spark.conf.get(CACHE_SETTING, None) or scratch_path(spark, "token-cache")
    counted = token_counts(docs, default_path(), cache)
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)
