"""Cross-tokenizer alignment: where the tokens of two vocabularies end together, and how often each pair of ids does so.

Exact-text deduplication. Rows are shuffled by their full text (each task first counts its own copies), so each distinct
text comes once, with its number of copies. Each is tokenised by both vocabularies and aligned once:

- A is a byte-level BPE in a tokenizers file, given a space and the text; B is a sentencepiece BPE, given the text, to
  which it adds the space. Special tokens are plain text to both. If the bytes of all A tokens or of all B tokens are not
  exactly the space and the text, the text has no tokens.
- Byte offsets where a token of A and one of B both end cut the tokens into groups. No token is empty, so each such
  offset is one link: the A and the B token that end there.

Distinct texts are written with their links, summed up by pair of ids. A pair's count is the sum over the texts of its
links times the copies: an aggregate in which each task first sums up its own pairs. A pair is best if no other pair of its
B id has a higher count. Texts then join their pairs to these counts, and rows to their texts by SHA-256.

The pairs of a text meet the counts in a broadcast table only while it is counted to be at most ``BROADCAST_PAIRS`` rows;
a larger one is joined by a shuffle on the pair, whose hot pairs adaptive execution splits (a pair comes at most once a
text).

A is encoded by tiktoken from the vocabulary of the tokenizers file, several times as fast as the tokenizers library and with
the same ids; it cannot take very long runs of white space, so texts with one go through the encoder of ``bpe.py``.

Null and empty texts, and texts that cannot be put together again, have no tokens: zeros, and an empty digest. Repeated
rows and rows of one id are rows of their own and count as copies. A text is aligned whole, in about 200 bytes of
memory for each of its bytes. Other columns are not read and may have any names; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.bpe import SPLIT, Bpe
from skyledger.llm.common import map_texts, small_batches, table
from skyledger.session import written

#: White space that tiktoken is not given in one run.
LONG_BLANK = re.compile(r"\s{1000}")
#: Pairs of ids (about 40 bytes each) that are broadcast at most.
BROADCAST_PAIRS = 1 << 20
#: The sentencepiece letter for a space.
SPACE = "▁"

MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


class Aligner:
    """Both vocabularies with what the alignment looks up by id."""

    def __init__(self, a: str, b: str) -> None:
        import sentencepiece
        import tiktoken

        self.bpe = Bpe(a)
        special = set(self.bpe.special.values())
        ranks = {spelt: i for i, spelt in self.bpe.spelt.items() if i not in special}
        self.fast = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.spelt_a = [self.bpe.spelt.get(i, b"") for i in range(max(self.bpe.spelt) + 1)]
        self.model = model = sentencepiece.SentencePieceProcessor(model_file=b)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.spelt_b = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.length_a = np.array(list(map(len, self.spelt_a)), dtype=np.int64)
        self.length_b = np.array(list(map(len, self.spelt_b)), dtype=np.int64)
        # What follows an id: a comma, or after the last one of a group the sign that ends its side.
        self.digits_a = [np.array([f"{i}{sign}" for i in range(len(self.spelt_a))], dtype=object) for sign in ",|"]
        self.digits_b = [np.array([f"{i}{sign}" for i in range(len(self.spelt_b))], dtype=object) for sign in ",;"]

    def ids_a(self, text: str) -> list[int]:
        if LONG_BLANK.search(text):
            bpe = self.bpe
            return list(chain.from_iterable(map(bpe.memo.__getitem__, bpe.split(f" {text}"))))
        return self.fast.encode_ordinary(f" {text}")

    def align(self, texts: list[str]) -> dict[str, list]:
        """Of each text: its numbers of tokens and groups, the groups' SHA-256, and the pairs linked with their links."""
        ids_a, ids_b = [], []
        for text, b in zip(texts, self.model.encode(texts, num_threads=1), strict=True):
            a, whole = self.ids_a(text), f" {text}".encode()
            same = text and b"".join(map(self.spelt_a.__getitem__, a)) == whole == b"".join(map(self.spelt_b.__getitem__, b))
            ids_a.append(a if same else [])
            ids_b.append(b if same else [])
        n_a, n_b = (np.array(list(map(len, ids)), dtype=np.int64) for ids in (ids_a, ids_b))
        a, b = (np.fromiter(chain.from_iterable(ids), dtype=np.int64, count=n.sum()) for ids, n in ((ids_a, n_a), (ids_b, n_b)))
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        # Texts stand one after another in both, so each also ends at a common offset.
        last_a = np.isin(ends_a, ends_b, assume_unique=True)
        last_b = np.isin(ends_b, ends_a, assume_unique=True)
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        links_a, links_b = a[last_a], b[last_b]
        of_text = np.repeat(np.arange(len(texts)), n_a)[last_a]
        n_groups = np.bincount(of_text, minlength=len(texts))
        parts = np.empty(len(a) + len(b), dtype=object)
        before_b = np.concatenate([[0], np.flatnonzero(last_b) + 1])  # B tokens in the groups before each
        before_a = np.concatenate([[0], np.flatnonzero(last_a) + 1])
        parts[np.arange(len(a)) + before_b[group_a]] = np.where(last_a, self.digits_a[1][a], self.digits_a[0][a])
        parts[np.arange(len(b)) + before_a[group_b + 1]] = np.where(last_b, self.digits_b[1][b], self.digits_b[0][b])
        digests, at = [], 0
        for n in n_a + n_b:
            digests.append(hashlib.sha256("".join(parts[at : at + n].tolist())[:-1].encode()).hexdigest() if n else "")
            at += n
        order = np.lexsort((links_b, links_a, of_text))
        keys = np.stack([of_text[order], links_a[order], links_b[order]])
        first = np.ones(len(order), dtype=bool)
        first[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
        starts = np.flatnonzero(first)
        times = np.diff(np.append(starts, len(order)))
        offsets = np.searchsorted(keys[0][starts], np.arange(len(texts) + 1)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v.astype(np.int32))) for v in (keys[1][starts], keys[2][starts], times)]
        return {
            "n_a": pa.array(n_a),
            "n_b": pa.array(n_b),
            "n_groups": pa.array(n_groups.astype(np.int64)),
            "groups_sha256": pa.array(digests, pa.string()),
            "pair_a": lists[0],
            "pair_b": lists[1],
            "times": lists[2],
        }


@lru_cache(1)
def load(a: str, b: str) -> Aligner:
    """Both vocabularies, read once by each Python worker."""
    return Aligner(a, b)


def distinct_texts(docs: DataFrame, text: str) -> DataFrame:
    """Each distinct text that is not empty, with its number of rows."""
    return docs.select(F.col(text).alias("text")).where(F.length("text") > 0).groupBy("text").agg(F.count("*").alias("copies"))


def aligned_texts(texts: DataFrame, a: str, b: str) -> DataFrame:
    """Of each distinct text: SHA-256, copies, counts, groups' digest and its pairs."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = load(a, b).align(batch.column(2).to_pylist())
        return pa.RecordBatch.from_arrays([*batch.columns[:2], *found.values()], ["digest", "copies", *found])

    schema = "digest binary, copies long, n_a long, n_b long, n_groups long, groups_sha256 string, pair_a array<int>, pair_b array<int>, times array<int>"
    rows = texts.select(_digest("text").alias("digest"), "copies", "text")
    return map_texts(rows, 2, work, schema).withColumn("tid", F.monotonically_increasing_id())


def _digest(text: str):
    return F.unhex(F.sha2(F.col(text).cast("binary"), 256))


def _pairs(aligned: DataFrame, *keep: str) -> DataFrame:
    zipped = F.inline(F.arrays_zip("pair_a", "pair_b", "times"))
    # One number for both ids: joins and aggregates on a single long are the fastest.
    pair = F.shiftleft(F.col("pair_a").cast("long"), 32).bitwiseOR(F.col("pair_b").cast("long"))
    return aligned.select(*keep, zipped).select(*keep, pair.alias("pair"), "times")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """Of each pair of ids: A id, B id, its count in all rows, and whether it is its B id's highest."""
    counts = _pairs(aligned, "copies").groupBy("pair").agg(F.sum(F.col("times") * F.col("copies")).alias("n"))
    counts = written(counts.withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))), "alignment-counts")
    top = counts.groupBy("b").agg(F.max("n").alias("top"))
    rows = counts.join(top, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    return written(rows, "alignment-pairs")


def text_measures(aligned: DataFrame, pairs: DataFrame) -> DataFrame:
    """Of each distinct text: links whose pair is best, and the sum of the counts over its links."""
    if pairs.count() <= BROADCAST_PAIRS:
        pairs = F.broadcast(pairs)
    found = _pairs(aligned, "tid").join(pairs, "pair")
    return found.groupBy("tid").agg(
        F.sum(F.when(F.col("best"), F.col("times").cast("long")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"),
    )


def align(docs: DataFrame, a: str, b: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The ``keep`` columns and measures of every row; and all pairs (A id, B id, count, best)."""
    small_batches(docs.sparkSession)
    aligned = written(aligned_texts(distinct_texts(docs, text), a, b), "alignment-texts")
    pairs = pair_counts(aligned)
    narrow = aligned.select("tid", "digest", "n_a", "n_b", "n_groups", "groups_sha256")
    measured = narrow.join(text_measures(aligned, pairs), "tid", "left").drop("tid")
    # Columns are renamed while they travel, so that they cannot clash with the operator's own.
    kept = [f"_{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(k) for c, k in zip(keep, kept, strict=True)], _digest(text).alias("digest"))
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_a", "n_b", "n_groups", "n_best", "count_sum")]
    numbers.insert(3, F.coalesce("n_groups", F.lit(0)).cast("long").alias("n_links"))
    found = rows.join(written(measured, "alignment-measures"), "digest", "left").select(
        *[F.col(k).alias(c) for k, c in zip(kept, keep, strict=True)], *numbers, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")
    )
    named = pairs.select(
        F.shiftright("pair", 32).cast("int").alias("a_id"),
        F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("b_id"),
        F.col("n").alias("links"),
        "best",
    )
    return found, named


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"), *default_paths())[0]
