"""Quartile bucket digests: short fingerprints whose difference tells how alike two texts are.

Each place of a text adds three byte triplets, taken from the four bytes there, to 128 hashed buckets. The
digest holds, in hex: a code of the length on a log scale (2 digits), the first and second quartile of the
bucket counts as shares of the third (1 digit each), and for each bucket the quartile that its count falls
into (2 bits, so 64 digits). The difference of two digests adds up the distances of these parts and is cut at
``FARTHEST``; likeness is 1 - difference / ``FARTHEST``.

``neighbour_digests`` needs each document's successor by id. Rows are range-partitioned and sorted by id, so
that neighbours meet in one task; the last row of each task meets the first row of the next one that has rows
in a join of two rows a task.

A null text counts as empty; texts under four bytes fill no bucket. Rows of equal id follow each other by text
(null ids first), so repeated rows are each other's successors; an only row succeeds itself. An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import pieces, small_batches, table
from skyledger.session import written

BUCKETS = 128
FARTHEST = 200
_TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 3))
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


def _codes(data: bytes, lengths: list[int]) -> np.ndarray:
    """One digest a row: length code, two quartile shares, then 128 quartile numbers."""
    out = np.zeros((len(lengths), 3 + BUCKETS), dtype=np.uint8)
    raw = np.frombuffer(data, dtype=np.uint8).astype(np.uint32)
    places = max(0, len(raw) - 3)
    kinds = []
    for salt, triplet in enumerate(_TRIPLETS):
        value = np.full(places, 0x27D4EB2F * (salt + 1) & 0xFFFFFFFF, dtype=np.uint32)
        for shift, factor in zip(triplet, _FACTORS, strict=True):
            value = (value ^ raw[shift : shift + places]) * factor
            value ^= value >> np.uint32(15)
        kinds.append((value >> np.uint32(8)).astype(np.uint8) & np.uint8(BUCKETS - 1))
    at = 0
    for row, length in enumerate(lengths):
        out[row, 0] = min(255, round(math.log1p(length) / math.log(1.1)))
        if length > 3:
            count = sum(np.bincount(kind[at : at + length - 3], minlength=BUCKETS) for kind in kinds)
            low, mid, high = np.partition(count, (31, 63, 95))[[31, 63, 95]]
            out[row, 1] = 15 * low // max(high, 1)
            out[row, 2] = 15 * mid // max(high, 1)
            out[row, 3:] = (count > low).astype(np.uint8) + (count > mid) + (count > high)
        at += length
    return out


def _spelt(codes: np.ndarray) -> list[str]:
    quads = codes[:, 3:].reshape(len(codes), BUCKETS // 4, 4)
    packed = quads[:, :, 0] << 6 | quads[:, :, 1] << 4 | quads[:, :, 2] << 2 | quads[:, :, 3]
    heads = np.stack([codes[:, 0], codes[:, 1] << 4 | codes[:, 2]], axis=1)
    return [row.tobytes().hex() for row in np.concatenate([heads, packed], axis=1)]


def _likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    apart = np.abs(a.astype(np.int32) - b.astype(np.int32))
    apart[:, 3:] += 3 * (apart[:, 3:] == 3)
    return 1.0 - np.minimum(apart.sum(axis=1), FARTHEST) / FARTHEST


def digests(texts: list[str]) -> tuple[np.ndarray, list[str]]:
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    codes = _codes(b"".join(raw), [len(r) for r in raw])
    return codes, _spelt(codes)


def digest(text: str) -> str:
    return digests([text])[1][0]


def likeness(one: str, other: str) -> float:
    """How alike two digests are, from 0 to 1."""

    def read(spelt: str) -> np.ndarray:
        raw = np.frombuffer(bytes.fromhex(spelt), dtype=np.uint8)
        quads = np.stack([raw[2:] >> s & 3 for s in (6, 4, 2, 0)], axis=1).ravel()
        return np.concatenate([[raw[0], raw[1] >> 4, raw[1] & 15], quads])[None, :]

    return float(_likeness(read(one), read(other))[0])


def edited(text: str, following: str) -> str:
    """The last quarter replaced by as many characters from the start of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


_MADE = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_MADE_NAMES = [c.split()[0] for c in _MADE.split(", ")]
_MADE_TYPES = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _made_columns(texts: list[str], after: list[str], codes: np.ndarray, spelt: list[str], after_codes: np.ndarray) -> list[pa.Array]:
    """The made columns of texts with their digests, and the texts that follow them with theirs."""
    changed = [edited(t, u) for t, u in zip(texts, after, strict=True)]
    other, other_spelt = digests(changed)
    values = (
        [len(t) for t in texts],
        [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
        spelt,
        other_spelt,
        _likeness(codes, other),
        _likeness(codes, after_codes),
    )
    return [pa.array(v, t) for v, t in zip(values, _MADE_TYPES, strict=True)]


def _pairs(texts: list[str], after: list[str]) -> list[pa.Array]:
    codes, spelt = digests([*texts, *after])
    n = len(texts)
    return _made_columns(texts, after, codes[:n], spelt[:n], codes[n:])


def _sequence(texts: list[str]) -> list[pa.Array]:
    """The made columns of all texts but the last, each followed by the next."""
    codes, spelt = digests(texts)
    return _made_columns(texts[:-1], texts[1:], codes[:-1], spelt[:-1], codes[1:])


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Complete rows, and open ones: the first text of the task, and the last row with its text."""
    task = TaskContext.get().partitionId()
    names = ["task", "open", "doc_id", *_MADE_NAMES, "text"]

    def rows(opened: str | None, ids: pa.Array, made: list[pa.Array], texts: pa.Array) -> pa.RecordBatch:
        n = len(ids)
        return pa.RecordBatch.from_arrays([pa.array([task] * n, pa.int32()), pa.array([opened] * n, pa.string()), ids, *made, texts], names)

    nothing = [pa.nulls(1, t) for t in _MADE_TYPES]
    last_id = last_text = None
    for batch in batches:
        for piece in pieces(batch, 1):
            texts = [t or "" for t in piece.column(1).to_pylist()]
            ids = piece.column(0)
            if last_id is None:
                yield rows("first", pa.nulls(1, pa.int64()), nothing, pa.array(texts[:1], pa.string()))
            else:
                ids, texts = pa.concat_arrays([last_id, ids]), [last_text, *texts]
            if len(texts) > 1:
                n = len(texts) - 1
                yield rows(None, ids[:n], _sequence(texts), pa.nulls(n, pa.string()))
            last_id, last_text = ids[len(ids) - 1 :], texts[-1]
    if last_id is not None:
        yield rows("last", last_id, nothing, pa.array([last_text], pa.string()))


def neighbour_digests(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Digests of every document and of its edited text, and their likeness to each other and to the successor."""
    spark = docs.sparkSession
    small_batches(spark)
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text").asc_nulls_first()]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    made = written(rows.mapInArrow(_in_order, f"task int, open string, doc_id long, {_MADE}, text string"), "digests")
    names = ["doc_id", *_MADE_NAMES]
    # One number a task; its size does not follow the rows.
    tasks = sorted(r.task for r in made.where("open = 'first'").select("task").collect())
    follows = spark.createDataFrame(list(zip(tasks, [*tasks[1:], *tasks[:1]], strict=True)), "task int, next_task int")
    last = made.where("open = 'last'").select("task", "doc_id", "text")
    first = made.where("open = 'first'").select(F.col("task").alias("next_task"), F.col("text").alias("next_text"))
    open_rows = last.join(follows, "task").join(first, "next_task").select("doc_id", "text", "next_text")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *_pairs(batch.column(1).to_pylist(), batch.column(2).to_pylist())], names)

    return made.where("open is null").select(*names).unionByName(open_rows.mapInArrow(close, f"doc_id long, {_MADE}"))


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_digests(table(spark, sf_dir, "documents"))
