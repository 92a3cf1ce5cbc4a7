"""What the operators share: table reading, Arrow batches of texts, hashes of byte ranges."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from skyledger.session import configure

#: Rows of an Arrow batch sent to Python, so that a batch of long texts stays small.
BATCH_ROWS = 1000
#: A batch handed to an operator holds about so many bytes of text (one longer text alone may exceed it).
BATCH_BYTES = 1 << 20

MULTIPLIER = 0x9E3779B97F4A7C15 | 1
#: White space of the word pattern ``[^\x20\x09-\x0D]+``.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Where Python workers find this package, if it is not installed for them.
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def small_batches(spark: SparkSession) -> None:
    """Settings for the Python side: bounded batches, and the package's place for the workers."""
    environment = spark.sparkContext.environment
    if _ROOT not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [_ROOT, environment.get("PYTHONPATH")]))
    for key, value in (("maxRecordsPerBatch", str(BATCH_ROWS)), ("maxBytesPerBatch", "8m")):
        if spark.conf.get(f"spark.sql.execution.arrow.{key}") != value:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", value)


def pieces(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a piece holds about ``BATCH_BYTES`` of the text in column ``text``."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0))
    part = np.cumsum(sizes, dtype=np.int64) // BATCH_BYTES
    cuts = np.flatnonzero(np.diff(part)) + 1
    for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def map_texts(df: DataFrame, text: int, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``work`` on pieces of the rows of ``df``, whose column number ``text`` is the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text):
                yield work(piece)

    return df.mapInArrow(run, schema)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one byte array and the n + 1 offsets of the texts in it; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or not len(offsets) or offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


_TABLES: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the multiplier and of its inverse modulo 2^64."""
    if len(_TABLES.get("up", ())) <= n:
        _TABLES["up"] = _powers(MULTIPLIER, n + 1)
        _TABLES["down"] = _powers(pow(MULTIPLIER, -1, 1 << 64), n + 1)
    return _TABLES["up"], _TABLES["down"]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Sums of values times powers of the multiplier: entry i covers the first i values."""
    up, _ = powers(len(values))
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values.astype(np.uint64) * up[: len(values)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end], the same wherever the same values stand."""
    _, down = powers(len(prefix) - 1)
    return mixed((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word of the texts, and for each text the number of words before it (n + 1 entries)."""
    if not len(data):
        zero = np.zeros(0, dtype=np.int64)
        return zero, zero, np.zeros(len(offsets), dtype=np.int64)
    inside = ~IS_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cut = offsets[:-1][offsets[:-1] < len(data)]
    begins[cut] = inside[cut]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    ends[last] = inside[last]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, offsets)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
