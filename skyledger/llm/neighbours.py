"""Approximate nearest neighbours: stable projections in kd-trees, verified until a chi-square test holds.

Vectors are scaled to length one, so that the largest cosine is the smallest distance, and projected to
``PROJECTED`` dimensions by a Gaussian (2-stable) matrix: the squared projected distance of two vectors is their
squared distance times a chi-square variable. A search takes the candidates in order of projected distance, leaf by
leaf of a kd-tree, and verifies each in the original space. It stops when a candidate as near as the k-th best so far
would, with probability ``CERTAINTY``, have had a smaller projected distance than all that is left.

The top of the kd-tree is fitted on ``FIT_ROWS`` vectors at most, those whose rows hash lowest; its leaves are cells
of about ``CELL_ROWS`` rows, dealt to tasks, each of which builds the rest of the tree for its cell. Every vector is
indexed. A query first searches its own cell. With the k-th best found there, the same test tells which other cells
it must visit; usually few.

Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows without an id.
Different vectors of one id are rows of their own, told apart by a hash of id and vector: each asks, and is a
candidate for the others. Rows repeated in full count once. Vectors of different lengths are never compared.
Of equal vectors only the k + 1 smallest ids can be among anyone's k nearest (ties go to smaller ids), so only these
are candidates; all of them may ask. With fewer candidates than k, all are returned. Extra columns are not read; an
empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.common import small_batches, table
from skyledger.session import written

PROJECTED = 8
CERTAINTY = 0.95
FIT_ROWS = 20_000
CELL_ROWS = 1024
LEAF_ROWS = 32
#: Leaves verified at once.
STRIDE = 8
SALTS = 32


@lru_cache(64)
def _matrix(dim: int) -> np.ndarray:
    return np.random.default_rng([dim, PROJECTED]).standard_normal((dim, PROJECTED))


def chi_square(x: np.ndarray) -> np.ndarray:
    """Distribution function of the chi-square variable with PROJECTED (even) degrees of freedom."""
    half = np.minimum(np.asarray(x, dtype=np.float64) / 2, 700)
    return 1 - np.exp(-half) * sum(half**i / math.factorial(i) for i in range(PROJECTED // 2))


def _units(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt(np.sum(vectors * vectors, axis=1, keepdims=True))


def cosines(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Row by row in one fixed order of sums, so that equal vectors get equal scores."""
    return np.sum(many * one, axis=1) / (np.sqrt(np.sum(one * one)) * np.sqrt(np.sum(many * many, axis=1)))


class Tree:
    """Median splits of projected points: inner nodes (dimension, value), and leaves numbered in order."""

    def __init__(self, points: np.ndarray, leaves: int) -> None:
        self.nodes: list[tuple[int, float, int, int]] = []
        self.boxes: list[np.ndarray] = []
        self.root = self._split(points, max(1, leaves), np.array([[-np.inf] * PROJECTED, [np.inf] * PROJECTED]))

    def _split(self, points: np.ndarray, leaves: int, box: np.ndarray) -> int:
        """The node's number, or -1 - leaf."""
        if leaves > 1 and len(points) > 1:
            at = int(np.argmax(points.max(axis=0) - points.min(axis=0)))
            value = float(np.median(points[:, at]))
            left = points[:, at] < value
            if left.any():
                me = len(self.nodes)
                self.nodes.append((at, value, 0, 0))
                below, above = box.copy(), box.copy()
                below[1, at] = above[0, at] = value
                a = self._split(points[left], leaves // 2, below)
                b = self._split(points[~left], leaves - leaves // 2, above)
                self.nodes[me] = (at, value, a, b)
                return me
        self.boxes.append(box)
        return -len(self.boxes)

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), dtype=np.int64)
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -1 - node
            elif len(rows):
                at, value, a, b = self.nodes[node]
                left = points[rows, at] < value
                todo += [(a, rows[left]), (b, rows[~left])]
        return out

    def reach(self, points: np.ndarray, boxes: np.ndarray | None = None) -> np.ndarray:
        """Squared distance of each point to each leaf's box."""
        boxes = np.array(self.boxes) if boxes is None else boxes
        out = np.zeros((len(points), len(boxes)))
        for at in range(PROJECTED):
            p = points[:, at : at + 1]
            out += np.maximum(0, np.maximum(boxes[None, :, 0, at] - p, p - boxes[None, :, 1, at])) ** 2
        return out


def _matrix_of(column: pa.Array) -> np.ndarray:
    """Vectors of one length as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = np.asarray(column.flatten(), dtype=np.float64)
    return values.reshape(len(column), -1)


def search(query_ids: np.ndarray, query_rows: np.ndarray, queries: np.ndarray, bounds: np.ndarray, ids: np.ndarray, row_keys: np.ndarray, vectors: np.ndarray, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(query id and row key, ids, row keys, scores) of each query's k best among the vectors; ``bounds`` holds k-th best scores known."""
    matrix = _matrix(vectors.shape[1])
    units = _units(vectors)
    points = units @ matrix
    tree = Tree(points, -(-len(ids) // LEAF_ROWS))
    leaf = tree.leaf_of(points)
    order = np.argsort(leaf, kind="stable")
    starts = np.searchsorted(leaf[order], np.arange(len(tree.boxes) + 1))
    tight = np.array([[points[order[a:b]].min(axis=0), points[order[a:b]].max(axis=0)] for a, b in zip(starts, starts[1:], strict=False)])
    asked = _units(queries)
    reach = tree.reach(asked @ matrix, tight)
    turns = np.argsort(reach, axis=1, kind="stable")
    for i, (query_id, query_row) in enumerate(zip(query_ids, query_rows, strict=True)):
        found, close, best = [], [], np.zeros(0)
        for turn in range(0, len(tight), STRIDE):
            kth = max(bounds[i], best[k - 1] if len(best) >= k else -np.inf)
            far = reach[i, turns[i, turn]]
            if np.isfinite(kth) and chi_square(far / max(2 - 2 * kth, 1e-300)) >= CERTAINTY and far > 0:
                break
            rows = np.concatenate([order[starts[j] : starts[j + 1]] for j in turns[i, turn : turn + STRIDE]])
            rows = rows[(ids[rows] != query_id) | (row_keys[rows] != query_row)]
            near = units[rows] @ asked[i]
            found.append(rows)
            close.append(near)
            best = np.sort(np.concatenate([best, near]))[::-1][:k]
        if not len(best):
            continue
        rows, near = np.concatenate(found), np.concatenate(close)
        rows = rows[near >= best[-1] - 1e-9]
        score = cosines(queries[i], vectors[rows])
        top = np.lexsort((row_keys[rows], ids[rows], -score))[:k]
        yield int(query_id), int(query_row), ids[rows[top]], row_keys[rows[top]], score[top]


def _search_cell(k: int):
    names = ["query_id", "query_row", "vec_id", "row", "score"]
    kinds = pa.schema([*((name, pa.int64()) for name in names[:-1]), ("score", pa.float64())])

    def run(asking: pa.Table, held: pa.Table) -> pa.Table:
        parts: list[list[np.ndarray]] = [*([np.zeros(0, np.int64)] for _ in names[:-1]), [np.zeros(0)]]
        if asking.num_rows and held.num_rows:
            keys = lambda rows: (np.asarray(rows.column("vec_id")), np.asarray(rows.column("row")), _matrix_of(rows.column("embedding")))
            for query_id, query_row, ids, rows, score in search(*keys(asking), np.asarray(asking.column("bound")), *keys(held), k):
                for part, values in zip(parts, (np.full(len(ids), query_id), np.full(len(ids), query_row), ids, rows, score), strict=True):
                    part.append(values)
        return pa.Table.from_arrays([pa.array(np.concatenate(p), t) for p, t in zip(parts, kinds.types, strict=True)], names)

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding, row) of the different rows that take part."""
    whole = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.forall("embedding", whole) & F.exists("embedding", lambda x: x != 0))
    return rows.distinct().withColumn("row", F.xxhash64("vec_id", "embedding"))


def _trees(rows: DataFrame, total: int, fit_rows: int, cell_rows: int) -> dict[int, Tree]:
    """For each vector length in the bounded sample, the top of its tree."""
    sample = rows.orderBy("row", "vec_id").limit(fit_rows).toArrow()
    vectors = sample.column("embedding").combine_chunks()
    length = pc.list_value_length(vectors)
    trees = {}
    for dim in pc.unique(length).to_pylist():
        own = _matrix_of(vectors.filter(pc.equal(length, dim)))
        share = total * len(own) / max(1, sample.num_rows)
        trees[dim] = Tree(_units(own) @ _matrix(dim), min(len(own) // 4, math.ceil(share / cell_rows)))
    return trees


def nearest(vectors: DataFrame, k: int = 5, each: int = 50, fit_rows: int = FIT_ROWS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every vector whose id is divisible by ``each``."""
    small_batches(vectors.sparkSession)
    rows = written(usable(vectors), "ann-vectors")
    trees = _trees(rows, rows.count(), fit_rows, cell_rows)
    schema = "dim int, cell int, vec_id long, embedding array<double>, row long"
    names = ["dim", "cell", "vec_id", "embedding", "row"]

    def by_length(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, pa.RecordBatch]]:
        length = pc.list_value_length(batch.column(column))
        for dim in pc.unique(length).to_pylist():
            yield dim, batch.filter(pc.equal(length, dim))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part in by_length(batch, 1):
                points = _units(_matrix_of(part.column(1))) @ _matrix(dim)
                cell = trees[dim].leaf_of(points) if dim in trees else np.zeros(len(points), dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([dim] * len(points), pa.int32()), pa.array(cell, pa.int32()), *part.columns], names)

    placed = written(rows.mapInArrow(place, schema), "ann-cells")
    # Of equal vectors the k + 1 smallest ids, found within salts first.
    least = lambda *key: F.row_number().over(Window.partitionBy("dim", "cell", "embedding", *key).orderBy("vec_id"))
    held = placed.withColumn("salt", F.pmod(F.xxhash64("vec_id"), SALTS)).withColumn("n", least("salt")).where(F.col("n") <= k + 1)
    held = written(held.withColumn("n", least()).where(F.col("n") <= k + 1).select(*names), "ann-candidates")

    asking = placed.where(F.col("vec_id") % each == 0)
    result = "query_id long, query_row long, vec_id long, row long, score double"
    found = lambda queries: queries.groupBy("dim", "cell").cogroup(held.groupBy("dim", "cell")).applyInArrow(_search_cell(k), result)
    at_home = written(found(asking.withColumn("bound", F.lit(float("-inf")))), "ann-home")
    kth = at_home.groupBy("query_id", "query_row").agg(F.min("score").alias("worst"), F.count(F.lit(1)).alias("n"))
    kth = kth.select(F.col("query_id").alias("vec_id"), F.col("query_row").alias("row"), F.when(F.col("n") >= k, F.col("worst")).alias("bound"))
    asking = asking.join(kth, ["vec_id", "row"], "left").select(*names, F.coalesce("bound", F.lit(float("-inf"))).alias("bound"))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part in by_length(batch, 3):
                if dim not in trees or len(trees[dim].boxes) < 2:
                    continue
                reach = trees[dim].reach(_units(_matrix_of(part.column(3))) @ _matrix(dim))
                kth = np.asarray(part.column(5))
                limit = np.where(np.isfinite(kth), np.maximum(2 - 2 * kth, 1e-300), np.inf)
                go = chi_square(reach / limit[:, None]) < CERTAINTY
                go[np.arange(len(go)), np.asarray(part.column(1))] = False
                row, cell = np.nonzero(go)
                for lo in range(0, len(row), 1000):
                    some = part.take(pa.array(row[lo : lo + 1000]))
                    yield pa.RecordBatch.from_arrays([some.column(0), pa.array(cell[lo : lo + 1000], pa.int32()), *some.columns[2:]], [*names, "bound"])

    elsewhere = found(asking.mapInArrow(visit, f"{schema}, bound double"))
    rank = F.row_number().over(Window.partitionBy("query_id", "query_row").orderBy(F.col("score").desc(), "vec_id", "row"))
    return at_home.unionByName(elsewhere).withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
