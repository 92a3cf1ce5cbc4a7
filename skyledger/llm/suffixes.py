"""Suffix-array dedup of byte strings: remove what a string of ``LENGTH`` bytes repeats anywhere in the corpus.

Sampled suffixes. Every ``LENGTH``-byte string has an anchor: of the ``ANCHOR``-byte strings in it the one whose hash is
least (the leftmost of equals). Equal strings have equal anchors at equal places, so only suffixes that begin at
anchors need sorting: about one for each 140 bytes. An anchor comes with its stretch, the bytes of all strings whose
anchor it is.

Where a document repeats itself with a period (a run of blanks, a dashed rule), one suffix after the other has the same
anchor and stretch at even steps. Such suffixes, compared byte by byte, travel as one row with their number, and their strings
are one span that repeats.

Sorting, first by three tokens: the hash of the anchor bytes, and 128 bits of BLAKE2b of the stretch. Spark samples splitters and
range-partitions the suffixes by these tokens; each task sorts its bucket and compares neighbours. Runs of equal tokens
that may go on in another bucket are left open: each task reports its first and last run, and these few numbers, put
together, decide the open rows. Two equal stretches repeat each other whole. An anchor with several stretches needs
the bytes.

Sorting, then by bytes: those stretches fetch their bytes from the documents (one stretch stands for all equal
ones). Grouped by anchor, a multikey quicksort orders the suffixes by the bytes from the anchor on, and the reversed
prefixes by the bytes before it, in tokens of eight bytes, level by level: rows that still tie are sorted by their next
token. Both orders give the common lengths of neighbours. A string that begins ``a`` bytes before the anchor repeats if
another row is in the same block of the suffix order (common length LENGTH - a or more) and of the prefix order
(a or more). All strings of a stretch hold the anchor, so the removed bytes are one run, from the first to the last
string that repeats.

An anchor with more than ``GROUP_ROWS`` different stretches (a passage in a large share of all documents, each time
in other surroundings) is not gathered in one task: its strings are hashed one by one (128 bits of BLAKE2b), counted with an aggregate that
combines in the map tasks, and joined back. Bytes are held equal by such a hash or by comparison, never by the hash that picks anchors.

Matches never cross rows. A null text counts as empty; texts under LENGTH bytes lose nothing. Texts are cut into
overlapping segments of ``SEGMENT`` bytes for the work on anchors, which does not change the result. Rows repeated in
full repeat each other; rows are told apart by id and a hash of the text. An empty table gives no rows. Extra columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import mixed, pieces, powers, prefix_hash, small_batches, table, text_bytes
from skyledger.session import written

LENGTH = 400
ANCHOR = 128
#: Different stretches of one anchor that one task sorts, at most.
GROUP_ROWS = 100_000
SEGMENT = 1 << 20

_NAMES = ["g", "c", "d", "doc_id", "mark", "at", "low", "high", "times", "last"]
#: Tokens g (anchor), c and d (stretch); the row (doc_id, mark); the anchor's place, and of the first and last string; how many
#: such suffixes follow each other at even steps, and the last string of the last one.
_SUFFIX = "g long, c long, d long, doc_id long, mark int, at long, low long, high long, times long, last long"


def _least_in_windows(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` values, from running minima of blocks in both directions."""
    n = len(key) - width + 1
    blocks = -(-len(key) // width)
    padded = np.full(blocks * width, np.uint64(2**64 - 1), dtype=np.uint64)
    padded[: len(key)] = key
    square = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(square, axis=1).ravel()
    backward = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


def _stretch_tokens(raw: bytes, low: np.ndarray, end: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Two 64-bit tokens for each stretch raw[low:end], told apart also by where its anchor stands in it."""
    made = b"".join(
        hashlib.blake2b(raw[a:b], digest_size=16, salt=n.to_bytes(16, "little")).digest()
        for a, b, n in zip(low.tolist(), end.tolist(), before.tolist(), strict=True)
    )
    return np.frombuffer(made, dtype=np.int64).reshape(-1, 2)


def _periods(data: np.ndarray, same: np.ndarray, low: np.ndarray, end: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First rows, and numbers of rows, of suffixes that follow each other at even steps with equal stretches (to ``end``).

    ``same`` tells whether a row may equal the one before it.
    """
    step = np.diff(low, prepend=0)
    same = same & (step <= length)
    # A row goes on with a period if it may equal the one before, at the same step as that (or as the first step).
    goes_on = same & (np.append(False, ~same[:-1]) | np.append(False, step[1:] == step[:-1]))
    first = np.flatnonzero(~goes_on)
    times = np.diff(np.append(first, len(low)))
    for at in np.flatnonzero(times > 1):
        one, many = first[at], times[at]
        t = low[one + 1] - low[one]
        stop = end[one + many - 1]
        if not np.array_equal(data[low[one] : stop - t], data[low[one] + t : stop]):
            goes_on[one : one + many] = False
    first = np.flatnonzero(~goes_on)
    return first, np.diff(np.append(first, len(low)))


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """(segment, g, c, d, at, low, high, times, last) of all segments data[offsets[i]:offsets[i + 1]]; places count from the segment's start."""
    none = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return (none,) * 9
    sums = prefix_hash(data.astype(np.uint64) + np.uint64(1))
    _, down = powers(len(data))
    grams = len(data) - anchor + 1
    gram = mixed((sums[anchor:] - sums[:grams]) * down[:grams])
    # 40 bits of the hash, then the place: the least is the leftmost of the least hashes.
    key = gram >> np.uint64(24) << np.uint64(24) | np.arange(grams, dtype=np.uint64)
    least = (_least_in_windows(key, length - anchor + 1) & np.uint64((1 << 24) - 1)).astype(np.int64)
    segment = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    start = np.arange(len(least))
    inside = segment[: len(least)] == segment[length - 1 :]
    start, least = start[inside], least[inside]
    if not len(start):
        return (none,) * 9
    fresh = np.flatnonzero((np.diff(least, prepend=-1) != 0) | (np.diff(start, prepend=-2) != 1))
    low, high, at = start[fresh], np.append(start[fresh[1:] - 1], start[-1]), least[fresh]
    g, own = gram[at].view(np.int64), segment[low]
    same = np.append(False, (g[1:] == g[:-1]) & (own[1:] == own[:-1]) & (np.diff(at - low) == 0) & (np.diff(high - low) == 0))
    first, times = _periods(data, same, low, high + length, length)
    last = high[first + times - 1]
    g, own, at, low, high = (x[first] for x in (g, own, at, low, high))
    c = _stretch_tokens(data.tobytes(), low, high + length, at - low)
    base = offsets[own]
    return own, g, c[:, 0], c[:, 1], at - base, low - base, high - base, times, last - base


def _segments(batch: pa.RecordBatch, length: int, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(data, offsets, row, shift): the texts of a batch in segments that share length - 1 bytes with the next."""
    data, offsets = text_bytes(batch.column(2))
    chunks, row, shift, held = [], [], [], 0
    for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        for begin in range(int(a), int(b) - length + 1, size):
            chunks.append(data[begin : min(int(b), begin + size + length - 1)])
            row.append(i)
            shift.append(begin - int(a))
            held += len(chunks[-1])
            if held >= size:
                yield _joined(chunks, row, shift)
                chunks, row, shift, held = [], [], [], 0
    if chunks:
        yield _joined(chunks, row, shift)


def _joined(chunks: list[np.ndarray], row: list[int], shift: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return np.concatenate(chunks), np.concatenate([[0], np.cumsum([len(c) for c in chunks])]), np.array(row), np.array(shift)


def _suffixes(length: int, anchor: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 2):
                for data, offsets, row, shift in _segments(piece, length, size):
                    segment, g, c, d, at, low, high, times, last = anchors(data, offsets, length, anchor)
                    rows, move = pa.array(row[segment], pa.int64()), shift[segment]
                    made = [g, c, d, piece.column(0).take(rows), piece.column(1).take(rows), at + move, low + move, high + move, times, last + move]
                    yield pa.RecordBatch.from_arrays([pa.array(m) if isinstance(m, np.ndarray) else m for m in made], _NAMES)

    return run


#: What a task knows of a suffix after sorting: its stretch repeats; its anchor has other stretches (how many in all);
#: it stands for the equal ones; open: it does so, and the run of its g may go on in another task.
_SORTED = f"{_SUFFIX}, task int, repeats boolean, kinds long, first boolean, open boolean, count long"


def _sort_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sort the task's suffixes by their tokens and compare neighbours; keep those that meet an equal token."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    whole = pa.Table.from_batches(got).combine_chunks()
    g, c, d = (np.asarray(whole.column(i)) for i in range(3))
    times = np.asarray(whole.column("times"))
    order = np.lexsort((d, c, g))
    g, c, d, times = g[order], c[order], d[order], times[order]
    new_g = np.append(True, g[1:] != g[:-1])
    new_c = new_g | np.append(True, (c[1:] != c[:-1]) | (d[1:] != d[:-1]))
    runs_g, runs_c = np.flatnonzero(new_g), np.flatnonzero(new_c)
    size_c = np.add.reduceat(times, runs_c)
    kinds = np.add.reduceat(new_c.astype(np.int64), runs_g)
    of_g, of_c = np.cumsum(new_g) - 1, np.cumsum(new_c) - 1
    # The later rows of a run of equal stretches are decided: they repeat, and do not stand for the others.
    opened = ((g == g[0]) | (g == g[-1])) & new_c
    keep = (size_c[of_c] > 1) | (kinds[of_g] > 1) | opened
    task = TaskContext.get().partitionId()
    rows = whole.take(pa.array(order[keep])).combine_chunks()
    made = [
        pa.array(np.full(int(keep.sum()), task, dtype=np.int32)),
        pa.array(size_c[of_c][keep] > 1),
        pa.array(kinds[of_g][keep]),
        pa.array(new_c[keep]),
        pa.array(opened[keep]),
        pa.array(size_c[of_c][keep]),
    ]
    names = [*_NAMES, "task", "repeats", "kinds", "first", "open", "count"]
    table_ = pa.Table.from_arrays([*rows.columns, *made], names)
    yield from table_.to_batches(max_chunksize=50_000)


def _across(found: DataFrame) -> DataFrame:
    """The sorted suffixes, with the open ones decided by what all tasks together have of their tokens."""
    spark = found.sparkSession
    # Of each task, the stretches at the ends of its first and last run and the number of stretches in these runs: a few numbers.
    stretch = F.struct("c", "d")
    ends = found.where("open").groupBy("task", "g").agg(F.min(stretch).alias("c0"), F.max(stretch).alias("c1"), F.min_by("count", stretch).alias("n0"), F.max_by("count", stretch).alias("n1"), F.first("kinds").alias("kinds"))
    by_g: dict[int, list] = {}
    for r in ends.collect():
        by_g.setdefault(r.g, []).append(r)
    kinds_of, repeated = [], []
    for g, parts in by_g.items():
        times: dict[tuple[int, int], int] = {}
        for r in parts:
            for c, n in {(r.c0, r.n0), (r.c1, r.n1)}:
                times[c] = times.get(c, 0) + n
        # A stretch at the border of several tasks was counted by each.
        double = sum(sum(c in (r.c0, r.c1) for r in parts) - 1 for c in times)
        kinds_of.append((g, sum(r.kinds for r in parts) - double))
        repeated += [(g, *c) for c, n in times.items() if n > 1]
    kinds = spark.createDataFrame(kinds_of, "g long, all_kinds long")
    again = spark.createDataFrame(repeated, "g long, c long, d long").withColumn("again", F.lit(True))
    opened = found.where("open").join(kinds, "g").join(again, ["g", "c", "d"], "left")
    opened = opened.withColumn("repeats", F.col("repeats") | F.coalesce("again", F.lit(False))).withColumn("kinds", F.col("all_kinds")).drop("all_kinds", "again")
    both = found.where("not open").unionByName(opened)
    return both.where("repeats or kinds > 1")


def multikey_order(group: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by group, then tokens, and the common bytes (tokens of 8) of each with the one before; -1 across groups."""
    n, depth = tokens.shape
    order = np.argsort(group, kind="stable")
    common = np.full(n, 8 * depth, dtype=np.int64)
    common[np.flatnonzero(np.append(True, group[order][1:] != group[order][:-1]))] = -1
    split = common < 0
    for level in range(depth):
        # Rows that tie with a neighbour so far; ties are runs between splits.
        tied = ~split | ~np.append(split[1:], True)
        places = np.flatnonzero(tied)
        if not len(places):
            break
        block = np.cumsum(split)[places]
        token = tokens[order[places], level]
        turn = np.lexsort((token, block))
        order[places] = order[places][turn]
        token = token[turn]
        differs = np.append(False, (token[1:] != token[:-1]) & (block[1:] == block[:-1]))
        apart = token[differs] ^ token[np.flatnonzero(differs) - 1]
        equal = sum((apart >> np.uint64(64 - 8 * b) == 0).astype(np.int64) for b in range(1, 8))
        common[places[differs]] = 8 * level + equal
        split[places[differs]] = True
    return order, common


def _tokens(stretches: list[bytes], before: np.ndarray, length: int, widest: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes from the anchor and reversed prefixes before it, in big-endian tokens, zeros behind the end."""
    right = np.zeros((len(stretches), -(-length // 8) * 8), dtype=np.uint8)
    left = np.zeros((len(stretches), -(-max(widest, 1) // 8) * 8), dtype=np.uint8)
    for i, (raw, at) in enumerate(zip(stretches, before.tolist(), strict=True)):
        line = np.frombuffer(raw, dtype=np.uint8)
        right[i, : len(line) - at] = line[at:]
        left[i, :at] = line[:at][::-1]
    return right.view(">u8").astype(np.uint64), left.view(">u8").astype(np.uint64)


def repeated_range(group: np.ndarray, stretches: list[bytes], before: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """For each stretch (anchor ``before`` bytes in): the most and the fewest bytes before the anchor at which a repeated string begins; -1 if none."""
    n = len(stretches)
    most, fewest = np.full(n, -1), np.full(n, -1)
    strings = np.array([len(s) for s in stretches]) - length + 1
    right, left = _tokens(stretches, before, length, int(before.max(initial=0)))
    orders = [multikey_order(group, t) for t in (right, left)]
    del right, left
    ranks, peaks = [], []
    for order, common in orders:
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.arange(n)
        ranks.append(rank)
        peaks.append(np.maximum(common, np.append(common[1:], -1))[rank])
    # With its closest neighbours in each order, a row can repeat strings that begin so far before the anchor only.
    highest = np.minimum(before, peaks[1])
    lowest = np.maximum(before - strings + 1, length - peaks[0])
    for a in range(int(lowest[lowest <= highest].min(initial=0)), int(highest.max(initial=-1)) + 1):
        rows = np.flatnonzero((lowest <= a) & (a <= highest))
        if not len(rows):
            continue
        blocks = [np.cumsum(common < least)[rank[rows]] for (_, common), rank, least in zip(orders, ranks, (length - a, a), strict=True)]
        _, which, times = np.unique(blocks[0] * (n + 1) + blocks[1], return_inverse=True, return_counts=True)
        again = rows[times[which] > 1]
        most[again] = a
        fewest[again[fewest[again] < 0]] = a
    return most, fewest


def _compare(length: int):
    """Spans (doc_id, mark, begin, end) that the stretches of a task's anchors repeat; each anchor is in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        whole = pa.Table.from_batches(got).combine_chunks()
        g = np.asarray(whole.column("g"))
        at, low = np.asarray(whole.column("at")), np.asarray(whole.column("low"))
        order = np.argsort(g, kind="stable")
        cuts = np.flatnonzero(np.append(True, g[order][1:] != g[order][:-1]))
        # Whole anchors, so many that their bytes stay few.
        part = np.cumsum(np.diff(np.append(cuts, len(g)))) // 20_000
        for some in np.split(order, cuts[1:][part[1:] != part[:-1]]):
            stretches = whole.column("stretch").take(pa.array(some)).to_pylist()
            most, fewest = repeated_range(g[some], stretches, (at - low)[some], length)
            hit = most >= 0
            rows = some[hit]
            spans = [pa.array(at[rows] - most[hit]), pa.array(at[rows] - fewest[hit] + length)]
            kept = whole.select(["doc_id", "mark"]).take(pa.array(rows)).combine_chunks()
            for batch in pa.Table.from_arrays([*kept.columns, *spans], ["doc_id", "mark", "begin", "end"]).to_batches():
                yield batch

    return run


def _strings(length: int):
    """Every string of a stretch by itself: two hashes and its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, raw in enumerate(batch.column(batch.schema.names.index("stretch")).to_pylist()):
                start = np.arange(len(raw) - length + 1)
                hashes = _stretch_tokens(raw, start, start + length, start * 0).T
                rows = pa.array(np.full(len(start), i))
                low = batch.column(batch.schema.names.index("low"))[i].as_py()
                yield pa.RecordBatch.from_arrays([pa.array(hashes[0]), pa.array(hashes[1]), batch.column(0).take(rows), batch.column(1).take(rows), pa.array(low + start)], ["h", "k", "doc_id", "mark", "begin"])

    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, group_rows: int = GROUP_ROWS, segment: int = SEGMENT) -> DataFrame:
    """(doc_id, mark, begin, end) of bytes to remove, for rows (doc_id, mark, text); spans of a row may overlap."""
    suffixes = written(docs.select("doc_id", "mark", "text").mapInArrow(_suffixes(length, anchor, segment), _SUFFIX), "suffixes")
    bucketed = suffixes.repartitionByRange("g", "c", "d", "doc_id")
    found = written(_across(written(bucketed.mapInArrow(_sort_bucket, _SORTED), "suffixes-sorted")), "suffixes-met")
    whole = found.where("repeats").select("doc_id", "mark", F.col("low").alias("begin"), (F.col("last") + length).alias("end"))

    # One stretch of each kind fetches its bytes; a document's list is as long as its text allows.
    asked = found.where("kinds > 1 and first").groupBy("doc_id", "mark").agg(F.collect_list(F.struct("g", "at", "low", "high", "repeats", (F.col("kinds") > group_rows).alias("hot"))).alias("asked"))
    asked = asked.withColumnsRenamed({"doc_id": "of_id", "mark": "of_mark"})
    texts = docs.join(asked, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("mark") == F.col("of_mark"))).select("doc_id", "mark", "text", "asked")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 2):
                rows, parts, cut = [], {k: [] for k in ("g", "at", "low", "repeats", "hot")}, []
                for i, (text, wanted) in enumerate(zip(piece.column(2).cast(pa.binary()).to_pylist(), piece.column(3).to_pylist(), strict=True)):
                    for w in wanted:
                        rows.append(i)
                        cut.append(text[w["low"] : w["high"] + length])
                        for k, values in parts.items():
                            values.append(w[k])
                kinds = {"g": pa.int64(), "at": pa.int64(), "low": pa.int64(), "repeats": pa.bool_(), "hot": pa.bool_()}
                index = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays([piece.column(0).take(index), piece.column(1).take(index), *[pa.array(v, kinds[k]) for k, v in parts.items()], pa.array(cut, pa.binary())], ["doc_id", "mark", *parts, "stretch"])

    stretches = written(texts.mapInArrow(fetch, "doc_id long, mark int, g long, at long, low long, repeats boolean, hot boolean, stretch binary"), "suffixes-bytes")
    partly = stretches.where("not hot").repartition("g").mapInArrow(_compare(length), "doc_id long, mark int, begin long, end long")

    hot = stretches.where("hot").mapInArrow(_strings(length), "h long, k long, doc_id long, mark int, begin long")
    again = hot.groupBy("h", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h", "k")
    often = hot.join(again, ["h", "k"]).groupBy("doc_id", "mark", "begin").agg(F.lit(1)).select("doc_id", "mark", "begin", (F.col("begin") + length).alias("end"))
    return whole.unionByName(partly).unionByName(often)


def merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the spans; touching ones are one run."""
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    fresh = np.append(True, begin[1:] > reach[:-1])
    return begin[fresh], np.append(reach[:-1][fresh[1:]], reach[-1:])


def remove_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, group_rows: int = GROUP_ROWS, segment: int = SEGMENT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row of ``docs`` (doc_id, text); kept is binary."""
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).cast("string").alias("mark"), text.alias("text"))
    docs = docs.withColumn("mark", F.hash("mark"))
    # An aggregate, not a set: two equal spans of rows repeated in full do no harm, and a row has few.
    spans = written(repeated_spans(docs, length, anchor, group_rows, segment), "suffixes-spans")
    spans = spans.groupBy("doc_id", "mark").agg(F.collect_list("begin").alias("begins"), F.collect_list("end").alias("ends"))
    spans = spans.withColumnsRenamed({"doc_id": "of_id", "mark": "of_mark"})
    rows = docs.join(spans, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("mark") == F.col("of_mark")), "left").select("doc_id", "text", "begins", "ends")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 1):
                sizes, removed, counts, kept = [], [], [], []
                for text, begins, ends in zip(piece.column(1).cast(pa.binary()).to_pylist(), piece.column(2).to_pylist(), piece.column(3).to_pylist(), strict=True):
                    sizes.append(len(text))
                    if not begins:
                        removed.append(0)
                        counts.append(0)
                        kept.append(text)
                        continue
                    begin, end = merged(np.array(begins), np.array(ends))
                    edges = [0, *np.stack([begin, end], axis=1).ravel().tolist(), len(text)]
                    kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                    removed.append(int((end - begin).sum()))
                    counts.append(len(begin))
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(counts, pa.int64()), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return rows.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_repeats(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
