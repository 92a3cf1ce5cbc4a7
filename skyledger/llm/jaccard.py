r"""N-gram Jaccard join by parity sketches: documents whose shingle sets are similar, and their components.

Each token (hashed shingle) flips one bit of its document's sketch, so the Hamming distance of two sketches is at
most the symmetric difference of the sets. Sets linked at ``percent`` differ in no more than
(a + b) * (100 - percent) / (100 + percent) tokens. Within a band of sizes that allows ``slack`` differences, a sketch
is cut into slack + ``spare`` parts, so linked documents agree on at least ``spare`` whole parts: the pigeonhole. Parts
are ranges of the token hash, and are so sparse (2^64 places) that they are kept as the XOR of their tokens' hashes.
An empty part joins nothing: a document with fewer than ``spare`` empty parts keeps an agreeing part that is not
empty. If it has more, it joins on its empty parts too, with others of that kind, so no link is lost.

What agrees on a part is then filtered by a second, dense sketch (two bits or more for each token, folded to equal
widths): a Hamming distance above the slack rules a pair out. What is left is verified on the sets themselves.

Words are numbered by a keyed hash of 64 bits (SipHash, BLAKE2b for long ones), so no rule of arithmetic leads from one word to another of the same number;
a run of words is numbered by mixing in one word after the other, and a set by BLAKE2b of its sorted tokens.

Nodes are distinct sets, so copies are one node; each map batch sends a part of a node once. Near copies of one text
fall into the same groups again and again, so pairs are not listed at once: first each node is verified with the one
partner it meets most often; then, in a few of the groups that still hold several components, each with its closest
partner by the dense sketch; and then, in all such groups, all pairs of different components that the sketches allow. Every linked pair is thus verified
or already inside one component.

Texts are ASCII lower-cased and cut into words ``[^\x20\x09-\x0D]+``; a set holds the distinct runs of ``n`` words, or
the whole sequence if it is shorter. Null texts and texts without words have the empty set and link with nothing. A
component is named by its smallest id (nulls last); repeated rows are copies of each other. Extra columns are not
read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.common import lower_ascii, map_texts, mixed, pieces, small_batches, table, text_bytes, words
from skyledger.llm.components import components
from skyledger.session import written

#: Ids of documents to verify are broadcast up to so many (8 bytes each); beyond that the join shuffles.
BROADCAST_IDS = 500_000
#: Groups in which a node first looks for its closest partner.
CLOSEST_GROUPS = 4
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], dtype=np.uint64)


#: Longer words are numbered one by one.
LONG_WORD = 64
_KEY = hashlib.blake2b(b"words of a shingle", digest_size=32).digest()
_START = np.frombuffer(_KEY, dtype="<u8")
#: Keeps the first 0 to 8 bytes of a little-endian number.
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


def _rotated(x: np.ndarray, bits: int) -> np.ndarray:
    return x << np.uint64(bits) | x >> np.uint64(64 - bits)


def _rounds(v: list[np.ndarray], times: int) -> list[np.ndarray]:
    """The add, rotate and XOR rounds of SipHash on many states at once."""
    a, b, c, d = v
    for _ in range(times):
        a, c = a + b, c + d
        b, d = _rotated(b, 13) ^ a, _rotated(d, 16) ^ c
        a, c = _rotated(a, 32) + d, c + b
        b, d = _rotated(b, 17) ^ c, _rotated(d, 21) ^ a
        c = _rotated(c, 32)
    return [a, b, c, d]


def word_numbers(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A keyed 64-bit number for the bytes of each word: SipHash, eight bytes of all words at a time; BLAKE2b of long ones."""
    size = end - start
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    eight = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    state = [np.full(len(start), k, dtype=np.uint64) for k in _START]
    rows, block = np.flatnonzero(size <= LONG_WORD), 0
    while len(rows):
        left = size[rows] - 8 * block
        message = eight[start[rows] + 8 * block] & _FIRST_BYTES[np.minimum(left, 8)]
        # The last block has the length in its free top byte, so it is one of less than eight bytes.
        message |= np.where(left < 8, size[rows], 0).astype(np.uint64) << np.uint64(56)
        v = [x[rows] for x in state]
        v[3] = v[3] ^ message
        v = _rounds(v, 1)
        v[0] = v[0] ^ message
        for x, new in zip(state, v, strict=True):
            x[rows] = new
        rows, block = rows[left >= 8], block + 1
    state[2] ^= np.uint64(0xFF)
    a, b, c, d = _rounds(state, 3)
    numbers = a ^ b ^ c ^ d
    for i in np.flatnonzero(size > LONG_WORD):
        raw = data[start[i] : end[i]].tobytes()
        numbers[i] = int.from_bytes(hashlib.blake2b(raw, digest_size=8, key=_KEY).digest(), "little")
    return numbers


def shingle_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = text_bytes(column)
    if not len(data):
        return [np.zeros(0, dtype=np.uint64)] * len(column)
    low = lower_ascii(data)
    start, end, before = words(data, offsets)
    word = word_numbers(low, start, end)
    runs = max(0, len(word) - n + 1)
    total = np.zeros(runs, dtype=np.uint64)
    for i in range(n):
        total = mixed(total * _ODD[0] + (word[i : i + runs] ^ _ODD[1 + i % 4]))
    out = []
    for a, b in zip(before, before[1:], strict=False):
        if b - a >= n:
            out.append(np.unique(total[a : b - n + 1]))
        elif b > a:
            short = np.array([b - a], dtype=np.uint64)
            for w in word[a:b]:
                short = mixed(short * _ODD[0] ^ w)
            out.append(short)
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def node_of(tokens: np.ndarray) -> int:
    """A set's own number (64 bits, signed)."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


class Bands:
    """Windows of set sizes in which linked sets meet, and the slack in each."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.ratio = 100 / percent

    def slack(self, size: int | np.ndarray):
        """Tokens in which linked sets with so many tokens together may differ."""
        return size * (100 - self.percent) // (100 + self.percent)

    def of(self, size: int) -> tuple[int, ...]:
        """A set is the smaller partner in its own window, and may be the larger one in that below."""
        own = int(math.log(size) / math.log(self.ratio) + 1e-9)
        return (own, own - 1) if own else (own,)

    def parts(self, window: int) -> tuple[int, int]:
        """(slack, spare) of a window: its smaller partners have sizes up to that of the next window's start."""
        small = math.ceil(self.ratio ** (window + 1)) + 1
        slack = self.slack(small + small * 100 // self.percent)
        return slack, 4 + slack // 16


def signatures(tokens: np.ndarray, bands: Bands) -> np.ndarray:
    """One value for each part of each window that the set joins on."""
    out = []
    high, spread = tokens >> np.uint64(32), mixed(tokens ^ _ODD[2])
    for window in bands.of(len(tokens)):
        slack, spare = bands.parts(window)
        if not slack:
            continue
        parts = slack + spare
        part = (high * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.diff(part, prepend=-1))
        name = np.uint64(window + 1 << 32) + part[first].astype(np.uint64)
        out.append(mixed(np.bitwise_xor.reduceat(spread, first) ^ mixed(name)))
        if parts - len(first) >= spare:
            empty = np.setdiff1d(np.arange(parts), part[first]).astype(np.uint64)
            out.append(mixed(np.uint64(window + 1 << 32) + empty ^ _ODD[1]))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def dense_sketch(tokens: np.ndarray) -> np.ndarray:
    """Parities of the tokens over a power of two of bits, twice the number of tokens or more."""
    bits = max(512, 1 << (len(tokens) - 1).bit_length() + 1)
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def _folded(sketch: np.ndarray, length: int) -> np.ndarray:
    while len(sketch) > length:
        half = len(sketch) // 2
        sketch = sketch[:half] ^ sketch[half:]
    return sketch


def _nodes(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, n_shingles, node, sketch) of every row; without shingles the node is null."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column(1), n)
        full = [len(s) > 0 for s in sets]
        columns = [
            batch.column(0),
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([node_of(s) if f else None for s, f in zip(sets, full, strict=True)], pa.int64()),
            pa.array([dense_sketch(s).tobytes() if f else None for s, f in zip(sets, full, strict=True)], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "node", "sketch"])

    return map_texts(docs, 1, work, "doc_id long, n_shingles long, node long, sketch binary")


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _signatures(docs: DataFrame, n: int, bands: Bands) -> DataFrame:
    """(sig, node): in one batch, a set that several rows have is listed once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 0):
                known = {node_of(s): s for s in shingle_sets(piece.column(0), n) if len(s)}
                made = [signatures(s, bands) for s in known.values()]
                if known:
                    node = np.repeat(np.fromiter(known, np.int64, len(known)), [len(m) for m in made])
                    yield pa.RecordBatch.from_arrays([_signed(np.concatenate(made)), pa.array(node)], ["sig", "node"])

    return docs.select("text").mapInArrow(run, "sig long, node long")


def _meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sig, node, least node of the group) of the signatures that several nodes have, from rows sorted by sig and node.

    Groups pass by: all that is kept of one is its last row, its least node, and whether it has several.
    """
    last, least_so_far, sent = None, 0, False
    for batch in batches:
        if not batch.num_rows:
            continue
        sig, node = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        if last is not None:
            sig, node = np.append(last[0], sig), np.append(last[1], node)
        fresh = np.append(True, (sig[1:] != sig[:-1]) | (node[1:] != node[:-1]))
        sig, node = sig[fresh], node[fresh]
        first = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
        sizes = np.diff(np.append(first, len(sig)))
        least, several = np.repeat(node[first], sizes), np.repeat(sizes > 1, sizes)
        send = several.copy()
        if last is not None:
            least[: sizes[0]] = least_so_far
            if sent:
                several[: sizes[0]] = send[: sizes[0]] = True
                send[0] = False
        yield pa.RecordBatch.from_arrays([pa.array(x[send]) for x in (sig, node, least)], ["sig", "node", "least"])
        last, least_so_far, sent = (sig[-1], node[-1]), least[-1], bool(several[-1])


def _by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each signature, from rows sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        sig = np.asarray(batch.column(0))
        cuts = np.append(np.flatnonzero(np.append(not held or sig[0] != held[-1].column(0)[0].as_py(), sig[1:] != sig[:-1])), len(sig))
        if held and cuts[0] != 0:
            held.append(batch.slice(0, cuts[0]))
        elif held:
            yield pa.Table.from_batches(held)
            held = []
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if held:
                yield pa.Table.from_batches(held)
            held = [batch.slice(lo, hi - lo)]
    if held:
        yield pa.Table.from_batches(held)


def _allowed(bands: Bands, closest: bool):
    """Pairs of a group in different components that sizes and dense sketches allow; or each node's closest one."""

    def of_group(node: np.ndarray, root: np.ndarray, size: np.ndarray, sketches: list[bytes]) -> Iterator[tuple[int, int]]:
        views = [np.frombuffer(s, dtype=np.uint64) for s in sketches]
        width = min(map(len, views))
        sketch = np.stack([_folded(v, width) for v in views])
        # Who is in the largest component of the group is found by the others.
        _, which, times = np.unique(root, return_inverse=True, return_counts=True)
        small = np.flatnonzero(which != np.argmax(times))
        for i in small if closest else range(len(node) - 1):
            others = np.arange(len(node)) if closest else np.arange(i + 1, len(node))
            low, high = np.minimum(size[others], size[i]), np.maximum(size[others], size[i])
            others = others[(root[others] != root[i]) & (100 * low >= bands.percent * high)]
            if len(others):
                apart = np.bitwise_count(sketch[others] ^ sketch[i]).sum(axis=1)
                fits = apart <= bands.slack(size[others] + size[i])
                if closest and fits.any():
                    yield (int(node[i]), int(node[others[fits][np.argmin(apart[fits])]]))
                elif fits.any():
                    for at in others[fits]:
                        yield (int(node[i]), int(node[at]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: set[tuple[int, int]] = set()
        for group in _by_group(batches):
            group = group.combine_chunks()
            node, root, size = (np.asarray(group.column(i)) for i in (1, 2, 3))
            for a, b in of_group(node, root, size, group.column(4).to_pylist()):
                pairs.add((min(a, b), max(a, b)))
                if len(pairs) > 100_000:
                    yield _pairs(pairs)
                    pairs.clear()
        yield _pairs(pairs)

    return run


def _pairs(pairs: set[tuple[int, int]]) -> pa.RecordBatch:
    found = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])


class _Join:
    """The state of one join: its documents and their nodes."""

    def __init__(self, docs: DataFrame, n: int, percent: int) -> None:
        self.n, self.bands = n, Bands(percent)
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        small_batches(docs.sparkSession)
        self.rows = written(_nodes(self.docs, n), "jaccard-nodes")
        full = self.rows.where("node is not null")
        # A node's sketch and size follow from its set, so any row's will do.
        by_node = full.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("size"), F.first("sketch").alias("sketch"))
        self.nodes = written(by_node, "jaccard-classes")

    def linked(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) whose sets are similar enough."""
        pairs = written(pairs, "jaccard-pairs")
        wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        ids = written(self.nodes.join(wanted, "node").select(F.col("doc_id").alias("of_id")).distinct(), "jaccard-ids")
        if ids.count() <= BROADCAST_IDS:
            ids = F.broadcast(ids)
        texts = self.docs.join(ids, F.col("doc_id").eqNullSafe(F.col("of_id"))).select("doc_id", "text")
        n, percent = self.n, self.bands.percent

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [s for s in shingle_sets(batch.column(1), n) if len(s)]
            return pa.RecordBatch.from_arrays([pa.array([node_of(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "tokens"])

        sets = map_texts(texts, 1, work, "node long, tokens binary").dropDuplicates(["node"])
        sets = written(sets, "jaccard-sets")
        side = lambda c: sets.select(F.col("node").alias(c), F.col("tokens").alias(f"{c}_tokens"))
        both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_tokens", "b_tokens")

        def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                good = []
                for one, other in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                    x, y = np.frombuffer(one, dtype=np.uint64), np.frombuffer(other, dtype=np.uint64)
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    good.append(100 * common >= percent * (len(x) + len(y) - common))
                yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

        return written(both.mapInArrow(check, "a long, b long"), "jaccard-links")

    def most_met(self, meeting: DataFrame) -> DataFrame:
        """For each node, the least node of a group with which it shares most groups, if the sketches allow the pair."""
        met = meeting.where("node <> least").groupBy("node", "least").agg(F.count(F.lit(1)).alias("times"))
        met = met.groupBy("node").agg(F.max(F.struct("times", "least"))["least"].alias("least"))
        known = self.nodes.select("node", "size", "sketch")
        met = met.join(known, "node").join(known.select(F.col("node").alias("least"), F.col("size").alias("size_b"), F.col("sketch").alias("sketch_b")), "least")
        bands = self.bands

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                a, b, x, y, s, t = (batch.column(i).to_pylist() for i in range(6))
                fits = []
                for size, other, one, two in zip(x, y, s, t, strict=True):
                    u, v = np.frombuffer(one, dtype=np.uint64), np.frombuffer(two, dtype=np.uint64)
                    width = min(len(u), len(v))
                    apart = int(np.bitwise_count(_folded(u, width) ^ _folded(v, width)).sum())
                    fits.append(apart <= bands.slack(size + other) and 100 * min(size, other) >= bands.percent * max(size, other))
                keep = pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
                yield keep.filter(pa.array(fits, pa.bool_()))

        return met.select("node", "least", "size", "size_b", "sketch", "sketch_b").mapInArrow(near, "a long, b long")

    def roots(self) -> DataFrame:
        """(node, root) of the nodes that are linked with others."""
        sent = _signatures(self.docs, self.n, self.bands).repartition("sig").sortWithinPartitions("sig", "node")
        meeting = written(sent.mapInArrow(_meeting, "sig long, node long, least long"), "jaccard-meeting")
        links = self.linked(self.most_met(meeting))
        roots = written(components(links), "jaccard-roots")
        for closest in (True, False):
            placed = meeting.join(roots, "node", "left").select("sig", "node", F.coalesce("root", "node").alias("root"))
            placed = written(placed, "jaccard-placed")
            several = placed.groupBy("sig").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
            unsettled = placed.join(several.select("sig"), "sig", "left_semi")
            if closest:
                # A few groups of each node are enough to find it a partner; the last turn looks at all.
                pick = Window.partitionBy("node").orderBy(F.xxhash64("sig"))
                unsettled = unsettled.withColumn("nth", F.row_number().over(pick)).where(F.col("nth") <= CLOSEST_GROUPS).drop("nth")
            known = unsettled.join(self.nodes.select("node", "size", "sketch"), "node").select("sig", "node", "root", "size", "sketch")
            pairs = known.repartition("sig").sortWithinPartitions("sig").mapInArrow(_allowed(self.bands, closest), "a long, b long").distinct()
            links = links.unionByName(self.linked(pairs))
            roots = written(components(links), "jaccard-roots")
        return roots


def jaccard_components(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text)."""
    join = _Join(docs, n, percent)
    named = join.nodes.select("node", "doc_id").join(join.roots(), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = written(named.join(least, "root").select("node", "component_id"), "jaccard-named")
    found = join.rows.select("doc_id", "n_shingles", "node").join(named, "node", "left")
    return found.select("doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The row with the smallest id (nulls last) of each component; all columns stay.

    Rows are told apart by a hash of id and text; of rows repeated in full, one stays.
    """
    keyed = docs.withColumn("row_key", F.xxhash64("doc_id", "text"))
    found = jaccard_components(keyed.select(F.col("row_key").alias("doc_id"), "text"), n, percent)
    ids = written(keyed.groupBy("row_key").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("times")), "jaccard-keys")
    least = F.min(F.struct(F.col("ids.doc_id").isNull().alias("last"), F.col("ids.doc_id").alias("doc_id"), F.col("row_key").alias("row_key")))
    chosen = found.select(F.col("doc_id").alias("row_key"), "component_id").join(ids.alias("ids"), "row_key")
    chosen = written(chosen.groupBy("component_id").agg(least["row_key"].alias("kept_key")).select("kept_key"), "jaccard-kept")
    kept = keyed.join(chosen, F.col("row_key") == F.col("kept_key"), "left_semi")
    if not ids.where("times > 1").isEmpty():
        kept = kept.dropDuplicates(["row_key"])
    return kept.drop("row_key")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
