import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from skyledger.llm.components import components
from skyledger.llm.jaccard import Bands, _by_group, _meeting, dense_sketch, jaccard_components, op10_jaccard_join, shingle_sets, signatures


def plain_set(text, n):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + n]) for i in range(max(1, len(found) - n + 1)))


def brute(rows, n=4, percent=85):
    """Counter of (doc_id, n_shingles, component_id) by comparing all pairs that share a shingle."""
    sets = [plain_set(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    common = Counter()
    for held in holders.values():
        for i in range(len(held)):
            for j in range(i):
                common[held[j], held[i]] += 1
    for (i, j), c in common.items():
        if 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c):
            parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    name = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return Counter((rows[i][0], len(sets[i]), name[find(i)]) for i in range(len(rows)))


def changed(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = f"n{rng.randrange(10**6)}"
        elif kind == 1:
            out.insert(at, f"n{rng.randrange(10**6)}")
        elif len(out) > 1:
            del out[at]
    return out


def test_linked_sets_agree_on_a_part():
    rng = np.random.default_rng(4)
    for percent in (85, 80):
        bands = Bands(percent)
        for size in [*range(1, 60), 100, 333, 1000, 4000]:
            for _ in range(20):
                whole = rng.integers(0, 2**63, 2 * size + 2, dtype=np.uint64)
                low = int(np.ceil(percent * size / 100))
                other = int(rng.integers(low, size * 100 // percent + 1))
                common = -(-percent * (size + other) // (100 + percent))
                if common > min(size, other):
                    continue
                a = np.unique(whole[:size])
                b = np.unique(np.concatenate([whole[:common], whole[size : size + other - common]]))
                if len(a) == len(b) == common:
                    continue
                assert np.intersect1d(signatures(a, bands), signatures(b, bands)).size, (size, other, common)


def test_dense_sketch_bounds_the_difference():
    rng = np.random.default_rng(5)
    a = np.unique(rng.integers(0, 2**63, 700, dtype=np.uint64))
    b = np.unique(np.concatenate([a[:650], rng.integers(0, 2**63, 30, dtype=np.uint64)]))
    assert np.bitwise_count(dense_sketch(a) ^ dense_sketch(b)).sum() <= len(np.setxor1d(a, b))


def test_sets_equal_the_plain_ones():
    texts = ["A b c d E", "a B c d e", None, "", "one two", "x y z w x y z w", "\x0bq\xa0r s t u"]
    sets = shingle_sets(pa.array(texts), 4)
    assert [len(s) for s in sets] == [len(plain_set(t, 4)) for t in texts]
    assert np.array_equal(sets[0], sets[1])


def test_groups_across_batches():
    rng = random.Random(9)
    for _ in range(300):
        rows = sorted((rng.randrange(6), rng.randrange(4)) for _ in range(rng.randrange(1, 30)))
        cuts = sorted(rng.sample(range(len(rows) + 1), min(3, len(rows))))
        parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
        batches = [pa.RecordBatch.from_arrays([pa.array([x for x, _ in p], pa.int64()), pa.array([y for _, y in p], pa.int64())], ["sig", "node"]) for p in parts]
        got = [tuple(r.values()) for b in _meeting(iter(batches)) for r in b.to_pylist()]
        nodes = defaultdict(set)
        for x, y in rows:
            nodes[x].add(y)
        assert got == [(x, y, min(nodes[x])) for x in sorted(nodes) if len(nodes[x]) > 1 for y in sorted(nodes[x])]
        whole = [[tuple(r.values()) for r in t.to_pylist()] for t in _by_group(iter(batches))]
        assert whole == [[r for r in rows if r[0] == x] for x in sorted(nodes)]


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (300, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {100 + i: 100 for i in range(50)} | {300: 200, 200: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80)])
def test_documents_against_all_pairs(spark, n, percent):
    rng = random.Random(n)
    rows, doc_id = [(None, "a lonely text of no id at all"), (5, None), (6, ""), (7, "  \n "), (8, "short one"), (9, "Short ONE"), (9, "Short ONE")], 100
    passage = [f"p{i}" for i in range(60)]
    for length in (3, 5, 8, 12, 20, 40, 80, 200, 600):
        for _ in range(6):
            base = [f"w{rng.randrange(3000)}" for _ in range(length)]
            if rng.random() < 0.5:
                base[length // 2 : length // 2] = passage
            for _ in range(5):
                rows.append((doc_id, " ".join(changed(rng, base, rng.randrange(0, 2 + length // 25)))))
                doc_id += rng.randrange(1, 9)
    long = [f"l{i % 977}" for i in range(30_000)]
    rows += [(90_000, " ".join(long)), (90_001, " ".join(long[:-5]))]
    chain = [f"c{i}" for i in range(120)]
    for i in range(40):  # each is close to the next, the ends share nothing
        rows.append((doc_id + i, " ".join(chain)))
        chain = chain[4:] + [f"x{i}a", f"x{i}b", f"x{i}c", f"x{i}d"]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, node int")
    got = Counter(tuple(r) for r in jaccard_components(docs, n, percent).collect())
    assert got == brute(rows, n, percent)
    assert jaccard_components(docs.limit(0), n, percent).count() == 0


def test_query_against_all_pairs(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(tuple(r) for r in op10_jaccard_join(spark, sf).collect()) == brute(rows)


def test_words_of_equal_polynomials_are_different(spark):
    one, other = "m" * 26, "onmnjokonpkmkonmppnlplmllm"
    rows = [(1, f"{one} b c d"), (2, f"{other} b c d"), (3, one), (4, other), (5, f"{one} b c d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard_components(docs).collect()} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}


def test_word_numbers_are_siphash():
    """Against the rounds written out on Python numbers, for words of every length."""
    from skyledger.llm.jaccard import _START, LONG_WORD, word_numbers

    mask, key = 2**64 - 1, [int(k) for k in _START]
    turn = lambda x, b: (x << b | x >> 64 - b) & mask

    def rounds(a, b, c, d):
        a = a + b & mask
        b = turn(b, 13) ^ a
        a = turn(a, 32)
        c = c + d & mask
        d = turn(d, 16) ^ c
        a = a + d & mask
        d = turn(d, 21) ^ a
        c = c + b & mask
        b = turn(b, 17) ^ c
        return a, b, turn(c, 32), d

    def plain(word):
        a, b, c, d = key
        tail = word + bytes(7 - len(word) % 8) + bytes([len(word)])
        for i in range(0, len(tail), 8):
            m = int.from_bytes(tail[i : i + 8], "little")
            d ^= m
            a, b, c, d = rounds(a, b, c, d)
            a ^= m
        c ^= 0xFF
        for _ in range(3):
            a, b, c, d = rounds(a, b, c, d)
        return a ^ b ^ c ^ d

    rng = random.Random(1)
    words = [bytes(rng.randrange(33, 256) for _ in range(n)) for n in [*range(1, LONG_WORD + 1), *range(1, 30)]]
    data = np.frombuffer(b" ".join(words), dtype=np.uint8)
    end = np.cumsum([len(w) + 1 for w in words]) - 1
    start = end - np.array([len(w) for w in words])
    assert word_numbers(data, start, end).tolist() == [plain(w) for w in words]
    long = np.frombuffer(b"a" * 100 + b"b" * 65 + b"a" * 100, dtype=np.uint8)
    one, other, again = word_numbers(long, np.array([0, 100, 165]), np.array([100, 165, 265]))
    assert one == again != other
