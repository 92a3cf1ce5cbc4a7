import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from skyledger.llm.suffixes import anchors, multikey_order, op2_suffix_dedup, remove_repeats, repeated_range


def brute(rows, length):
    """(doc_id, n_bytes, n_removed, n_spans, sha256 of the rest) by counting every string."""
    raw = [(t or "").encode() for _, t in rows]
    times = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = Counter()
    for (doc_id, _), r in zip(rows, raw, strict=True):
        gone = np.zeros(len(r) + 1, dtype=int)
        for i in range(len(r) - length + 1):
            if times[r[i : i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        gone = np.cumsum(gone[:-1]) > 0
        kept = bytes(np.frombuffer(r, dtype=np.uint8)[~gone])
        out[doc_id, len(r), int(gone.sum()), int(np.sum(np.diff(gone.astype(int), prepend=0) == 1)), hashlib.sha256(kept).hexdigest()] += 1
    return out


def digest(rows):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in rows)


def test_anchors_depend_on_the_string_alone():
    rng = np.random.default_rng(0)
    body = rng.integers(97, 100, 60).astype(np.uint8)
    a = np.concatenate([rng.integers(0, 255, 50).astype(np.uint8), body, rng.integers(0, 255, 20).astype(np.uint8)])
    data, offsets = np.concatenate([a, body]), np.array([0, len(a), len(a) + len(body)])
    segment, g, _, _, at, low, high, times, _ = anchors(data, offsets, 40, 12)
    assert set(times) == {1}
    for start in range(21):  # strings of the body, in both segments
        one = next((int(x), int(p) - 50 - start) for s, x, p, lo, hi in zip(segment, g, at, low, high) if s == 0 and lo <= 50 + start <= hi)
        two = next((int(x), int(p) - start) for s, x, p, lo, hi in zip(segment, g, at, low, high) if s == 1 and lo <= start <= hi)
        assert one == two
    assert sum(hi - lo + 1 for lo, hi in zip(low, high)) == len(a) - 39 + 21


def test_multikey_order():
    rng = np.random.default_rng(1)
    rows = rng.integers(97, 99, (300, 24)).astype(np.uint8)
    rows[100:200] = rows[:100]
    group = rng.integers(0, 4, 300)
    order, common = multikey_order(group, rows.view(">u8").astype(np.uint64))
    keys = [(int(group[i]), bytes(rows[i])) for i in order]
    assert keys == sorted(keys)
    for (g, x), (h, y), n in zip(keys, keys[1:], common[1:], strict=False):
        assert n == (-1 if g != h else next((i for i in range(24) if x[i] != y[i]), 24))


def test_repeated_range_against_all_strings():
    rng = random.Random(2)
    for _ in range(200):
        anchor = bytes(rng.choice(b"xy") for _ in range(6))
        rows = []
        for _ in range(rng.randrange(2, 9)):
            left = bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 6)))
            right = bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 6)))
            # Strings of 12 bytes that hold the anchor.
            if len(left) + 6 + len(right) >= 12:
                rows.append((left + anchor + right, len(left)))
        if not rows:
            continue
        strings = [{(p - s): raw[s : s + 12] for s in range(len(raw) - 11)} for raw, p in rows]
        most, fewest = repeated_range(np.zeros(len(rows), dtype=np.int64), [r for r, _ in rows], np.array([p for _, p in rows]), 12)
        times = Counter((a, s) for own in strings for a, s in own.items())
        for i, own in enumerate(strings):
            again = [a for a, s in own.items() if times[a, s] > 1]
            assert (most[i], fewest[i]) == ((max(again), min(again)) if again else (-1, -1))


@pytest.mark.parametrize("group_rows", [100_000, 2])
def test_documents_against_every_string(spark, group_rows):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(14) for _ in range(4)]
    rows = [(None, None), (1, None), (2, ""), (3, "short"), (4, "a" * 500), (5, "ab" * 300 + "c"), (6, text(9)), (None, passages[0])]
    for i in range(60):
        parts = [text(rng.randrange(0, 12)) for _ in range(3)]
        parts.insert(rng.randrange(3), rng.choice(passages))
        rows.append((10 + i, " ".join(parts)))
    base = text(80)
    rows += [(100, base), (101, base), (101, base), (102, base[:200] + "#" + base[200:]), (103, base[57:])]
    rows += [(200, passages[1] * 3), (201, "x" + passages[1][5:] + "y" + passages[2][:30])]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, mark string").repartition(5)
    got = digest(remove_repeats(docs, 40, 12, group_rows).collect())
    assert got == brute(rows, 40)
    assert remove_repeats(docs.limit(0), 40, 12).count() == 0


@pytest.mark.parametrize("segment", [40, 257])
def test_segments_do_not_matter(spark, segment):
    rng = random.Random(3)
    text = "".join(rng.choice("abc d") for _ in range(3000))
    rows = [(1, text), (2, text[500:1700] + "!" + text[1701:]), (3, text[:90] + text[300:])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert digest(remove_repeats(docs, 40, 12, segment=segment).collect()) == brute(rows, 40)


def test_words_of_equal_polynomials_are_different(spark):
    """Both words have one value under the polynomial that picks anchors; before the same letters only the latter repeat."""
    one, other = "m" * 26, "onmnjokonpkmkonmppnlplmllm"
    rng = random.Random(9)
    tail = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(480))
    rows = [(1, one + tail), (2, other + tail)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = digest(remove_repeats(docs).collect())
    assert got == brute(rows, 400)
    assert {r[2] for r in got} == {481}  # both words end in the same letter


@pytest.mark.parametrize("group_rows", [100_000, 1])
@pytest.mark.parametrize("segment", [1 << 20, 97])
def test_runs_against_every_string(spark, group_rows, segment):
    rng = random.Random(11)
    text = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    rows = [(1, "a" * 700), (2, "ab" * 300 + "c" + "ab" * 30), (3, text(50) + "-=" * 90 + text(50)), (4, "-----+" * 60), (5, text(30) + "a" * 39), (6, "a" * 40 + text(30))]
    rows += [(7, "x" * 39 + "y" + "x" * 45), (8, text(20) + "-----+" * 8 + text(20)), (9, " " * 41), (10, text(40) + " " * 60 + text(5)), (11, "b" * 40), (12, ("q" * 45 + text(3)) * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert digest(remove_repeats(docs, 40, 12, group_rows, segment).collect()) == brute(rows, 40)
    for i in range(len(rows)):  # one run alone repeats itself
        alone = spark.createDataFrame(rows[i : i + 1], docs.schema)
        if i in (0, 3, 8, 10):
            assert digest(remove_repeats(alone, 40, 12, group_rows, segment).collect()) == brute(rows[i : i + 1], 40)


def test_a_run_is_few_suffixes():
    for unit in (b" ", b"ab", b"-" * 79 + b"\n"):
        data = np.frombuffer(unit * (1_000_000 // len(unit)), dtype=np.uint8)
        *_, low, _, times, last = anchors(data, np.array([0, len(data)]))
        assert len(low) <= 8
        assert low[0] == 0 and last[-1] == len(data) - 400


def test_query_against_every_string(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = Counter(tuple(r) for r in op2_suffix_dedup(spark, sf).collect())
    assert got == brute(rows, 400)
