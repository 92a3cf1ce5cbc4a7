import random
import zlib
from collections import Counter, defaultdict

from skyledger.llm import sharding
from skyledger.llm.sharding import TICKETS, cut, op4_sharding, propagate, shard_documents


def check(rows, texts, shards):
    """Sizes, checksums, gapless slots, even counts; returns the shards of each text."""
    want = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in texts)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(0 <= s < shards for s in slots)
    for held in slots.values():
        assert sorted(held) == list(range(len(held)))
    counts = [len(slots.get(s, ())) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    places = defaultdict(Counter)
    for r in rows:
        places[r.text_crc32, r.size][r.shard] += 1
    return places


def test_groups_stay_together_and_counts_even(spark):
    texts = [(i, f"text {i}") for i in range(400)]
    texts += [(1000 + i, f"pair {i % 60}") for i in range(120)]
    texts += [(2000 + i, "hot") for i in range(300)] + [(3000 + i, f"five {i % 8}") for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("shard", docs_col(spark))
    rows = shard_documents(docs, shards=6).collect()
    places = check(rows, texts, 6)
    pairs = [p for p in places.values() if sum(p.values()) == 2]
    assert sum(len(p) == 1 for p in pairs) > 0.9 * len(pairs)
    again = shard_documents(docs.repartition(3), shards=6).collect()
    assert Counter(again) == Counter(rows)


def docs_col(spark):
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_nulls_repeats_and_small_tables(spark):
    texts = [(1, None), (1, None), (None, "x"), (2, "x"), (2, "x"), (3, ""), (4, ""), (5, "z" * 100_000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    check(shard_documents(docs, shards=3).collect(), texts, 3)
    check(shard_documents(docs, shards=24).collect(), texts, 24)
    assert shard_documents(docs.limit(0)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    texts = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows = op4_sharding(spark, sf).collect()
    places = check(rows, texts, 24)
    groups = [p for p in places.values() if sum(p.values()) > 1]
    assert sum(len(p) == 1 for p in groups) > 0.9 * len(groups)
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}


def test_groups_below_the_quota_are_not_cut(spark):
    """One part for a group that fits into a shard, however many copies it has."""
    sizes = (501, 1_200, 3_000)
    texts = [(i, f"text {i}") for i in range(12_000)]
    texts += [(100_000 + 10_000 * g + i, f"hot {g}") for g, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    places = check(shard_documents(docs, shards=4).collect(), texts, 4)
    groups = [p for p in places.values() if sum(p.values()) > 1]
    assert sorted(sum(p.values()) for p in groups) == list(sizes)
    assert all(max(p.values()) > 0.9 * sum(p.values()) for p in groups)


def test_copies_only_are_whole(spark):
    """Shards are full of linked rows, so groups have to change places; all sizes divide the quota."""
    texts = [(2 * i + j, f"pair {i}") for i in range(3_000) for j in range(2)]
    texts += [(100_000 + 10 * i + j, f"ten {i}") for i in range(600) for j in range(10)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    places = check(shard_documents(docs, shards=6).collect(), texts, 6)
    assert len(places) == 3_600 and all(len(p) == 1 for p in places.values())


def test_only_what_fits_no_shard_comes_apart(spark):
    texts = [(3 * i + j, f"three {i}") for i in range(100) for j in range(3)] + [(1000 + i, "large") for i in range(155)]
    texts += [(2000 + i, f"half {i % 3}") for i in range(180)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    places = check(shard_documents(docs, shards=6).collect(), texts, 6)
    apart = [sum(p.values()) for p in places.values() if len(p) > 1]
    assert 155 in apart and len(apart) < 1 + 6


def label_rows(spark, texts):
    """A label table from lists of rows held by shard."""
    rows = [(b"%06d" % i, sum(held), [(k, s) for s, k in enumerate(held) if k]) for i, held in enumerate(texts)]
    return spark.createDataFrame(rows, "text_key binary, n long, held array<struct<k: long, shard: int>>")


def test_texts_gather_where_most_of_their_rows_are(spark):
    labels = label_rows(spark, [(3, 1, 0), (0, 2, 5), (1, 4, 1)])
    settled, left, room = propagate(labels, [20, 20, 20], "test")
    assert left.count() == 0 and len(settled) == 1 and room == [16, 14, 13]
    assert {r.text_key[-1:]: r.shard for r in settled[0].collect()} == {b"0": 0, b"1": 2, b"2": 1}


def test_full_shards_send_wishes_on(spark):
    """All texts wish for shard 0, which has room for the largest only; the others vote again until all have gathered."""
    labels = label_rows(spark, [(6, 0, 0)] + [(3, 1, 0)] * 4 + [(2, 0, 0)] * 2)
    settled, left, room = propagate(labels, [10, 8, 8], "test")
    assert left.count() == 0 and room == [0, 0, 0] and len(settled) > 1
    assert settled[0].where("n = 6 and shard = 0").count() == 1


def test_rounds_fill_the_room_and_no_more(spark):
    rng = random.Random(1)
    for shards in (1, 3, 7):
        quota = [rng.randint(30, 40)] * shards
        texts, left = [], sum(quota)
        while (n := rng.randint(2, quota[0])) <= left:
            held = Counter(rng.randrange(shards) for _ in range(n))
            texts.append([held[s] for s in range(shards)])
            left -= n
        parts, rest, room = propagate(label_rows(spark, texts), quota, "test")
        placed = [r for part in parts for r in part.collect()]
        load = Counter()
        for r in placed:
            load[r.shard] += r.n
        rest = rest.collect()
        assert room == [q - load[s] for s, q in enumerate(quota)] and min(room) >= 0
        assert sorted(r.n for r in placed + rest) == sorted(map(sum, texts))
        assert len(rest) < shards and all(r.n > max(room) for r in rest)


def test_pieces_hold_all_rows_of_a_text():
    room = [5, 9, 0, 7]
    pieces = cut(18, room)
    assert pieces == [(TICKETS // 2, 1), (TICKETS * 16 // 18, 3), (TICKETS, 0)] and room == [3, 0, 0, 0]


def test_rows_repeated_in_full_spread_over_tasks(spark, monkeypatch):
    """Copies of one row are numbered apart, written out in parts, and stay whole where they fit."""
    monkeypatch.setattr(sharding, "COPY_ROWS", 100)
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 50)
    texts = [(7, "same")] * 950 + [(8, "other")] * 100 + [(9, None)] * 450 + [(i, f"text {i}") for i in range(100, 1_600)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = shard_documents(docs, shards=3).collect()
    places = check(rows, texts, 3)
    assert all(len(places[zlib.crc32(t), len(t) + 8]) == 1 for t in (b"same", b"other"))
    assert Counter(shard_documents(docs.repartition(5), shards=3).collect()) == Counter(rows)
