import re
from collections import defaultdict

import pytest

from skyledger.llm.mixing import mix, op5_mixing


def plain_targets(sizes):
    """Shares by weight; whoever is above three times its size stops there, until none is."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), {}
    while True:
        left = total - sum(stopped.values())
        free = [s for s in names if s not in stopped]
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = [s for s in free if share[s] > 3 * sizes[s]]
        if not above:
            return stopped | share
        stopped |= {s: 3.0 * sizes[s] for s in above}


def check(rows, texts):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, text, source in texts:
        sizes[source] += size(text)
    want = plain_targets(sizes) if sizes else {}
    assert len(rows) == len(texts)
    by_id = defaultdict(list)
    for doc_id, text, source in texts:
        by_id[doc_id].append((size(text), source))
    for r in rows:
        source = next(s for n, s in by_id[r.doc_id] if n == r.size)
        assert r.source_size == sizes[source] and r.target == pytest.approx(want[source])
        assert 0 <= r.copies * r.size <= 3 * r.size
        taken[source] += r.copies * r.size
        largest[source] = max(largest[source], r.size)
    for source in sizes:
        assert abs(taken[source] - want[source]) <= max(largest[source], 0.01 * want[source]) * 0.51 + 1


def test_nulls_repeats_stopped_targets_and_clashing_columns(spark):
    rows = [(1, "a b c", "s1", 9), (1, "a b c", "s1", 9), (2, None, "s1", 9), (3, "x " * 900, "s2", 9), (4, "", None, 9), (5, "w\x0b w\xa0w", None, 9), (None, "q r", "s3", 9), (6, "   ", "s4", 9)]
    rows += [(10 + i, "k " * (i % 5 + 1), "s5", 9) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = mix(docs)
    check(got.collect(), [r[:3] for r in rows])
    assert sorted(got.drop("text").columns) == sorted(["doc_id", "source", "size", "source_size", "target", "rate", "copies"])
    assert mix(docs.limit(0)).count() == 0
    again = mix(docs.repartition(5)).groupBy("doc_id", "copies").count()
    assert got.groupBy("doc_id", "copies").count().exceptAll(again).count() == 0


def test_query_meets_its_targets(spark):
    sf = "/root/testdata/sf0.01"
    texts = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source").collect()]
    check(op5_mixing(spark, sf).collect(), texts)
