import hashlib
from collections import Counter

from skyledger.llm.fingerprint import digest, likeness, neighbour_digests, op8_fingerprint


def plain(rows):
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) in a loop."""
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        n = len(text) // 4
        new = text[: len(text) - n] + after[:n]
        out.append((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), digest(text), digest(new), likeness(digest(text), digest(new)), likeness(digest(text), digest(after))))
    return out


def test_likeness_orders_changes():
    text = "".join(f"word{i % 37} went by the {i % 11} river " for i in range(200))
    other = "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich. " * 60
    assert likeness(digest(text), digest(text)) == 1
    assert likeness(digest(text), digest(text[:-60] + "something else here")) > likeness(digest(text), digest(text[:4000] + other[:2000]))
    assert likeness(digest(text), digest(other)) < 0.5
    assert digest("") == digest("abc")[:0] + digest("") and len(digest("abc")) == 68


def test_rows_nulls_ties_and_clashing_columns(spark):
    rows = [(5, "fünf " * 9, "a"), (None, "none", "a"), (1, "one one one", "b"), (5, "fünf " * 9, "a"), (9, None, None), (7, "", "x"), (8, "x" * 300_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    want = plain(sorted([r[:2] for r in rows], key=lambda r: -1 if r[0] is None else r[0]))
    assert Counter(tuple(r) for r in neighbour_digests(docs).collect()) == Counter(want)
    assert neighbour_digests(docs.limit(0)).count() == 0
    one = neighbour_digests(docs.where("doc_id = 1")).collect()
    assert [tuple(r) for r in one] == plain([(1, "one one one")])


def test_query_against_a_loop(spark):
    sf = "/root/testdata/sf0.001"
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    got = op8_fingerprint(spark, sf).collect()
    assert Counter(tuple(r) for r in got) == Counter(plain(rows))
    assert sum(r.near_edited > r.near_next for r in got) > 0.8 * len(got)
