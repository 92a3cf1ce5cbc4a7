import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tokenizers import Tokenizer

from skyledger.llm.alignment import MEASURES, align, default_paths, load, op12_alignment
from skyledger.llm.bpe import byte_letters


@pytest.fixture(scope="module")
def libraries():
    a, b = default_paths()
    first = Tokenizer.from_file(a)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=b)


def token_bytes(libraries, text):
    """Ids and bytes of both vocabularies by the libraries alone; none if they do not make up the text."""
    first, second = libraries
    letters = byte_letters()
    ids_a = first.encode(" " + text, add_special_tokens=False).ids if text else []
    spelt_a = [bytes(letters[c] for c in first.id_to_token(i)) for i in ids_a]
    ids_b = second.encode(text) if text else []
    pieces = [second.id_to_piece(i) for i in ids_b]
    spelt_b = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces)]
    if not text or b"".join(spelt_a) != (" " + text).encode() or b"".join(spelt_b) != (" " + text).encode():
        return [], [], [], []
    return ids_a, spelt_a, ids_b, spelt_b


def brute(libraries, texts):
    counts, found = Counter(), []
    for text in texts:
        ids_a, spelt_a, ids_b, spelt_b = token_bytes(libraries, text)
        groups, links, at_a, at_b, j, side_a, side_b = [], [], 0, 0, 0, [], []
        for a, s in zip(ids_a, spelt_a, strict=True):
            at_a += len(s)
            side_a.append(a)
            while at_b < at_a:
                at_b += len(spelt_b[j])
                side_b.append(ids_b[j])
                j += 1
            if at_a == at_b:
                links.append((a, ids_b[j - 1]))
                groups.append(f"{','.join(map(str, side_a))}|{','.join(map(str, side_b))}")
                side_a, side_b = [], []
        counts.update(links)
        found.append((len(ids_a), len(ids_b), groups, links))
    top = defaultdict(int)
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    out = []
    for n_a, n_b, groups, links in found:
        best = sum(counts[x] == top[x[1]] for x in links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((n_a, n_b, len(groups), len(links), best, sum(counts[x] for x in links), digest))
    return out, counts


def row(r):
    return (*(r[m] for m in MEASURES), r.groups_sha256)


PARTS = ["a", "The", " ", "  ", "   ", "\n", "\t", "é", "ß", "'s", "0", "12", "---", "日本", "🙂", "<s>", "<0x41>", "<|endoftext|>", "\x00", "_", "١", "ing", "ization", "\xa0", "́"]


def odd_texts(n, seed=1, more=()):
    rng = random.Random(seed)
    parts = [*PARTS, *more]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(20))) for _ in range(n)]


def test_byte_ids_equal_the_library(libraries):
    aligner = load(*default_paths())
    blanks = ["a" + " " * n + "b" for n in (999, 1000, 200_000)]
    for text in [*odd_texts(3000, 2), "x" * 300_000, *blanks]:
        assert aligner.ids_a(text) == libraries[0].encode(" " + text, add_special_tokens=False).ids, repr(text[:100])


def test_measures_of_odd_texts(spark, libraries):
    texts = [*odd_texts(400, 3, more=["▁"]), "the same text", "the same text", "the same text", "▁", " ", ""]
    rows = [(i, t, None) for i, t in enumerate(texts)] + [(None, None, 1), (7, None, 2)]
    want, counts = brute(libraries, [t or "" for _, t, _ in rows])
    docs = spark.createDataFrame(rows, "n_a long, text string, tid int")
    found, pairs = align(docs, *default_paths(), keep=("tid",))
    assert sorted(map(row, found.collect())) == sorted(want)
    assert {(r.a_id, r.b_id): r.links for r in pairs.collect()} == counts


def test_pairs_joined_by_a_shuffle(spark, libraries, monkeypatch):
    monkeypatch.setattr("skyledger.llm.alignment.BROADCAST_PAIRS", 0)
    texts = odd_texts(200, 4)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want, _ = brute(libraries, texts)
    assert {r.doc_id: row(r) for r in align(docs, *default_paths())[0].collect()} == dict(enumerate(want))


def test_long_text_and_empty_tables(spark, libraries):
    texts = [" ".join(odd_texts(3000, 5)), "x" * 20_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want, _ = brute(libraries, texts)
    assert {r.doc_id: row(r) for r in align(docs, *default_paths())[0].collect()} == dict(enumerate(want))
    assert align(docs.limit(0), *default_paths())[0].count() == 0
    nothing = spark.createDataFrame([(1, ""), (2, None)], docs.schema)
    assert {row(r) for r in align(nothing, *default_paths())[0].collect()} == {(0, 0, 0, 0, 0, 0, "")}


def test_query_equals_the_libraries(spark, libraries):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = {r.doc_id: row(r) for r in op12_alignment(spark, sf).collect()}
    assert len(rows) == len(docs)
    assert [rows[i] for i, _ in docs] == brute(libraries, [t for _, t in docs])[0]
