import hashlib
import random
import struct

import pytest
from tokenizers import Tokenizer

from skyledger.llm.bpe import default_path, encode, load, op9_bpe


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_path())


def test_ids_equal_the_library_on_random_texts(library):
    rng, bpe = random.Random(3), load(default_path())
    alphabet = ["a", "aa", "the", " ", "  ", "\n", "\t", "é", "ß", "ing", "Q", "'s", "'ll", "0", "12", "---", "%%%", "日本", "🙂", " ", " ", "\x1c", "\x85", "é", "<|endoftext|>", "<|endof", "_", "١"]
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(30)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert list(bpe.encode(text)) == ids, text
        assert bpe.decode(ids) == library.decode(ids, skip_special_tokens=False) == text
    for text in ("a" * 5000, "ab" * 3000, " " * 3000, "".join(rng.choice("abcdefgh") for _ in range(20_000))):
        assert list(bpe.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_split_agrees_on_every_character(library):
    bpe = load(default_path())
    odd = []
    for point in [*range(0xD800), *range(0xE000, 0x11000)]:
        text = f"a{chr(point)} {chr(point)}1"
        if list(bpe.encode(text)) != library.encode(text, add_special_tokens=False).ids:
            odd.append(hex(point))
    assert not odd


def test_rows_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, "the cat", 1, "x"), (1, "the cat", 1, "x"), (None, None, None, None), (2, "", 5, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int, decoded string")
    got = sorted((r.doc_id or 0, tuple(r.ids), r.decoded) for r in encode(docs, default_path()).collect())
    ids = tuple(load(default_path()).encode("the cat"))
    assert got == [(0, (), ""), (1, ids, "the cat"), (1, ids, "the cat"), (2, (), "")]
    assert encode(docs.limit(0), default_path()).count() == 0


def test_query_equals_the_library(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op9_bpe(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
