import random

import pytest
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skyledger.llm.token_counts import TokenCounter, content, default_path, load, op11_token_counts, stored, token_counts

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    parts = ["a", "The", "CAT", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x0c", "\x1c", "\x85", "\xa0", " ", "é", "É", "H̱", "ẖ", "Σ", "ΑΣ", "İ", "ß", "'s", "'LL", "n't", "0", "12", "---", "%", "日本", "🙂", "́", "<|endoftext|>", "<|ENDOFTEXT|>", "<|endof", "<|startoftext|>", "|>", "_", "١", "\x00", "▁"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(n)]


def test_counts_equal_the_library_on_odd_texts(library):
    counter = TokenCounter(WORDS)
    texts = odd_texts(4000)
    assert counter.folds
    assert counter.counts(texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    long = " ".join(odd_texts(3000, 2))
    assert counter.counts([long, "x" * 30_000]) == [len(library.encode(t, add_special_tokens=False).ids) for t in (long, "x" * 30_000)]


def test_content_has_the_count_of_its_text(spark, library):
    texts = [*odd_texts(1500, 3), *(t.encode("ascii", "ignore").decode() for t in odd_texts(1500, 4)), " A  b\n", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", content(F.col("text"), True).alias("content")).collect()
    n = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    assert all(n(r.text) == n(r.content) for r in rows)
    assert len({r.content for r in rows}) < len(set(texts))


@pytest.mark.parametrize("path", [PIECES, BYTES])
def test_other_tokenizers_get_whole_texts(spark, tmp_path, path):
    texts = [t.replace("\x00", "") for t in odd_texts(300, 5)]
    if path == PIECES:
        want = list(map(len, sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)))
    else:
        want = [len(e.ids) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts(docs, path, str(tmp_path / "cache")).collect()}
    assert [got[i] for i in range(len(texts))] == want
    assert not load(path).folds


def test_cache_encodes_only_distinct_misses(spark, tmp_path):
    cache, version = str(tmp_path / "cache"), load(WORDS).version
    size = lambda: spark.read.parquet(f"{cache}/version={version}").count()
    docs = spark.createDataFrame([(1, "The cat"), (2, "the  CAT"), (3, "a dog"), (4, None)], "doc_id long, text string")
    first = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts(docs, WORDS, cache).collect()}
    assert first == {1: (7, 2), 2: (8, 2), 3: (5, 2), 4: (0, 0)}
    assert size() == 3  # one row for the first two
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts(docs, WORDS, cache).collect()} == first
    assert size() == 3  # nothing was encoded again
    more = docs.union(spark.createDataFrame([(5, "two birds here")], docs.schema))
    assert {r.doc_id: r.n_tokens for r in token_counts(more, WORDS, cache).collect()}[5] == 3
    assert size() == 4
    # A count that is stored is taken as it is; another version is encoded anew.
    spark.read.parquet(f"{cache}/version={version}").withColumn("n_tokens", F.col("n_tokens") + 100).coalesce(1).write.parquet(f"{tmp_path}/wrong/version={version}")
    assert {r.n_tokens for r in token_counts(docs, WORDS, f"{tmp_path}/wrong").collect()} == {100, 102}
    token_counts(docs, BYTES, cache)
    assert stored(spark, cache, load(BYTES).version).count() == 4 and size() == 4
    # Rows appended twice by two runs at once count once.
    spark.read.parquet(f"{cache}/version={version}").write.mode("append").parquet(f"{tmp_path}/wrong2/version={version}")
    spark.read.parquet(f"{cache}/version={version}").write.mode("append").parquet(f"{tmp_path}/wrong2/version={version}")
    assert token_counts(more, WORDS, f"{tmp_path}/wrong2").count() == 5


def test_many_misses_beside_stored_counts(spark, tmp_path, monkeypatch, library):
    monkeypatch.setattr("skyledger.llm.token_counts.FEW_MISSES", 2)
    cache = str(tmp_path / "cache")
    rows = [(i, f"word{i % 40} and more") for i in range(200)] + [(i, "a hot text") for i in range(1000, 1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    token_counts(docs.where("doc_id < 10"), WORDS, cache)
    got = {r.doc_id: r.n_tokens for r in token_counts(docs, WORDS, cache).collect()}
    assert got == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in rows}
    assert spark.read.parquet(cache).count() == 41


def test_nulls_repeats_clashes_and_empty_tables(spark, tmp_path):
    rows = [(1, "the cat", 5, b"x", "y"), (1, "the cat", 5, b"x", "y"), (None, None, None, None, None), (2, "", 1, b"", "")]
    docs = spark.createDataFrame(rows, "digest long, text string, n_tokens int, content binary, version string")
    got = token_counts(docs, WORDS, str(tmp_path / "a"), keep=("digest", "version")).collect()
    assert sorted((r.digest or 0, r.version or "", r.n_bytes, r.n_tokens) for r in got) == [(0, "", 0, 0), (1, "y", 7, 2), (1, "y", 7, 2), (2, "", 0, 0)]
    assert token_counts(docs.limit(0), WORDS, str(tmp_path / "b"), keep=("digest",)).count() == 0


def test_query_equals_the_library(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op11_token_counts(spark, sf).collect()
    assert len(rows) == len(texts) and default_path() == WORDS
    for r in rows:
        n = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 2048)
