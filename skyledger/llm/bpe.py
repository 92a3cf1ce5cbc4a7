"""Byte-level BPE by dynamic programming over prefixes, exact to the token id.

Every prefix of a piece of text has one BPE encoding, so one last token. Working through the prefixes, the
suffix automaton of the vocabulary reports all tokens that end at a prefix, longest first. A token is the last
one of that prefix if it is compatible with the last token of the prefix before it: undoing their merges from
the latest on, no pair across the border may exist whose merge ranks before those undone. That test looks at
the two tokens alone. Following the stored tokens back from the end gives the ids.

Texts are first split at special tokens and then by the vocabulary's pattern, as the merges never cross pieces.
Pieces repeat (words), so each Python worker keeps the ids of pieces seen, up to ``MEMO_PIECES``.

A null or empty text has no ids and decodes to the empty text. Each row is encoded on its own: repeated rows
give repeated results, an empty table an empty one, and texts of any length are encoded whole.
"""

from __future__ import annotations

import json
from array import array
from functools import lru_cache
from itertools import chain

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import map_texts, small_batches, table

#: Pieces whose ids a worker remembers, in two generations.
MEMO_PIECES = 1 << 18
#: Longer pieces are not remembered.
MEMO_LENGTH = 64

# Fixed value: the split of the byte-level pre-tokenizer.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """Encoder and decoder for a byte-level vocabulary in a tokenizers JSON file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        letters = byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        vocabulary = stated["model"]["vocab"]
        self.spelt: dict[int, bytes] = {number: raw(token) for token, number in vocabulary.items()}
        self.special = {t["content"]: t["id"] for t in stated.get("added_tokens", [])}
        self.spelt |= {number: content.encode() for content, number in self.special.items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in stated["model"]["merges"]]
        # Of each token: the rank of the merge that makes it (-1: a byte) and the two tokens merged.
        self.rank: dict[int, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for rank, (left, right) in enumerate(merges):
            pair, whole = (vocabulary[left], vocabulary[right]), vocabulary[left + right]
            self.merged.setdefault(pair, rank)
            if whole not in self.rank:
                self.rank[whole], self.halves[whole] = rank, pair
        self.product = [vocabulary[left + right] for left, right in merges]
        self.byte_token = {raw(letter)[0]: vocabulary[letter] for letter in letters if letter in vocabulary}
        self.made: dict[int, bool] = {}
        self.matches = ahocorasick.Automaton()
        for token, number in vocabulary.items():
            if number in self.rank or len(token) == 1:
                self.rank.setdefault(number, -1)
                self.matches.add_word(raw(token).decode("latin-1"), (number, len(token)))
        self.matches.make_automaton()
        self.fits = lru_cache(1 << 16)(self._fits)
        self.split = regex.compile(SPLIT).findall
        self.at_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.memo = _Memo(self)

    def _fits(self, left: int, right: int) -> bool:
        """Whether BPE leaves the border between these two tokens alone."""
        rank, halves, merged = self.rank, self.halves, self.merged
        # Undo the later of the two tokens' merges; a pair across the border that ranks before everything
        # undone so far would have been merged first. At equal ranks the left merge came first.
        undone, undone_left = len(merged) + 1, False
        while True:
            across = merged.get((left, right))
            if across is not None and (across < undone or across == undone and not undone_left):
                return False
            a, b = rank[left], rank[right]
            if a < 0 and b < 0:
                return True
            if b >= a:
                undone, undone_left, right = b, False, halves[right][0]
            else:
                undone, undone_left, left = a, True, halves[left][1]

    def encode_piece(self, piece: bytes) -> list[int]:
        # Of each prefix: its last token and where that begins.
        last, begins = [-1] * (len(piece) + 1), [0] * (len(piece) + 1)
        fits, ended = self.fits, -1
        for at, (token, length) in self.matches.iter(piece.decode("latin-1")):
            if at == ended:
                continue
            start = at + 1 - length
            if self.alone(token, length) and (start == 0 or fits(last[start], token)):
                last[at + 1], begins[at + 1], ended = token, start, at
        ids, at = [], len(piece)
        while at:
            ids.append(last[at])
            at = begins[at]
        return ids[::-1]

    def alone(self, token: int, length: int) -> bool:
        """Whether BPE makes this token from its own bytes at all; only such tokens occur."""
        made = self.made.get(token)
        if made is None:
            made = self.made[token] = length == 1 or self._merged_alone(token)
        return made

    def _merged_alone(self, token: int) -> bool:
        """Merge the bytes of one vocabulary entry, lowest rank first."""
        spelt, merged = self.spelt[token], self.merged
        parts = [self.byte_token[b] for b in spelt]
        while len(parts) > 1:
            rank, at = min((merged.get(pair, len(merged)), i) for i, pair in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == len(merged):
                return False
            parts[at : at + 2] = [self.product[rank]]
        return parts == [token]

    def encode(self, text: str | None) -> array:
        if not text:
            return array("I")
        if self.at_special is None or not self.at_special.search(text):
            return array("I", chain.from_iterable(map(self.memo.__getitem__, self.split(text))))
        ids, at = array("I"), 0
        for m in self.at_special.finditer(text):
            ids.extend(chain.from_iterable(map(self.memo.__getitem__, self.split(text[at : m.start()]))))
            ids.append(self.special[m[0]])
            at = m.end()
        ids.extend(chain.from_iterable(map(self.memo.__getitem__, self.split(text[at:]))))
        return ids

    def decode(self, ids) -> str:
        return b"".join(map(self.spelt.__getitem__, ids)).decode("utf-8", "replace")


class _Memo(dict):
    """Ids of pieces seen; when full it becomes the older generation, from which pieces that come again return."""

    def __init__(self, bpe: Bpe) -> None:
        super().__init__()
        self.bpe = bpe
        self.older: dict[str, tuple[int, ...]] = {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.older.get(piece)
        if ids is None:
            ids = tuple(self.bpe.encode_piece(piece.encode()))
        if len(piece) <= MEMO_LENGTH:
            if len(self) >= MEMO_PIECES // 2:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


@lru_cache(2)
def load(path: str) -> Bpe:
    """The vocabulary, read once by each Python worker."""
    return Bpe(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode(docs: DataFrame, vocabulary: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The ``keep`` columns, ``ids`` (array of int) and ``decoded`` text of every row."""
    return _mapped(docs, vocabulary, keep, text, digests=False)


def _mapped(docs: DataFrame, vocabulary: str, keep: tuple[str, ...], text: str, digests: bool) -> DataFrame:
    small_batches(docs.sparkSession)
    rows = docs.select(*keep, text)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = load(vocabulary)
        ids = [bpe.encode(t) for t in batch.column(len(keep)).to_pylist()]
        decoded = pa.array([bpe.decode(i) for i in ids], pa.string())
        if digests:  # the ids as bytes, so that they can be hashed without leaving Arrow
            made = [pa.array([len(i) for i in ids], pa.int64()), pa.array([_little(i) for i in ids], pa.binary()), decoded]
            names = ["n_tokens", "id_bytes", "decoded"]
        else:
            made = [pa.array(ids, pa.list_(pa.int32())), decoded]
            names = ["ids", "decoded"]
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], [*keep, *names])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    columns = "n_tokens long, id_bytes binary, decoded string" if digests else "ids array<int>, decoded string"
    return map_texts(rows, len(keep), work, f"{kept}, {columns}")


def _little(ids: array) -> bytes:
    import sys

    if sys.byteorder == "big":
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()


def encoded_digests(docs: DataFrame, vocabulary: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """Per row: number of ids, SHA-256 of the ids as little-endian 32-bit integers and of the decoded text."""
    return _mapped(docs, vocabulary, keep, text, digests=True).select(
        *keep,
        "n_tokens",
        F.sha2("id_bytes", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(table(spark, sf_dir, "documents"), default_path())
