"""Secrets in texts: keyword automaton first, anchored patterns at its hits, checksums inside tokens last.

One pass of an Aho-Corasick automaton over the text (ASCII letters lower-cased) finds the keywords that can
begin a secret. Only there an anchored pattern is tried. Runs of hex digits have no keyword; they are sieved
by looking at every fourth character, since 16 digits in a row cover four of those. Tokens that carry a
checksum (``ghp_`` and relatives, ``npm_``: 30 characters and their CRC-32 in six base-62 digits) count only
if the checksum holds.

Null and empty texts have no spans. Every row is judged on its own, so repeated rows give repeated results
and an empty table an empty one. Texts of any length are searched whole.
"""

from __future__ import annotations

import re
import zlib
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import map_texts, small_batches, table

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "github", "npm")

# What starts a secret, and its form from there on.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
NPM = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

SPANS = "array<struct<kind:string,start:int,end:int>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
_HEX = np.zeros(128, dtype=bool)
_HEX[[ord(c) for c in "0123456789abcdef"]] = True
_HEX_DIGITS = frozenset("0123456789abcdef")


@cache
def _automaton() -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    starts = {word: "assign" for word in ASSIGN_WORDS} | {"akia": "access", "npm_": "npm"}
    starts |= {f"gh{kind}_": "github" for kind in "pousr"}
    for word, kind in starts.items():
        made.add_word(word, (kind, len(word)))
    made.make_automaton()
    return made


def checksum(body: str) -> str:
    """CRC-32 of the body in six base-62 digits."""
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits


def _hex_runs(text: str) -> list[tuple[int, int]]:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")[3::4]
    if len(points) < 4:
        return []
    digit = _HEX[np.minimum(points, 127)]
    runs, done = [], 0
    for i in np.flatnonzero(digit[:-3] & digit[1:-2] & digit[2:-1] & digit[3:]):
        at = 4 * int(i) + 3
        if at < done:
            continue
        start = at
        while start > 0 and text[start - 1] in _HEX_DIGITS:
            start -= 1
        done = at + 1
        while done < len(text) and text[done] in _HEX_DIGITS:
            done += 1
        if done - start >= 16:
            runs.append((start, done))
    return runs


def spans_of(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of a text, by start, then by kind as listed in ``KINDS``."""
    if not text:
        return []
    found: list[tuple[str, int, int]] = []
    low = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    past = dict.fromkeys(KINDS, 0)
    # The automaton reports by end; starts of one kind still ascend, as no keyword of a kind holds another.
    for last, (kind, length) in _automaton().iter(low):
        at = last - length + 1
        if at < past[kind]:
            continue
        if kind == "assign":
            if m := ASSIGN.match(text, at):
                past[kind] = m.end()
                if m.end(1) - m.start(1) >= 12:
                    found.append((kind, at, m.end()))
        elif kind == "access":
            if m := ACCESS.match(text, at):
                past[kind] = m.end()
                if m.end() - at >= 18:
                    found.append((kind, at, m.end()))
        elif (m := (GITHUB if kind == "github" else NPM).match(text, at)) and checksum(m[1]) == m[2]:
            past[kind] = m.end()
            found.append((kind, at, m.end()))
    found += [("hex", start, end) for start, end in _hex_runs(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def masked(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    """The text with every maximal covered stretch replaced by the mark."""
    out, at = [], 0
    for _, start, end in spans:
        if end <= at:
            continue
        if start >= at and (start > at or not out):
            out += [text[at:start], mark]
        at = end
    return "".join([*out, text[at:]])


def find_secrets(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The ``keep`` columns and ``spans`` (kind, start, end in code points) of every row."""
    small_batches(docs.sparkSession)
    rows = docs.select(*keep, text)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans_of(t)] for t in batch.column(len(keep)).to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(spans, _SPAN_TYPE)], [*keep, "spans"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return map_texts(rows, len(keep), work, f"{kinds}, spans {SPANS}")


def mask_secrets(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with its secrets replaced by ``mark``; all columns and rows stay, null texts too."""
    small_batches(docs.sparkSession)
    at = docs.columns.index(text)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t and masked(t, spans_of(t), mark) for t in batch.column(at).to_pylist()]
        columns = list(batch.columns)
        columns[at] = pa.array(texts, pa.string())
        return pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return map_texts(docs, at, work, docs.schema)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = find_secrets(table(spark, sf_dir, "documents"))
    is_base = lambda s: s["kind"].isin(*BASE_KINDS)
    told = lambda column: F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return spans.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(told(F.filter("spans", is_base)), 256).alias("base_sha256"),
        told(F.col("spans")).alias("spans"),
    )
