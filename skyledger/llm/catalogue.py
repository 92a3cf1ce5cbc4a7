"""The registered queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skyledger.llm.alignment import op12_alignment
from skyledger.llm.bpe import op9_bpe
from skyledger.llm.fingerprint import op8_fingerprint
from skyledger.llm.jaccard import op10_jaccard_join
from skyledger.llm.links import op1_url_filter
from skyledger.llm.mixing import op5_mixing
from skyledger.llm.neighbours import op6_nearest
from skyledger.llm.quality import op3_quality_classifier
from skyledger.llm.secrets import op7_secret_scan
from skyledger.llm.sharding import op4_sharding
from skyledger.llm.suffixes import op2_suffix_dedup
from skyledger.llm.token_counts import op11_token_counts
from skyledger.llm.whitening import op13_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_sharding": op4_sharding,
    "op5_mixing": op5_mixing,
    "op6_nearest": op6_nearest,
    "op7_secret_scan": op7_secret_scan,
    "op8_fingerprint": op8_fingerprint,
    "op9_bpe": op9_bpe,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_token_counts": op11_token_counts,
    "op12_alignment": op12_alignment,
    "op13_whitening": op13_whitening,
}

# Every string of 400 bytes by itself, in hexadecimal.
_REPEATS = r"""
with d as (select doc_id, row_number() over () as r, hex(encode(coalesce(text, ''))) as h from documents),
p as (select r, unnest(range(0, greatest(cast(length(h) // 2 - 399 as bigint), 0))) as i from d),
strings as (select p.r, p.i, md5(substring(d.h, cast(2 * p.i + 1 as bigint), 800)) as m from p join d on d.r = p.r),
again as (select r, i from strings qualify count(*) over (partition by m) > 1),
marked as (select r, i, case when i <= lag(i) over (partition by r order by i) + 400 then 0 else 1 end as opens from again),
runs as (select r, i, sum(opens) over (partition by r order by i) as run from marked),
spans as (select r, run, min(i) as a, max(i) + 400 as b from runs group by r, run),
cuts as (select r, a, b, coalesce(lag(b) over (partition by r order by a), 0) as since from spans),
kept as (select c.r, count(*) as n_spans, sum(b - a) as n_removed, max(b) as last,
    string_agg(substring(d.h, cast(2 * since + 1 as bigint), cast(2 * (a - since) as bigint)), '' order by a) as head
  from cuts c join d on d.r = c.r group by c.r)
select d.doc_id, cast(length(d.h) // 2 as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  cast(coalesce(n_spans, 0) as bigint) as n_spans,
  sha256(unhex(case when n_spans is null then d.h else head || substring(d.h, cast(2 * last + 1 as bigint)) end)) as kept_sha256
from d left join kept k on k.r = d.r
"""

# All pairs that share a shingle, and all that reach each other over links.
_COMPONENTS = r"""
with recursive w as (
  select doc_id, row_number() over () as r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words
  from documents),
s as (select doc_id, r, list_distinct(case when len(words) = 0 then [] when len(words) < 4 then [array_to_string(words, ' ')]
    else list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) end) as shingles from w),
e as (select r, len(shingles) as n, unnest(shingles) as shingle from s),
links as (select a.r as a, b.r as b from e a join e b on a.shingle = b.shingle and a.r < b.r
  group by a.r, b.r, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
both_ways as (select a, b from links union all select b, a from links),
reach as (select r as a, r as b from s union select reach.a, both_ways.b from reach join both_ways on reach.b = both_ways.a)
select s.doc_id, cast(len(s.shingles) as bigint) as n_shingles, min(o.doc_id) as component_id
from s join reach on reach.a = s.r join s o on o.r = reach.b group by s.r, s.doc_id, s.shingles
"""

#: The others have no SQL: fitted models, byte hashes, rounding to copies, vocabularies, patterns with places.
ORACLE_SQL: dict[str, str] = {
    "op2_suffix_dedup": " ".join(_REPEATS.split("\n")),
    "op10_jaccard_join": " ".join(_COMPONENTS.split("\n")),
}
