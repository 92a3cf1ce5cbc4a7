import re
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from test_jaccard import brute as brute_components
from test_mixing import plain_targets
from tokenizers import Tokenizer

from skyledger.llm.bpe import default_path
from skyledger.llm.quality import KEEP_FROM, features, trained
from skyledger.llm.secrets import masked, spans_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before the first and after each stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert made.dtypes == docs.dtypes
        out.append(made.collect())
        docs = spark.createDataFrame(out[-1], made.schema)
    return out


def test_quality_keeps_what_scores_well(spark, stages):
    model = trained(spark, spark.createDataFrame(stages[0]), SF)
    texts = [r.text for r in stages[0]]
    tails = model.tails(*features(pa.array(texts)), len(texts))[:, -1]
    assert Counter(stages[1]) == Counter(r for r, t in zip(stages[0], tails, strict=True) if t >= KEEP_FROM)
    assert len(stages[1]) > 0.8 * len(stages[0])


def test_one_of_each_group_stays(stages):
    named = brute_components([(r.doc_id, r.text) for r in stages[1]], 5, 80)
    assert {r.doc_id for r in stages[2]} == {c for _, _, c in named}
    assert len(stages[2]) == len({c for _, _, c in named}) < len(stages[1])
    assert not Counter(stages[2]) - Counter(stages[1])


def test_secrets_are_masked(stages):
    want = Counter((r.doc_id, masked(r.text, spans_of(r.text), "[SECRET]")) for r in stages[2])
    assert Counter((r.doc_id, r.text) for r in stages[3]) == want
    assert all(r.n_chars == len(r.text) and not spans_of(r.text) for r in stages[3])


def test_mix_meets_its_targets(stages):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    before, after, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in stages[3]:
        before[r.source] += size(r.text)
        largest[r.source] = max(largest[r.source], size(r.text))
    for r in stages[4]:
        after[r.source] += size(r.text)
    assert max(Counter(stages[4]).values()) <= 3 and not set(stages[4]) - set(stages[3])
    for source, target in plain_targets(before).items():
        assert abs(after[source] - target) <= 0.51 * max(largest[source], 0.02 * target) + 1


def test_ids_equal_the_library(stages):
    library = Tokenizer.from_file(default_path())
    want = Counter((r.doc_id, r.lang, r.source, tuple(library.encode(r.text, add_special_tokens=False).ids)) for r in stages[4])
    assert Counter((r.doc_id, r.lang, r.source, tuple(r.ids)) for r in stages[5]) == want
    assert all(r.exact and r.n_tokens == len(r.ids) for r in stages[5])


def test_run_equals_its_stages(spark, stages):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == Counter((r.doc_id, tuple(r.ids)) for r in stages[5])


def test_nulls_repeats_and_empty_tables(spark):
    long = " ".join(f"w{i}" for i in range(50))
    rows = [(1, long, "en", "s", 9), (1, long, "en", "s", 9), (2, long, "en", None, 9), (None, None, None, None, None), (3, "", "en", "s", 0), (None, long, "de", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_copies(spark, docs, SF).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter([(1, long), (None, None), (3, "")])
    for start in (docs, docs.limit(0)):
        made = start
        for _, stage in corpus_pipeline.STAGES:
            made = stage(spark, made, SF)
        assert made.count() == (0 if start is not docs else made.count())
    assert np.isfinite(made.count())
