from __future__ import annotations

import re

import numpy as np
import pytest

import corpus_pipeline as P
from tests.llm.test_jaccard_join import brute as components
from tests.llm.test_line_dedup import brute as lines
from tidemark.llm import toxicity
from tidemark.llm.common import table

tokenizers = pytest.importorskip("tokenizers")
vocabularies = pytest.importorskip("public_tokenizers")
DATA = "/root/testdata/sf0.001"


def test_whole_pipeline_against_brute_force(spark):
    docs = table(spark, DATA, "documents")
    model = toxicity.train(docs, table(spark, DATA, "labels"), split_severe=True)
    lookup = toxicity._Lookup(model.names)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    above = lambda t: model.above(np.array([model.weights[toxicity.present(t, lookup)].sum()])).sum()
    rows = [(i, t) for i, t in rows if above(t) < P.SEVERE]
    rows = [(i, t) for i, _, a, b, t in lines(rows, P.LINE_MIN_CHARS) if a + b == 0 or t.strip()]
    keep = {i for i, _, c in components(rows, P.SIMILAR, P.SHINGLE) if i == c}
    word = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    items = [word(r.text) for r in table(spark, DATA, "benchmark").collect()]
    # The items have no names, numbers or units; a covered half of one counts, but here they are whole or not there.
    rows = [(i, t) for i, t in rows if i in keep and not any(x in word(t) for x in items)]
    library = tokenizers.Tokenizer.from_file(vocabularies.path("word_bpe_49k.json"))
    want = {i: np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for i, t in rows}
    got = P.run(spark, DATA).collect()
    assert {r.doc_id: bytes(r.ids) for r in got} == want and len(got) == len(want)
    assert all(r.n_tokens == len(r.ids) // 4 for r in got)


def test_stages_keep_columns_and_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, ids string, key int"
    rows = [(1, "a clean line of this text here\nanother line of the text", "en", None, 56, "x", 1), (2, None, None, "s", None, "y", 2), (3, "", "en", "s", 0, None, 3),
            (None, "a clean line of this text here", "en", "s", 30, "z", 4), (4, "w " * 50_000, "en", "s", 100_000, "q", 5), (1, "a clean line of this text here\nanother line of the text", "en", None, 56, "x", 1)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, DATA)
        assert out.columns == docs.columns, name
        ids = [r.doc_id for r in out.collect()]
        assert {2, 3, 4} <= set(ids) and 1 in ids, name
        assert stage(spark, docs.limit(0), DATA).count() == 0, name
    assert P.encode_documents(spark, docs, DATA).count() == len(rows)
