from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import bpe
from tidemark.llm.queries import QUERIES

tokenizers = pytest.importorskip("tokenizers")
vocabularies = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def spec():
    return bpe.read_spec(vocabularies.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(vocabularies.path("word_bpe_49k.json"))


def as_bytes(ids):
    return np.array(ids, "<u4").tobytes()


def test_random_texts(spec, library):
    own, rng = bpe.encoder(spec), random.Random(3)
    letters = ["aeiou", "abcdefghijklmnopqrstuvwxyz", "aaab", "éèüß日本ñ𝄞", "'st!?.,<>|-_0123456789 \t\n\x1c\x85 ΣσİÅ²½"]
    for _ in range(4000):
        some = "".join(rng.sample(letters, 2))
        text = "".join(rng.choice(some) for _ in range(rng.randint(0, 30)))
        want = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == as_bytes(want), text
        assert own.decode(as_bytes(want)) == library.decode(want, skip_special_tokens=False)


def test_small_merge_lists_against_greedy_merging():
    """The automaton accepts what merging pairs by rank gives, for random merge lists over a few letters."""
    rng = random.Random(5)
    for _ in range(150):
        tokens = list("abc")
        merges = []
        for _ in range(rng.randint(1, 9)):
            pair = (rng.choice(tokens), rng.choice(tokens))
            if pair[0] + pair[1] not in tokens:
                merges.append(pair)
                tokens.append(pair[0] + pair[1])
        vocab = {t: i for i, t in enumerate(tokens)}
        rank = {m: i for i, m in enumerate(merges)}
        auto = bpe.Automaton(vocab, merges)
        for _ in range(40):
            word = [rng.choice("abc") for _ in range(rng.randint(1, 9))]
            parts = list(word)
            while pairs := [(rank[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in rank]:
                _, i = min(pairs)
                parts[i : i + 2] = ["".join(parts[i : i + 2])]
            state = bpe.START
            for token in parts:
                assert auto.arc(state, vocab[token]), (merges, word, parts)
                state = auto.goal[vocab[token]]


def test_cases(spark, spec, library):
    rows = [(1, None, "x"), (2, "", "x"), (None, "No id", "x"), (3, "same", "x"), (3, "same", "x"), (4, "<|endoftext|>A <|startoftext|>b<|EndOfText|>", "x"), (5, "y" * 100_000, "x"), (6, "word " * 60_000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.decode(bpe.encode(df, spec), spec).collect()
    want = []
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, as_bytes(ids), library.decode(ids, skip_special_tokens=False)))
    assert sorted(((r.doc_id, bytes(r.ids), r.text) for r in got), key=str) == sorted(want, key=str)
    assert bpe.encode(df.limit(0), spec).collect() == []


def test_query(spark, library):
    data = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    got = QUERIES["op2_bpe_automaton"](spark, data).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert tuple(r) == (r.doc_id, len(ids), hashlib.sha256(as_bytes(ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
