from __future__ import annotations

import gc
import weakref

import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, common, decontamination, jaccard_join, token_files


class Held:
    pass


def test_a_worker_keeps_one_object():
    first = common.worker_slot("a", 1, Held)
    assert common.worker_slot("a", 1, Held) is first
    gone = weakref.ref(first)
    del first
    second = common.worker_slot("a", 2, Held)
    gc.collect()
    assert gone() is None and common.worker_slot("a", 2, Held) is second
    assert common.worker_slot("b", 2, Held) is not second


def test_dictionaries_of_words_are_bounded(monkeypatch):
    """Neither their entries nor the length of what they keep grows with the texts."""
    monkeypatch.setattr(jaccard_join, "KEPT", 100)
    monkeypatch.setattr(decontamination, "KEPT", 100)
    words = jaccard_join._Words()
    tokens = decontamination._Words(None)
    for i in range(1000):
        words[f"w{i}".encode()], tokens[f"w{i}"]
    long = "x" * 100_000
    assert words[long.encode()] == jaccard_join._Words()[long.encode()] and tokens[long] == decontamination._token(long)
    assert len(words) <= 100 and len(tokens) <= 101 and max(map(len, words)) < 100 and max(map(len, tokens)) < 100


def test_operators_take_turns_in_one_worker(spark):
    """The stages of a pipeline in one process: what an operator leaves behind goes when the next one begins."""
    pytest.importorskip("tokenizers")
    vocabularies = pytest.importorskip("public_tokenizers")
    word, byte = (bpe.read_spec(vocabularies.path(n)) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
    refs = []
    for _ in range(2):
        own = bpe.encoder(word)
        refs.append(weakref.ref(own))
        assert own.encode("a text") and bpe.encoder(word) is own
        del own
        jaccard_join.shingle_set("some words of a text")
        gc.collect()
        assert refs[-1]() is None
        pieces = token_files.piece_encoder(byte)
        refs.append(weakref.ref(pieces))
        del pieces
        common.worker_slot("decontamination", 0, lambda: decontamination._Words(None))
        gc.collect()
        assert refs[-1]() is None


def test_batches_are_bounded_in_rows_and_bytes(spark):
    common.bounded_batches(spark)
    sizes = spark.range(2000, numPartitions=1).select(F.repeat(F.lit("x"), 100_000).alias("t")).mapInArrow(
        lambda batches: (type(b).from_pydict({"rows": [b.num_rows], "size": [b.nbytes]}) for b in batches), "rows long, size long"
    ).collect()
    assert sum(r.rows for r in sizes) == 2000 and max(r.rows for r in sizes) <= 256 and max(r.size for r in sizes) < 2 * common.BATCH_BYTES
