from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from tidemark import runtime
from tidemark.llm import bpe
from tidemark.llm.queries import QUERIES
from tidemark.llm.token_files import PieceEncoder, Shard, WaveletMatrix, read_tokens, write_tokens

tokenizers = pytest.importorskip("tokenizers")
vocabularies = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def spec():
    return bpe.read_spec(vocabularies.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(vocabularies.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("n", [0, 1, 7, 511, 512, 513, 5000])
def test_wavelet_matrix(n):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, 300, n).astype(np.uint32)
    data = Shard.build([None, 5], [n // 2, n - n // 2], ids, 9).to_bytes()
    shard = Shard.from_bytes(data)
    m = shard.matrix
    assert shard.doc_ids == [None, 5] and shard.lengths.tolist() == [n // 2, n - n // 2]
    assert (m.ids() == ids).all() and len(m.ids()) == n
    for at in rng.integers(0, n, 20) if n else []:
        token = int(ids[at])
        where = np.flatnonzero(ids == token)
        assert m.access(at) == token and m.count(token) == len(where) and m.count(token, int(at)) == (where < at).sum()
        assert [m.find(token, k) for k in range(len(where))] == where.tolist()
        with pytest.raises(IndexError):
            m.find(token, len(where))
    assert m.count(511) == 0 and m.count(5000) == 0


def test_pieces_give_what_the_library_gives(spec, library):
    own, rng = PieceEncoder(spec), random.Random(2)
    letters = ["aeiou", "abc'tsd'll", "  \t\n", "éèü日ñ𝄞", "!?.,<>|-_0123456789 \n\x1c\x85    ²½"]
    texts = ["".join(rng.choice("".join(rng.sample(letters, 3))) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["a<|endoftext|>b", " <|endoftext|>", "don't  stop\n\n 's", ""]
    got = own.encode(texts) + own.encode(texts)
    want = [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    assert got == want + want


def test_words_of_letters_skip_the_splitting(spec, library):
    own, seen, ids = PieceEncoder(spec), [], PieceEncoder._ids
    own._ids = lambda texts: (seen.extend(texts), ids(own, texts))[1]
    texts = ["plain words geprüft, niños***\nÉté fin.", "fin plain\nwords&&&"] * 3
    got = own.encode(texts)
    assert got == [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert sorted(seen) == ["&&&", "***", ",", "."]  # not a word, and no sign twice
    others = ["слово мир! 日本語? ǅ ɐɐ. ªº \U00031350!! ա\u0301 don't!! \u0378x", "\n", "a ", " a", "x\n"]
    assert own.encode(others) == [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in others]


def brute(rows, library, end=2):
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, end]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_cases(spark, spec, library):
    rows = [(9, None), (2, ""), (None, "no id"), (3, "same"), (3, "same"), (-4, "word " * 60_000), (5, "x" * 100_000), (1, "é\n\nb")]
    df = spark.createDataFrame([(*r, b"f", 1) for r in rows], "doc_id long, text string, file binary, part int").repartition(3)
    path = runtime.scratch_path(spark, "test-tokens")
    write_tokens(df, spec, path, shard_tokens=50)
    got = sorted(((r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in read_tokens(spark, path).collect()), key=lambda r: r[1])
    assert got == brute(rows, library)
    path = runtime.scratch_path(spark, "test-tokens")
    write_tokens(df.limit(0), spec, path)
    assert read_tokens(spark, path).collect() == []


def test_query(spark, library):
    data = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in QUERIES["op8_token_files"](spark, data).collect()), key=lambda r: r[1])
    assert got == brute(rows, library)


def test_ascii_words_go_to_the_model_at_once(spec, library):
    """Neither to the splitting nor to the general way of a word; long stretches are not remembered."""
    own, seen, word = PieceEncoder(spec), [], PieceEncoder._word
    own._word = lambda p: (seen.append(p), word(own, p))[1]
    texts = ["first plain words, été again plain\nline " + "x" * 100, "words plain", ""]
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert own.encode(texts) == want and own.encode(texts) == want
    assert not {"plain", "words", "again", "x" * 100} & set(seen) and "été" in seen
    assert "x" * 100 not in own.young and "plain" in own.young
