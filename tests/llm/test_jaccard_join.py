from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tidemark.llm import jaccard_join as J
from tidemark.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, key long, rep long, n int"


def sets_of(text, size=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def brute(rows, percent=90, size=3):
    sets = [sets_of(t, size) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if rows[i][0] is None or rows[j][0] is None:
                continue
            if rows[i][0] == rows[j][0] and a and b or a and b and 100 * len(a & b) >= percent * len(a | b):
                up[root(i)] = root(j)
    out = []
    for i, (key, _) in enumerate(rows):
        mates = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((key, len(sets[i]), min(mates) if key is not None else None))
    return sorted(out, key=str)


def joined(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in J.similar_components(df, **kw).collect()), key=str)


def family(rng, n, words, edits):
    base = [rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randint(1, 3) + str(rng.randint(0, 40)) for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            p = rng.randrange(len(w))
            k = rng.randint(0, 2)
            w[p : p + 1] = [[f"new{rng.randint(0, 99)}"], [], [w[p], "put"]][k]
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("percent,size,seed", [(90, 3, 1), (80, 5, 2), (90, 3, 3)])
def test_random_families(spark, percent, size, seed):
    rng = random.Random(seed)
    texts = [t for words, edits in ((3, 1), (9, 1), (14, 2), (25, 3), (60, 4), (150, 8), (400, 20)) for t in family(rng, 14, words, edits)]
    rows = [(i * 3 % 101 + 1000 * (i // 101), t) for i, t in enumerate(texts)]
    rows += [(5000, None), (5001, ""), (5002, " \t\n"), (None, texts[20]), (5003, "One"), (5004, "one "), (5005, "one two"), (7, texts[3])]
    assert joined(spark, rows, percent=percent, size=size) == brute(rows, percent, size)


def test_large_group_and_long_text(spark):
    rng = random.Random(9)
    rows = [(i, t) for i, t in enumerate(family(rng, 120, 70, 9))] + [(200 + i, "copy of this one text here") for i in range(300)]
    long = " ".join(f"w{i}" for i in range(60_000))
    rows += [(900, long), (901, long + " end"), (902, long.replace("w5", "v5"))]
    assert joined(spark, rows) == brute(rows)


def test_bounds():
    rng = random.Random(4)
    bands = J.Bands(90)
    for _ in range(3000):
        a = rng.randint(1, 3000)
        b = rng.randint(a, a * 10 // 9)
        band = bands.of(a)
        assert band in bands.indexed(a) and band in bands.indexed(b)
        assert (a + b) // 19 <= bands.limit[band]
    s = np.unique(np.random.default_rng(1).integers(0, 2**63, 300).astype(np.uint64))
    t = np.concatenate([s[:-10], np.arange(7, dtype=np.uint64)])
    assert sum(int(x).bit_count() for x in (J.parity(s) ^ J.parity(t)).view(np.uint64)) <= 17


def test_empty(spark):
    assert joined(spark, []) == []


def test_query(spark):
    data = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in QUERIES["op5_jaccard_join"](spark, data).collect()), key=str) == brute(rows)
