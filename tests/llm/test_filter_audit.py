from __future__ import annotations

import math
import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import run_sql
from tidemark.llm.filter_audit import audit, failure_counts, lattice, text_filters
from tidemark.llm.queries import ORACLES, QUERIES

DOCS = "keep string, doc_id long, n int, mask int, lang string, text string, rows string"
LABELS = "doc_id long, quality int, toxic int, part string"
NAMES = "ABCDE"
LONG = " ".join(f"word{i}" for i in range(250))
ROWS = [
    (1, "en", LONG), (2, "en", LONG), (3, "de", LONG), (4, "en", "short text"), (5, None, None), (6, "en", ""), (7, "en", "UPPER CASE $ 5"),
    (8, "fr", "same same " * 150), (9, "fr", "same same " * 150), (9, "fr", "same same " * 150), (8, "fr", "same same " * 150),
    (None, "en", LONG), (None, "en", "nobody's own"), (None, "en", "nobody's own"), (10, "de", LONG + " #"), (11, "de", "a\tb\nc " * 80_000),
    (12, "", "\x0b\x0c é É ß"), (13, "en", LONG + " x"),
]
MARKS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (4, None, 1), (7, 0, 0), (9, 1, None), (None, 1, 1), (99, 1, 1)]


def failed(docs, labels):
    first, out = {}, []
    for i, _, t in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    for i, lang, t in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = ""
        fails += "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
        fails += "C" * (100 * len(re.findall("[A-Z]", t)) > 3 * len(t)) + "D" * bool(re.search(r"[#$%&*|]", t))
        fails += "E" * (t in first and (i is None or i > first[t]))
        mine = [m for m in labels if m[0] is not None and m[0] == i]
        out.append((lang or "", fails, any(m[1] == 1 for m in mine), any(m[2] == 1 for m in mine)))
    return out


def brute(docs, labels, orders=None):
    rows, out = failed(docs, labels), []
    orders = orders or ["".join(p) for p in permutations(NAMES)]
    for part in {r[0] for r in rows}:
        removed_by, steps = dict.fromkeys(NAMES, 0), []
        for order in orders:
            left = here = [r for r in rows if r[0] == part]
            for k, f in enumerate(order):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                removed_by[f] += len(gone)
                fails = sum(f in r[1] for r in here)
                steps.append((f, (part, order, k + 1, len(left), len(gone), fails - len(gone), sum(r[1] == f for r in here), sum(r[2] for r in gone), sum(r[3] for r in gone))))
        out += [(*s, removed_by[f]) for f, s in steps]
    return sorted(out)


def tables(spark, docs, labels):
    d = spark.createDataFrame([("k", i, 0, 0, lang, t, "r") for i, lang, t in docs], DOCS)
    return d, spark.createDataFrame([(*m, "p") for m in labels], LABELS)


def run(spark, docs, labels, **options):
    filters = text_filters()
    return audit(failure_counts(*tables(spark, docs, labels), filters), [*filters, "E"], **options)


def test_cases(spark):
    assert sorted(tuple(r) for r in run(spark, ROWS, MARKS).collect()) == brute(ROWS, MARKS)


def test_types(spark):
    assert dict(run(spark, ROWS[:1], []).dtypes) == {"part": "string", "filter_order": "string", "step": "int"} | dict.fromkeys(
        ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"), "bigint"
    )


def test_hot_copies_over_many_partitions(spark):
    rows = [(i, ("en", "de", None)[i % 3], "a copy" if i % 3 else f"text {i % 40} $") for i in range(3000)]
    marks = [(i, i % 2, i % 5 == 0) for i in range(0, 3000, 2)]
    marks = [(i, q, int(t)) for i, q, t in marks]
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        assert sorted(tuple(r) for r in run(spark, rows, marks).collect()) == brute(rows, marks)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")


def test_empty(spark):
    assert run(spark, [], []).collect() == []
    assert len(run(spark, [(1, "en", "x")], []).collect()) == 600


def test_orders_with_conditions(spark):
    orders = [o for o in ("".join(p) for p in permutations(NAMES)) if o.index("E") < o.index("A") and o.index("A") < o.index("D")]
    got = run(spark, ROWS, MARKS, before=[("E", "A"), ("A", "D")])
    assert sorted(tuple(r) for r in got.collect()) == brute(ROWS, MARKS, orders)
    with pytest.raises(ValueError, match="no order"):
        run(spark, ROWS, MARKS, before=[("E", "A"), ("A", "E")])


def test_lattice_counts_paths():
    for k in range(1, 6):
        edges = lattice(k)
        assert len(edges) == k * 2 ** (k - 1)
        # All edges that leave states of one size hold every order once.
        for size in range(k):
            assert sum(w for s, _, w in edges if s.bit_count() == size) == math.factorial(k)


def test_own_filters(spark):
    docs, labels = tables(spark, [(1, "en", "a b"), (2, "en", "a"), (3, "en", "")], [])
    counts = failure_counts(docs, labels, {"X": F.col("__words") > 1, "Y": F.col("doc_id") > 1}, repeated=None)
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.shapley) for r in audit(counts, "XY").collect()}
    assert got == {("XY", 1): (2, 1, 0, 2), ("XY", 2): (0, 2, 0, 4), ("YX", 1): (1, 2, 0, 4), ("YX", 2): (0, 1, 0, 2)}
    with pytest.raises(ValueError, match="one letter"):
        audit(counts, ["X", "X"])
    with pytest.raises(ValueError, match="filters"):
        failure_counts(docs, labels, {}, repeated=None)


def test_query(spark, duck):
    df = QUERIES["op13_filter_audit"](spark, "/root/testdata/sf0.001")
    assert sorted((tuple(r) for r in df.collect()), key=str) == run_sql(duck, ORACLES["op13_filter_audit"], df.columns)
