from __future__ import annotations

import math

import numpy as np
import pytest

from tidemark.llm import toxicity
from tidemark.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, severity int, id string, grade string"


def test_ordinal_fit_recovers_order_and_grades():
    rng = np.random.default_rng(1)
    rows, grades = [], []
    for _ in range(1500):
        g = int(rng.integers(0, 4))
        rows.append(sorted({*rng.choice(20, 3).tolist(), *(20 + k for k in range(3) if k < g or rng.random() < 0.02)}))
        grades.append(g)
    model = toxicity.fit_ordinal(rows, np.array(grades), [str(i) for i in range(23)])
    assert (np.diff(model.thresholds) > 0).all() and len(model.thresholds) == 3
    expected = model.above(np.array([model.weights[r].sum() for r in rows])).sum(1)
    assert np.abs(expected - grades).mean() < 0.35 and np.corrcoef(expected, grades)[0, 1] > 0.95


def test_gradient_against_differences():
    """One step without momentum moves against the numerical gradient: the likelihood rises from step to step."""
    rows, grades = [[0], [0, 1], [1], [], [2], [0, 2]], np.array([1, 2, 1, 0, 0, 1])

    def loss(m):
        score = np.array([m.weights[r].sum() for r in rows])
        up = np.concatenate([np.ones((6, 1)), m.above(score), np.zeros((6, 1))], 1)
        return -np.log(up[np.arange(6), grades] - up[np.arange(6), grades + 1]).mean()

    losses = [loss(toxicity.fit_ordinal(rows, grades, ["a", "b", "c"], steps=k, rate=0.02)) for k in (1, 20, 100, 400)]
    assert losses == sorted(losses, reverse=True) and losses[-1] < 0.6 * losses[0]


def test_held_out(spark):
    """Labelled documents outside the training part are told apart; some labelled toxic have nothing toxic in them."""
    data = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    model = toxicity.train(docs, labels.filter("doc_id % 3 > 0"), split_severe=True)
    held = toxicity.score(docs, model).join(labels.filter("doc_id % 3 = 0"), "doc_id")
    got = np.array([(r.severity >= 0.5, r.toxic == 1) for r in held.collect()])
    hits = (got[:, 0] & got[:, 1]).sum()
    assert hits / got[:, 1].sum() > 0.9 and hits / got[:, 0].sum() > 0.95, (hits, got.sum(0))


@pytest.fixture(scope="module")
def tiny(spark):
    rows = [(i, "a nice text number" + " xyz" * (i % 2) + " rotter" * (i % 5 == 0), 0, "x", "y") for i in range(60)]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(60)], "doc_id long, toxic int")


def test_cases(spark, tiny):
    docs, labels = tiny
    model = toxicity.train(docs, labels.union(spark.createDataFrame([(None, 1), (3, None), (999, 1), (5, 1)], labels.schema)))
    odd = spark.createDataFrame([(1, None, 0, "x", "y"), (2, "", 0, "x", "y"), (None, "Rotter!", 0, "x", "y"), (4, "word " * 100_000 + "rotter", 0, "x", "y"), (4, "nice", 0, "x", "y")], SCHEMA)
    got = toxicity.score(odd, model).collect()
    assert [(r.doc_id, r.severity >= 0.5) for r in got] == [(1, False), (2, False), (None, True), (4, True), (4, False)]
    left = toxicity.reject(odd, model)
    assert left.columns == odd.columns and [(r.doc_id, r.text) for r in left.collect()] == [(1, None), (2, ""), (4, "nice")]
    assert toxicity.score(odd.limit(0), model).collect() == []


def test_without_two_grades(spark, tiny):
    docs, labels = tiny
    for some in (labels.limit(0), labels.filter("toxic = 0")):
        assert {r.severity for r in toxicity.score(docs, toxicity.train(docs, some)).collect()} == {0.0}


def test_query(spark):
    df = QUERIES["op4_toxicity"](spark, "/root/testdata/sf0.001")
    rows = df.collect()
    assert len(rows) == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert all(0 <= r.severity <= 2 and r.toxic == (r.severity >= 0.5) for r in rows)


def test_query_against_plain_python(spark):
    """Counts, choice of features, grades and scores of the query by loops; only the fit itself is shared."""
    data = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    grade = {}
    for r in spark.read.parquet(f"{data}/labels.parquet").collect():
        if r.doc_id in texts and r.toxic is not None:
            grade[r.doc_id] = max(grade.get(r.doc_id, 0), r.toxic)
    ids = sorted(grade)
    bad, good = sum(grade[i] > 0 for i in ids), sum(grade[i] <= 0 for i in ids)
    counts = {}
    for i in ids:
        for f in toxicity.all_features(texts[i]):
            counts.setdefault(f, [0, 0])[grade[i] <= 0] += 1
    z = {}
    for f, (a, c) in counts.items():
        odds = math.log((a + 0.5) / (bad - a + 0.5)) - math.log((c + 0.5) / (good - c + 0.5))
        z[f] = odds / math.sqrt(1 / (a + 0.5) + 1 / (c + 0.5))
    names = sorted((f for f in z if sum(counts[f]) >= 3 and abs(z[f]) >= toxicity.LEAST_Z), key=lambda f: (-abs(z[f]), f))[: toxicity.FEATURES]
    number = {f: k for k, f in enumerate(names)}
    found = {i: sorted(number[f] for f in toxicity.all_features(t) if f in number) for i, t in texts.items()}
    grades = np.array([grade[i] for i in ids])
    telling = {k for f, k in number.items() if z[f] > 0}
    marks = np.array([len(telling.intersection(found[i])) for i in ids])
    grades[(grades > 0) & (marks >= np.median(marks[grades > 0]))] += 1
    model = toxicity.fit_ordinal([found[i] for i in ids], grades, names)
    want = {i: float((1 / (1 + np.exp(model.thresholds - model.weights[f].sum()))).sum()) for i, f in found.items()}
    got = {r.doc_id: r.severity for r in QUERIES["op4_toxicity"](spark, data).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[i], want[i], rel_tol=1e-6, abs_tol=1e-9) for i in want)
