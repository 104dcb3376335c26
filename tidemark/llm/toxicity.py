"""Severity of toxic language by cumulative-link ordinal regression.

The log-odds that a text is at most of grade k are ``threshold[k] - weights . features``: one set of weights for all
thresholds, which are ordered. Features say that a word, or words with the same first letters, occur once, twice, three
times, or often for the length of the text; those that tell toxic from clean training texts best are kept. The output is
the expected grade.

Training reads a bounded sample of labelled rows (``train_rows``, by a hash of the identifier); feature counts are made
by Spark, and only the kept features of the sample reach the driver. Scoring reads every text in whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, stored, text_of

TRAIN_ROWS = 10_000
FEATURES = 4096
LEAST_Z = 3.0
PREFIXES = (4, 5, 6)
# A word is frequent if it is at least one in so many words of its text.
OFTEN = 250
# Words that a worker keeps, and the longest of them.
KEPT, KEPT_CHARS = 200_000, 32
_WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[str]:
    """The word itself and its beginnings."""
    return ["=" + word] + [f"^{word[:n]}" for n in PREFIXES if len(word) > n]


def counted_features(base: str, count: int, words: int) -> list[str]:
    """Features of one word or beginning that occurs so often in a text of so many words."""
    made = [base]
    if count > 1:
        made.append(base + "*2")
        if count > 2:
            made.append(base + "*3")
        if count * OFTEN >= words:
            made.append(base + "%")
    return made


class _Lookup(dict):
    """Which of a word's features any kept one is about, by word; forgotten when there are many."""

    def __init__(self, names: list[str]) -> None:
        super().__init__()
        self.number = {f: i for i, f in enumerate(names)}
        self.bases = {f.rstrip("*23%") for f in names}

    def __missing__(self, word: str) -> tuple[str, ...]:
        made = tuple(f for f in word_features(word) if f in self.bases)
        if len(word) <= KEPT_CHARS:
            if len(self) >= KEPT:
                self.clear()
            self[word] = made
        return made


def all_features(text: str) -> list[str]:
    """All features of a text."""
    words = _WORD.findall(text.lower())
    counts: Counter[str] = Counter()
    for word, n in Counter(words).items():
        for f in word_features(word):
            counts[f] += n
    return [f for base, n in counts.items() for f in counted_features(base, n, len(words))]


def present(text: str, lookup: _Lookup) -> list[int]:
    """Numbers of the kept features of a text."""
    words = _WORD.findall(text.lower())
    counts: Counter[str] = Counter()
    for word, n in Counter(words).items():
        for f in lookup[word]:
            counts[f] += n
    number = lookup.number
    return sorted(number[f] for base, n in counts.items() for f in counted_features(base, n, len(words)) if f in number)


@dataclass(frozen=True)
class Model:
    """Feature names, their weights and the ordered thresholds (one less than grades)."""

    names: list[str]
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each score and threshold."""
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(self.thresholds[None, :] - score[:, None]))


def fit_ordinal(rows: list[list[int]], grades: np.ndarray, names: list[str], steps: int = 400, rate: float = 0.05, penalty: float = 2e-4) -> Model:
    """Maximum likelihood with a quadratic penalty by Adam; thresholds are a first one and positive steps."""
    top = int(grades.max(initial=0))
    n = len(rows)
    if top == 0:
        return Model(names, np.zeros(len(names)), np.empty(0))
    share = [min(max(float((grades <= k).mean()), 1e-3), 1 - 1e-3) for k in range(top)]
    start = np.log(np.array(share) / (1 - np.array(share)))
    params = np.concatenate([np.zeros(len(names)), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    lengths = np.fromiter(map(len, rows), np.int64, n)
    of_row = np.repeat(np.arange(n), lengths)
    index = np.fromiter((i for r in rows for i in r), np.int64, int(lengths.sum()))
    m1, m2, d = np.zeros_like(params), np.zeros_like(params), len(names)
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -50, 50)))
    for t in range(1, steps + 1):
        w, steps_up = params[:d], np.exp(params[d + 1 :])
        theta = params[d] + np.concatenate([[0], np.cumsum(steps_up)])
        score = np.bincount(of_row, w[index], n)
        at_most = np.concatenate([np.zeros((n, 1)), sigmoid(theta[None, :] - score[:, None]), np.ones((n, 1))], 1)
        mass = np.maximum(at_most[np.arange(n), grades + 1] - at_most[np.arange(n), grades], 1e-12)
        slope = at_most * (1 - at_most)
        upper, lower = slope[np.arange(n), grades + 1] / mass, slope[np.arange(n), grades] / mass
        to_score = (upper - lower) / n  # of the negative log-likelihood
        to_theta = np.zeros(top + 2)
        np.add.at(to_theta, grades + 1, -upper / n)
        np.add.at(to_theta, grades, lower / n)
        to_theta = to_theta[1:-1]
        grad = np.concatenate([np.bincount(index, to_score[of_row], d) + penalty * w, [to_theta.sum()], np.cumsum(to_theta[::-1])[::-1][1:] * steps_up])
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad**2
        params -= rate * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-9)
    theta = params[d] + np.concatenate([[0], np.cumsum(np.exp(params[d + 1 :]))])
    return Model(names, params[:d], theta)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))


def sample_labelled(docs: DataFrame, labels: DataFrame, grade: str, id_col: str, text_col: str, rows: int) -> DataFrame:
    """``id, text, grade`` of at most ``rows`` labelled documents, by a hash of the identifier."""
    graded = labels.select(F.col(id_col).cast("long").alias("key"), F.expr(grade).cast("int").alias("grade")).dropna()
    graded = graded.groupBy("key").agg(F.max("grade").alias("grade")).orderBy(F.xxhash64("key"), "key").limit(rows)
    texts = _texts(docs, id_col, text_col)
    joined = texts.join(F.broadcast(graded), texts["id"] == F.col("key"))  # broadcast: at most ``rows`` rows
    return joined.groupBy("id").agg(F.min("text").alias("text"), F.max("grade").alias("grade"))


def train(docs: DataFrame, labels: DataFrame, grade: str = "toxic", id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS, split_severe: bool = False) -> Model:
    """Fit on labelled rows; ``grade`` is an SQL expression over ``labels`` with integer grades from 0.

    With ``split_severe`` labels of two grades become three: labelled texts with at least the median number of telling
    features among those of grade 1 get grade 2. Labels without an identifier or grade, and those of documents that are
    not there, are left out; of several labels of one document the largest counts. Without labels of two grades at
    least, the model gives every text the only grade there is, or 0.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    sample = stored(sample_labelled(docs, labels, grade, id_col, text_col, train_rows), "toxicity-sample")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, g in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = all_features(text)
                yield pa.record_batch([pa.array(found, pa.string()), pa.array([g > 0] * len(found), pa.bool_())], names=["feature", "toxic"])

    totals = sample.agg(F.count_if(F.col("grade") > 0), F.count_if(F.col("grade") <= 0), F.max("grade")).first()
    bad, good = totals[0], totals[1]
    if not bad or not good:
        return Model([], np.zeros(0), np.full(totals[2] or 0, -50.0))
    counts = sample.select("text", "grade").mapInArrow(features, "feature string, toxic boolean").groupBy("feature").agg(
        F.count_if("toxic").alias("a"), F.count_if(~F.col("toxic")).alias("c")
    )
    odds = F.log((F.col("a") + 0.5) / (bad - F.col("a") + 0.5)) - F.log((F.col("c") + 0.5) / (good - F.col("c") + 0.5))
    z = odds / F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("c") + 0.5))
    best = counts.filter((F.col("a") + F.col("c") >= 3) & (F.abs(z) >= LEAST_Z)).orderBy(F.abs(z).desc(), "feature").limit(FEATURES)
    kept = best.select("feature", (z > 0).alias("telling")).collect()
    names = [r.feature for r in kept]
    telling = {i for i, r in enumerate(kept) if r.telling}

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Lookup(names)
        for batch in batches:
            found = [present(t, lookup) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.int32()))], names=["id", "grade", "found"])

    data = sample.select("id", "text", "grade").mapInArrow(numbered, "id long, grade int, found array<int>").orderBy("id").collect()
    grades = np.array([max(0, r.grade) for r in data], np.int64)
    rows = [list(r.found) for r in data]
    if split_severe:
        marks = np.array([len(telling.intersection(r)) for r in rows])
        grades[(grades > 0) & (marks >= np.median(marks[grades > 0]))] += 1
    return fit_ordinal(rows, grades, names)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, severity, grade``: expected and most likely grade of every row; null texts count as empty."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Lookup(model.names)
        for batch in batches:
            totals = np.array([model.weights[present(t, lookup)].sum() for t in batch.column(1).to_pylist()])
            above = model.above(totals)
            steps = np.concatenate([np.ones((len(totals), 1)), above, np.zeros((len(totals), 1))], 1)
            likely = np.argmax(steps[:, :-1] - steps[:, 1:], 1).astype(np.int32)
            yield pa.record_batch([batch.column(0), pa.array(above.sum(1)), pa.array(likely)], names=[id_col, "severity", "grade"])

    rows = _texts(docs, id_col, text_col)
    return rows.mapInArrow(run, f"`{id_col}` long, severity double, grade int")


def reject(docs: DataFrame, model: Model, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose expected grade is ``least`` or more; all columns pass unchanged."""
    bounded_batches(docs.sparkSession)
    columns = docs.columns
    at = columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Lookup(model.names)
        for batch in batches:
            totals = np.array([model.weights[present(t or "", lookup)].sum() for t in batch.column(at).to_pylist()])
            yield batch.filter(pa.array(model.above(totals).sum(1) < least))

    return docs.mapInArrow(run, docs.schema)
