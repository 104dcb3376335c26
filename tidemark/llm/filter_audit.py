"""Interaction of corpus filters: what each removes, alone and after others, in every order of application.

The filters' subsets form a lattice. A state is the set of filters applied so far; an edge adds one filter and removes
the documents that pass the state's filters and fail the new one. An order is a path from the empty to the full set.
Forward counting gives the number of orders that reach a state, backward counting the number that leave it for the full
set, so an edge lies on (reaching its start) * (leaving its end) orders. The Shapley sums weight each edge's removals by
that number; the steps of an order are read from the same edges.

The documents are reduced to one count per part and set of failed filters in Spark. What follows has at most 2^k rows per
part, for k filters; the lattice and the orders depend on k only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored, text_of

SPACES = r"[\x20\x09-\x0D]+"
MOST_FILTERS = 8
# Of the registered query: limits of the text filters, and the letter of the filter on repeated texts.
LEAST_WORDS, DISTINCT_PERCENT, UPPER_PERCENT, SIGNS = 200, 50, 3, r"[#$%&*|]"
REPEATED = "E"


def text_filters() -> dict[str, Column]:
    """Failure conditions over the columns that ``failure_counts`` makes of a text."""
    return {
        "A": F.col("__words") < LEAST_WORDS,
        "B": 100 * F.col("__distinct") < DISTINCT_PERCENT * F.col("__words"),
        "C": 100 * F.col("__upper") > UPPER_PERCENT * F.char_length("__text"),
        "D": F.col("__text").rlike(SIGNS),
    }


def failure_counts(
    docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column], repeated: str | None = REPEATED,
    id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by part and failed filters (bit i: the i-th filter; ``repeated`` is last).

    The conditions in ``filters`` see the columns of ``docs`` and ``__text, __words, __distinct, __upper`` (the text, its
    words, different words, and letters A-Z). ``repeated`` fails where an equal text has a smaller identifier, in any
    part, whatever else that document fails; rows without an identifier come after all others, and rows that share the
    smallest identifier pass alike. A null text is empty, a null part the empty string. A document is good (toxic) if any
    row of ``labels`` with its identifier says so. Repeated rows all count. Other columns are not read.
    """
    if not filters or len(filters) + (repeated is not None) > MOST_FILTERS:
        raise ValueError(f"between one and {MOST_FILTERS} filters")
    clash = [c for c in docs.columns if c in ("__text", "__words", "__distinct", "__upper")]
    words = F.filter(F.split("__text", SPACES), lambda w: w != "")
    texts = docs.drop(*clash).withColumn("__text", text_of(text_col)).withColumn("__list", words)
    texts = texts.withColumns({
        "__words": F.size("__list"), "__distinct": F.size(F.array_distinct("__list")), "__upper": F.regexp_count("__text", F.lit("[A-Z]")),
    })
    mask = F.lit(0)
    for i, fails in enumerate(filters.values()):
        mask = mask + F.coalesce(fails, F.lit(False)).cast("int") * (1 << i)
    rows = texts.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), mask.alias("mask"),
        F.unhex(F.sha2("__text", 256)).alias("digest"),
    )
    rows = stored(rows.groupBy("id", "digest", "part", "mask").agg(F.count(F.lit(1)).alias("rows")), "audit-rows")
    is_one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    marks = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("id"))
    marks = marks.agg(is_one("quality").alias("good"), is_one("toxic").alias("toxic"))
    no = F.lit(False)
    known = rows.filter(F.col("id").isNotNull()).join(marks, "id", "left").withColumns({c: F.coalesce(c, no) for c in ("good", "toxic")})
    # Rows without an identifier have no labels and would meet in one partition of the join.
    marked = known.unionByName(rows.filter(F.col("id").isNull()).withColumns({"good": no, "toxic": no}))
    group = ["part", "mask", "good", "toxic"]
    if repeated is None:
        counts = marked.groupBy(*group).agg(F.sum("rows").alias("n"))
    else:
        # Copies are counted before they meet, so a group of copies has a few rows per part however large it is.
        copies = marked.groupBy("digest", *group).agg(F.sum("rows").alias("n"), F.min("id").alias("first"), F.min_by("rows", "id").alias("n_first"))
        firsts = copies.groupBy("digest").agg(F.min("first").alias("overall"))
        copies = copies.join(firsts, "digest")
        passing = F.when(F.col("overall").isNull(), F.col("n")).when(F.col("first") == F.col("overall"), F.col("n_first")).otherwise(0)
        both = F.array(
            F.struct(F.col("mask"), passing.alias("n")),
            F.struct((F.col("mask") + (1 << len(filters))).alias("mask"), (F.col("n") - passing).alias("n")),
        )
        split = copies.select("part", "good", "toxic", F.explode(both).alias("s"))
        counts = split.groupBy("part", F.col("s.mask").alias("mask"), "good", "toxic").agg(F.sum("s.n").alias("n")).filter("n > 0")
    by_mark = {c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c) for c in ("good", "toxic")}
    return counts.groupBy("part", "mask").agg(F.sum("n").alias("n"), by_mark["good"], by_mark["toxic"])


def lattice(k: int, before: Sequence[tuple[int, int]] = ()) -> list[tuple[int, int, int]]:
    """Edges ``(state, filter, orders through it)`` of the lattice of k filters; ``before`` lists pairs (earlier, later).

    Edges that no admitted order takes are left out.
    """
    full = (1 << k) - 1
    needs = [sum(1 << a for a, b in set(before) if b == f) for f in range(k)]
    steps = [(s, f) for s in range(full + 1) for f in range(k) if not s >> f & 1 and not needs[f] & ~s]
    reaching, leaving = [0] * (full + 1), [0] * (full + 1)
    reaching[0] = leaving[full] = 1
    for s, f in steps:
        reaching[s | 1 << f] += reaching[s]
    for s, f in reversed(steps):
        leaving[s] += leaving[s | 1 << f]
    edges = [(s, f, reaching[s] * leaving[s | 1 << f]) for s, f in steps]
    return [e for e in edges if e[2]]


def audit(counts: DataFrame, names: Sequence[str], before: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """One row per part, order and step, of ``failure_counts``' rows; ``names`` are the filters by bit, one letter each.

    ``part, filter_order, step``, then document counts: ``kept`` after the step, ``removed`` by it, ``redundant`` (fail
    its filter, but were removed earlier), ``unique_fails`` (fail its filter only), ``good_lost`` and ``toxic_lost`` of
    those removed, and ``shapley``, its filter's removals summed over all orders. ``before`` restricts the orders to those
    in which the first filter of each pair precedes the second. No document, no part; every part has all orders.
    """
    spark, k = counts.sparkSession, len(names)
    if len(set(names)) != k or any(len(n) != 1 for n in names):
        raise ValueError("filters have names of one letter, each its own")
    place = {n: i for i, n in enumerate(names)}
    edges = lattice(k, [(place[a], place[b]) for a, b in before])
    if not edges:
        raise ValueError("no order meets the conditions in 'before'")
    # A literal list of at most k * 2^(k-1) edges: each count meets each edge without a join.
    literal = F.array(*[F.struct(F.lit(s).alias("state"), F.lit(f).alias("filter"), F.lit(1 << f).alias("bit"), F.lit(w).cast("long").alias("orders")) for s, f, w in edges])
    met = counts.select("*", F.explode(literal).alias("e")).select("*", "e.state", "e.filter", "e.bit", "e.orders")
    fails, reached = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("state")) == 0
    total = lambda which, of="n": F.sum(F.when(which, F.col(of)).otherwise(0))
    taken = stored(met.groupBy("part", "state", "filter").agg(
        total(~fails & reached).alias("kept"), total(fails & reached).alias("removed"), total(fails & ~reached).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"), total(fails & reached, "good").alias("good_lost"),
        total(fails & reached, "toxic").alias("toxic_lost"), F.max("orders").alias("orders"),
    ), "audit-edges")
    shapley = taken.groupBy("part", "filter").agg(F.sum(F.col("removed") * F.col("orders")).alias("shapley"))
    steps = []
    for order in permutations(range(k)):
        if all(order.index(place[a]) < order.index(place[b]) for a, b in before):
            name, state = "".join(names[f] for f in order), 0
            for i, f in enumerate(order):
                steps.append((state, f, name, i + 1))
                state |= 1 << f
    path = spark.createDataFrame(steps, "state int, filter int, filter_order string, step int")
    # At most k * k! steps, whatever the data.
    rows = taken.join(shapley, ["part", "filter"]).join(F.broadcast(path), ["state", "filter"])
    return rows.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
