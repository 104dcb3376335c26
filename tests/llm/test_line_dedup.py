from __future__ import annotations

import hashlib
import random

import pytest

from tests.llm.conftest import run_sql
from tidemark.llm.line_dedup import line_dedup
from tidemark.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, line string, pos int"


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, least):
    """Rows in order: identifier (none last), then the first characters and the digest of the text."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, (r[1] or "")[:64], hashlib.sha256((r[1] or "").encode()).hexdigest()))
    out, seen = [], []
    for i, t in order:
        n = again = near = 0
        kept = []
        for raw in t.split("\n") if t is not None else []:
            x = raw.strip(" \t\r")
            a = x != "" and x in seen
            b = not a and len(x) >= least and any(len(y) >= least and within_one(x, y) for y in seen)
            seen.append(x)
            n, again, near = n + 1, again + a, near + b
            if not (a or b):
                kept.append(raw)
        out.append((i, n, again, near, None if t is None else "\n".join(kept)))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "__lines", "__repeated", "__near", "text").collect()), key=str)


@pytest.mark.parametrize("long_chars", [6, 9, 2048])
def test_random_lines(spark, long_chars):
    rng = random.Random(long_chars)
    base = ["".join(rng.choice("ab é") for _ in range(rng.randint(3, 14))) for _ in range(12)]

    def edited(s):
        k, p = rng.randint(0, 3), rng.randint(0, len(s))
        return (s, s[:p] + rng.choice("ab𝄞") + s[p:], s[:p] + s[p + 1 :], s[:p] + "c" + s[p + 1 :])[k]

    rows = [(rng.randint(-3, 400) * 2 + 1, "\n".join(edited(rng.choice(base)) for _ in range(rng.randint(1, 5)))) for _ in range(60)]
    rows = [*{i: (i, t) for i, t in rows}.values(), (1000, None), (1002, ""), (1004, "\n\n"), (None, base[0] + "\r\n  " + base[1])]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA).repartition(3)
    assert result(line_dedup(df, min_chars=4, long_chars=long_chars)) == brute(rows, 4)


def test_rows_without_or_with_shared_identifiers(spark):
    """Lines belong to rows: no row loses what another one with its identifier repeats."""
    one, two, own = "a line that is found here twice", "another line that stands in two", "a line nobody else has at all"
    rows = [(5, one), (None, f"{one}\n{own}"), (None, f"{own} either\n{two}"), (None, two), (None, two), (7, two), (7, two), (7, f"{own}, says seven\n{one}"), (3, "}\n}\nshort"), (9, "short\n\n")]
    rows += [(None, None), (8, None), (8, ""), (None, "same line, many copies\nof one row"), (None, "same line, many copies\nof one row"), (4, one)]
    for parts in (1, 5):
        df = spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA).repartition(parts)
        assert result(line_dedup(df)) == brute(rows, 24)
    # All rows under one identifier, or under none.
    for i in (1, None):
        rows = [(i, f"a row with the number {k * 7919} in it\nand a line for {k % 5} to {k % 7}\nx{k % 3}") for k in range(200)]
        df = spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA).repartition(4)
        assert result(line_dedup(df)) == brute(rows, 24)


def test_one_common_line(spark):
    rows = [(i, f"a line that all documents share\nline number {i * 7919} of its own") for i in range(1500)]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA)
    got = {r[0]: r for r in result(line_dedup(df, min_chars=10))}
    assert got[0][2] == 0 and all(got[i][2] == 1 for i in range(1, 1500))
    seen, near = [], {}
    for i, t in rows:
        x = t.split("\n")[1]
        near[i] = int(any(within_one(x, y) for y in seen if abs(len(x) - len(y)) < 2))
        seen.append(x)
    assert {i: r[3] for i, r in got.items()} == near


def test_empty(spark):
    assert line_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query(spark, duck):
    df = QUERIES["op3_line_dedup"](spark, "/root/testdata/sf0.001")
    assert sorted((tuple(r) for r in df.collect()), key=str) == run_sql(duck, ORACLES["op3_line_dedup"], df.columns)
