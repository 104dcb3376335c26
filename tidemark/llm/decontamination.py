"""Benchmark decontamination by canonical templates.

Numbers, units and names are replaced with typed placeholders, so that a question asked with other values has the same
template; a run of words that take one kind of placeholder has one only. Windows of template words are hash-joined with
those of the benchmark, in two forms: a capitalised word at the beginning of a sentence is a word in the first and a name
in the second. Windows of the literal words find verbatim copies of any item, however short it is and however many
placeholders it has.

The alignments of a document and an item are the differences of the places of their equal windows; neighbouring ones, as
an added word or a longer name makes them, count together. Along them the placeholders' values, the slots, must be
consistent: a value of the item always stands for the same value in the document, and different values for different
ones. A document is contaminated by an item if consistent windows cover enough of it.

Only words of the benchmark can be in an equal window. A document's words are looked up in hash slots of the benchmark's
words; any other word ends a window, and windows are hashed only where they can be equal. All texts of a batch are worked
through together, with a word that no item has between them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import runtime
from tidemark.llm.common import bounded_batches, stored, text_of, worker_slot

WINDOW = 8
LEAST_WORDS = 5
COVERAGE = 0.5
# Alignments that differ by at most so many words count together.
SLACK = 4
# Units that take a placeholder after a number.
UNITS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg ton tons oz lb lbs pound pounds ml l liter liters litre litres "
    "second seconds minute minutes hour hours day days week weeks month months year years cent cents dollar dollars euro euros "
    "percent degree degrees meter meters metre metres gram grams kilogram kilograms mph kmh watt watts volt volts".split()
)
_TOKENS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|\d+(?:[.,:]\d+)*|[.!?\n]")
_PLAIN, _NUMBER, _UNIT, _CAPITAL, _STOP = range(5)
_KIND = np.uint64(7)
# Places of the kinds in templates; words have larger values.
_PLACES = np.array([0, 8, 16, 24], np.uint64)
LITERAL, TEMPLATE, NAMED = range(3)
# Hash slots of the benchmark's words and of its windows that documents look up before the join: 256 KB each, whatever
# the size of the benchmark.
SLOTS = 1 << 21
# Words kept in a worker, and the longest of them.
KEPT, KEPT_CHARS = 200_000, 32
# Between texts: the end of a sentence, a word that no item has, the end of a sentence.
_BETWEEN = (".", "", ".")


def _token(token: str) -> int:
    """A token's kind in three bits below the hash of its lower-case form."""
    if token in ".!?\n":
        return _STOP
    low = token.lower()
    kind = _NUMBER if token[0].isdigit() else _UNIT if low in UNITS else _CAPITAL if token[0].isupper() else _PLAIN
    return xxhash.xxh3_64_intdigest(low.encode("utf-8", "surrogatepass")) & ~7 | 64 | kind


def _slot(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(20) & np.uint64(SLOTS - 1)).astype(np.int64)


def slots_of(values: np.ndarray) -> bytes:
    """The hash slots taken by some values, one bit each."""
    taken = np.zeros(SLOTS, bool)
    taken[_slot(values)] = True
    return np.packbits(taken, bitorder="little").tobytes()


def _bits(slots: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(slots, np.uint8), bitorder="little").astype(bool)


class _Words(dict):
    """Codes of tokens; those of words in no taken slot have a kind only."""

    def __init__(self, taken: np.ndarray | None) -> None:
        super().__init__()
        self.taken = None if taken is None else taken.tobytes()
        self[""] = _PLAIN

    def __missing__(self, token: str) -> int:
        made = _token(token)
        if self.taken is not None and not self.taken[made >> 20 & SLOTS - 1]:
            made &= 7
        if len(token) <= KEPT_CHARS:
            if len(self) >= KEPT:
                self.clear()
                self[""] = _PLAIN
            self[token] = made
        return made

    def codes(self, texts: Sequence[Sequence[str]]) -> np.ndarray:
        """The codes of several texts' tokens, each text followed by _BETWEEN."""
        tokens = chain.from_iterable(chain(t, _BETWEEN) for t in texts)
        return np.fromiter(map(self.__getitem__, tokens), np.uint64, sum(map(len, texts)) + len(_BETWEEN) * len(texts))


class Form(NamedTuple):
    """One form of a text: values of its words and placeholders, which are placeholders, and the places of their first words."""

    values: np.ndarray
    slots: np.ndarray
    places: np.ndarray


def forms(codes: np.ndarray) -> tuple[Form, Form, Form]:
    """The literal words and both templates of a text's tokens. A value of 0 is a word that no item has."""
    kinds = codes & _KIND
    keep = kinds != _STOP
    before = np.concatenate([[np.uint64(_STOP)], kinds[:-1]])[keep]
    words, kinds = codes[keep] & ~_KIND, kinds[keep]
    out = [Form(words, np.zeros(len(words), bool), np.arange(len(words)))]
    number, unit = kinds == _NUMBER, (kinds == _UNIT) & (before == _NUMBER)
    for name in ((kinds == _CAPITAL) & (before != _STOP), kinds == _CAPITAL):
        place = np.where(number, 1, np.where(unit, 2, np.where(name, 3, 0)))
        goes_on = np.zeros(len(words), bool)
        # A word at the beginning of a sentence may be capitalised for that alone: a run of names does not begin with it.
        goes_on[1:] = (place[1:] > 0) & (place[1:] == place[:-1]) & (before[1:] != _STOP) & ((place[1:] < 3) | (before[:-1] != _STOP))
        first = np.flatnonzero(~goes_on)
        out.append(Form(np.where(place > 0, _PLACES[place], words)[first], place[first] > 0, first))
    return tuple(out)  # type: ignore[return-value]


def windows(form: Form, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the windows of ``size`` known words and placeholders, at least half of them words."""
    n = len(form.values) - size + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    sums = lambda x: np.concatenate([[0], np.cumsum(x)])
    unknown, filled = sums(form.values == 0), sums(form.slots)
    start = np.flatnonzero((unknown[size:] == unknown[:-size]) & (2 * (filled[size:] - filled[:-size]) <= size))
    total = np.full(len(start), np.uint64(size))
    for k in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + form.values[start + k]
        total ^= total >> np.uint64(29)
    return start, total


def _values(words: Sequence[str], begin: int, form: Form, start: int, size: int) -> list[str | None]:
    """Values of the placeholders of a window, null for words; ``words`` are those of its text, which begins at ``begin``."""
    at = form.places[start : start + size + 1] - begin
    ends = at[1:].tolist() if len(at) > size else [*at[1:].tolist(), len(words)]
    return [" ".join(words[a:b]) if x else None for a, b, x in zip(at.tolist(), ends, form.slots[start : start + size].tolist())]


_FOUND = "id long, at int, size int, form int, hash long, values array<string>, of_item int"


def _template_rows(rows: DataFrame, sizes: list[int] | None, window: int, least: int, word_slots: bytes | None, window_slots: bytes | None) -> DataFrame:
    """``id, at, size, form, hash, values, of_item``: windows of all texts in all forms, by the place of their first word.

    ``values`` are words in placeholders, else null; literal windows have none. Without ``sizes`` the texts are items:
    each form has windows of one size, its length if it is short, and template windows only from ``least`` words and placeholders on. With
    slots only windows whose words and hash may be an item's are given.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = worker_slot("decontamination", hash(word_slots), lambda: _Words(None if word_slots is None else _bits(word_slots)))
        taken = None if window_slots is None else _bits(window_slots)
        for batch in batches:
            keys, texts = batch.column(0), [_TOKENS.findall(t) for t in batch.column(1).to_pylist()]
            codes = known.codes(texts)
            made = forms(codes)
            # Where each text's words begin; the word between texts is the last of the text before it.
            kept = np.concatenate([[0], np.cumsum((codes & _KIND) != _STOP)])
            begins = kept[np.concatenate([[0], np.cumsum([len(t) + len(_BETWEEN) for t in texts])])]
            parts = []
            for kind, form in enumerate(made):
                text_of_place = np.searchsorted(begins, form.places, side="right") - 1
                if sizes is None:
                    # Items: the word between texts does not count.
                    lengths = np.bincount(text_of_place, minlength=len(texts)) - 1
                    able = lengths >= (1 if kind == LITERAL else least)
                    wanted = [(int(n), able & (np.minimum(window, lengths) == n)) for n in np.unique(np.minimum(window, lengths)) if n > 0]
                else:
                    wanted = [(n, None) for n in sizes]
                for size, mine in wanted:
                    start, got = windows(form, size)
                    text = text_of_place[start]
                    if mine is not None:
                        fit = mine[text]
                        start, got, text = start[fit], got[fit], text[fit]
                    of_item = np.bincount(text, minlength=len(texts))[text]
                    if taken is not None:
                        hit = taken[_slot(got)]
                        start, got, text, of_item = start[hit], got[hit], text[hit], of_item[hit]
                    if len(start):
                        parts.append((kind, size, form, start, got, text, of_item))
            cols: list[list] = [[] for _ in range(7)]
            words: dict[int, list[str]] = {}
            for kind, size, form, start, got, text, of_item in parts:
                cols[0].append(keys.take(pa.array(text)))
                cols[1].append(pa.array(form.places[start] - begins[text], pa.int32()))
                cols[2].append(pa.array(np.full(len(start), size), pa.int32()))
                cols[3].append(pa.array(np.full(len(start), kind), pa.int32()))
                cols[4].append(pa.array(got.view(np.int64)))
                values: list[list[str | None]] = [[] for _ in start] if kind == LITERAL else []
                for s, t in zip(start.tolist(), text.tolist()) if kind != LITERAL else ():
                    if t not in words:
                        words[t] = [w for w in texts[t] if w not in ".!?\n"]
                    values.append(_values(words[t], int(begins[t]), form, s, size))
                cols[5].append(pa.array(values, pa.list_(pa.string())))
                cols[6].append(pa.array(of_item, pa.int32()))
            if parts:
                yield pa.record_batch([pa.concat_arrays(c) for c in cols], names=["id", "at", "size", "form", "hash", "values", "of_item"])

    return rows.mapInArrow(run, _FOUND)


def _words_of(rows: DataFrame) -> DataFrame:
    """``code``: every word of the items once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {t for text in batch.column(1).to_pylist() for t in _TOKENS.findall(text)}
            yield pa.record_batch([pa.array(np.array([_token(t) for t in found], np.uint64).view(np.int64))], names=["code"])

    return rows.mapInArrow(run, "code long")


def _taken(df: DataFrame, column: str) -> bytes:
    """Slots taken by a column's hashes: at most SLOTS numbers come to the driver."""
    slot = F.shiftrightunsigned(column, 20).bitwiseAND(F.lit(SLOTS - 1))
    found = np.array([r[0] for r in df.select(slot.alias("s")).distinct().collect()], np.uint64)
    return slots_of(found << np.uint64(20))


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, least_words: int = LEAST_WORDS, coverage: float = COVERAGE,
) -> DataFrame:
    """One row per document and item that it contains: ``doc_id, item_id, covered, windows, at, exact``.

    ``covered`` of the item's ``windows`` windows are in the document from word ``at`` on along the best consistent
    alignments; ``exact`` is true if all slot values are the item's own. The windows are those with enough words besides
    placeholders in one of the template forms, or, if too few of them are found, all windows, matched by the first
    template or literally (upper and lower case are the same). Items of fewer than ``window`` words match as a whole,
    those of fewer than ``least_words`` words only literally. Never matched are rows without an identifier in either
    table, and null or empty texts. Items with equal texts each match. Repeated rows of a document count as one. Other
    columns are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    asked = _texts(benchmark, item_col, item_text_col).dropna(subset=["id"]).distinct()
    items = stored(_template_rows(asked, None, window, least_words, None, None), "items")
    sizes = sorted(r[0] for r in items.select("size").distinct().collect())  # at most window of them
    rows = _texts(docs, id_col, text_col).dropna(subset=["id"])
    found = stored(_template_rows(rows, sizes, window, least_words, _taken(_words_of(asked), "code"), _taken(items, "hash")), "windows")
    theirs = items.select(
        F.col("id").alias("item"), F.col("at").alias("item_at"), "size", "form", "hash", F.col("values").alias("item_values"), F.col("of_item").alias("windows")
    )
    same = found.drop("of_item").distinct().join(runtime.broadcast_if_small(theirs), ["hash", "size", "form"])
    # Alignments of a document and an item in order; a gap of more than SLACK begins another group.
    along = Window.partitionBy("id", "item").orderBy("diagonal")
    same = same.withColumn("diagonal", F.col("at") - F.col("item_at"))
    gap = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > SLACK, F.lit(False)).cast("int")
    same = same.withColumn("gap", gap).withColumn("group", F.sum("gap").over(along))
    key = ["id", "item", "group"]
    # In periodic texts a window is equal to several; the one nearest to the group's fullest alignment counts.
    same = same.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*key, "diagonal")))
    same = same.withColumn("main", F.max_by("diagonal", F.struct("n", -F.col("diagonal"))).over(Window.partitionBy(*key)))
    nearest = Window.partitionBy(*key, "item_at", "form").orderBy(F.abs(F.col("diagonal") - F.col("main")), "at")
    same = same.withColumn("near", F.row_number().over(nearest)).filter("near = 1")
    same = stored(same.select(*key, "form", "at", "item_at", "windows", "values", "item_values"), "alignments")
    pairs = same.select(*key, "form", F.explode(F.arrays_zip("values", "item_values")).alias("s"))
    pairs = pairs.select(*key, "form", F.lower("s.values").alias("mine"), F.lower("s.item_values").alias("yours"))
    pairs = pairs.filter(F.col("mine").isNotNull()).distinct()
    # A value with two partners, on either side, makes a form's slots inconsistent.
    twice = [pairs.groupBy(*key, "form", side).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*key, "form") for side in ("mine", "yours")]
    judged = twice[0].unionByName(twice[1]).withColumns({"bad": F.lit(True), "other": F.lit(False)})
    judged = judged.unionByName(pairs.filter(F.col("mine") != F.col("yours")).select(*key, "form", F.lit(False).alias("bad"), F.lit(True).alias("other")))
    judged = judged.groupBy(*key).agg(*[F.coalesce(F.bool_or((F.col("form") == f) & F.col(c)), F.lit(False)).alias(f"{c}{f}") for f in (TEMPLATE, NAMED) for c in ("bad", "other")])
    is_form = {f: F.col("form") == f for f in (LITERAL, TEMPLATE, NAMED)}
    lines = same.groupBy(*key, "item_at").agg(
        *[F.bool_or(c).alias(f"in{f}") for f, c in is_form.items()], *[F.max(F.when(c, F.col("windows"))).alias(f"w{f}") for f, c in is_form.items()], F.min("at").alias("at")
    )
    lines = lines.groupBy(*key).agg(
        *[F.count_if(F.col(f"in{f}")).alias(f"c{f}") for f in is_form], *[F.max(f"w{f}").alias(f"w{f}") for f in is_form],
        F.count_if(F.col("in0") | F.col("in1")).alias("c3"), F.min("at").alias("at"),
    ).withColumn("w3", F.col("w0"))
    lines = lines.join(judged, key, "left").fillna(False, ["bad1", "other1", "bad2", "other2"])
    ways = []
    for n, bad, other in ((TEMPLATE, "bad1", "other1"), (NAMED, "bad2", "other2"), (3, "bad1", "other1")):
        enough = F.coalesce(F.col(f"c{n}") >= F.ceil(F.lit(coverage) * F.col(f"w{n}")), F.lit(False)) & (F.col(f"c{n}") > 0)
        way = F.struct(F.col(f"c{n}").alias("covered"), F.col(f"w{n}").alias("windows"), "at", (~F.col(other)).alias("exact"))
        ways.append(F.when(enough & ~F.col(bad), way))
    good = lines.withColumn("way", F.coalesce(*ways)).filter(F.col("way").isNotNull())
    best = good.groupBy("id", "item").agg(F.max_by("way", F.struct("way.covered", -F.col("way.at"))).alias("b"))
    return best.select(
        F.col("id").alias("doc_id"), F.col("item").alias("item_id"), F.col("b.covered").alias("covered"),
        F.col("b.windows").cast("long").alias("windows"), F.col("b.at").cast("long").alias("at"), F.col("b.exact").alias("exact"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options: Column) -> DataFrame:
    """``docs`` without the contaminated documents; rows without an identifier stay."""
    bad = stored(contaminated(docs, benchmark, id_col, **options).select(F.col("doc_id").alias("__bad")).distinct(), "contaminated")
    return docs.join(bad, docs[id_col].cast("long") == F.col("__bad"), "left_anti").select(*docs.columns)
