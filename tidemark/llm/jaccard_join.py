"""Exact Jaccard self-join of shingle sets and its connected components.

Pigeonhole over a partitioned universe. Sizes are cut into bands; for a pair whose smaller set is in a band the symmetric
difference has at most H elements. Shingles are hashed into segments, and every set is indexed by its subset in each:

* H + 1 segments, equal subsets: one segment at least has no difference (a few more segments are made, so that the empty
  ones, which are equal in many sets, need not be indexed);
* or half as many segments with one-deletion neighbourhoods (a subset, and it without each of its elements): one segment
  has one difference at most.

For bands of short sets, where both are affordable, the cheaper allocation is chosen by cost: index entries plus
candidates, counted over all documents. A set is indexed in its own band and in those of smaller sets it can be linked
with, so no link is missed.

Components instead of pairs. Every member of an index entry is first paired with the smallest one (a star, so large
groups of near copies stay linear), pairs are verified on the full sets, and components are formed. Only members of an
entry that are still in different components are then paired with each other; sizes and 1024 parity bits, whose
distance is a lower bound of the symmetric difference, discard pairs inside that join. Large sets have more bits, which
are compared before texts are moved. What remains is verified too.
Equal sets are put together beforehand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import attach, bounded_batches, may_match, stored, text_of, worker_slot

SHINGLE = 3
PERCENT = 90
# Ratio of a band's bounds, and the largest H for which both allocations are tried.
BAND = 1.35
TRIED = 3
PARITY_LONGS = 16
# Sets with more elements than this have more parity bits besides, which are looked at pair by pair.
WIDE_FROM, WIDE_LONGS = 1000, 256
# Words whose hash a worker keeps, and the longest of them.
KEPT, KEPT_BYTES = 200_000, 48
# What a candidate costs in index entries.
CANDIDATE_COST = 4
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix."""
    x = (x ^ x >> np.uint64(30)) * _B
    x = (x ^ x >> np.uint64(27)) * _C
    return x ^ x >> np.uint64(31)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        made = xxhash.xxh3_64_intdigest(word)
        if len(word) <= KEPT_BYTES:
            if len(self) >= KEPT:
                self.clear()
            self[word] = made
        return made


def shingle_set(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; fewer words than ``size`` are one shingle."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and white space only
    if not words:
        return np.empty(0, np.uint64)
    known = worker_slot("jaccard", None, _Words)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    n = len(h) - size + 1
    total = np.full(n, np.uint64(size))
    for k in range(size):
        total = mix(total + h[k : k + n] * _A)
    return np.unique(total)


class Bands:
    """Size bands of a threshold in percent."""

    def __init__(self, percent: int) -> None:
        if not 50 <= percent < 100:
            raise ValueError("the threshold is 50 to 99 percent")
        self.percent, self.starts, self.limit = percent, [1], []

    def _differences(self, a: int, b: int) -> int:
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def of(self, size: int) -> int:
        """The band of a size; bands are made up to it."""
        while self.starts[-1] <= size:
            low = self.starts[-1]
            high = max(low + 1, int(low * BAND + 0.999))
            self.limit.append(self._differences(high - 1, (high - 1) * 100 // self.percent))
            self.starts.append(high)
        lo, hi = 0, len(self.starts) - 1
        while lo < hi:
            mid = (lo + hi + 1) // 2
            lo, hi = (mid, hi) if self.starts[mid] <= size else (lo, mid - 1)
        return lo

    def indexed(self, size: int) -> range:
        """Bands of the smaller sets that a set of this size can be linked with, its own included."""
        return range(self.of(-(-size * self.percent // 100)), self.of(size) + 1)


def slack(h: int) -> int:
    """Segments beyond the h + 1 that the pigeonhole needs, so that empty ones need not be indexed."""
    return (h + 1) // 16 + 1


def index_keys(s: np.ndarray, band: int, segments: int, deletions: bool, spare: int = 0) -> np.ndarray:
    """Hashes of the set's subsets in each segment, with one-deletion neighbourhoods if asked for.

    With ``spare`` segments more than needed, up to so many empty ones are left out: enough others remain for one to be
    equal in any set that can be linked. A set with more empty segments has them all, and so meets others like it.
    """
    mode = np.uint64(2 * band + deletions + 1)
    value = mix(s + mode * _A)
    segment = (s >> np.uint64(20)) % np.uint64(segments)
    at = segment.astype(np.int64)
    content = np.zeros(segments, np.uint64)
    np.add.at(content, at, value)
    number = mix(np.arange(segments, dtype=np.uint64) * _A + mode)
    keys = mix(content ^ number)
    if spare:
        filled = np.bincount(at, minlength=segments) > 0
        if segments - int(filled.sum()) <= spare:
            keys = keys[filled]
    return np.concatenate([keys, mix((content[at] - value) ^ number[at])]) if deletions else keys


def parity(s: np.ndarray, longs: int = PARITY_LONGS) -> np.ndarray:
    """Parity of the elements hashed to each of the bits, as signed 64-bit integers."""
    bits = np.bincount((mix(s ^ _C) & np.uint64(64 * longs - 1)).astype(np.int64), minlength=64 * longs) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


_SETS = "id long, n long, d1 long, d2 long, bits array<long>, wide array<long>, keys array<long>, tried array<struct<band:int,mode:int,key:long>>"


def _sets(docs: DataFrame, percent: int, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        tried_kind = pa.list_(pa.struct([("band", pa.int32()), ("mode", pa.int32()), ("key", pa.int64())]))
        with np.errstate(over="ignore"):
            for batch in batches:
                cols: list[list] = [[] for _ in range(8)]
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    s = shingle_set(text, size)
                    keys, tried = [], []
                    for band in bands.indexed(len(s)) if len(s) else ():
                        h = bands.limit[band]
                        if h > TRIED:
                            keys.append(index_keys(s, band, h + 1 + slack(h), False, slack(h)))
                        elif h:
                            for mode, m, spare in ((0, h + 1 + slack(h), slack(h)), (1, (h + 2) // 2, 0)):
                                made = index_keys(s, band, m, bool(mode), spare).view(np.int64).tolist()
                                tried += [{"band": band, "mode": mode, "key": k} for k in made]
                    v = mix(s)
                    digest = np.array([np.bitwise_xor.reduce(v), v.sum(dtype=np.uint64)], np.uint64).view(np.int64).tolist() if len(s) else [None, None]
                    wide = parity(s, WIDE_LONGS) if len(s) > WIDE_FROM else None
                    row = (key, len(s), *digest, parity(s), wide, np.concatenate(keys).view(np.int64) if keys else [], tried)
                    for c, x in zip(cols, row):
                        c.append(x)
                kinds = [*[pa.int64()] * 4, *[pa.list_(pa.int64())] * 3, tried_kind]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], names=["id", "n", "d1", "d2", "bits", "wide", "keys", "tried"])

    return docs.mapInArrow(run, _SETS)


def _verified(pairs: DataFrame, texts: DataFrame, percent: int, size: int) -> DataFrame:
    """Of the pairs ``a, b`` those whose sets are similar enough, computed on the whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                keep = []
                last = (None, None)
                for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                    if last[0] != y:  # many pairs in a row have the same smallest member
                        last = (y, shingle_set(y, size))
                    s, t = shingle_set(x, size), last[1]
                    common = len(np.intersect1d(s, t, assume_unique=True))
                    keep.append(100 * common >= percent * (len(s) + len(t) - common))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    needed = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    some = may_match(texts, "id", needed)
    left = pairs.join(some.withColumnsRenamed({"id": "a", "text": "x"}), "a")
    both = left.join(some.withColumnsRenamed({"id": "b", "text": "y"}), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long").distinct()


def _far(other: str = "o_") -> Column:
    """Lower bound of the symmetric difference from the parities of both sides."""
    total = F.lit(0)
    for i in range(PARITY_LONGS):
        total = total + F.bit_count(F.get(F.col("bits"), i).bitwiseXOR(F.get(F.col(f"{other}bits"), i)))
    return total


def _possible(percent: int) -> Column:
    """Whether sizes and parities allow a link."""
    n, o = F.col("n"), F.col("o_n")
    sizes = (100 * F.least(n, o)) >= (percent * F.greatest(n, o))
    return sizes & ((100 + percent) * _far() <= (100 - percent) * (n + o))


def _not_far(pairs: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` without those of large sets whose many parity bits show that they are too different."""
    wide = facts.filter(F.col("wide").isNotNull()).select("id", "n", "wide")
    both = pairs.join(wide.withColumnsRenamed({"id": "a"}), "a", "left")
    both = both.join(wide.withColumnsRenamed({"id": "b", "n": "o_n", "wide": "o_wide"}), "b", "left")
    differ = F.zip_with("wide", "o_wide", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    far = F.aggregate(differ, F.lit(0), lambda total, x: total + x)
    keep = F.col("wide").isNull() | F.col("o_wide").isNull() | ((100 + percent) * far <= (100 - percent) * (F.col("n") + F.col("o_n")))
    return both.filter(keep).select("a", "b")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``id, component``: the smallest identifier reachable, for every identifier in the edges ``a, b``.

    Alternating star contractions: each round links neighbours with their smallest neighbour, until nothing changes.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), name)
    before = None
    while True:
        state = tuple(now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        if state == before:
            return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("id"), F.col("v").alias("component"))
            ).groupBy("id").agg(F.min("component").alias("component"))
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        down = large.join(least, "u")
        small = down.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        now = stored(small.filter("u > v").distinct(), name)


def _index(sets: DataFrame) -> DataFrame:
    """``key, id``: all index entries, with the cheaper allocation in bands where both were made."""
    tried = sets.select("id", F.explode("tried").alias("t")).select("id", "t.band", "t.mode", "t.key")
    sizes = tried.groupBy("band", "mode", "key").agg(F.count(F.lit(1)).alias("n"))
    costs = sizes.groupBy("band", "mode").agg((F.sum("n") + CANDIDATE_COST * F.sum(F.col("n") - 1)).alias("cost")).collect()  # two rows per band
    best: dict[int, tuple[int, int]] = {}
    for r in costs:
        best[r.band] = min(best.get(r.band, (r.cost, r["mode"])), (r.cost, r["mode"]))
    chosen = F.lit(False)
    for band, (_, mode) in sorted(best.items()):
        chosen = chosen | ((F.col("band") == band) & (F.col("mode") == mode))
    return sets.select(F.explode("keys").alias("key"), "id").unionByName(tried.filter(chosen).select("key", "id"))


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """One row per input row: ``id_col, n_shingles, component_id``.

    Texts without words (null, empty, blank) have no shingles and are linked with nothing. Rows without an identifier
    have a null component and link nothing. Rows that share an identifier are one document, linked with whatever any of
    its texts is linked with. Other columns are not read. An empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    sets = stored(_sets(rows, percent, size), "sets")
    known = sets.filter(F.col("id").isNotNull() & (F.col("n") > 0))
    equal = stored(known.groupBy("d1", "d2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("times")), "equal-sets")
    by_digest = equal.select(F.struct("d1", "d2").alias("digest"), "rep", "times")
    owners = stored(attach(known.select("id", F.struct("d1", "d2").alias("digest")), by_digest, "digest", "times").select("id", "rep").distinct(), "owners")
    texts = rows.filter(F.col("id").isNotNull())

    index = _index(known)
    groups = index.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    groups = stored(groups.filter("first <> last").select("key", "first"), "index-groups")
    members = stored(index.join(groups, "key").join(owners, "id").select("key", "rep").distinct(), "index-members")
    stars = members.groupBy("key").agg(F.min("rep").alias("b"))
    facts = stored(known.join(equal.select(F.col("rep").alias("id")), "id", "left_semi").select("id", "n", "bits", "wide").dropDuplicates(["id"]), "set-facts")
    pairs = members.join(stars, "key").select(F.col("rep").alias("a"), "b").filter("a <> b").distinct()
    mine = facts.select(F.col("id").alias("a"), "n", "bits")
    theirs = facts.select(F.col("id").alias("b"), F.col("n").alias("o_n"), F.col("bits").alias("o_bits"))
    pairs = pairs.join(mine, "a").join(theirs, "b").filter(_possible(percent)).select("a", "b")
    pairs = stored(_not_far(pairs, facts, percent), "star-pairs")
    links = stored(_verified(pairs, texts, percent, size), "star-links")
    first = stored(components(links), "star-components")

    placed = members.join(first.withColumnRenamed("id", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    open_keys = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("key")
    left = stored(placed.join(open_keys, "key").join(facts.select(F.col("id").alias("rep"), "n", "bits"), "rep"), "open-members")
    other = left.select("key", *[F.col(c).alias(f"o_{c}") for c in ("rep", "component", "n", "bits")])
    apart = left.join(other, (left["key"] == other["key"]) & (F.col("rep") > F.col("o_rep")) & (F.col("component") != F.col("o_component")) & _possible(percent))
    more = apart.select(F.col("rep").alias("a"), F.col("o_rep").alias("b")).distinct()
    more = stored(_not_far(more.join(pairs, ["a", "b"], "left_anti"), facts, percent), "open-pairs")
    links = links.unionByName(_verified(more, texts, percent, size))
    same_id = owners.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).filter("a <> b").select("a", "b")
    final = stored(components(links.unionByName(same_id)), "set-components")

    rep_of = stored(equal.join(final.withColumnRenamed("id", "rep"), "rep", "left").select(F.struct("d1", "d2").alias("digest"), F.coalesce("component", "rep").alias("component_id"), "times"), "set-classes")
    linked = attach(known.select("id", "n", F.struct("d1", "d2").alias("digest")), rep_of, "digest", "times").select("id", "n", "component_id")
    alone = sets.filter(F.col("id").isNull() | (F.col("n") == 0)).select("id", "n", F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")
