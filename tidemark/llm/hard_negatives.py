"""Hard negatives by exact integer scores, with the method of the Four Russians.

Vectors are quantised to whole numbers. For every group of eight dimensions an anchor has a table of its 256 subset sums.
A candidate is packed into bit planes: one byte per plane and group, of the plane's bits of those eight dimensions. The
inner product is then, from the highest plane to the lowest, the doubled total plus one table entry per group; the highest
plane counts negatively, as in two's complement. Nothing is estimated: the scores are those of the full vectors.

Anchors are a stated set of queries. They and the candidates are dealt into blocks of bounded size, and every pair of
blocks is one task's work: first the best rows of an anchor's own label, then, with these known, the best rows of other
labels in the band of each. A block hands on a few rows per anchor, never its scores.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, stored

ANCHOR_ROWS, CANDIDATE_ROWS = 2048, 16_384
# Anchors with tables at one time, and candidates scored at one time: both fit a processor's cache.
TABLES, STRIP = 64, 1024
GROUP = 8


def quantised(vectors: DataFrame, label: Column, anchor: Column, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``id, label, q, anchor, key``: the distinct rows that take part, components as floor(scale * x)."""
    sound = F.forall(vec_col, lambda x: F.coalesce(F.abs(x.cast("double") * scale) < 2.0**63, F.lit(False)))
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.when(sound, F.transform(vec_col, lambda x: F.floor(x.cast("double") * scale))).alias("q"),
    )
    rows = rows.dropna(subset=["id", "label", "q"]).distinct()
    return rows.withColumn("key", F.xxhash64("id", "label", "q"))


def pack_planes(q: np.ndarray, planes: int) -> np.ndarray:
    """Bytes by row, plane (lowest first) and group of eight dimensions; bit j of a byte is dimension j of its group."""
    return np.stack([np.packbits((q >> b & 1).astype(np.uint8), axis=1, bitorder="little") for b in range(planes)], axis=1)


def subset_sums(q: np.ndarray, dtype: type) -> np.ndarray:
    """Tables by group, byte and anchor: the sum of the anchor's components whose bit is set in the byte."""
    groups = q.shape[1] // GROUP
    out = np.zeros((groups, 1 << GROUP, len(q)), dtype)
    for g in range(groups):
        for j in range(GROUP):
            out[g, 1 << j : 2 << j] = out[g, : 1 << j] + q[:, g * GROUP + j].astype(dtype)
    return out


def scores(tables: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """Inner products by candidate and anchor, by lookups, additions and doubling only."""
    rows, planes, groups = packed.shape
    out = np.zeros((rows, tables.shape[2]), tables.dtype)
    for at in range(0, rows, STRIP):
        strip, total = packed[at : at + STRIP], out[at : at + STRIP]
        found = np.empty_like(total)
        for b in range(planes - 1, -1, -1):
            total += total
            for g in range(groups):
                np.take(tables[g], strip[:, b, g], axis=0, out=found, mode="clip")
                if b == planes - 1:
                    total -= found
                else:
                    total += found
    return out


def _packer(dims: int, planes: int) -> Callable:
    """Rows as ``id, label, key, block, planes, q``: packed bits, and the components of anchors."""
    schema = pa.schema([("id", pa.int64()), ("label", pa.int64()), ("key", pa.int64()), ("block", pa.int64()), ("planes", pa.binary()), ("q", pa.binary())])

    def run(batches):  # noqa: ANN001, ANN202
        for batch in batches:
            vectors = batch.column(batch.schema.get_field_index("q"))
            q = np.zeros((len(batch), dims), np.int64)
            lengths = np.diff(vectors.offsets.to_numpy())
            q[np.arange(dims) < lengths[:, None]] = vectors.flatten().to_numpy()
            packed = pack_planes(q, planes)
            anchor = batch.column(batch.schema.get_field_index("anchor")).to_pylist()
            columns = [batch.column(batch.schema.get_field_index(n)) for n in ("id", "label", "key", "block")]
            columns += [pa.array([p.tobytes() for p in packed], pa.binary()), pa.array([v.tobytes() if a else None for a, v in zip(anchor, q)], pa.binary())]
            yield pa.record_batch(columns, schema=schema)

    return run


def _block(table: pa.Table, column: str, shape: tuple[int, ...], dtype: type) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), dtype).reshape(len(table), *shape)


def _ints(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).to_numpy()


def _best_of_own_label(dims: int, planes: int, dtype: type, most: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Per anchor of the block, the best candidates of its label in the block: at most ``most``."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("id")  # ties: the smaller identifier first
        ids, labels, packed = _ints(rows, "id"), _ints(rows, "label"), _block(rows, "planes", (planes, dims // GROUP), np.uint8)
        keys, own, own_ids = _ints(anchors, "key"), _ints(anchors, "label"), _ints(anchors, "id")
        q = _block(anchors, "q", (dims,), np.int64)
        out: tuple[list, list, list] = ([], [], [])
        for label in np.unique(own):
            mine, theirs = np.flatnonzero(own == label), np.flatnonzero(labels == label)
            for at in range(0, len(mine) if len(theirs) else 0, TABLES):
                some = mine[at : at + TABLES]
                got = scores(subset_sums(q[some], dtype), packed[theirs])
                for j, a in enumerate(some):
                    other = np.flatnonzero(ids[theirs] != own_ids[a])
                    column = got[other, j].astype(np.int64)
                    best = np.argsort(~column, kind="stable")[:most]  # ~x falls as x rises, without overflow
                    out[0].extend([keys[a]] * len(best))
                    out[1].extend(ids[theirs][other[best]])
                    out[2].extend(column[best])
        return pa.table([pa.array(c, pa.int64()) for c in out], names=["key", "positive_id", "positive_score"])

    return run


def _best_in_bands(dims: int, planes: int, dtype: type, most: int, low: tuple[int, int], high: tuple[int, int]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Per anchor and positive, the best candidates of other labels whose score is in the positive's band."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("id")
        ids, labels, packed = _ints(rows, "id"), _ints(rows, "label"), _block(rows, "planes", (planes, dims // GROUP), np.uint8)
        keys, own, positives = _ints(anchors, "key"), _ints(anchors, "label"), anchors.column("positives").to_pylist()
        q = _block(anchors, "q", (dims,), np.int64)
        out: tuple[list, list, list, list] = ([], [], [], [])
        for at in range(0, len(keys) if len(ids) else 0, TABLES):
            some = range(at, min(at + TABLES, len(keys)))
            got = scores(subset_sums(q[at : at + TABLES], dtype), packed)
            for j, a in enumerate(some):
                bands = [(-(-low[0] * s // low[1]), high[0] * s // high[1]) for s in positives[a]]
                column = got[:, j].astype(np.int64)
                fit = np.flatnonzero((column >= min(b[0] for b in bands)) & (column <= max(b[1] for b in bands)) & (labels != own[a]))
                falling = ~column[fit]
                order = np.argsort(falling, kind="stable")
                fit, falling = fit[order], falling[order]
                for no, (least, highest) in enumerate(bands):
                    first, end = np.searchsorted(falling, ~highest), np.searchsorted(falling, ~least, side="right")
                    best = fit[first : max(first, min(end, first + most))]
                    out[0].extend([keys[a]] * len(best))
                    out[1].extend([no] * len(best))
                    out[2].extend(ids[best])
                    out[3].extend(column[best])
        return pa.table([pa.array(c, pa.int64()) for c in out], names=["key", "no", "negative_id", "negative_score"])

    return run


def hard_negatives(
    vectors: DataFrame, label: Column | None = None, anchor: Column | None = None, id_col: str = "vec_id", vec_col: str = "embedding",
    positives: int = 5, negatives: int = 10, low: tuple[int, int] = (30, 100), high: tuple[int, int] = (90, 100), scale: int = 256,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Scores are inner products of components floor(``scale`` * x). An anchor's positives are the ``positives`` best other
    rows of its label; for each, the best ``negatives`` rows of other labels with ``low`` * positive_score <= score <=
    ``high`` * positive_score (fractions of whole numbers) are ranked from 1. Ties go to the smaller identifier. A
    positive with a negative score has an empty band. ``label`` is the column ``label`` and ``anchor`` an identifier
    divisible by 100 unless given.

    Rows without identifier, label or vector, and those with a component that is null, not finite or too large for a
    whole number of 64 bits, take no part; scores must fit 64 bits. Shorter vectors count as padded with zeros. Rows that
    are equal in identifier, label and components count once; those that share an identifier only are rows of their own,
    each an anchor if the identifier is one, and none is another's positive. Other columns are not read. No rows, no
    anchors or no partners give an empty result.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    is_anchor = F.col(id_col) % 100 == 0 if anchor is None else anchor
    rows = stored(quantised(vectors, F.col("label") if label is None else label, is_anchor, id_col, vec_col, scale), "negatives-rows")
    facts = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("anchor").alias("anchors"), F.max(F.size("q")).alias("dims"),
        F.max(F.array_max("q")).alias("most"), F.min(F.array_min("q")).alias("least"),
    ).first()
    dims = -(-max(facts["dims"] or 0, 1) // GROUP) * GROUP
    most, least = facts["most"] or 0, facts["least"] or 0
    planes = max(most, ~least).bit_length() + 1
    dtype = np.int32 if dims * max(most, -least) ** 2 < 2**31 else np.int64
    # More, smaller blocks where there are few rows for the tasks at hand.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    c_blocks = max(-(-facts["rows"] // CANDIDATE_ROWS), min(tasks, -(-facts["rows"] // STRIP)), 1)
    a_blocks = max(-(-facts["anchors"] // ANCHOR_ROWS), 1)
    cells = a_blocks * c_blocks
    packer = _packer(dims, planes)
    kinds = "id long, label long, key long, block long, planes binary, q binary"
    candidates = rows.withColumn("block", F.pmod(F.hash("key"), F.lit(c_blocks)).cast("long")).mapInArrow(packer, kinds)
    candidates = candidates.drop("q").withColumn("a", F.explode(F.sequence(F.lit(0), F.lit(a_blocks - 1))))
    candidates = candidates.withColumn("cell", F.col("a") * c_blocks + F.col("block")).repartition(cells, "cell")
    anchors = rows.filter("anchor").withColumn("block", F.pmod(F.hash("key"), F.lit(a_blocks)).cast("long")).mapInArrow(packer, kinds).drop("planes")

    def in_cells(left: DataFrame, best: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
        dealt = left.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))))
        dealt = dealt.withColumn("cell", F.col("block") * c_blocks + F.col("c")).repartition(cells, "cell")
        return dealt.groupBy("cell").cogroup(candidates.groupBy("cell")).applyInArrow(best, schema)

    found = in_cells(anchors, _best_of_own_label(dims, planes, dtype, positives), "key long, positive_id long, positive_score long")
    by_score = Window.partitionBy("key").orderBy(F.desc("positive_score"), "positive_id")
    found = found.withColumn("no", F.row_number().over(by_score)).filter(F.col("no") <= positives)
    found = found.withColumn("no", F.col("no") - 1)
    # At most ``positives`` entries per anchor.
    lists = found.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("no", "positive_id", "positive_score"))).alias("list"))
    lists = stored(lists, "negatives-positives")
    ready = anchors.join(lists, "key").withColumn("positives", F.col("list.positive_score"))
    met = in_cells(ready.drop("list"), _best_in_bands(dims, planes, dtype, negatives, low, high), "key long, no long, negative_id long, negative_score long")
    rank = F.row_number().over(Window.partitionBy("key", "no").orderBy(F.desc("negative_score"), "negative_id"))
    met = met.withColumn("rank", rank).filter(F.col("rank") <= negatives)
    named = rows.filter("anchor").select("key", F.col("id").alias("anchor_id")).join(lists, "key")
    named = named.select("key", "anchor_id", F.explode("list").alias("p")).select("key", "anchor_id", F.col("p.no").cast("long").alias("no"), "p.positive_id", "p.positive_score")
    return met.join(named, ["key", "no"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
