"""Resharding with the fewest bytes moved.

A layout is a folder of Parquet files below one directory per shard; a file is a block. Given the bytes of the old shards
and the capacities of the new ones, a minimum-cost flow says how many bytes each old shard sends to each new one. The
rows of an old shard lie on a line, block after block; the flow cuts that line into ranges, one per target. A block inside
one range stays or moves as a whole, and only the few blocks that hold a cut are split by rows. Files without a row that
moves are left as they are, the others are written anew.

Spark has the rows, the blocks and their running sums. The driver sees sums per shard, the cuts, and the large rows, of
which there are at most ``LARGE_SHARE`` times the number of shards: rows that no flow in bytes can place, because they
cannot be divided.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark import runtime
from tidemark.llm.common import stored

# A row of more than 1/LARGE_SHARE of a mean shard is placed by itself.
LARGE_SHARE = 32
FILE_ROWS = 1_000_000
SHARD, SIZE, FILE, ROW, SLOT, FROM = "__shard", "__size", "__file", "__row", "__slot", "__from"
_END = 2**63 - 1


def row_bytes(text_col: str) -> Column:
    """UTF-8 bytes of the text, none for null, plus one."""
    return (F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)) + 1).cast("long")


@dataclass(frozen=True)
class Layout:
    """A folder of shards; the schema is kept because an empty one has no file to read it from."""

    spark: SparkSession
    path: str
    schema: StructType

    def read(self) -> DataFrame:
        """The rows with the place of each: shard, size, file and number in the file."""
        rows = self.spark.read.schema(self.schema).parquet(self.path)
        place = rows.metadataColumn("_metadata")
        return rows.withColumns({FILE: place["file_name"], ROW: place["row_index"]})


def _write(rows: DataFrame, path: str) -> Layout:
    """Large shards are split over several files and tasks, small ones are put together (Spark's rebalance)."""
    files = rows.hint("rebalance", F.col(SHARD))
    files.write.mode("errorifexists").option("maxRecordsPerFile", FILE_ROWS).partitionBy(SHARD).parquet(path)
    return Layout(rows.sparkSession, path, rows.schema)


def write_layout(docs: DataFrame, path: str, shard: Column, text_col: str = "text") -> Layout:
    """Write ``docs`` with all its columns as shards of files; ``shard`` is a whole number from 0 on."""
    clash = {SHARD, SIZE, FILE, ROW, SLOT, FROM} & set(docs.columns)
    if clash:
        raise ValueError(f"columns named {sorted(clash)} are reserved")
    return _write(docs.withColumns({SHARD: shard.cast("int"), SIZE: row_bytes(text_col)}), path)


def least_cost_flow(supply: Sequence[int], capacity: Sequence[int], cost: Sequence[Sequence[int]]) -> list[list[int]]:
    """Units sent from each supply to each capacity at the least cost; costs are not negative.

    Shortest augmenting paths in the residual network, whose size is that of ``cost``, whatever the units are.
    """
    if sum(supply) > sum(capacity):
        raise ValueError("the capacities are smaller than what is to be placed")
    many, more = len(supply), len(capacity)
    sent = [[0] * more for _ in range(many)]
    left, room = list(supply), list(capacity)
    while any(left):
        # Distances from all supplies that have units left; nodes are supplies, then capacities.
        dist: list[float] = [0 if x else float("inf") for x in left] + [float("inf")] * more
        came = [-1] * (many + more)
        changed = True
        while changed:
            changed = False
            for o in range(many):
                for n in range(more):
                    if dist[o] + cost[o][n] < dist[many + n]:
                        dist[many + n], came[many + n], changed = dist[o] + cost[o][n], o, True
                    if sent[o][n] and dist[many + n] - cost[o][n] < dist[o]:
                        dist[o], came[o], changed = dist[many + n] - cost[o][n], many + n, True
        end = min((n for n in range(more) if room[n]), key=lambda n: dist[many + n])
        path, node = [], many + end
        while came[node] >= 0:
            path.append((came[node], node))
            node = came[node]
        units = min([left[node], room[end], *(sent[b][a - many] for a, b in path if a >= many)])
        for a, b in path:
            if a < many:
                sent[a][b - many] += units
            else:
                sent[b][a - many] -= units
        left[node] -= units
        room[end] -= units
    return sent


def moving_costs(old: int, new: int) -> list[list[int]]:
    """A byte that stays costs nothing, one that moves costs one."""
    return [[int(o != n) for n in range(new)] for o in range(old)]


def equal_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (n < total % shards) for n in range(shards)]


def _room(capacity: Sequence[int], taken: Sequence[int], needed: int, level: bool) -> list[int]:
    """What large rows leave of the capacities, all changed by one amount, the least with which ``needed`` fits.

    Without ``level`` capacities are raised only, where large rows have overfilled some and the rest lacks room.
    """
    room = lambda more: [max(0, c + more - t) for c, t in zip(capacity, taken)]
    low, high = -max(capacity) if level else 0, needed + max(taken)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if sum(room(middle)) >= needed else (middle + 1, high)
    return room(low)


@dataclass(frozen=True)
class Resharding:
    """A finished resharding: the old layout without the files for which ``gone`` holds, and those written anew."""

    old: Layout
    anew: Layout
    gone: Column
    capacities: tuple[int, ...]
    # Bytes by (old shard, new shard), as the flow has them; large rows are not in it.
    flow: tuple[tuple[int, ...], ...]

    def read(self) -> DataFrame:
        """All rows in their new shards: the columns of the table and ``__shard, __size, __slot, __from``.

        ``__slot`` numbers a shard's rows from 0 without a gap: first those of files left in place, then the others, in
        the order of file names and of rows in the files. ``__from`` is the old shard.
        """
        kept = self.old.read().filter(~self.gone).withColumns({"__anew": F.lit(0), FROM: F.col(SHARD)})
        rows = kept.unionByName(self.anew.read().withColumn("__anew", F.lit(1)))
        files = rows.groupBy(SHARD, "__anew", FILE).agg(F.count(F.lit(1)).alias("rows"))
        # One row per file: a shard's files are few enough for one task.
        order = Window.partitionBy(SHARD).orderBy("__anew", FILE)
        first = F.sum("rows").over(order) - F.col("rows")
        files = stored(files.select(SHARD, "__anew", FILE, first.alias("__first")), "reshard-files")
        placed = rows.join(runtime.broadcast_if_small(files), [SHARD, "__anew", FILE])
        return placed.withColumn(SLOT, F.col("__first") + F.col(ROW)).drop("__first", "__anew", FILE, ROW)


def reshard(
    layout: Layout, new_path: str, shards: int, capacities: Sequence[int] | None = None, costs: Sequence[Sequence[int]] | None = None,
) -> Resharding:
    """Bring a layout to shards 0 .. ``shards`` - 1 and write what has to move below ``new_path``.

    ``capacities`` are bytes per new shard, equal ones unless given; together they must hold the whole table. ``costs``
    has the cost of a byte from each old to each new shard, 0 for staying and 1 for moving unless given. Rows are not
    divided: a shard may be over its capacity by a row at each of its cuts, and by large rows, which stay where they fit
    and else go where most room is. The old folder is not changed; the files that are not part of the result any more can
    be removed later. Null texts have one byte; repeated rows and rows without an identifier are rows like others, since
    rows are addressed by file and number. An empty layout gives an empty one.
    """
    spark = layout.spark
    rows = layout.read()
    slim = rows.select(SHARD, FILE, ROW, SIZE)
    sums = {r[SHARD]: r["bytes"] for r in slim.groupBy(SHARD).agg(F.sum(SIZE).alias("bytes")).collect()}
    total = sum(sums.values())
    old = max([0, *sums]) + 1
    capacity = list(capacities) if capacities is not None else equal_capacities(total, shards)
    if len(capacity) != shards or sum(capacity) < total:
        raise ValueError("one capacity per new shard, and room for all bytes")
    cost = costs if costs is not None else moving_costs(old, shards)
    # Large rows: at most LARGE_SHARE * shards of them, as each has more than that share of all bytes.
    limit = max(1, total // (LARGE_SHARE * shards))
    is_large = F.col(SIZE) > limit
    placed: list[tuple[int, str, int, int]] = []
    taken, rest = [0] * shards, [sums.get(o, 0) for o in range(old)]
    for r in slim.filter(is_large).orderBy(F.col(SIZE).desc(), SHARD, FILE, ROW).collect():
        o, size = r[SHARD], r[SIZE]
        fits = [n for n in range(shards) if taken[n] + size <= capacity[n]]
        to = min(fits, key=lambda n: (cost[o][n], taken[n] - capacity[n])) if fits else max(range(shards), key=lambda n: capacity[n] - taken[n])
        taken[to] += size
        rest[o] -= size
        placed.append((o, r[FILE], r[ROW], to))
    room = _room(capacity, taken, sum(rest), level=capacities is None)
    flow = least_cost_flow(rest, room, cost)
    # The line of each old shard in ranges, what stays first; the last one has no end, so that blocks without bytes meet it.
    ranges = []
    for o in range(old):
        at, mine = 0, sorted((n for n in range(shards) if flow[o][n]), key=lambda n: (n != o, n)) or [min(range(shards), key=lambda n: cost[o][n])]
        for n in mine:
            ranges.append((o, at, _END if n == mine[-1] else at + flow[o][n], n))
            at += flow[o][n]
    lines = F.broadcast(spark.createDataFrame(ranges, f"{SHARD} int, lo long, hi long, to int"))  # at most old + new rows, or old * new
    own = F.when(is_large, 0).otherwise(F.col(SIZE))
    blocks = slim.groupBy(SHARD, FILE).agg(F.sum(own).alias("bytes"))
    upto = F.sum("bytes").over(Window.partitionBy(SHARD).orderBy(FILE))
    blocks = blocks.withColumn("end", upto).withColumn("start", F.col("end") - F.col("bytes"))
    in_range = (F.col("start") >= F.col("lo")) & (F.col("start") < F.col("hi"))
    blocks = stored(blocks.join(lines, SHARD).filter(in_range), "reshard-blocks")
    cut = blocks.filter(F.col("end") > F.col("hi")).select(SHARD, FILE, "start").collect()  # one per cut at most
    straddling, targets = [], None
    if cut:
        starts = F.broadcast(spark.createDataFrame([tuple(c) for c in cut], f"{SHARD} int, {FILE} string, block_start long"))
        of_cut = slim.filter(_named([(c[SHARD], c[FILE]) for c in cut]) & ~is_large).join(starts, [SHARD, FILE])
        within = F.sum(SIZE).over(Window.partitionBy(SHARD, FILE).orderBy(ROW))
        of_cut = of_cut.withColumn("end", F.col("block_start") + within).withColumn("start", F.col("end") - F.col(SIZE))
        of_cut = of_cut.join(lines, SHARD).filter(in_range)
        targets = stored(of_cut.select(SHARD, FILE, ROW, SIZE, "start", "end", "hi", "to"), "reshard-cut")
        whole = targets.filter(F.col("end") <= F.col("hi"))
        straddling = targets.filter(F.col("end") > F.col("hi")).orderBy(F.col(SIZE).desc(), SHARD, FILE, ROW).collect()
        targets = whole.select(SHARD, FILE, ROW, "to")
    # A row over a cut goes to the side that lacks most of what it was to get from such rows.
    touched = [[(n, min(hi, r["end"]) - max(lo, r["start"])) for o, lo, hi, n in ranges if o == r[SHARD] and lo < r["end"] and hi > r["start"]] for r in straddling]
    short = [0] * shards
    for n, part in (x for t in touched for x in t):
        short[n] += part
    for r, t in zip(straddling, touched):
        to = max((n for n, _ in t), key=lambda n: (short[n], n == r[SHARD]))
        short[to] -= r[SIZE]
        placed.append((r[SHARD], r[FILE], r[ROW], to))
    exceptions = spark.createDataFrame(placed, f"{SHARD} int, {FILE} string, {ROW} long, own_to int")
    # Blocks that move as a whole are neighbours on the line: one pair of names for each range.
    moving = blocks.filter((F.col("to") != F.col(SHARD)) & (F.col("end") <= F.col("hi")))
    moved = moving.groupBy(SHARD, "to").agg(F.min(FILE).alias("first"), F.max(FILE).alias("last")).collect()
    homes = exceptions.join(blocks.select(SHARD, FILE, "to"), [SHARD, FILE]).filter(F.col("own_to") != F.col("to"))
    odd = [(r[SHARD], r[FILE]) for r in homes.select(SHARD, FILE).distinct().collect()]
    affected = [F.lit(False), _named([(c[SHARD], c[FILE]) for c in cut] + odd)]
    affected += [(F.col(SHARD) == m[SHARD]) & F.col(FILE).between(m["first"], m["last"]) for m in moved]
    gone = reduce(lambda a, b: a | b, affected)
    todo = rows.filter(gone).join(F.broadcast(exceptions), [SHARD, FILE, ROW], "left")
    todo = todo.join(runtime.broadcast_if_small(blocks.select(SHARD, FILE, F.col("to").alias("block_to"))), [SHARD, FILE])
    if targets is not None:
        todo = todo.join(runtime.broadcast_if_small(targets.withColumnRenamed("to", "cut_to")), [SHARD, FILE, ROW], "left")
    known = [F.col(c) for c in ("own_to", "cut_to", "block_to") if c in todo.columns]
    todo = todo.withColumn("__to", F.coalesce(*known)).drop("own_to", "cut_to", "block_to", FILE, ROW)
    anew = _write(todo.withColumnRenamed(SHARD, FROM).withColumnRenamed("__to", SHARD), new_path)
    return Resharding(layout, anew, gone, tuple(capacity), tuple(map(tuple, flow)))


def _named(files: Sequence[tuple[int, str]]) -> Column:
    """Whether a row's file is one of the named ones."""
    by_shard: dict[int, set[str]] = {}
    for shard, name in files:
        by_shard.setdefault(shard, set()).add(name)
    named = [(F.col(SHARD) == s) & F.col(FILE).isin(*sorted(names)) for s, names in sorted(by_shard.items())]
    return reduce(lambda a, b: a | b, named, F.lit(False))
