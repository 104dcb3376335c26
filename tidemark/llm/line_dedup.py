"""Removal of repeated lines, exact and within one edit, with DataFrame operations only.

Lines are compared without surrounding blanks. Of equal lines the earliest stays, by (document identifier, position);
blank lines always stay. A line within one insertion, deletion or substitution of an earlier line goes too, if both have a
least length: short lines that differ by one character are different. Such pairs are found by the join of
deletion neighbourhoods: every line emits the hashes of itself and of itself without each of its characters.

* Equal variants that lack the character at the same place: the lines differ by a substitution at most.
* A line that equals another's variant: they differ by one insertion.

In either case the earliest member of the group is a neighbour of all others that the rule names, so a minimum per group
replaces the pairs. The edit distance to the neighbour found is verified on the texts.

Variants are emitted only by lines that can have a neighbour at all: two lines within one edit have lengths that differ
by one at most and share their first or their last half, so lines that share neither with another line of such a length
are left out beforehand. Nothing else is: the result is that of comparing all lines with all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import attach, may_match, stored

BLANKS = " \t\r"
# From this length on, hashes of variants come from running sums over the characters instead of the texts themselves.
LONG_CHARS = 16_384


def with_row_keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with ``__row``, a key of each row that grows with the identifier.

    A row that has its identifier for itself is known by it. Rows that share one, or have none, are stored in order of
    (identifier, first characters, digest of the text) and numbered in it, so that equal rows too have keys of their own;
    those without an identifier come last.
    """
    own_id, wide = F.col(id_col).cast("long"), "decimal(38,0)"
    base = lambda c: (c.cast("decimal(20,0)") * F.lit(2**31).cast("decimal(10,0)")).cast(wide)
    ids = docs.select(own_id.alias("__id")).groupBy("__id").agg(F.count(F.lit(1)).alias("__rows"))
    shared = stored(ids.filter(F.col("__id").isNull() | (F.col("__rows") > 1)), "line-shared")
    if shared.isEmpty():
        return docs.withColumn("__row", base(own_id))
    known, wanted = docs.withColumn("__id", own_id).filter(own_id.isNotNull()), shared.filter(F.col("__id").isNotNull())
    odd = may_match(known, "__id", wanted).join(wanted.select("__id"), "__id", "left_semi")
    own = may_match(known, "__id", wanted, others=True).unionByName(may_match(known, "__id", wanted).join(wanted.select("__id"), "__id", "left_anti"))
    odd = odd.select(*docs.columns, "__id").unionByName(docs.withColumn("__id", own_id).filter(own_id.isNull()).select(*docs.columns, "__id"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    order = [F.col("__id").asc_nulls_last(), F.substring(text, 1, 64), F.sha2(text, 256)]
    odd = stored(odd.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__n", F.monotonically_increasing_id()), "line-odd")
    # Numbers without gaps: what earlier partitions hold is added, one row for each of them.
    part = F.shiftright("__n", 33)
    parts = odd.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__rows")).orderBy("__part").collect()
    before, total = [], 0
    for r in parts:
        before.append((r["__part"], total))
        total += r["__rows"]
    offsets = F.broadcast(odd.sparkSession.createDataFrame(before, "__part long, __before long"))  # one row per partition
    odd = odd.withColumn("__part", part).join(offsets, "__part").withColumn("__n", F.col("__before") + F.col("__n").bitwiseAND(F.lit(2**33 - 1)))
    nobody = odd.filter(F.col("__id").isNull()).withColumn("__row", base(F.expr("9223372036854775808BD + __n")))
    firsts = stored(odd.filter(F.col("__id").isNotNull()).groupBy("__id").agg(F.min("__n").alias("__first"), F.count(F.lit(1)).alias("__rows")), "line-firsts")
    several = attach(odd.filter(F.col("__id").isNotNull()), firsts, "__id", "__rows")
    at = F.col("__n") - F.col("__first")
    at = F.when(at < 2**31, at).otherwise(F.raise_error(F.lit("more than 2^31 rows share an identifier")))
    several = several.withColumn("__row", (base(F.col("__id")) + at.cast("decimal(10,0)")).cast(wide))
    columns = [*docs.columns, "__row"]
    return own.withColumn("__row", base(F.col("__id"))).select(*columns).unionByName(several.select(*columns)).unionByName(nobody.select(*columns))


def _lines(rows: DataFrame, text_col: str) -> DataFrame:
    at = rows.select("__row", F.posexplode_outer(F.split(F.col(text_col).cast("string"), "\n", -1)).alias("pos", "raw"))
    return at.select("__row", "pos", F.btrim("raw", F.lit(BLANKS)).alias("line"))


def _order() -> Column:
    """Position of a line among all lines."""
    return (F.col("__row") * F.lit(2**31).cast("decimal(10,0)") + F.col("pos").cast("decimal(10,0)")).cast("decimal(38,0)")


def _half_keys() -> dict[str, Column]:
    """Hashes of both halves for partners of the same length or shorter (longer line's length n) and longer (n + 1)."""
    out = {}
    for k, tag in (("same", F.col("n")), ("longer", F.col("n") + 1)):
        half = ((tag - 1) / 2).cast("int")
        out[f"{k}_head"] = F.xxhash64(F.lit("head"), tag, F.substring(F.col("line"), F.lit(1), half))
        out[f"{k}_tail"] = F.xxhash64(F.lit("tail"), tag, F.substring(F.col("line"), F.col("n") - half + 1, half))
    return out


def _variants(lines: DataFrame, long_chars: int) -> DataFrame:
    """``ord, z, at``: the hash of the line (``at`` 0) and of the line without its character ``at``.

    A line that shares only its first half with others can differ from them only behind it, and the other way round.
    """
    half = ((F.col("n") - 1) / 2).cast("int")
    lo, hi = F.when(F.col("by_tail"), 1).otherwise(half + 1), F.when(F.col("by_head"), F.col("n")).otherwise(F.col("n") - half)
    lines = lines.withColumns({"lo": lo, "hi": hi})
    short = lines.filter(F.col("n") <= long_chars)
    cut = short.select("ord", "line", F.explode(F.concat(F.array(F.lit(0)), F.sequence("lo", "hi"))).alias("at"))
    without = F.concat(F.substring(F.col("line"), F.lit(1), F.col("at") - 1), F.substring(F.col("line"), F.col("at") + 1, F.char_length("line")))
    by_text = cut.select("ord", F.xxhash64(F.lit("text"), F.when(F.col("at") == 0, F.col("line")).otherwise(without)).alias("z"), "at")
    # Characters hashed with their place, combined by exclusive or: what stands before a gap keeps its place, what stands
    # behind it moves up by one. A line of exactly the limit is emitted in both ways and so meets both neighbours.
    long = lines.filter(F.col("n") >= long_chars).repartition("ord")
    chars = long.select("ord", "lo", "hi", F.posexplode(F.split("line", "")).alias("at", "c"))
    chars = chars.withColumns({"own": F.xxhash64("c", "at"), "moved": F.xxhash64("c", F.col("at") - 1)})
    upto = Window.partitionBy("ord").orderBy("at")
    whole = Window.partitionBy("ord")
    run = chars.select(
        "ord", "lo", "hi", "at", "own", F.bit_xor("own").over(upto).alias("own_upto"), F.bit_xor("moved").over(upto).alias("moved_upto"),
        F.bit_xor("own").over(whole).alias("own_all"), F.bit_xor("moved").over(whole).alias("moved_all"),
    )
    gap = F.col("own_upto").bitwiseXOR(F.col("own")).bitwiseXOR(F.col("moved_all")).bitwiseXOR(F.col("moved_upto"))
    gaps = run.filter((F.col("at") + 1).between(F.col("lo"), F.col("hi"))).select("ord", F.xxhash64(F.lit("sum"), gap).alias("z"), (F.col("at") + 1).alias("at"))
    full = run.filter(F.col("at") == 0).select("ord", F.xxhash64(F.lit("sum"), "own_all").alias("z"), F.lit(0).alias("at"))
    return by_text.unionByName(gaps).unionByName(full)


def _near(candidates: DataFrame, long_chars: int) -> DataFrame:
    """``ord, near_ord``: lines with an earlier line within one edit, and the earliest such line."""
    # The table is small, what is made of it is not: deal it out to all tasks.
    parts = int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _variants(candidates.repartition(parts, "ord"), long_chars)
    gapped, full = F.when(F.col("at") > 0, F.col("ord")), F.when(F.col("at") == 0, F.col("ord"))
    groups = rows.groupBy("z").agg(F.min("ord").alias("lo"), F.max("ord").alias("hi"), F.min(gapped).alias("first_gapped"), F.min(full).alias("first_full"))
    shared = stored(groups.filter(F.col("lo") != F.col("hi")).drop("lo", "hi"), "line-variants")
    met = stored(may_match(rows, "z", shared).join(shared, "z"), "line-met")
    same_gap = met.filter(F.col("at") > 0).groupBy("z", "at").agg(F.min("ord").alias("first_here"))
    found = met.join(same_gap, ["z", "at"], "left")
    other = F.when(F.col("at") == 0, F.col("first_gapped")).otherwise(F.least("first_here", "first_full"))
    pairs = found.withColumn("near_ord", other).filter(F.col("near_ord") < F.col("ord")).groupBy("ord").agg(F.min("near_ord").alias("near_ord"))
    texts = candidates.select("ord", "line")
    both = pairs.join(texts, "ord").join(texts.select(F.col("ord").alias("near_ord"), F.col("line").alias("near_line")), "near_ord")
    return both.filter(F.levenshtein("line", "near_line", 1).between(0, 1)).select("ord", "near_ord")


def repeated_lines(rows: DataFrame, text_col: str = "text", min_chars: int = 24, long_chars: int = LONG_CHARS) -> DataFrame:
    """The lines to remove from rows with a key ``__row``: ``__row, pos, edits``.

    ``edits`` is 0 for a repeated line and 1 for a line within one edit; lines of fewer than ``min_chars`` characters are
    not compared for the latter. A null text has no lines.
    """
    lines = _lines(rows, text_col).withColumn("n", F.char_length("line")).filter(F.col("n") > 0)
    keys = {k: F.when(F.col("n") >= min_chars, c) for k, c in _half_keys().items()}
    hashed = lines.withColumns({"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit(1), "line"), "ord": _order(), **keys})
    hashed = stored(hashed.drop("line", "n"), "line-hashes")
    distinct = hashed.groupBy("h1", "h2").agg(F.min("ord").alias("first_ord"), F.count(F.lit(1)).alias("times"), *[F.max(k).alias(k) for k in keys])
    distinct = stored(distinct, "line-distinct")
    halves = distinct.select("first_ord", F.explode(F.array(*[F.struct(F.col(k).alias("half"), F.lit(k.endswith("head")).alias("head")) for k in keys])).alias("h"))
    halves = halves.select("first_ord", "h.half", "h.head").filter(F.col("half").isNotNull())
    shared = halves.groupBy("half").agg(F.min("first_ord").alias("lo"), F.max("first_ord").alias("hi")).filter(F.col("lo") != F.col("hi")).select("half")
    shared = stored(shared, "line-halves")
    able = stored(may_match(halves, "half", shared).join(shared, "half", "left_semi").groupBy("first_ord").agg(
        F.bool_or("head").alias("by_head"), F.bool_or(~F.col("head")).alias("by_tail")
    ), "line-able")
    pos, row = F.expr("pmod(first_ord, 2147483648BD)"), F.expr("(first_ord - pmod(first_ord, 2147483648BD)) / 2147483648BD")
    places = able.select("first_ord", "by_head", "by_tail", row.cast("decimal(38,0)").alias("__row"), pos.cast("int").alias("pos"))
    # A row's lines: bounded by its text.
    wanted = places.groupBy("__row").agg(F.collect_list(F.struct("pos", "first_ord", "by_head", "by_tail")).alias("places"))
    holders = may_match(rows.select("__row", F.col(text_col).cast("string").alias("text")), "__row", wanted)
    holders = holders.join(wanted, "__row").select(F.split("text", "\n", -1).alias("all"), F.explode("places").alias("p"))
    line = F.btrim(F.get(F.col("all"), F.col("p.pos")), F.lit(BLANKS))
    candidates = holders.select(F.col("p.first_ord").alias("ord"), F.col("p.by_head"), F.col("p.by_tail"), line.alias("line")).withColumn("n", F.char_length("line"))
    candidates = stored(candidates, "line-candidates")
    near = stored(_near(candidates, long_chars), "line-near")
    firsts = attach(hashed.select("__row", "pos", "ord", "h1", "h2"), distinct.select("h1", F.col("h2").alias("g2"), "first_ord", "times"), "h1", "times")
    firsts = firsts.filter(F.col("h2") == F.col("g2"))
    again = firsts.filter(F.col("ord") != F.col("first_ord")).select("__row", "pos", F.lit(0).alias("edits"))
    first = may_match(firsts.filter(F.col("ord") == F.col("first_ord")), "ord", near)
    close = first.join(near.select("ord"), "ord", "left_semi").select("__row", "pos", F.lit(1).alias("edits"))
    return again.unionByName(close)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 24, long_chars: int = LONG_CHARS) -> DataFrame:
    """``docs`` with the remaining text, plus ``__lines``, ``__repeated`` and ``__near``: lines, and lines removed.

    All rows stay, also those that lose every line (their text is empty then) and those with a null text (it stays
    null). Rows that share an identifier come in the order of their texts' first 64 characters and SHA-256, rows without
    one come after all others in that order; of equal rows one is the first. Other columns pass unchanged.
    """
    rows = with_row_keys(docs, id_col, text_col)
    gone = repeated_lines(rows, text_col, min_chars, long_chars)
    gone = gone.groupBy("__row").agg(
        F.collect_set("pos").alias("__gone"), F.count_if(F.col("edits") == 0).alias("__repeated"), F.count_if(F.col("edits") == 1).alias("__near")
    )
    gone = stored(gone, "line-gone")
    split = F.split(F.col(text_col).cast("string"), "\n", -1)
    kept = F.filter(F.transform(split, lambda x, i: F.when(~F.array_contains("__gone", i), x)), lambda x: x.isNotNull())
    # What goes grows with the documents: no broadcast that holds on small tables only.
    found = rows.join(gone.hint("merge"), "__row", "left")
    text = F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    zero = F.lit(0).cast("long")
    done = found.withColumns({
        text_col: text, "__lines": F.when(F.col(text_col).isNull(), 0).otherwise(F.size(split)),
        "__repeated": F.coalesce("__repeated", zero), "__near": F.coalesce("__near", zero),
    })
    columns = [*docs.columns, "__lines", "__repeated", "__near"]
    return done.select(*columns)
