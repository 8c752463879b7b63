"""Mixing sources to target weights by Pareto order sampling.

1. Sizes in words are summed by source.  Sources, by code point and null last, have weights that
   repeat; the budget is shared by weight, no source gets more than ``limit`` times its size, and
   what is over is shared again.  The level at which the shares stop is found in closed form from
   the sources ordered by limit over weight.
2. Every document gets the whole copies of its source's ratio of target to size.
3. The rest is drawn without repetition.  Inclusion probabilities are proportional to size, with
   certain inclusion where that reaches one (found from power-of-two size classes); documents are
   ranked by u/(1-u) over p/(1-p) with u from a hash, and the first are taken whose words fill
   the rest.  The cut is found from sums over bins of the rank, so that no source is ever sorted
   as a whole; only the documents of one narrow bin are ordered.

DataFrame functions only.  Defined results: a null or empty text has size 0 and is never taken.
Ties of the rank go by doc_id and text.  Rows that are equal in all of these are taken as one group,
and of the group at the cut as many as fill the rest; which of them is told by a number that they
get in a stored table, so that no task holds the group.  Very long texts are counted whole.  A null
source is a source.  An empty table gives no row.  Reruns agree, up to which of equal rows.  Columns of the input stay; added ones replace those of their name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import WORD, small_join, stored

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
LIMIT = 2
#: A source: its name, and whether it is null.
KEY = ["_key", "_none"]
#: Order of the documents of a source.
TIES = ["place", "_id", "_text"]
#: Bins of the rank in each source, and of each such bin.
BINS = 1 << 14
#: Bins for each power of e of the rank.
STEPS = 256
SEED = 20_240_101


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """``sizes`` (the key of a source, source_size) with target; one row for each source, which
    is a table of another order than the documents, so that its windows take one task.

    A source stops at its limit where limit over weight is at or below the level.  With sources
    ordered by that ratio, the level is what is left of the budget after the limits so far, over
    the weights still open; sources before the first whose ratio exceeds it have stopped.  From that
    source on the levels fall, as each takes more than its share away, so the right one is the largest.
    """
    by_name = Window.orderBy("_none", "_key")
    cycle = F.array(*map(F.lit, map(float, weights)))
    rows = sizes.withColumn("w", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    rows = rows.withColumn("cap", F.col("source_size") * float(limit)).withColumn("ratio", F.col("cap") / F.col("w"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_ratio = Window.orderBy("ratio", "_none", "_key").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns(
        {
            "budget": F.sum("source_size").over(everything) * float(share),
            "w_all": F.sum("w").over(everything),
            "cap_before": F.coalesce(F.sum("cap").over(by_ratio), F.lit(0.0)),
            "w_before": F.coalesce(F.sum("w").over(by_ratio), F.lit(0.0)),
        }
    )
    level = (F.col("budget") - F.col("cap_before")) / (F.col("w_all") - F.col("w_before"))
    rows = rows.withColumn("level", F.when(F.col("ratio") > level, level))
    rows = rows.withColumn("level", F.max("level").over(everything))
    return rows.select(
        *KEY, "source_size",
        F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("w"), F.col("cap"))).alias("target"),
    )


def scales(classes: DataFrame) -> DataFrame:
    """(source, scale, top) from (source, rest, size_class, words, squares, largest).

    A document's inclusion probability is scale times size, and 1 above size class ``top``.  From
    the largest class down, classes are certain until the scale that fills the rest keeps the next
    below 1.  A source without a row here has equal probabilities.
    """
    above = Window.partitionBy(*KEY).orderBy(F.desc("size_class")).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*KEY).orderBy("size_class").rowsBetween(Window.unboundedPreceding, 0)
    scale = (F.col("rest") - F.coalesce(F.sum("words").over(above), F.lit(0))) / F.sum("squares").over(upto)
    fits = classes.withColumn("scale", scale).filter((F.col("scale") * F.col("largest") <= 1) & (F.col("scale") > 0))
    return fits.groupBy(*KEY).agg(F.max_by("scale", "size_class").alias("scale"), F.max("size_class").alias("top"))


def drawn(text: Column, source: Column, doc_id: Column) -> list[Column]:
    """What the draw needs of each row: key of its source, size, and order of ties."""
    return [
        F.coalesce(source, F.lit("")).alias("_key"), source.isNull().alias("_none"),
        words(text).alias("size"), doc_id.cast("long").alias("_id"), F.xxhash64(text).alias("_text"),
    ]


def place() -> Column:
    """The Pareto rank on a logarithmic scale, as a place among the bins."""
    u = (F.xxhash64(F.lit(SEED), "_id", "_text").bitwiseAND((1 << 52) - 1) + 0.5) / float(1 << 52)
    p = F.when(F.log2("size") >= F.col("top") + 1, 1.0).otherwise(F.coalesce(F.col("scale") * F.col("size"), F.lit(0.5)))
    rank = F.log(u / (1 - u)) - F.log(p / (1 - p))
    at = F.greatest(F.lit(0.0), F.least((rank + 32) * STEPS, F.lit(BINS - 1e-9)))
    return F.when(p >= 1, 0.0).otherwise(at)


def bins() -> list[Column]:
    """The bin of a place, and the bin within that bin."""
    first = F.floor("place").cast("int")
    return [first, F.floor((F.col("place") - first) * BINS).cast("int")]


def cut(rows: DataFrame, by_source: DataFrame) -> DataFrame:
    """``by_source`` with ``last``: the struct of place and ties of the last document taken, and
    with the number of ``equal`` rows there and how many of them ``fit``.

    Sums by bin give the bin in which the rest of the source is filled, sums by the bins within it
    the narrower one; the documents of that one are ordered, equal ones as one.
    """
    found = by_source.select(*KEY, F.col("rest").alias("open")).filter("open > 0")
    inside = rows
    for level, at in enumerate(bins()):
        inside = small_join(inside, found, KEY).withColumn("bin", at)
        sums = stored(inside.groupBy(*KEY, "open", "bin").agg(F.sum("size").alias("words")), "mix-bins")
        upto = F.sum("words").over(Window.partitionBy(*KEY).orderBy("bin"))
        filled = sums.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("words"))
        found = filled.filter("before < open AND upto >= open")
        cuts = stored(found.select(*KEY, F.col("bin").alias("cut"), (F.col("open") - F.col("before")).alias("left")), "mix-cuts")
        inside = small_join(inside, cuts, KEY).filter("bin = cut").drop("open", "bin", "cut", "left")
        found = cuts.select(*KEY, F.col("left").alias("open"))
        by_source = by_source.join(cuts.select(*KEY, F.col("cut").alias(f"cut{level}")), KEY, "left")
    inside = small_join(inside, found, KEY).groupBy(*KEY, "open", *TIES, "size").agg(F.count("*").alias("equal"))
    order = Window.partitionBy(*KEY).orderBy(*TIES)
    before = F.sum(F.col("size") * F.col("equal")).over(order) - F.col("size") * F.col("equal")
    fit = F.least(F.col("equal"), F.floor((F.col("open") - before) / F.col("size") + 0.5))
    taken = inside.withColumn("fit", fit.cast("long")).filter("fit > 0")
    at = F.struct(*TIES)
    last = taken.groupBy(*KEY).agg(F.max(at).alias("last"), F.max_by("fit", at).alias("fit"), F.max_by("equal", at).alias("equal"))
    return by_source.join(last, KEY, "left")


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``number``, from 1 in each source.  Rows count within their part of the stored
    table, and parts begin behind the parts before them."""
    rows = stored(rows.withColumn("_at", F.monotonically_increasing_id()), "mix-equal")
    rows = rows.withColumn("_part", F.shiftright("_at", 33))
    parts = rows.groupBy(*KEY, "_part").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*KEY).orderBy("_part"))
    parts = stored(parts.select(*KEY, "_part", (upto - F.col("n")).alias("before")), "mix-parts")
    inside = F.row_number().over(Window.partitionBy(*KEY, "_part").orderBy("_at"))
    rows = small_join(rows.withColumn("number", inside), parts, [*KEY, "_part"])
    return rows.withColumn("number", F.col("number") + F.col("before")).drop("_at", "_part", "before")


def mixed(docs: DataFrame, text: str = "text", source: str = "source", weights: Sequence[float] = WEIGHTS,
          share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken (size times copies)."""
    rows = stored(docs.select(*drawn(F.col(text), F.col(source), F.col("doc_id"))), "mix-rows")
    sums = rows.groupBy(*KEY).agg(F.sum("size").alias("source_size"))
    by_source = targets(sums, weights, share, limit)
    some = F.col("source_size") > 0
    by_source = by_source.withColumn("whole", F.when(some, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    by_source = stored(by_source.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "mix-sources")

    classes = rows.filter("size > 0").groupBy(*KEY, F.floor(F.log2("size")).alias("size_class")).agg(
        F.sum("size").alias("words"), F.sum(F.col("size").cast("double") ** 2).alias("squares"), F.max("size").alias("largest")
    )
    by_source = stored(by_source.join(scales(small_join(classes, by_source, KEY)), KEY, "left"), "mix-scales")
    placed = small_join(rows.filter("size > 0"), by_source.select(*KEY, "scale", "top"), KEY).withColumn("place", place())
    by_source = stored(cut(placed.drop("scale", "top"), by_source), "mix-cut")

    own = ["size", "source_size", "target", "copies", "taken"]
    row = F.struct(*docs.columns)
    wide = docs.select(row.alias("_row"), *drawn(F.col(text), F.col(source), F.col("doc_id")))
    wide = small_join(wide, by_source, KEY, "left").withColumn("place", place())
    first, second = bins()
    earlier = (first < F.col("cut0")) | ((first == F.col("cut0")) & (second < F.col("cut1")))
    there = (first == F.col("cut0")) & (second == F.col("cut1"))
    at_cut = (F.col("rest") > 0) & there & (F.struct(*TIES) == F.col("last"))
    more = (F.col("rest") > 0) & (earlier | (there & (F.struct(*TIES) <= F.col("last"))))

    def finished(rows: DataFrame, more: Column) -> DataFrame:
        copies = F.when(F.col("size") > 0, F.col("whole") + F.coalesce(more, F.lit(False)).cast("long")).otherwise(0).cast("long")
        rows = rows.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))
        kept = [c for c in docs.columns if c.lower() not in own]
        return rows.select(*[F.col("_row")[c].alias(c) for c in kept], *own)

    if by_source.filter("fit < equal").isEmpty():
        return finished(wide, more)
    # Of the equal rows at a cut some are taken.
    some_of = F.coalesce(at_cut & (F.col("fit") < F.col("equal")), F.lit(False))
    return finished(wide.filter(~some_of), more).unionByName(finished(numbered(wide.filter(some_of)), F.col("number") <= F.col("fit")))
