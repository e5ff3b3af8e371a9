"""Mixing sources to target weights by systematic sampling.

Each document of a source is due the same expected number of copies, target / size of the source. The documents of
a source stand in a fixed order (by size, then a hash of the id, so that neighbours are of like size); the prefix sum
of the expected copies plus one random offset of the source is taken, and a document is emitted once for every whole
number that its step crosses. Prefix sums run in two levels, within blocks of a source and over the blocks' totals, so
that a source with a third of all rows is spread over many tasks.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuloom.llm.shared import inner_names, stored

#: Expected copies are whole multiples of 1 / UNIT: sums are exact, so a rerun or a lost task can't change the mix.
UNIT = 1 << 26


def words(text: Column) -> Column:
    """Number of runs of `[^\\x20\\x09-\\x0D]+`; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def whole(n: int) -> Column:
    return F.lit(str(n)).cast("decimal(38,0)")


def draw(name: Column, seed: int) -> Column:
    """A whole number below 16**7 that the name and the seed fix: the start of an MD5."""
    return F.conv(F.substring(F.md5(F.concat(name.cast("string"), F.lit(f"#{seed}"))), 1, 7), 16, 10).cast("long")


def water_level(sources: DataFrame, total: Fraction, most_rounds: int = 10_000) -> Fraction | None:
    """The level at which targets min(cap, level * weight) add up to total; None: every source is at its cap.

    Each round is one aggregate over the sources, so their number is not bounded by any task's memory. A round caps
    every source that would be above its cap and reshares the rest by weight.
    """
    level = Fraction(0)
    for _ in range(most_rounds):
        # cap > level * weight  <=>  cap * denominator > numerator * weight, exactly
        free = F.col("cap").cast("decimal(38,0)") * whole(level.denominator) > F.col("weight").cast("decimal(38,0)") * whole(level.numerator)
        row = sources.agg(F.sum(F.when(~free, F.col("cap")).otherwise(0)), F.sum(F.when(free, F.col("weight")).otherwise(0))).first()
        capped, weight = int(row[0] or 0), int(row[1] or 0)
        if not weight:
            return None
        new = (total - capped) / weight
        if new == level:
            return level
        level = new
    raise RuntimeError("the shares of the sources didn't settle")


def mix(docs: DataFrame, text: str = "text", id: str = "doc_id", source: str = "source", weights: tuple[int, ...] = (3, 1, 2), share: Fraction = Fraction(3, 2), most: int = 2, seed: int = 42, blocks: int = 1024) -> DataFrame:
    """One row a row of docs: id, source, size, source_size, target, copies, taken (copies * size).

    Sources in the order of code points, null last, have the weights in turn and share `share` of all words; no
    target is above `most` times the source's size, the excess goes to the others by weight. No row is emitted more
    than `most` times. Null and empty texts have size 0 and take 0. A null source is a source of its own. Repeated
    rows are drawn one by one. An empty table gives an empty table. Other columns of docs aren't read. The mix is a
    function of the rows and the seed alone. blocks: slices
    of each size class of a source; a task sorts one, so a source of 10**10 rows still has tasks of some million.
    """
    sized = stored(docs.select(F.col(id).alias("id"), F.col(source).alias("source"), words(F.col(text)).alias("size")))
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    # Ranks of the sources without a window over all of them: ranges of the sorted names, then an offset a range.
    ranged = stored(per_source.repartitionByRange(F.col("source").isNull(), "source").sortWithinPartitions(F.col("source").isNull(), "source").withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", 33)
    counts = ranged.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    offsets = counts.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rank = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    ranked = ranged.withColumn("part", part).join(offsets.select("part", "before"), "part")
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    sources = stored(ranked.select("source", "source_size", "n_docs", weight.alias("weight"), (F.col("source_size") * most).alias("cap")))
    everything = int(sources.agg(F.sum("source_size")).first()[0] or 0)
    level = water_level(sources, everything * share)
    aim = F.col("cap").cast("double")
    if level is not None:
        aim = F.least(aim, F.col("weight") * F.lit(level.numerator).cast("double") / F.lit(level.denominator).cast("double"))
    sources = sources.select("source", "source_size", "n_docs", aim.alias("target"))
    # The step is the same for every document of a source: at most `most` whole numbers lie within it.
    sources = sources.withColumn("step", F.when(F.col("source_size") > 0, F.least(F.round(F.col("target") / F.col("source_size") * UNIT), F.lit(most * UNIT)).cast("long")).otherwise(F.lit(0)))
    sources = sources.withColumn("offset", draw(F.coalesce(F.col("source"), F.lit("")), seed) % UNIT)

    drawn = with_prefix(joined_sources(sized, sources), seed, blocks)
    copies = F.floor((F.col("upto") + F.col("offset")) / UNIT) - F.floor((F.col("upto") - F.col("step") + F.col("offset")) / UNIT)
    out = drawn.withColumn("copies", copies.cast("long"))
    return out.select(F.col("id").alias(id), F.col("source").alias(source), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def joined_sources(sized: DataFrame, sources: DataFrame, most_hot: int = 1024) -> DataFrame:
    """Rows with their source's columns; the fewer than most_hot sources that hold over 1/most_hot of all rows are broadcast."""
    n_rows = sized.count()
    hot = F.broadcast(sources.where(F.col("n_docs") > n_rows // most_hot).withColumnRenamed("source", "s"))
    rest = sources.where(F.col("n_docs") <= n_rows // most_hot).withColumnRenamed("source", "s")
    same = sized["source"].eqNullSafe(F.col("s"))
    return sized.join(hot, same).drop("s").unionByName(sized.join(hot, same, "left_anti").join(rest, same).drop("s"))


def with_prefix(rows: DataFrame, seed: int, blocks: int) -> DataFrame:
    """Adds upto: the sum of step over the rows of the source up to and with this one.

    A block is a size class (a doubling) and, within it, a slice by a hash of the id; the blocks of a source are in
    order of class, and rows within a block by size and hash.
    """
    chance = draw(F.coalesce(F.col("id").cast("string"), F.lit("")), seed)
    rows = rows.withColumn("chance", chance).withColumn("block", F.length(F.bin("size")).cast("long") * blocks + F.col("chance") % blocks)
    totals = rows.groupBy("source", "block").agg(F.sum("step").alias("block_step"))
    over_blocks = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("source").alias("s"), F.col("block").alias("b"), F.coalesce(F.sum("block_step").over(over_blocks), F.lit(0)).alias("earlier"))
    within = Window.partitionBy("source", "block").orderBy("size", "chance", "id").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("within", F.sum("step").over(within))
    return rows.join(totals, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b"))).withColumn("upto", F.col("earlier") + F.col("within"))


def mixed_documents(docs: DataFrame, text: str = "text", id: str = "doc_id", source: str = "source", **how) -> DataFrame:
    """The rows of docs that the mix takes, repeated as often as it takes them; all columns of docs.

    Rows that agree in id, source and size share the copies that the mix takes of them as evenly as can be.
    """
    drawn = mix(docs, text, id, source, **how).select(F.col(id).alias("id"), F.col(source).alias("source"), "size", "copies")
    drawn = stored(drawn.groupBy("id", "source", "size").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows")).where("copies > 0"))
    rows = inner_names(docs)
    c_id, c_text, c_source = (f"c{docs.columns.index(c)}" for c in (id, text, source))
    same = F.col(c_id).eqNullSafe(F.col("id")) & F.col(c_source).eqNullSafe(F.col("source")) & (words(F.col(c_text)) == F.col("size"))
    # Most documents are drawn, so the texts move once to meet their copies, whatever the size of either.
    out = rows.join(drawn.where("rows = 1").hint("merge"), same).withColumn("take", F.col("copies"))
    if drawn.where("rows > 1").limit(1).count():
        alike = Window.partitionBy("id", "source", "size").orderBy(c_text)
        more = rows.join(drawn.where("rows > 1").hint("merge"), same).withColumn("k", F.row_number().over(alike))
        out = out.unionByName(more.withColumn("take", F.floor(F.col("copies") / F.col("rows")) + (F.col("k") <= F.col("copies") % F.col("rows")).cast("long")).drop("k").where("take > 0"))
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("take")))).select(*rows.columns).toDF(*docs.columns)
