"""Mixing sources to target token weights by entropy balancing, with DataFrame functions only.

Every document gets a rate: of all rates that meet the token target of each source, those closest in relative entropy to the
base rates. They have the form base x exp(tilt of the source), and the tilts solve a convex dual: Newton steps on the sums of
tilted tokens, which are aggregates. The sums need only the tokens per source and base rate, so the documents are added up
once and a step is an aggregation of that table. Rates are then rounded to whole copies by systematic draws in the order of
size within blocks of bounded size, and a few documents per source are moved by one copy to close what rounding left open.
All draws are hashes of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from armature.llm import textkit
from armature.operators.smallside import cut_lineage

#: Rows of a block whose copies are drawn in one go.
BLOCK_ROWS = 4096
#: Tables of one short row per source are broadcast up to this many sources.
MOST_BROADCAST = 50_000


def word_count(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(textkit.WORD_PATTERN)), F.lit(0)).cast("long")


def rotating_targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size) -> with `weight` and `target`.

    Sources in the order of their code points, null last, weigh `weights`, repeating. Targets share `share` of all sizes by
    weight; none is above `most` times its source, and what is cut there is shared again by weight among the others until
    none is above. One narrow row per source is numbered in one task.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))) - 1
    weighed = cut_lineage(sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))).withColumn("cap", most * F.col("source_size")))
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:  # each round caps at least one more kind of source; every source of a larger cap per weight stays open
        above = F.col("cap") <= level * F.col("weight")
        capped, open_ = weighed.agg(F.sum(F.when(above, F.col("cap")).otherwise(0.0)), F.sum(F.when(above, 0.0).otherwise(F.col("weight")))).first()
        higher = (share * total - (capped or 0.0)) / open_ if open_ else level
        if not open_ or higher <= level * (1 + 1e-15):
            break
        level = higher
    return weighed.withColumn("target", F.least("cap", F.lit(level) * F.col("weight"))).drop("cap")


def tilts(cells: DataFrame, targets: DataFrame, most: float = 2.0, rounds: int = 80, close: float = 1e-9) -> DataFrame:
    """(key, tilt) so that the sum of tokens x min(most, base x exp(tilt)) is the target of each source.

    `cells` has (key, base, tokens), where the key names a source and is never null. A round is one Newton step for all sources: slope and curvature of the dual are
    sums over cells. Tilts known to be too small and too large bound the step; a step beyond them, or where every document is
    at `most`, is replaced by their middle. Ends when every source is within `close` of its target. Each round's tilts are
    written to the checkpoint folder.
    """
    none = F.lit(None).cast("double")
    now = cut_lineage(targets.select("key", "target", F.lit(0.0).alias("tilt"), none.alias("low"), none.alias("high")))
    for _ in range(rounds):
        rate = F.col("base") * F.exp("tilt")
        joined = cells.join(now, "key").select("key", "target", "tilt", "low", "high", "tokens", F.least(rate, F.lit(most)).alias("rate"), (rate < most).alias("free"))
        sums = joined.groupBy("key", "target", "tilt", "low", "high").agg(F.sum(F.col("tokens") * F.col("rate")).alias("got"), F.sum(F.when(F.col("free"), F.col("tokens") * F.col("rate")).otherwise(0.0)).alias("bend"))
        gap = F.when(F.col("target") > 0, F.col("target") - F.col("got")).otherwise(0.0)
        known = sums.select("key", "target", "tilt", "bend", gap.alias("gap"), F.when(gap > 0, F.col("tilt")).otherwise(F.col("low")).alias("low"), F.when(gap < 0, F.col("tilt")).otherwise(F.col("high")).alias("high"))
        newton = F.when(F.col("bend") > 0, F.col("tilt") + F.col("gap") / F.col("bend"))
        middle = (F.coalesce("low", F.col("high") - 2) + F.coalesce("high", F.col("low") + 2)) / 2
        inside = newton.isNotNull() & (newton > F.coalesce("low", newton - 1)) & (newton < F.coalesce("high", newton + 1))
        step = F.when(F.col("gap") == 0, F.col("tilt")).when(inside, newton).otherwise(middle)
        now = cut_lineage(known.select("key", "target", "tilt", "low", "high", step.alias("next"), (F.abs("gap") / F.greatest("target", F.lit(1.0))).alias("miss")))
        worst = now.agg(F.max("miss")).first()[0]
        if worst is None or worst <= close:
            break
        now = now.select("key", "target", F.col("next").alias("tilt"), "low", "high")
    return now.select("key", "tilt")


def mix(docs: DataFrame, targets=rotating_targets, id_column: str = "doc_id", text: str = "text", source: str = "source", base: Column | None = None, most: float = 2.0, corrections: int = 4) -> DataFrame:
    """One row per row of `docs`: id, size (words), source, source_size, target, rate, copies and taken (copies x size).

    `targets` gets (source, source_size) and returns it with `target`. `base` is the rate of a document before balancing
    (default 1). A null text has size 0; documents of size 0 are kept with their rate but take nothing, and a source without
    words has target 0. A null source is a source. Rows that repeat are separate rows; the same table gives the same copies,
    whatever its partitions. No document has more than `most` copies, which must be whole.
    """
    if int(most) != most:
        raise ValueError("most must be whole")
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{source}`").cast("string").alias("source"), word_count(F.col(f"`{text}`").cast("string")).alias("size"), (F.lit(1.0) if base is None else base.cast("double")).alias("base"))
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))  # a null source has a key as well
    rows = cut_lineage(rows.withColumn("key", key).withColumn("draw", F.xxhash64(F.lit("mixing"), "id", "size", "source")))
    cells = cut_lineage(rows.groupBy("key", "base").agg(F.first("source").alias("source"), F.sum("size").alias("tokens"), F.count(F.lit(1)).alias("rows")))
    sizes = cells.groupBy("key").agg(F.first("source").alias("source"), F.sum("tokens").alias("source_size"), F.sum("rows").alias("source_rows"))
    wanted = cut_lineage(targets(sizes))
    plan = cut_lineage(wanted.join(tilts(cells.select("key", "base", "tokens"), wanted, most), "key").drop("source"))
    few = plan.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST

    blocks = F.greatest(F.lit(1), F.ceil(F.col("source_rows") / BLOCK_ROWS))
    rated = (
        rows.join(F.broadcast(plan) if few else plan, "key")
        .select("id", "source", "key", "size", "draw", "source_size", "target", F.least(F.col("base") * F.exp("tilt"), F.lit(most)).alias("rate"), F.pmod("draw", blocks).alias("block"))
    )
    if not few:  # a join by source leaves the rows of a source together: deal them out by block
        rated = rated.repartition("key", "block")
    # Systematic draws: cumulated rates, in the order of size, pass a whole number plus a start that is drawn per block.
    order = Window.partitionBy("key", "block").orderBy("size", "draw", F.col("id").asc_nulls_first())
    start = F.pmod(F.xxhash64(F.lit("start"), "key", "block"), F.lit(1 << 20)) / float(1 << 20)
    whole = F.floor(F.col("rate") + 1e-12)
    part = F.floor(F.greatest(F.lit(0.0), F.col("rate") - whole) * (1 << 40)).cast("long")
    before = F.coalesce(F.sum("part").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    turn = lambda at: F.floor((at + F.floor(start * (1 << 40))) / F.lit(1 << 40))
    drawn = (
        rated.withColumn("part", part)
        .withColumn("before", before)
        .withColumn("place", F.row_number().over(order))
        .withColumn("copies", F.least(F.lit(int(most)), (whole + turn(F.col("before") + F.col("part")) - turn(F.col("before"))).cast("int")))
        .select("id", "source", "key", "size", "draw", "source_size", "target", "rate", "block", "place", "copies")
    )
    drawn = cut_lineage(drawn)
    moves = None
    for _ in range(corrections):
        moves = _one_more_move(drawn, moves, int(most), few)
    if moves is not None:
        moved = moves.select("key", "block", "place", "move")
        drawn = drawn.join(F.broadcast(moved) if few else moved, ["key", "block", "place"], "left").withColumn("copies", F.col("copies") + F.coalesce("move", F.lit(0)))
    return drawn.select(F.col("id").alias(id_column), "size", F.col("source").alias(source), "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def _one_more_move(drawn: DataFrame, moves: DataFrame | None, most: int, few: bool) -> DataFrame:
    """Adds, for each source, the one move of a document by one copy that brings its taken words closest to the target, if
    any brings them closer. A document is moved once."""
    gap = drawn.groupBy("key").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("gap"))
    free = drawn
    if moves is not None:
        moved = moves.groupBy("key").agg(F.sum(F.col("move") * F.col("size")).alias("moved"))
        gap = gap.join(moved, "key", "left").select("key", (F.col("gap") - F.coalesce("moved", F.lit(0))).alias("gap"))
        moved_rows = moves.select("key", "block", "place")
        free = drawn.join(F.broadcast(moved_rows) if few else moved_rows, ["key", "block", "place"], "left_anti")
    fits = F.when(F.col("gap") > 0, F.col("copies") < most).otherwise(F.col("copies") > 0)
    left = F.abs(F.abs("gap") - F.col("size"))
    best = F.struct(left.alias("left"), "draw", "block", "place", "size", F.signum("gap").cast("int").alias("move"))
    near = free.join(F.broadcast(gap) if few else gap, "key").filter((F.col("size") > 0) & fits & (left < F.abs("gap")))
    chosen = near.groupBy("key").agg(F.min(best).alias("m")).select("key", "m.block", "m.place", "m.size", "m.move")
    return cut_lineage(chosen if moves is None else moves.union(chosen))
