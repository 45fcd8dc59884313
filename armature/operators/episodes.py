"""Episode-ordered operators that cut long episodes into segments.

An episode is (dataset_name, episode_id) ordered by `timestep`. It may hold a large share of the table, so nothing is
partitioned by episode alone. Rows are grouped by (episode, segment) with `segment = timestep div SEGMENT_ROWS`, and what has
to cross a segment border does so explicitly:

* `with_neighbours` copies the few rows next to a border into the adjacent segment (lag / lead by a constant);
* `fill_from_previous` / `fill_from_next` exchange one summary row per segment (unbounded scans);
* `with_episode_facts` does the same for whole-episode aggregates, and joins them on (episode, segment);
* `with_scans` does all of these in one pass, with one shuffle of the rows.

There is one plan for every size: a short episode is an episode of one segment.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from armature.operators.ordering import time_block, with_position

EPISODE = ("dataset_name", "episode_id")
SEGMENT_ROWS = 1 << 15


def with_timestep(df: DataFrame, timestep: Column) -> DataFrame:
    """Set the step index."""
    return df.withColumn("timestep", timestep.cast("int"))


def add_timestep(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column | None = None) -> DataFrame:
    """0-based step index inside each episode. `order` must be unique within an episode; `block` must not decrease along it.

    By default a block is an hour of an episode, whose rows the rate of the recording bounds.
    """
    block = time_block(F.col(order[0])) if block is None else block
    return with_timestep(with_position(df, keys, order, block, "timestep"), F.col("timestep"))


def segment_of(timestep: Column, rows: int = SEGMENT_ROWS) -> Column:
    return F.floor(timestep / rows).cast("long")


def _spread(df: DataFrame, back: int, ahead: int, rows: int) -> DataFrame:
    """Rows with `__segment`; those within `back` / `ahead` of a border appear in the adjacent segment as well."""
    if max(back, ahead) >= rows:
        raise ValueError("offset reaches beyond the adjacent segment")
    seg = segment_of(F.col("timestep"), rows)
    inner = F.col("timestep") - seg * rows
    copies = F.array(seg)
    if ahead:  # the first rows of a segment are what the previous one looks ahead to
        copies = F.when((inner < ahead) & (seg > 0), F.array(seg, seg - 1)).otherwise(copies)
    if back:
        copies = F.when(inner >= rows - back, F.array_append(copies, seg + 1)).otherwise(copies)
    return df.select("*", F.explode(copies).alias("__segment"))


def _own(df: DataFrame, rows: int) -> DataFrame:
    return df.filter(F.col("__segment") == segment_of(F.col("timestep"), rows)).drop("__segment")


def with_neighbours(
    df: DataFrame,
    shifted: Mapping[str, tuple[str, int]],
    keys: Sequence[str] = EPISODE,
    rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Add columns taken from other steps of the same episode: name -> (column, step offset). Null outside the episode.

    Offsets must be smaller than a segment.
    """

    def moved(w):
        return [F.lag(c, -o).over(w).alias(n) if o < 0 else F.lead(c, o).over(w).alias(n) for n, (c, o) in shifted.items()]

    back = max([0, *[-o for _, o in shifted.values()]])
    ahead = max([0, *[o for _, o in shifted.values()]])
    spread = _spread(df, back, ahead, rows)
    return _own(spread.select("*", *moved(Window.partitionBy(*keys, "__segment").orderBy("timestep"))), rows)


def with_rolling_means(
    df: DataFrame,
    means: Mapping[str, tuple[str, int]],
    keys: Sequence[str] = EPISODE,
    rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Add means over the last n steps, this one included: name -> (column, n). Fewer steps at the start of an episode."""

    def rolled(w):
        return [F.avg(c).over(w.rowsBetween(1 - n, 0)).alias(name) for name, (c, n) in means.items()]

    spread = _spread(df, max(n for _, n in means.values()) - 1, 0, rows)
    return _own(spread.select("*", *rolled(Window.partitionBy(*keys, "__segment").orderBy("timestep"))), rows)


def _fill(df, values: Mapping[str, Column], forward: bool, keys, rows) -> DataFrame:
    named = df.select("*", *[c.alias(f"__v_{n}") for n, c in values.items()])
    order = lambda c: F.col(c) if forward else F.col(c).desc()
    held = [f"__v_{n}" for n in values]
    named = named.withColumn("__segment", segment_of(F.col("timestep"), rows))
    inside = Window.partitionBy(*keys, "__segment").orderBy(order("timestep")).rowsBetween(Window.unboundedPreceding, 0)
    local = named.select("*", *[F.last(f"__v_{n}", ignorenulls=True).over(inside).alias(f"__in_{n}") for n in values])
    pick = F.max_by if forward else F.min_by
    summary = named.groupBy(*keys, "__segment").agg(
        *[pick(F.col(f"__v_{n}"), F.when(F.col(f"__v_{n}").isNotNull(), F.col("timestep"))).alias(f"__s_{n}") for n in values]
    )
    across = Window.partitionBy(*keys).orderBy(order("__segment")).rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(
        *keys, "__segment", *[F.last(f"__s_{n}", ignorenulls=True).over(across).alias(f"__out_{n}") for n in values]
    )
    joined = local.join(carried, [*keys, "__segment"])
    for n in values:
        joined = joined.withColumn(n, F.coalesce(f"__in_{n}", f"__out_{n}"))
        held += [f"__in_{n}", f"__out_{n}"]
    return joined.drop("__segment", *held)


def fill_from_previous(df, values: Mapping[str, Column], keys: Sequence[str] = EPISODE, rows: int = SEGMENT_ROWS) -> DataFrame:
    """Add, for each name, the value of its expression at the last step at or before this one where it is not null."""
    return _fill(df, values, True, keys, rows)


def fill_from_next(df, values: Mapping[str, Column], keys: Sequence[str] = EPISODE, rows: int = SEGMENT_ROWS) -> DataFrame:
    """Same, looking at this step and later ones."""
    return _fill(df, values, False, keys, rows)


def with_episode_facts(
    df: DataFrame,
    facts: Mapping[str, tuple[Column, str]],
    keys: Sequence[str] = EPISODE,
    rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Add whole-episode aggregates to every step: name -> (aggregate over steps, how to combine segments).

    The combiner is "max", "min", "sum", "first" or "last" (in step order).
    """
    whole = Window.partitionBy(*keys)
    seg = segment_of(F.col("timestep"), rows)
    per_segment = df.groupBy(*keys, seg.alias("__segment")).agg(*[agg.alias(n) for n, (agg, _) in facts.items()])
    ordered = whole.orderBy("__segment").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def combined(name: str, how: str) -> Column:
        if how in ("first", "last"):
            return (F.first if how == "first" else F.last)(name, ignorenulls=True).over(ordered)
        return {"max": F.max, "min": F.min, "sum": F.sum}[how](name).over(whole)

    table = per_segment.select(*keys, "__segment", *[combined(n, how).alias(n) for n, (_, how) in facts.items()])
    return df.withColumn("__segment", seg).join(table, [*keys, "__segment"]).drop("__segment")


def with_scans(
    df: DataFrame,
    order: Sequence[str] = ("timestep",),
    block: Column | None = None,
    *,
    forward: Mapping[str, Column] | None = None,
    backward: Mapping[str, Column] | None = None,
    following: Mapping[str, Column] | None = None,
    preceding: Mapping[str, Column] | None = None,
    first: Mapping[str, Column] | None = None,
    final: Mapping[str, Column] | None = None,
    position: str | None = None,
    length: str | None = None,
    keys: Sequence[str] = EPISODE,
    rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Several scans of each episode at once: rows are shuffled once, by (episode, block), whatever is asked for.

    For each name: `forward` is the last non-null value at or before a step, `backward` the first one at or after it, `following`
    and `preceding` the values of the next step and of the one before (null at the ends), `first` the first non-null value of the episode, `final` the value of its last
    step. `position` counts steps from 0 and `length` is their number. `order` must be unique in an episode and `block` must not
    decrease along it (default: segments of `timestep`). What crosses a block border comes from one narrow row per block.
    """
    forward, backward, following, preceding, first, final = (dict(x or {}) for x in (forward, backward, following, preceding, first, final))
    at = F.struct(*order)
    named = df.withColumns(
        {
            "__block": segment_of(F.col("timestep"), rows) if block is None else block,
            **{f"__{kind}_{n}": c for kind, asked in (("f", forward), ("b", backward), ("n", following), ("p", preceding), ("o", first), ("l", final)) for n, c in asked.items()},
        }
    )
    up = Window.partitionBy(*keys, "__block").orderBy(*order)
    down = Window.partitionBy(*keys, "__block").orderBy(*[F.desc(c) for c in order])
    until = (Window.unboundedPreceding, 0)
    local = named.select("*", F.row_number().over(up).alias("__row"), *[F.last(f"__f_{n}", ignorenulls=True).over(up.rowsBetween(*until)).alias(f"__fi_{n}") for n in forward], *[F.lead(f"__n_{n}", 1).over(up).alias(f"__ni_{n}") for n in following], *[F.lag(f"__p_{n}", 1).over(up).alias(f"__pi_{n}") for n in preceding])
    if backward:
        local = local.select("*", *[F.last(f"__b_{n}", ignorenulls=True).over(down.rowsBetween(*until)).alias(f"__bi_{n}") for n in backward])

    def when_known(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), at)

    # a value that may be null is wrapped, so that null is told from none
    whole = lambda c: F.struct(F.col(c).alias("v"))
    summary = named.groupBy(*keys, "__block").agg(
        F.count(F.lit(1)).alias("__size"),
        *[F.max_by(f"__f_{n}", when_known(f"__f_{n}")).alias(f"__fs_{n}") for n in forward],
        *[F.min_by(f"__b_{n}", when_known(f"__b_{n}")).alias(f"__bs_{n}") for n in backward],
        *[F.min_by(whole(f"__n_{n}"), at).alias(f"__ns_{n}") for n in following],
        *[F.max_by(whole(f"__p_{n}"), at).alias(f"__ps_{n}") for n in preceding],
        *[F.min_by(f"__o_{n}", when_known(f"__o_{n}")).alias(f"__os_{n}") for n in first],
        *[F.max_by(whole(f"__l_{n}"), at).alias(f"__ls_{n}") for n in final],
    )
    rise, fall = Window.partitionBy(*keys).orderBy("__block"), Window.partitionBy(*keys).orderBy(F.desc("__block"))
    before, all_ = rise.rowsBetween(Window.unboundedPreceding, -1), rise.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = summary.select(
        *keys, "__block", "__size",
        F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"),
        F.sum("__size").over(all_).alias("__all"),
        *[F.last(f"__fs_{n}", ignorenulls=True).over(before).alias(f"__fo_{n}") for n in forward],
        *[F.last(f"__bs_{n}", ignorenulls=True).over(fall.rowsBetween(Window.unboundedPreceding, -1)).alias(f"__bo_{n}") for n in backward],
        *[F.lead(f"__ns_{n}", 1).over(rise)["v"].alias(f"__no_{n}") for n in following],
        *[F.lag(f"__ps_{n}", 1).over(rise)["v"].alias(f"__po_{n}") for n in preceding],
        *[F.first(f"__os_{n}", ignorenulls=True).over(all_).alias(f"__oo_{n}") for n in first],
        *[F.last(f"__ls_{n}").over(all_)["v"].alias(f"__lo_{n}") for n in final],
    )
    out = {n: F.coalesce(f"__fi_{n}", f"__fo_{n}") for n in forward} | {n: F.coalesce(f"__bi_{n}", f"__bo_{n}") for n in backward}
    out |= {n: F.when(F.col("__row") == F.col("__size"), F.col(f"__no_{n}")).otherwise(F.col(f"__ni_{n}")) for n in following}
    out |= {n: F.when(F.col("__row") == 1, F.col(f"__po_{n}")).otherwise(F.col(f"__pi_{n}")) for n in preceding}
    out |= {n: F.col(f"__oo_{n}") for n in first} | {n: F.col(f"__lo_{n}") for n in final}
    if position:
        out[position] = (F.col("__before") + F.col("__row") - 1).cast("int")
    if length:
        out[length] = F.col("__all").cast("int")
    joined = local.join(carried, [*keys, "__block"])
    return joined.select(*[F.col(f"`{c}`") for c in df.columns if c not in out], *[c.alias(n) for n, c in out.items()])


def with_length(df: DataFrame, keys: Sequence[str] = EPISODE, rows: int = SEGMENT_ROWS) -> DataFrame:
    if "episode_len" in df.columns:
        return df
    counted = with_episode_facts(df, {"episode_len": (F.max("timestep"), "max")}, keys, rows)
    return counted.withColumn("episode_len", (F.col("episode_len") + 1).cast("int"))


def in_parts(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = EPISODE, order: str = "timestep", rows: int = 1024) -> DataFrame:
    """Nest the rows of each group into ordered lists of at most `rows` entries: one row per (group, part).

    The part is part of the key at every size; a group of `rows` rows or fewer has part 0 only.
    """
    part = F.floor(F.col(order) / rows).cast("long")
    nested = F.sort_array(F.collect_list(F.struct(order, *[c for c in columns if c != order])))
    return df.groupBy(*keys, part.alias("part")).agg(nested.alias("steps"))
