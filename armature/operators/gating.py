"""The control-rate gate on tables.

Whether an event passes depends on the last one that did: a chain through the whole episode. A key that holds a large
share of the table must not be walked by one task, so time is cut into slots and each slot is summarized first.

In a slot, the chain is fixed by where it enters: the first event more than one step after the last one that passed
before the slot. Only events within the slot's first step can be that entry - a later one passes whatever came before.
For each such entry the slot reports where its chain leaves; of entries that leave at the same event, the last is enough.
Slots of a key are then linked in order, which touches one row per slot, and a last pass marks the events with the entry
known.

Most slots are short, so tasks take them by Arrow batches: one numpy pass for all slots of a batch, no Python call for each.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _ordered(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Rows of a group follow each other in one task, in order, nulls last; `opens` marks the first row of each."""
    by = [F.col(c).asc_nulls_last() for c in order]
    opens = F.row_number().over(Window.partitionBy(*group).orderBy(*by)) == 1
    return rows.withColumn("opens", opens).sortWithinPartitions(*group, *by)


def _numbers(column: pa.Array | pa.ChunkedArray, missing: int = 0) -> np.ndarray:
    return column.fill_null(missing).to_numpy()


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of several Arrow batches cut where a group opens: no group is in two tables."""
    held = []
    for batch in batches:
        starts = np.flatnonzero(batch.column("opens").to_numpy(zero_copy_only=False))
        if len(starts):
            held.append(batch.slice(0, starts[-1]))
            if sum(b.num_rows for b in held):
                yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(starts[-1] if len(starts) else 0))
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held)


def _next(at: np.ndarray, opens: np.ndarray, step: int, slot_us: int) -> np.ndarray:
    """For each event, the index of the next one of its slot more than `step` later; its own if there is none."""
    slot = np.cumsum(opens)
    apart = slot * (slot_us + step) + at
    after = np.searchsorted(apart, apart + step, side="right")
    own = np.arange(len(at))
    return np.where(np.append(slot, 0)[after] == slot, after, own)


def _ends(jump: np.ndarray) -> np.ndarray:
    """For each event, the index of the last one of the chain that starts there."""
    while not np.array_equal(twice := jump[jump], jump):
        jump = twice
    return jump


def _reached(start: np.ndarray, jump: np.ndarray) -> np.ndarray:
    """The events of the chains that begin at `start`, marked: lengths double in each round."""
    on = start.copy()
    while True:
        on[jump[on]] = True
        twice = jump[jump]
        if np.array_equal(twice, jump):
            return on
        jump = twice


def rate_gate(
    events: DataFrame, key: str, hertz: float, slot_seconds: int = 3600
) -> DataFrame:
    """(key, event_id, at_us) of the events that pass. Input columns: key, at (timestamp), event_id.

    A key is cut into slots of `slot_seconds`, which are walked in parallel; between slots go only the few ways a walk can
    enter one and leave it. Events without a key or a time do not pass.
    """
    step = int(round(1e6 / hertz))
    slot_us = slot_seconds * 1_000_000
    if step >= slot_us:
        raise ValueError("a slot must be longer than one step")
    kind = events.schema[key].dataType
    ticks = events.select(key, F.col("event_id").cast("long"), F.unix_micros("at").alias("at_us")).filter(F.col(key).isNotNull() & F.col("at_us").isNotNull())
    slotted = ticks.withColumn("slot", F.expr(f"(at_us - pmod(at_us, {slot_us}L)) div {slot_us}L"))

    def summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _whole(batches):
            at, opens = _numbers(part["at_us"]), part["opens"].to_numpy()
            since = at % slot_us
            before = np.append(0, since[:-1])
            # entries: events of the first step, and the first one after it
            entry = opens | (since != before) & (before <= step)
            ends = _ends(_next(since, opens, step, slot_us))
            at_entry, slot = np.flatnonzero(entry), np.cumsum(opens)[entry]
            # of neighbours that leave at the same event, the last one
            more = np.append((slot[1:] != slot[:-1]) | (ends[at_entry][1:] != ends[at_entry][:-1]), True)
            at_entry, slot = at_entry[more], slot[more]
            first = np.flatnonzero(opens)
            offsets = pa.array(np.searchsorted(slot, np.arange(1, len(first) + 2)).astype(np.int32))
            rows = part.take(pa.array(first)).select([key, "slot"]).combine_chunks()
            for name, values in (("entries", at[at_entry]), ("exits", at[ends[at_entry]])):
                rows = rows.append_column(name, pa.ListArray.from_arrays(offsets, pa.array(values)))
            yield from rows.to_batches()

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            found = []
            for opens, entries, exits in zip(*(batch.column(c).to_pylist() for c in ("opens", "entries", "exits"))):
                last = None if opens else last
                found.append(last)
                i = 0 if last is None else bisect_right(entries, last + step)
                if i < len(entries):
                    last = exits[i]
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("slot"), pa.array(found, pa.int64())], [key, "slot", "last"])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _whole(batches):
            at, opens = _numbers(part["at_us"]), part["opens"].to_numpy()
            free = part["last"].is_null().to_numpy() | (at > _numbers(part["last"]) + step)
            start = free & (opens | ~np.append(False, free[:-1]))
            taken = _reached(start, _next(at % slot_us, opens, step, slot_us))
            yield from part.filter(pa.array(taken)).select([key, "event_id", "at_us"]).combine_chunks().to_batches()

    def having(*columns: tuple[str, T.DataType]) -> T.StructType:
        return T.StructType([T.StructField(key, kind), *[T.StructField(*c) for c in columns]])

    times = T.ArrayType(T.LongType())
    placed = _ordered(slotted.select(key, "slot", "at_us"), [key, "slot"], ["at_us"])
    summary = placed.mapInArrow(summarize, having(("slot", T.LongType()), ("entries", times), ("exits", times)))
    entered = _ordered(summary, [key], ["slot"]).mapInArrow(link, having(("slot", T.LongType()), ("last", T.LongType())))
    entered_ticks = _ordered(slotted.join(entered, [key, "slot"]), [key, "slot"], ["at_us", "event_id"])
    return entered_ticks.mapInArrow(mark, having(("event_id", T.LongType()), ("at_us", T.LongType())))
