"""Helpers the text operators share: Arrow passes over a table, and words of a whole batch found with numpy.

Inside a task a batch of texts is one byte array with offsets. Words are found, folded and hashed for the batch at once,
so no Python loop runs over words. A batch is handled in slices of whole texts of about `SLICE_BYTES`, which bounds the
memory of a task by the larger of that and one text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 2 << 20

#: White space of the contracts, `[\x20\x09-\x0D]`.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def not_space() -> np.ndarray:
    """Byte -> is part of a `[^\\x20\\x09-\\x0D]+` word."""
    table = np.ones(256, bool)
    table[list(SPACES)] = False
    return table


def letters_and_digits() -> np.ndarray:
    """Byte -> ASCII letter or digit, or part of a non-ASCII character."""
    table = np.zeros(256, bool)
    for low, high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
        table[low : high + 1] = True
    return table


def ascii_lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 32
    return table


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64 bits (the finalizer of a public 64-bit hash)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def texts_of(column: pa.Array) -> pa.Array:
    return pc.fill_null(column.cast(pa.large_string()), "")


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `most` bytes; a longer text is a range of its own."""
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(ends, ends[low] + most, side="right")) - 1)
        yield low, high
        low = high


def parts(column: pa.Array, rows: int = 512) -> Iterator[tuple[int, int, pa.Array]]:
    """Ranges of rows with their texts: a few rows of a batch are taken at a time, so that copies stay small."""
    for at in range(0, len(column), rows):
        texts = texts_of(column.slice(at, rows))
        for low, high in slices(texts):
            yield at + low, at + high, texts.slice(low, high - low)


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and where each text starts (one more entry than texts)."""
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or ends[-1] == ends[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


class Words:
    """Words of a batch of texts: `start`, `end` (byte positions), `hash` and, per text, where its words begin (`first`)."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, member: np.ndarray, fold: np.ndarray | None = None, hashes: bool = True):
        inside = member[data]
        before = np.zeros(len(data) + 1, bool)
        before[1:] = inside
        edge = starts[(starts >= 0) & (starts < len(data))]
        before[edge] = False
        self.start = np.flatnonzero(inside & ~before[:-1])
        after = np.zeros(len(data) + 1, bool)
        after[:-1] = inside
        after[starts[starts > 0]] = False
        self.end = np.flatnonzero(inside & ~after[1:]) + 1
        self.first = np.searchsorted(self.start, starts)
        self.hash = self._hash(data if fold is None else fold[data]) if hashes else None

    def _hash(self, data: np.ndarray) -> np.ndarray:
        """Polynomial hash of each word modulo 2**64, from running sums over the batch."""
        n = len(data)
        if not n or not len(self.start):
            return np.zeros(len(self.start), np.uint64)
        # fixed values: an odd base and its inverse modulo 2**64
        base = 0x9E3779B97F4A7C15 | 1
        inverse = pow(base, -1, 1 << 64)
        powers = np.full(n, base, np.uint64)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        back = np.full(n, inverse, np.uint64)
        back[0] = 1
        np.multiply.accumulate(back, out=back)
        powers *= data.astype(np.uint64) + np.uint64(1)
        np.add.accumulate(powers, out=powers)
        total = powers[self.end - 1]
        later = self.start > 0
        total[later] -= powers[self.start[later] - 1]
        return mix(total * back[self.start])

    def __len__(self) -> int:
        return len(self.start)

    def text_index(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def free_name(df: DataFrame, name: str) -> str:
    """`name`, or the first of `name_`, `name__`, ... that no column has (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_text_columns(
    df: DataFrame,
    text: str,
    fields: list[T.StructField],
    compute: Callable[[pa.Array], list[pa.Array | np.ndarray]],
    keep: list[str] | None = None,
) -> DataFrame:
    """The rows of `df` with columns computed from `text`, in one Arrow pass and without a shuffle.

    `compute` gets the texts (nulls as empty texts) of some rows and returns one array per field. `keep` are the input
    columns to carry (default: all). A result column replaces an input column of the same name.
    """
    added = {f.name.lower() for f in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in added]
    source = free_name(df, "text_to_read")
    ready = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias(source))
    schema = T.StructType([*ready.drop(source).schema.fields, *fields])
    place = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, texts in parts(batch.column(place)):
                found = compute(texts)
                arrays = [batch.column(i).slice(low, high - low) for i in range(place)]
                arrays += [x if isinstance(x, pa.Array) else pa.array(x) for x in found]
                yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema.fields])

    return ready.mapInArrow(run, schema)


def fold_number(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`: the fold of a labelled row. A null id has fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(0))
