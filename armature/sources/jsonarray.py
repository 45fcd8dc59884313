"""Files that are one JSON array of objects, read by many tasks.

Where an object begins cannot be seen from the middle of a file: a brace may stand in a string. So each byte range first gives
a summary of one row: the parity of its quotes, and how far it opens or closes brackets if it starts outside a string and if
it starts inside one. Running sums of the summaries tell how each range begins, and a second pass cuts out the objects that
begin in it; the last one is followed beyond the border.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of a file that one task reads.
RANGE_BYTES = 32 << 20
#: Bytes that are looked at together.
BLOCK_BYTES = 1 << 20
QUOTE, SLASH = ord('"'), ord("\\")
#: How far each byte opens a bracket, when it stands outside strings.
OPENS = np.zeros(256, "int8")
OPENS[[ord("["), ord("{")]] = 1
OPENS[[ord("]"), ord("}")]] = -1


def open_file(uri: str):
    """A seekable handle for a full URI, as Spark lists it."""
    from pyarrow import fs

    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    store, path = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    return store.open_input_file(path)


def slashes_before(handle, at: int) -> int:
    """Length of the run of backslashes that ends before `at`."""
    run = 0
    while at > run:
        start = max(0, at - run - 4096)
        piece = handle.read_at(at - run - start, start)
        kept = piece.rstrip(b"\\")
        run += len(piece) - len(kept)
        if kept:
            break
    return run


def brackets(block: np.ndarray, run: int, inside: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Brackets of a block by whether they stand in a string: (positions, 0 or 1), parity of the quotes, run of backslashes at the end.

    `run` is the number of backslashes before the block and `inside` whether it starts in a string.
    """
    n = len(block)
    plain = np.maximum.accumulate(np.where(block == SLASH, -1, np.arange(n)))
    plain_before = np.concatenate(([-1], plain))  # the last byte before a position that is no backslash
    quotes = np.flatnonzero(block == QUOTE)
    slashes = quotes - 1 - plain_before[quotes] + np.where(plain_before[quotes] < 0, run, 0)
    real = quotes[slashes % 2 == 0]
    found = np.flatnonzero(OPENS[block])
    in_string = (inside + np.searchsorted(real, found)) % 2
    trailing = n - 1 - int(plain[-1]) + (run if plain[-1] < 0 else 0)
    return found, in_string, len(real) % 2, trailing


def blocks(handle, start: int, end: int) -> Iterator[tuple[int, np.ndarray]]:
    while start < end:
        raw = handle.read_at(min(BLOCK_BYTES, end - start), start)
        if not raw:
            return
        yield start, np.frombuffer(raw, "uint8")
        start += len(raw)


def summarize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for path, length, start, end in zip(batch["path"], batch["length"], batch["start"], batch["end"]):
            with open_file(path) as handle:
                run, odd, outside, inside = slashes_before(handle, start), 0, 0, 0
                for _, block in blocks(handle, start, end):
                    found, in_string, parity, run = brackets(block, run, odd)
                    steps = OPENS[block[found]].astype("int64")
                    outside += int(steps[in_string == 0].sum())
                    inside += int(steps[in_string == 1].sum())
                    odd ^= parity
            out.append((path, length, start, end, odd, outside, inside))
        yield pd.DataFrame(out, columns=["path", "length", "start", "end", "odd", "outside", "inside"])


def objects(handle, length: int, start: int, end: int, inside: int, depth: int) -> Iterator[tuple[int, bytes]]:
    """(position, text) of the objects of the outer array that begin in [start, end)."""
    run, opened, pieces = slashes_before(handle, start), None, []
    for at, block in blocks(handle, start, length):
        raw, taken = block.tobytes(), 0
        found, in_string, parity, run = brackets(block, run, inside)
        found = found[in_string == 0]
        steps = OPENS[block[found]].astype("int64")
        level = depth + np.cumsum(steps)
        edges = ((steps > 0) & (level == 2)) | ((steps < 0) & (level == 1))
        for i, step in zip(found[edges].tolist(), steps[edges].tolist()):
            if step > 0:
                if at + i >= end:
                    return
                opened, taken = at + i, i
            elif opened is not None:
                pieces.append(raw[taken : i + 1])
                text = b"".join(pieces)
                if text[:1] == b"{":
                    yield opened, text
                opened, pieces = None, []
        if opened is not None:
            pieces.append(raw[taken:])
        elif at + len(block) >= end:
            return
        inside ^= parity
        depth += int(steps.sum())


def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def frame(path, rows):
        return pd.DataFrame({"path": path, "at": [a for a, _ in rows], "value": [t.decode("utf-8", "replace") for _, t in rows]})

    for batch in batches:
        for path, length, start, end, inside, depth in zip(*[batch[c] for c in ("path", "length", "start", "end", "starts_inside", "depth")]):
            with open_file(path) as handle:
                rows, size = [], 0
                for row in objects(handle, length, start, end, inside, depth):
                    rows.append(row)
                    size += len(row[1])
                    if size >= BLOCK_BYTES:
                        yield frame(path, rows)
                        rows, size = [], 0
                if rows:
                    yield frame(path, rows)


def array_objects(spark: SparkSession, path: str, glob: str = "*", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, at, value): the text of every object of the array files at `path`, with its file and byte position.

    Elements that are no objects are left out; empty files and empty arrays have no rows. A file that is not one closed array
    is an error.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path).select("path", "length")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long")))
    ranges = files.filter("length > 0").select("path", "length", starts.alias("start"))
    ranges = ranges.withColumn("end", F.least(F.col("start") + range_bytes, "length"))
    tasks = max(1, ranges.count())
    # a fixed number of partitions stays one task per range, however little the list of ranges weighs
    dealt = ranges.repartition(tasks, "path", "start")
    summary = dealt.mapInPandas(summarize, "path string, length long, start long, end long, odd long, outside long, inside long")
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    begun = summary.withColumn("starts_inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    begun = begun.withColumn("step", F.when(F.col("starts_inside") == 1, F.col("inside")).otherwise(F.col("outside")))
    begun = begun.withColumn("depth", F.coalesce(F.sum("step").over(before), F.lit(0)))
    last = (F.col("end") == F.col("length")) & ((F.col("depth") + F.col("step") != 0) | ((F.col("starts_inside") + F.col("odd")) % 2 != 0))
    whole = F.when(last, F.raise_error(F.concat(F.lit("not one closed JSON array: "), "path"))).otherwise(F.col("depth"))
    found = begun.withColumn("depth", whole).select("path", "length", "start", "end", "starts_inside", "depth")
    return found.repartition(tasks, "path", "start").mapInPandas(cut, "path string, at long, value string")
