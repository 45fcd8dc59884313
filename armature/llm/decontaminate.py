"""Benchmark passages in documents, found by spaced seeds.

Texts are compared as sequences of lower-case words. A document holds a benchmark item if `span` consecutive words of both,
position by position, agree in at least `share` of the places (13 words, at most two substitutions). An item of fewer words
is compared as a whole. One of fewer than `least` words is found only where it is a whole line, word for word: inside a
sentence it names nothing.

Fixed masks find all such windows. The places of a window are dealt into the seven points of the Fano plane, place i to point
i mod 7, and each of its seven lines is a mask that ignores the places of its three points. Any two points lie on a line, so
whatever two places differ, one mask ignores them both and its hash is equal on both sides. A bitmap of the benchmark's
hashes, of bounded size, lets almost only real hits leave the scan of the documents; a join on the hash pairs them with the
windows of the benchmark, and the words of both windows are then compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from armature.llm import textkit

#: The lines of the Fano plane.
LINES = ((0, 1, 3), (1, 2, 4), (2, 3, 5), (3, 4, 6), (4, 5, 0), (5, 6, 1), (6, 0, 2))
#: Two substitutions are what the masks are sure to find.
SURE = 2
NOT_NEWLINE = np.arange(256) != 0x0A
#: The bitmap is never larger; a larger benchmark lets more rows through to the join, which is exact.
MOST_BITS = 1 << 24


@dataclass(frozen=True)
class Rule:
    span: int = 13
    share: float = 0.8
    least: int = 5

    def __post_init__(self):
        if any(self.allowed(n) > SURE for n in range(self.least, self.span + 1)):
            raise ValueError(f"the masks find up to {SURE} substitutions")

    def allowed(self, span: int) -> int:
        """Substitutions in a window of `span` words."""
        return int(span * (1 - self.share) + 1e-9)


def words_of(texts: pa.Array) -> textkit.Words:
    """Runs of letters and digits of any script, without case; common non-ASCII punctuation separates like ASCII's does."""
    data, starts = textkit.raw_bytes(pc.utf8_lower(texts))
    if len(data) > 2:
        # fixed values: UTF-8 of U+2000-203F and U+3000-303F, and of U+0080-00BF
        three = np.flatnonzero(((data[:-2] == 0xE2) | (data[:-2] == 0xE3)) & (data[1:-1] == 0x80))
        two = np.flatnonzero(data[:-1] == 0xC2)
        if len(three) or len(two):
            data = data.copy()
            for at in (three, three + 1, three + 2, two, two + 1):
                data[at] = 0x20
    return textkit.Words(data, starts, textkit.letters_and_digits())


def seeds(tokens: np.ndarray, span: int) -> list[np.ndarray]:
    """The seven hashes of the window at each position."""
    n = len(tokens) - span + 1
    if n < 1:
        return [np.zeros(0, np.uint64)] * len(LINES)
    points = [np.zeros(n, np.uint64) for _ in range(7)]
    for place in range(span):
        odd = textkit.mix(np.array([place + 1], np.uint64)) | np.uint64(1)
        points[place % 7] += tokens[place : place + n] * odd
    total = points[0].copy()
    for p in points[1:]:
        total += p
    return [textkit.mix(total - points[a] - points[b] - points[c] + np.uint64(1000 * span + m)) for m, (a, b, c) in enumerate(LINES)]


def whole_lines(texts: pa.Array, words: textkit.Words, least: int) -> dict[int, np.ndarray]:
    """Number of words, below `least` -> the first words of the lines that have so many."""
    data, starts = textkit.raw_bytes(pc.utf8_lower(texts))
    lines = textkit.Words(data, starts, NOT_NEWLINE, hashes=False)
    first = np.searchsorted(words.start, lines.start)
    size = np.searchsorted(words.start, lines.end) - first
    return {n: first[size == n] for n in range(1, least)}


def line_seeds(tokens: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """One hash of the `size` words from each of `first` on."""
    out = np.full(len(first), 7919 * size, np.uint64)
    for k in range(size):
        out = textkit.mix(out + tokens[first + k])
    return out


def _window_rows(tokens: np.ndarray, at: np.ndarray, span: int) -> pa.Array:
    """The words of the windows at `at`, as 32-bit numbers."""
    short = (tokens >> np.uint64(32)).astype(np.uint32).view(np.int32)
    rows = short[at[:, None] + np.arange(span)]
    return pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * span, pa.int32()), pa.array(rows.reshape(-1)))


def benchmark_windows(items: DataFrame, rule: Rule, id_column: str = "item_id", text: str = "text") -> DataFrame:
    """(seed, span, item_id, item_word, item_window): every window of every item under every mask.

    An item of fewer than `least` words has one row, and its span is negative."""
    source = items.select(F.col(f"`{id_column}`").alias("item_id"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType([T.StructField("seed", T.LongType()), T.StructField("span", T.IntegerType()), source.schema["item_id"], T.StructField("item_word", T.LongType()), T.StructField("item_window", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, _, texts in textkit.parts(batch.column(1)):
                words = words_of(texts)
                for row, (a, b) in enumerate(zip(words.first[:-1], words.first[1:], strict=True)):
                    span = min(rule.span, int(b - a))
                    tokens = words.hash[a:b]
                    if span < rule.least:
                        if span:
                            seed = line_seeds(tokens, np.zeros(1, np.int64), span)
                            yield pa.RecordBatch.from_arrays([pa.array(seed.view(np.int64)), pa.array([-span], pa.int32()), batch.column(0).slice(low + row, 1), pa.array([0], pa.int64()), _window_rows(tokens, np.zeros(1, np.int64), span)], names=schema.names)
                        continue
                    at = np.arange(len(tokens) - span + 1)
                    window = _window_rows(tokens, at, span)
                    item = pa.concat_arrays([batch.column(0).slice(low + row, 1)] * len(at))
                    for seed in seeds(tokens, span):
                        yield pa.RecordBatch.from_arrays([pa.array(seed.view(np.int64)), pa.array(np.full(len(at), span, np.int32)), item, pa.array(at), window], names=schema.names)

    return source.mapInArrow(run, schema)


def bitmap_of(windows: DataFrame) -> np.ndarray:
    """Two bits per seed in at most `MOST_BITS` bits; made in the cluster, collected as at most MOST_BITS / 64 words."""
    count = windows.count()
    bits = min(MOST_BITS, 1 << max(12, (64 * count).bit_length()))
    mask = F.lit(bits - 1).cast("long")
    slots = windows.select(F.explode(F.array(F.col("seed").bitwiseAND(mask), F.shiftrightunsigned("seed", 32).bitwiseAND(mask))).alias("slot"))
    words = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 AS int))")).alias("bits")).toPandas()
    out = np.zeros(bits // 64, np.uint64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def candidate_windows(docs: DataFrame, bitmap: np.ndarray, spans: list[int], keep: list[str], text: str) -> DataFrame:
    """(kept columns, seed, span, word, window): the windows of documents whose seed may be one of the benchmark."""
    source = docs.select(*keep, F.col(f"`{text}`").cast("string").alias("scanned_text"))
    more = [("seed", T.LongType()), ("span", T.IntegerType()), ("word", T.LongType()), ("window", T.ArrayType(T.IntegerType()))]
    schema = T.StructType([*source.drop("scanned_text").schema.fields, *[T.StructField(n, k) for n, k in more]])
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        low_mask = np.uint64(64 * len(table) - 1)
        for batch in batches:
            for low, _, texts in textkit.parts(batch.column(len(keep))):
                words = words_of(texts)
                owner = words.text_index()
                short = whole_lines(texts, words, 1 - min(spans)) if min(spans, default=0) < 0 else {}
                for span in spans:
                    if len(words) < abs(span):
                        continue
                    if span < 0:  # whole lines
                        places = short[-span]
                        looked = [line_seeds(words.hash, places, -span)]
                        inside = np.ones(len(places), bool)
                    else:
                        inside = owner[: len(words) - span + 1] == owner[span - 1 :]
                        places = None
                        looked = seeds(words.hash, span)
                    for seed in looked:
                        slot = seed & low_mask
                        hit = np.flatnonzero((table[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) & inside)
                        slot = (seed[hit] >> np.uint64(32)) & low_mask
                        hit = hit[((table[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1)) > 0]
                        if len(hit):
                            seed, hit = seed[hit], hit if places is None else places[hit]
                            row = pa.array(owner[hit] + low)
                            yield pa.RecordBatch.from_arrays(
                                [*[batch.column(i).take(row) for i in range(len(keep))], pa.array(seed.view(np.int64)), pa.array(np.full(len(hit), span, np.int32)), pa.array(hit - words.first[owner[hit]]), _window_rows(words.hash, hit, abs(span))],
                                names=schema.names,
                            )

    return source.mapInArrow(run, schema)


def overlaps(docs: DataFrame, items: DataFrame, keep: list[str], text: str = "text", item_id: str = "item_id", item_text: str = "text", rule: Rule = Rule()) -> DataFrame:
    """One row per (`keep` columns, item_id) with an overlap: windows found, the most equal words in one, its span, and the
    first word of the first window in the document and of the best one in the item.

    Null and empty texts overlap with nothing, and an empty benchmark gives an empty result. Repeated document rows count
    as one; items that share a text are all named. A result column replaces a kept column of its name.
    """
    results = ("item_id", "n_windows", "equal_words", "span", "first_word", "item_word")
    called = [k for k in keep if k.lower() not in results]
    own = {k: f"kept_{i}" for i, k in enumerate(called)}  # names that clash with none of ours
    docs = docs.select(*[F.col(f"`{k}`").alias(n) for k, n in own.items()], F.col(f"`{text}`").alias("text_to_scan"))
    keep, text = list(own.values()), "text_to_scan"
    windows = benchmark_windows(items, rule, item_id, item_text)
    spans = sorted(r.span for r in windows.select("span").distinct().collect())
    found = candidate_windows(docs, bitmap_of(windows) if spans else np.zeros(64, np.uint64), spans, keep, "text_to_scan")
    pairs = found.join(windows, ["seed", "span"])
    equal = F.aggregate(F.zip_with("window", "item_window", lambda a, b: (a == b).cast("int")), F.lit(0), lambda s, x: s + x)
    enough = F.when(F.col("span") < 0, -F.col("span")).otherwise(F.ceil(F.col("span") * rule.share - 1e-9))
    good = pairs.withColumn("equal", equal).filter(F.col("equal") >= enough).withColumn("span", F.abs("span"))
    best = F.max(F.struct("equal", (-F.col("word")).alias("w"), (-F.col("item_word")).alias("i"), "span"))
    # equal windows come once per mask: first one row per window, then one per item
    once = good.select(*keep, "item_id", "word", "item_word", "span", "equal").distinct()
    return (
        once.groupBy(*keep, "item_id")
        .agg(F.count_distinct("word").alias("n_windows"), best.alias("best"), F.min("word").alias("first_word"))
        .select(*[F.col(n).alias(k) for k, n in own.items()], "item_id", "n_windows", F.col("best.equal").alias("equal_words"), F.col("best.span").alias("span"), "first_word", (-F.col("best.i")).alias("item_word"))
    )


def without_benchmark(docs: DataFrame, items: DataFrame, text: str = "text", rule: Rule = Rule()) -> DataFrame:
    """`docs` without the rows whose text holds a benchmark item; columns stay as they are. The verdict goes by the text, so
    rows without an id or with a repeated id are judged by what they say."""
    key = textkit.free_name(docs, "text_key")
    keyed = docs.withColumn(key, F.xxhash64(F.col(f"`{text}`")))
    found = overlaps(keyed.select(F.col(key).alias("doc_key"), F.col(f"`{text}`").alias("text_to_scan")), items, ["doc_key"], "text_to_scan", rule=rule)
    hit = found.select("doc_key").distinct()
    return keyed.join(hit, keyed[key] == hit["doc_key"], "left_anti").drop(key)
