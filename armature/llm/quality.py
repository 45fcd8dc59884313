"""Quality classifier: an additive model with pairwise interactions over shape and repetition features of a text."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from armature.llm import gam, textkit

FEATURES = (
    "log_words", "log_word_chars", "upper_share", "digit_share", "symbol_share", "bar_share", "mark_share", "stop_share", "comma_share",
    "line_words", "ended_lines", "lower_start_lines", "repeated_lines", "distinct_words", "repeated_words", "long_words", "common_word",
)


@dataclass(frozen=True)
class Bounds:
    """The bounded labelled sample. Everything else covers all rows."""

    rows: int = 20_000


def _groups() -> np.ndarray:
    """Byte -> 0 other, 1 upper case, 2 digit, 3 symbol, 4 bar, 5 exclamation or question mark, 6 full stop, 7 comma or colon."""
    table = np.zeros(256, np.uint8)
    for number, chars in enumerate(("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "#*$%&<>=+{}[]\\^~_@", "|", "!?", ".", ",;:"), 1):
        table[list(chars.encode())] = number
    return table


def features_of(texts: pa.Array) -> np.ndarray:
    """One row per text; shares of an empty text are zero."""
    n = len(texts)
    data, starts = textkit.raw_bytes(texts)
    size = np.maximum(1, np.diff(starts)).astype(float)
    out = np.zeros((n, len(FEATURES)))
    if not len(data):
        return out
    owner_of = lambda at: np.searchsorted(starts, at, side="right") - 1
    group = _groups()[data]
    for number in range(1, 8):
        out[:, 1 + number] = np.bincount(owner_of(np.flatnonzero(group == number)), minlength=n) / size

    words = textkit.Words(data, starts, textkit.not_space(), textkit.ascii_lower())
    owner, count = words.text_index(), np.diff(words.first)
    some = np.maximum(1, count).astype(float)
    length = words.end - words.start
    out[:, 0] = np.log1p(count)
    out[:, 1] = np.log1p(np.bincount(owner, length, n) / some)
    out[:, 15] = np.bincount(owner[length > 20], minlength=n) / some

    order = np.lexsort((words.hash, owner))
    first = np.ones(len(order), bool)
    first[1:] = (words.hash[order][1:] != words.hash[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    out[:, 13] = np.bincount(owner[order][first], minlength=n) / some
    edge = np.append(np.flatnonzero(first), len(order))
    most = np.zeros(n)
    np.maximum.at(most, owner[order][edge[:-1]], np.diff(edge))
    out[:, 16] = most / some
    # windows of three words that occur again in their text
    if len(words) > 2:
        h = words.hash
        triple = textkit.mix(textkit.mix(h[:-2]) + np.uint64(3) * h[1:-1] ^ textkit.mix(h[2:] + np.uint64(7)))
        inside = np.flatnonzero(owner[:-2] == owner[2:])
        by = np.lexsort((triple[inside], owner[inside]))
        t, o = triple[inside][by], owner[inside][by]
        out[:, 14] = np.bincount(o[1:][(t[1:] == t[:-1]) & (o[1:] == o[:-1])], minlength=n) / some

    lines = textkit.Words(data, starts, _not_newline())
    line_owner, line_count = lines.text_index(), np.diff(lines.first)
    each = np.maximum(1, line_count).astype(float)
    out[:, 9] = np.log1p(count / each)
    last = data[lines.end - 1]
    out[:, 10] = np.bincount(line_owner[np.isin(last, list(b".!?\"'"))], minlength=n) / each
    start = data[lines.start]
    out[:, 11] = np.bincount(line_owner[(start >= 0x61) & (start <= 0x7A)], minlength=n) / each
    by = np.lexsort((lines.hash, line_owner))
    h, o = lines.hash[by], line_owner[by]
    out[:, 12] = np.bincount(o[1:][(h[1:] == h[:-1]) & (o[1:] == o[:-1])], minlength=n) / each
    return out


def _not_newline() -> np.ndarray:
    table = np.ones(256, bool)
    table[0x0A] = False
    return table


def train(docs: DataFrame, labels: DataFrame, text: str = "text", id_column: str = "doc_id", label: str = "quality", bounds: Bounds = Bounds(), settings: gam.Settings = gam.Settings()) -> gam.Additive:
    """Fit on the labelled rows whose hash is least, at most `bounds.rows`. Rows without a label or id take no part; an id
    with several labels has the lowest; an id with several texts counts once per text, still within the bound."""
    one = labels.filter(F.col(label).isNotNull() & F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("id")).agg(F.min(F.col(label).cast("int")).alias("label"))
    draw = F.xxhash64(F.lit("quality sample"), "id")
    known = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").alias("text"))
    # ids of the sample first, without texts: documents that have a label
    chosen = one.join(known.select("id").distinct(), "id").orderBy(draw, "id").limit(bounds.rows)
    sample = known.join(F.broadcast(chosen), "id")
    width = len(FEATURES)

    def compute(texts: pa.Array) -> list[pa.Array]:
        found = features_of(texts)
        return [pa.FixedSizeListArray.from_arrays(pa.array(found.reshape(-1)), width).cast(pa.list_(pa.float64()))]

    rows = textkit.with_text_columns(sample, "text", [T.StructField("features", T.ArrayType(T.DoubleType()))], compute, ["id", "label"])
    got = rows.orderBy(draw, "id").limit(bounds.rows).toPandas()
    x = np.array(got["features"].tolist(), float).reshape(len(got), width)
    return gam.fit(x, got["label"].to_numpy(float).clip(0, 1), settings)


def score(docs: DataFrame, model: gam.Additive, text: str = "text", threshold: float = 0.7, keep: list[str] | None = None, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """Rows of `docs` with the probability of good quality and whether it reaches `threshold`.

    Null and empty texts get the score of a text without words. A result column replaces an input column of its name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # plain values: workers may lack this package

    def compute(texts: pa.Array) -> list[np.ndarray]:
        p = gam.Additive(**shared.value).score(features_of(texts))
        return [p, (p >= threshold).astype(np.int32)]

    return textkit.with_text_columns(docs, text, [T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())], compute, keep)
