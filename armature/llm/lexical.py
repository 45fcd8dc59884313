"""Ranked lexical search: an impact-sorted index, read by the no-random-access algorithm.

An index is one Parquet table. Documents are cut into segments of a few megabytes of text; a segment has, for each of its terms,
the documents that hold it in order of falling impact, in blocks. A search reads the blocks of its terms only. A task takes one
segment after another: it reads the lists of a query in step, deeper in every round, and keeps for each document of the segment
the score read so far (lower end) and what the unread parts of the lists could still add (upper end). A document whose upper
end lies below the best `k` lower ends, of this segment or of those the task has read before, is out. A query is done with a
segment when every document left has equal ends, so members, ties and scores are final. A document lies in one segment, so
the best of all segments are the best of all documents.

The impact of a term in a document is (10**9 tf) div (1000 tf + 8 m), with m = 10 + (90 n N) div L for a document of n terms among
N documents with L terms; the weight of a term that df documents hold is floor(1000 ln((2N + 2) / (2df + 1))). A score is the
sum of weight times impact over the terms of a query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from armature.llm import textkit
from armature.operators.smallside import cut_lineage

#: Text of a segment; a longer text is a segment of its own.
SEGMENT_BYTES = 4 << 20
#: Postings of a row of the index.
BLOCK = 512
#: Postings of a list that the first round reads; every round reads to four times the depth of the one before.
FIRST_DEPTH = 16
#: (item, term) pairs that are searched for at a time; further items take another pass over their lists.
PAIRS_AT_ONCE = 200_000


@dataclass(frozen=True)
class Index:
    """Where an index is, and the number of its documents with a term and of all their terms."""

    path: str
    documents: int
    terms: int


def words_of(texts: pa.Array) -> tuple[textkit.Words, np.ndarray]:
    """Terms (runs of ASCII letters and digits and of non-ASCII characters) and the bytes they lie in, A-Z in lower case."""
    data, starts = textkit.raw_bytes(texts)
    data = textkit.ascii_lower()[data]
    return textkit.Words(data, starts, textkit.letters_and_digits()), data


def impacts(tf: np.ndarray, length: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """(10**9 tf) div (1000 tf + 8 m); lengths whose product leaves 64 bits are multiplied as Python numbers."""
    if len(length) and 90 * int(length.max()) * documents >= 1 << 63:
        m = np.array([10 + 90 * int(n) * documents // terms for n in length], np.int64)
    else:
        m = 10 + (90 * length.astype(np.int64) * documents) // max(1, terms)
    return ((1_000_000_000 * tf.astype(np.int64)) // (1000 * tf + 8 * m)).astype(np.int32)


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _term_strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Byte ranges in any order as a string array."""
    size = end - start
    offsets = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], size)
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[at])).cast(pa.string())


def postings_of(texts: pa.Array, documents: int, terms: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Terms, where the list of each begins (one more entry), and places and impacts of all lists, impacts falling."""
    words, data = words_of(texts)
    owner = words.text_index()
    order = np.lexsort((owner, words.hash))
    token, place = words.hash[order], owner[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (token[1:] != token[:-1]) | (place[1:] != place[:-1])
    first = np.flatnonzero(fresh)
    tf = np.diff(np.append(first, len(order)))
    token, place, word = token[first], place[first], order[first]
    impact = impacts(tf, np.diff(words.first)[place], documents, terms)
    by = np.lexsort((place, -impact.astype(np.int64), token))
    token, place, impact, word = token[by], place[by], impact[by], word[by]
    begin = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else np.zeros(0, np.int64)
    return _term_strings(data, words.start[word[begin]], words.end[word[begin]]), np.append(begin, len(token)), place, impact


def build_index(docs: DataFrame, path: str, text: str = "text", id_column: str = "doc_id") -> Index:
    """Write the index of all rows of `docs` to `path`: two passes over the texts, without a shuffle.

    Every row is a document, repeated rows too. A null or empty text has no term; its row is in the index and is never found.
    Ids of any type that can be ordered, null among them, are carried. Columns other than the two are not read.
    """
    source = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holders = total = 0
        for batch in batches:
            for _, _, texts in textkit.parts(batch.column(0)):
                data, starts = textkit.raw_bytes(texts)
                n = np.diff(textkit.Words(data, starts, textkit.letters_and_digits(), hashes=False).first)
                holders, total = holders + int((n > 0).sum()), total + int(n.sum())
        yield pa.RecordBatch.from_pydict({"holders": [holders], "total": [total]})

    seen = source.select("text").mapInArrow(count, "holders long, total long").agg(F.sum("holders"), F.sum("total")).first()
    documents, terms = seen[0] or 0, seen[1] or 0
    schema = T.StructType(
        [
            T.StructField("segment", T.LongType()),
            T.StructField("term", T.StringType()),
            T.StructField("block", T.IntegerType()),
            T.StructField("places", T.ArrayType(T.IntegerType())),
            T.StructField("impacts", T.ArrayType(T.IntegerType())),
            T.StructField("ids", T.ArrayType(source.schema["id"].dataType)),
        ]
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = TaskContext.get().partitionId() << 32
        for batch in batches:
            all_texts = textkit.texts_of(batch.column(1))
            for low, high in textkit.slices(all_texts, SEGMENT_BYTES):
                # places follow the ids, so that the lower place wins a tie
                ids = batch.column(0).slice(low, high - low)
                by = pc.sort_indices(ids)
                yield from _segment_rows(segment, ids.take(by), all_texts.slice(low, high - low).take(by), documents, terms, schema.names)
                segment += 1

    source.mapInArrow(write, schema).write.mode("overwrite").parquet(path)
    return Index(path, documents, terms)


def _segment_rows(segment: int, ids: pa.Array, texts: pa.Array, documents: int, terms: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """A row without a term that lists the documents, then the blocks of all lists."""
    none = pa.nulls(1, pa.list_(pa.int32()))
    whole = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
    yield pa.RecordBatch.from_arrays([pa.array([segment]), pa.nulls(1, pa.string()), pa.nulls(1, pa.int32()), none, none, whole], names=names)
    strings, begin, place, impact = postings_of(texts, documents, terms)
    if not len(strings):
        return
    size = np.diff(begin)
    blocks = -(-size // BLOCK)
    term = np.repeat(np.arange(len(size)), blocks)
    block = np.arange(len(term)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    cut = pa.array(np.append(begin[term] + block * BLOCK, len(place)).astype(np.int32))
    columns = [np.full(len(term), segment), strings.take(pa.array(term)), block.astype(np.int32), pa.ListArray.from_arrays(cut, pa.array(place.astype(np.int32))), pa.ListArray.from_arrays(cut, pa.array(impact))]
    columns = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns]
    yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(term), whole.type)], names=names)


# ---- search ---------------------------------------------------------------------------------------------------------


def no_random_access(lists: list[tuple[np.ndarray, np.ndarray]], documents: int, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the `k` best documents of a segment whose score is above 0 and at least `floor`.

    `lists` are (places, scores) with falling scores. Equal scores go by place.
    """
    lower = np.zeros(documents, np.int64)
    at, depth = 0, FIRST_DEPTH
    if sum(int(s[0]) for _, s in lists) < max(1, floor):
        return np.zeros(0, np.int64), lower[:0]
    while True:
        credit = np.zeros(documents, np.int64)
        rest = 0
        for places, scores in lists:
            if at < len(places):
                lower[places[at:depth]] += scores[at:depth]
            if depth < len(places):  # the next score bounds all that this list can still add
                bound = int(scores[depth])
                rest += bound
                credit[places[:depth]] += bound
        upper = lower + (rest - credit)
        bar = max(1, floor)
        if documents > k:
            bar = max(bar, int(np.partition(lower, documents - k)[documents - k]))
        left = np.flatnonzero(upper >= bar)
        if (upper[left] == lower[left]).all():
            best = left[np.lexsort((left, -lower[left]))][:k]
            return best, lower[best]
        at, depth = depth, 4 * depth


class _Best:
    """The `k` highest scores of an item so far in a task."""

    def __init__(self, k: int):
        self.k, self.scores = k, np.zeros(0, np.int64)

    @property
    def floor(self) -> int:
        return int(self.scores[-1]) if len(self.scores) == self.k else 0

    def add(self, scores: np.ndarray) -> None:
        self.scores = -np.sort(-np.concatenate([self.scores, scores]))[: self.k]


def query_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item, term): the terms of every item, once each."""
    source = items.select(F.col(f"`{item_id}`").alias("item"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType([source.schema["item"], T.StructField("term", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, _, texts in textkit.parts(batch.column(1)):
                words, data = words_of(texts)
                if len(words):
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(words.text_index() + low)), _term_strings(data, words.start, words.end)], names=schema.names)

    return source.mapInArrow(run, schema).distinct()


def search(spark: SparkSession, index: Index, items: DataFrame, k: int = 10, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): for every item its `k` best documents with a score above 0, best first; equal scores by id,
    null last.

    Rows of an equal item id, null among them, are one item with the terms of all. An item without a term, or an empty index,
    gives no row. Items are taken in blocks of about `PAIRS_AT_ONCE` terms, each of which is sent to all tasks.
    """
    pairs = cut_lineage(query_terms(items, item_id, text))
    blocks = max(1, -(-pairs.count() // PAIRS_AT_ONCE))
    dealt = pairs.withColumn("part", F.pmod(F.xxhash64("item"), F.lit(blocks)))
    parts = [_search_block(spark, index, dealt.filter(F.col("part") == b).drop("part"), k) for b in range(blocks)]
    found = reduce(DataFrame.unionAll, parts)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(item_id), "rank", "doc_id", "score")


def _search_block(spark: SparkSession, index: Index, pairs: DataFrame, k: int) -> DataFrame:
    rows = spark.read.parquet(index.path)
    wanted = F.broadcast(pairs.select("term").distinct())
    lists = rows.filter(F.col("term").isNotNull()).join(wanted, "term", "left_semi").select(*rows.columns)
    df = {r.term: r.df for r in lists.groupBy("term").agg(F.sum(F.size("places")).alias("df")).collect()}
    weights = {t: weight(index.documents, n) for t, n in df.items()}
    queries: dict = {}
    for r in pairs.collect():
        if weights.get(r.term, 0) > 0:
            queries.setdefault(r.item, []).append(r.term)
    items = sorted(queries, key=lambda i: (i is None, str(i)))
    shared = spark.sparkContext.broadcast(([queries[i] for i in items], weights))
    kind = rows.schema["ids"].dataType.elementType
    schema = T.StructType([T.StructField("number", T.IntegerType()), T.StructField("doc_id", kind), T.StructField("score", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weight_of = shared.value
        best = [_Best(k) for _ in asked]
        for ids, lists in _segments(batches):
            for number, terms in enumerate(asked):
                scored = [(lists[t][0], lists[t][1] * weight_of[t]) for t in terms if t in lists]
                place, score = no_random_access(scored, len(ids), k, best[number].floor)
                if len(place):
                    best[number].add(score)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(place), number, np.int32)), ids.take(pa.array(place)), pa.array(score)], names=schema.names)

    by_segment = lists.unionByName(rows.filter(F.col("term").isNull())).repartition("segment").sortWithinPartitions("segment", F.asc_nulls_first("term"), "block")
    found = by_segment.mapInArrow(run, schema)
    item_kind = pairs.schema["item"].dataType
    numbers = spark.createDataFrame([(n, i) for n, i in enumerate(items)], T.StructType([T.StructField("number", T.IntegerType()), T.StructField("item", item_kind)]))
    return found.join(F.broadcast(numbers), "number").select("item", "doc_id", "score")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, dict[str, tuple[np.ndarray, np.ndarray]]]]:
    """Ids of the documents of a segment and its lists, one segment after another."""
    now, ids, lists = None, None, {}

    def whole():
        return {t: (np.concatenate([p for p, _ in b]), np.concatenate([s for _, s in b]).astype(np.int64)) for t, b in lists.items()}

    for batch in batches:
        segment, term = batch.column(0).to_numpy(), batch.column(1).to_pylist()
        places, values = batch.column(3), batch.column(4)
        p_at, i_at = places.offsets.to_numpy(), values.offsets.to_numpy()
        p_all, i_all = places.values.to_numpy(zero_copy_only=False), values.values.to_numpy(zero_copy_only=False)
        for row, name in enumerate(term):
            if segment[row] != now:
                if ids is not None and lists:
                    yield ids, whole()
                now, ids, lists = segment[row], None, {}
            if name is None:
                ids = batch.column(5)[row].values
            else:
                lists.setdefault(name, []).append((p_all[p_at[row] : p_at[row + 1]].copy(), i_all[i_at[row] : i_at[row + 1]].copy()))
    if ids is not None and lists:
        yield ids, whole()
