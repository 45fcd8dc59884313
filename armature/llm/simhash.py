"""Near-duplicate documents by SimHash, with candidates from Golay codewords.

A fingerprint has 64 bits. It is cut into three segments of 22, 21 and 21 bits, each read as a word of the binary Golay
code of length 23, which is perfect: every word is within three bits of exactly one codeword. `nearby` lists the codewords
within four bits of a word: one if the nearest is at most two bits away, else six. Two words that differ in at most two
bits always share such a codeword; and if they differ in one, the nearest codeword of either is nearby to the other.

Of four differing bits the three segments get at most (0, b, c) or (1, 1, c) with b <= 2 <= c after sorting, so linked
fingerprints agree in a key of one of two kinds:

* `exact`: the bits of one segment with a nearby codeword of another (six ordered pairs), for (0, b, c);
* `cross`: for two segments, a nearby codeword of the one with the nearest codeword of the other on one side, and the
  other way round on the other side (three pairs), for (1, 1, c).

Keys hold 33 and 24 bits, so buckets of unrelated fingerprints stay small. The join on a key is a sorted pass: rows are
dealt by key, and a bucket gives a spanning forest of its verified links rather than all its pairs, so a group of m near
copies gives m - 1 links. Buckets beyond `chunk` fingerprints are cut into chunks, each pair of which is compared in a
task of its own. Only distinct fingerprints take part; copies are counted once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from armature.llm import textkit
from armature.operators.smallside import cut_lineage

SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: The reach of the keys above.
MAX_BITS = 4
#: Hashes counted at once for one text.
COUNTED_AT_ONCE = 1 << 15


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 4, name: str = "fingerprint", keep: list[str] | None = None) -> DataFrame:
    """Rows of `docs` with the 64-bit SimHash of `text` as a long.

    A bit is set if it is set in over half the XXH64 values (seed 42) of the text's word shingles, repeats included.
    Fewer words than a shingle give one shingle of them all; no word, an empty or a null text gives zero.
    """

    def compute(texts: pa.Array) -> list[np.ndarray]:
        out = np.zeros(len(texts), np.uint64)
        digest = xxhash.xxh64_intdigest
        for row, value in enumerate(texts):
            words = value.as_buffer().to_pybytes().lower().split()
            if not words:
                continue
            joined = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words]) - 1
            size = min(shingle, len(words))
            stops = ends[size - 1 :].tolist()
            starts = [0, *(ends[: len(ends) - size] + 1).tolist()]
            counts = np.zeros(64, np.int64)
            for at in range(0, len(stops), COUNTED_AT_ONCE):
                hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts[at : at + COUNTED_AT_ONCE], stops[at : at + COUNTED_AT_ONCE], strict=True)], dtype=">u8")
                counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int32)
            bits = (2 * counts > len(stops)).astype(np.uint8)
            out[row] = int.from_bytes(np.packbits(bits).tobytes(), "big")
        return [out.view(np.int64)]

    return textkit.with_text_columns(docs, text, [T.StructField(name, T.LongType())], compute, keep)


def hex_digits(fingerprint) -> F.Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


# ---- Golay code -----------------------------------------------------------------------------------------------------


def _syndromes() -> tuple[np.ndarray, np.ndarray]:
    """Byte-wise remainders modulo the generator polynomial, and the least error pattern of each of 2048 remainders."""
    # fixed value: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 generates the code
    generator = 0b110001110101

    def remainder(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= generator << (bit - 11)
        return word

    single = [remainder(1 << i) for i in range(23)]
    tables = np.zeros((3, 256), np.uint32)
    for part in range(3):
        for value in range(256):
            for bit in range(8):
                if value >> bit & 1 and 8 * part + bit < 23:
                    tables[part, value] ^= single[8 * part + bit]
    leaders = np.zeros(2048, np.uint32)
    for i in range(23):
        leaders[single[i]] = 1 << i
        for j in range(i):
            leaders[single[i] ^ single[j]] = 1 << i | 1 << j
            for k in range(j):
                leaders[single[i] ^ single[j] ^ single[k]] = 1 << i | 1 << j | 1 << k
    return tables, leaders


class Golay:
    """Nearest and nearby codewords of arrays of 23-bit words; a codeword is named by its upper twelve bits."""

    def __init__(self):
        self.tables, self.leaders = _syndromes()
        # For each remainder: error patterns of weight four or less, the nearest first, filled up by repeating it.
        patterns: dict[int, list[int]] = {r: [int(e)] for r, e in enumerate(self.leaders)}
        single = [int(self.syndrome(np.array([1 << i], np.uint32))[0]) for i in range(23)]
        for a in range(23):
            for b in range(a):
                for c in range(b):
                    for d in range(c):
                        at = single[a] ^ single[b] ^ single[c] ^ single[d]
                        if int(self.leaders[at]).bit_count() == 3:
                            patterns[at].append(1 << a | 1 << b | 1 << c | 1 << d)
        self.count = np.array([len(patterns[r]) for r in range(2048)])
        self.errors = np.array([patterns[r] + [patterns[r][0]] * (6 - len(patterns[r])) for r in range(2048)], np.uint32)

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        t = self.tables
        return t[0][words & 255] ^ t[1][(words >> 8) & 255] ^ t[2][words >> 16]

    def nearest(self, words: np.ndarray) -> np.ndarray:
        return (words ^ self.leaders[self.syndrome(words)]) >> 11

    def nearby(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and codewords within four bits."""
        at = self.syndrome(words)
        count = self.count[at]
        rows = np.repeat(np.arange(len(words)), count)
        place = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
        return rows, (words[rows] ^ self.errors[at[rows], place]) >> 11


def segment_words(fingerprint: np.ndarray) -> list[np.ndarray]:
    bits = fingerprint.view(np.uint64)
    return [((bits >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.uint32) for at, width in SEGMENTS]


def keys_of(fingerprint: np.ndarray, golay: Golay) -> tuple[np.ndarray, np.ndarray]:
    """All keys of an array of fingerprints: (row, key). A fingerprint has a key once."""
    words = segment_words(fingerprint)
    near = [golay.nearby(w) for w in words]
    code = [golay.nearest(w) for w in words]
    rows, keys = [], []

    def add(row: np.ndarray, family: int, upper: np.ndarray, lower: np.ndarray) -> None:
        rows.append(row)
        keys.append((np.int64(family) << 40) | (upper.astype(np.int64) << 12) | lower.astype(np.int64))

    family = 0
    for i in range(3):
        for j in range(3):
            if i != j:
                row, codeword = near[j]
                add(row, family, words[i][row], codeword)
                family += 1
    for i, j in ((0, 1), (0, 2), (1, 2)):
        row, codeword = near[i]
        add(row, family, codeword, code[j][row])
        row, codeword = near[j]
        again = codeword == code[j][row]  # the key that both sides have
        add(row[~again], family, code[i][row[~again]], codeword[~again])
        family += 1
    return np.concatenate(rows), np.concatenate(keys)


# ---- links ----------------------------------------------------------------------------------------------------------


def forest(left: np.ndarray, bits: int, other: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links (at most `bits` differing bits) within `left`, or between `left` and `other`.

    Every value is visited once and compared with what was not reached before, so a tight group costs little more than
    its size; nothing but tree edges is returned.
    """
    both = left if other is None else np.concatenate([left, other])
    half = np.zeros(len(both), np.int8)
    if other is not None:
        half[len(left) :] = 1
    open_ = np.arange(len(both))
    a, b, todo = [], [], []
    while len(open_) or todo:
        if not todo:
            todo = [int(open_[0])]
            open_ = open_[1:]
        at = todo.pop()
        if not len(open_):
            break
        hit = np.bitwise_count(both[open_] ^ both[at]) <= bits
        if other is not None:
            hit &= half[open_] != half[at]
        if hit.any():
            found = open_[hit]
            open_ = open_[~hit]
            a.append(np.full(len(found), both[at], np.uint64))
            b.append(both[found])
            todo.extend(found.tolist())
    if not a:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(a), np.concatenate(b)


def small_runs(key: np.ndarray, value: np.ndarray, bits: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal keys of at most `reach` + 1 rows, for all runs at once."""
    a, b = [], []
    for shift in range(1, reach + 1):
        same = key[shift:] == key[:-shift]
        if not same.any():
            break
        at = np.flatnonzero(same)
        at = at[np.bitwise_count(value[at] ^ value[at + shift]) <= bits]
        a.append(value[at])
        b.append(value[at + shift])
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.uint64), np.zeros(0, np.uint64))


LINK = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("key", T.LongType()), T.StructField("chunk", T.IntegerType())])


def links(values: DataFrame, bits: int = MAX_BITS, chunk: int = 32768) -> DataFrame:
    """Edges (a, b) whose connected components are those of all links among the distinct fingerprints `values.f`.

    The result is written to the checkpoint folder.
    """
    if not 0 <= bits <= MAX_BITS:
        raise ValueError(f"the keys reach {MAX_BITS} bits")

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        golay = Golay()
        for batch in batches:
            f = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(f), 8192):
                part = f[at : at + 8192]
                row, key = keys_of(part, golay)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[row])], names=["key", "f"])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach = 8
        kept_key, kept_f = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        chunks = 0  # chunks of the run at hand that were given out

        def rows(a, b, key=None, number=None) -> pa.RecordBatch:
            none = pa.nulls(len(a))
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), none.cast(pa.int64()) if key is None else pa.array(key), none.cast(pa.int32()) if number is None else pa.array(number)],
                names=LINK.names,
            )

        def given(part: np.ndarray, key: int) -> pa.RecordBatch:
            return rows(part, part, np.full(len(part), key, np.int64), np.full(len(part), chunks, np.int32))

        def settle(key: np.ndarray, f: np.ndarray) -> Iterator[pa.RecordBatch]:
            """Links of complete runs of at most `chunk` rows."""
            edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
            size = np.diff(edge)
            small = np.repeat(size <= reach + 1, size)
            a, b = small_runs(key[small], f[small], bits, reach)
            if len(a):
                yield rows(a, b)
            for run in np.flatnonzero(size > reach + 1):
                a, b = forest(f[edge[run] : edge[run + 1]], bits)
                if len(a):
                    yield rows(a, b)

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.concatenate([kept_key, batch.column(0).to_numpy()])
            f = np.concatenate([kept_f, batch.column(1).to_numpy().view(np.uint64)])
            edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            if chunks and len(edge) > 1:  # the end of a run that was cut
                tail = f[: edge[1]]
                a, b = forest(tail, bits)
                yield rows(a, b)
                yield given(tail, int(key[0]))
                key, f, chunks = key[edge[1] :], f[edge[1] :], 0
                edge = edge[1:] - edge[1]
            open_at = int(edge[-1])
            if open_at:
                yield from settle(key[:open_at], f[:open_at])
            kept_key, kept_f = key[open_at:], f[open_at:]
            while len(kept_f) > chunk:
                part = kept_f[:chunk]
                a, b = forest(part, bits)
                yield rows(a, b)
                yield given(part, int(kept_key[0]))
                chunks += 1
                kept_key, kept_f = kept_key[chunk:], kept_f[chunk:]
        if len(kept_f):
            if chunks:
                a, b = forest(kept_f, bits)
                yield rows(a, b)
                yield given(kept_f, int(kept_key[0]))
            else:
                yield from settle(kept_key, kept_f)

    keyed = values.select("f").mapInArrow(expand, "key long, f long").repartition("key").sortWithinPartitions("key")
    found = cut_lineage(keyed.mapInArrow(runs, LINK))
    rest = found.filter(F.col("key").isNotNull())
    edges = found.filter(F.col("key").isNull()).select("a", "b")
    if rest.isEmpty():
        return edges.distinct()
    return edges.union(_between_chunks(rest, bits)).distinct()


def _between_chunks(rest: DataFrame, bits: int) -> DataFrame:
    """Links between the chunks of cut runs: one task per pair of chunks of a key, each of bounded size."""
    last = rest.groupBy("key").agg(F.max("chunk").alias("last"))
    pairs = (
        rest.join(last, "key")
        .select("key", F.col("a").alias("f"), "chunk", F.explode(F.sequence(F.lit(0), "last")).alias("other"))
        .filter("chunk != other")
        .select("key", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "chunk", "f")
    )

    def compare(table: pa.Table) -> pa.Table:
        chunk, low, f = (table.column(c).to_numpy() for c in ("chunk", "low", "f"))
        first = chunk == low
        a, b = forest(f[first].view(np.uint64), bits, f[~first].view(np.uint64))
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return pairs.groupBy("key", "low", "high").applyInArrow(compare, "a long, b long")


# ---- components -----------------------------------------------------------------------------------------------------


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of `edges` (a, b); the root is the least node of its component.

    Alternates two steps on the edge list: every node sends its larger neighbours to its least neighbour, then its smaller
    ones. Both keep components and the edge list never grows; it ends as a star around each root. Each round is written to
    the checkpoint folder.
    """
    now = cut_lineage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct())
    state = _signature(now)
    for _ in range(most_rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        now = cut_lineage(small.select("e.u", "e.v").filter("u != v").distinct())
        before, state = state, _signature(now)
        if state == before:
            nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return nodes.union(nodes.select(F.col("root").alias("node"), "root")).distinct()
    raise RuntimeError("components did not settle")


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1000003)).first())


#: Copies of a component's row that its values are dealt among.
SHARES = 16


def _groups(docs: DataFrame, id_column: str, text: str, shingle: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """Every row as (row_id, text_key, f), and for every fingerprint f the `first` row of its group."""
    read = docs.select(F.col(f"`{id_column}`").alias("row_id"), F.xxhash64(F.col(f"`{text}`")).alias("text_key"), F.col(f"`{text}`").alias("text_of_row"))
    printed = cut_lineage(fingerprints(read, "text_of_row", shingle, "f", keep=["row_id", "text_key"]))
    rows = printed.groupBy("f", "row_id", "text_key").agg(F.count(F.lit(1)).alias("rows"))
    first = F.struct(F.col("row_id").isNull().alias("no_id"), "row_id", "text_key", "rows")
    groups = cut_lineage(rows.groupBy("f").agg(F.min(first).alias("first")))
    roots = components(links(groups, bits))
    rooted = groups.join(roots.withColumnRenamed("node", "f"), "f", "left")
    alone = rooted.filter(F.col("root").isNull()).select("f", F.col("f").alias("root"), "first")
    # a very large component is dealt out: each of its values meets one of `SHARES` copies of the component's row
    linked = rooted.filter(F.col("root").isNotNull()).select("f", "root", "first", F.pmod(F.xxhash64("f"), F.lit(SHARES)).cast("int").alias("share"))
    parts = linked.groupBy("root", "share").agg(F.min("first").alias("first"))
    whole = cut_lineage(parts.groupBy("root").agg(F.min("first").alias("first")))
    copies = whole.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    return printed, alone.unionByName(linked.select("f", "root", "share").join(copies, ["root", "share"]).select("f", "root", "first"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = 4, bits: int = MAX_BITS) -> DataFrame:
    """One row per row of `docs`: the id, `fingerprint` (16 hex digits) and `component_id`.

    `component_id` is the smallest id of the documents that can be reached over links of at most `bits` differing bits;
    null if none of them has an id. Texts without words have fingerprint zero and link like any other. Rows that share an
    id are separate rows. An empty table gives an empty result; other columns are not read.
    """
    printed, member = _groups(docs, id_column, text, shingle, bits)
    return printed.join(member, "f").select(F.col("row_id").alias(id_column), hex_digits(F.col("f")).alias("fingerprint"), F.col("first.row_id").alias("component_id"))


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = 4, bits: int = MAX_BITS) -> DataFrame:
    """`docs` with one row of each group: the one with the smallest id, rows without an id last.

    Of rows of a group that share the smallest id, one is kept: the one whose text hashes lowest, and of repeated texts the
    one with the least JSON form. Null and empty texts form one group. Columns stay as they are.
    """
    id_, key, rows = (textkit.free_name(docs, n) for n in ("kept_id", "kept_text", "kept_rows"))
    _, member = _groups(docs, id_column, text, shingle, bits)
    chosen = member.select("root", "first").distinct().select(F.col("first.row_id").alias(id_), F.col("first.text_key").alias(key), F.col("first.rows").alias(rows))
    same = docs[id_column].eqNullSafe(chosen[id_]) & (F.xxhash64(docs[text]) == chosen[key])
    kept = docs.join(chosen, same)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    row = textkit.free_name(docs, "kept_row")
    repeated = kept.filter(F.col(rows) > 1).groupBy(id_, key).agg(F.min_by(F.struct(*columns), F.to_json(F.struct(*columns))).alias(row))
    return kept.filter(F.col(rows) == 1).select(*columns).union(repeated.select(*[F.col(f"{row}.`{c}`").alias(c) for c in docs.columns]))
