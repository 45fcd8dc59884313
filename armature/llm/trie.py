"""Prefix trie of conversations, from sorted sequences and range minima.

Conversations are put in the order of their turns (as digests), in blocks of a bounded number of turns. Between neighbours
stands the number of leading turns they share (LCP). A prefix of a conversation is a node; its members are the neighbours to the
left and right over which every LCP is at least its depth. A sparse table of range minima answers "is every LCP from here to
there at least d" at once, so each candidate prefix finds its two ends by two binary searches of its own, all of a block
together and without a stack. Counts and sums of a node are differences of running sums over its interval.

A prefix whose interval reaches the edge of its block is a prefix of the first or last conversation there. Those two rows of
every block are a shorter sorted sequence, on which the same search is run in one task (two rows per block); it says
where each such node begins, and an aggregate by that place adds up its parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from armature.operators.smallside import cut_lineage, pin_small

#: Turns of a block, and the fewest for which it is worth a task of its own. A longer conversation is never cut.
MOST_TURNS, LEAST_TURNS = 1 << 19, 1 << 12
#: Ids in a row of the list of conversations that end at a node.
PIECE = 256
#: Kinds of rows that a block gives.
NODE, PART, EDGE, ENDS = 0, 1, 2, 3
LEFT, RIGHT = 0, 1


def sequences(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(id, turns): one row per conversation, its turns as (key, bytes): a digest of role and text, and the text's UTF-8 bytes.

    Turns go by number, null first; equal numbers by role, then text. A null role or text is empty. Repeated rows are separate
    turns. Ids are whole numbers; a row without one belongs to no conversation. Other columns are not read.
    """
    plain = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    said = turns.select(F.col(f"`{conversation}`").cast("long").alias("id"), F.struct(F.col(f"`{turn}`").alias("turn"), plain(role).alias("role"), plain(text).alias("text")).alias("said"))
    whole = said.filter("id IS NOT NULL").groupBy("id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    digest = lambda t: F.unhex(F.md5(F.concat(F.length(t["role"]).cast("string"), F.lit(":"), t["role"], t["text"]).cast("binary")))
    return whole.select("id", F.transform("said", lambda t: F.struct(digest(t).alias("key"), F.octet_length(t["text"]).cast("long").alias("bytes"))).alias("turns"))


class Minima:
    """Sparse table: minima of all ranges whose length is a power of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            below, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(below[:-half], below[half:]))

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minimum of each range, both ends included."""
        level = np.frexp((last - first + 1).astype(float))[1] - 1
        out = np.empty(len(first), self.levels[0].dtype)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(self.levels[k][first[at]], self.levels[k][last[at] - (1 << k) + 1])
        return out

    def right(self, place: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last place that can be reached from `place` over values of at least `depth`; the value at a place stands before it."""
        end = place.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            fits = end + 1 < len(level)
            fits[fits] = level[end[fits] + 1] >= depth[fits]
            end[fits] += 1 << k
        return end

    def left(self, place: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first place that reaches `place` over values of at least `depth`."""
        begin = place.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            start = begin - (1 << k) + 1
            fits = start >= 1
            fits[fits] = self.levels[k][start[fits]] >= depth[fits]
            begin[fits] -= 1 << k
        return begin


def common_prefixes(keys: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """LCP of each sequence with the one before it; -1 for the first. `keys` has a row of two numbers per turn."""
    size = np.diff(offset)
    out = np.full(len(size), -1, np.int64)
    if len(size) < 2:
        return out
    out[1:] = 0
    least = np.minimum(size[1:], size[:-1])
    alive, depth = np.arange(1, len(size)), 0
    while len(alive):
        alive = alive[least[alive - 1] > depth]
        same = (keys[offset[alive] + depth] == keys[offset[alive - 1] + depth]).all(axis=1)
        alive, depth = alive[same], depth + 1
        out[alive] = depth
    return out


def _sums(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(values)])


OUT = T.StructType(
    [
        T.StructField("kind", T.IntegerType()),
        *[T.StructField(n, T.LongType()) for n in ("block", "side", "depth", "conv_id", "parent_conv_id", "parent_side", "n_convs", "n_children", "n_leaves", "saved_tokens")],
        *[T.StructField(n, T.LongType()) for n in ("all_bytes", "new_bytes", "first_bytes", "prefix_bytes", "inner", "piece")],
        T.StructField("ids", T.ArrayType(T.LongType())),
        *[T.StructField(n, T.ArrayType(T.BinaryType())) for n in ("first_keys", "last_keys")],
        T.StructField("first_sizes", T.ArrayType(T.LongType())),
    ]
)
_KINDS = [pa.int32(), *[pa.int64()] * 16, pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.binary()), pa.list_(pa.int64())]


def _rows(kind: int, block: int, size: int, **columns) -> pa.RecordBatch:
    columns |= {"kind": np.full(size, kind, np.int32), "block": np.full(size, block, np.int64)}
    arrays = []
    for field, as_ in zip(OUT.fields, _KINDS, strict=True):
        found = columns.get(field.name)
        arrays.append(pa.nulls(size, as_) if found is None else found if isinstance(found, pa.Array) else pa.array(found, as_))
    return pa.RecordBatch.from_arrays(arrays, names=OUT.names)


def block_rows(block: int, ids: np.ndarray, keys: np.ndarray, sizes: np.ndarray, offset: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The nodes that lie inside a block, its parts of nodes that reach an edge of it, its two edge rows, and who ends where."""
    n, size = len(ids), np.diff(offset)
    lcp = common_prefixes(keys, offset)
    before = _sums(sizes)
    prefix = lambda row, depth: before[offset[row] + depth] - before[offset[row]]
    total = before[offset[1:]] - before[offset[:-1]]

    # one candidate for every prefix that the row before does not have
    fresh = size - lcp
    place = np.repeat(np.arange(n), fresh)
    depth = np.arange(len(place)) - np.repeat(_sums(fresh)[:-1], fresh) + lcp[place] + 1
    table, least = Minima(lcp), Minima(ids)
    first, last = table.left(place, depth), table.right(place, depth)
    above = np.maximum(depth - 1, 0)
    parent_first, parent_last = table.left(place, above), table.right(place, above)

    leaf = np.zeros(n, bool)
    leaf[:-1] = lcp[1:] < size[:-1]  # of the last row only the next block can tell
    new = total - prefix(np.arange(n), np.maximum(lcp, 0))
    new[0] = 0
    leaves, all_bytes, new_bytes = _sums(leaf), _sums(total), _sums(new)
    over = lambda sums, low: sums[last + 1] - sums[low]
    step = int(size.max()) + 2
    key, own = parent_first * step + above, first * step + depth
    child_key, child_count = np.unique(key[(depth > 0) & (place > 0)], return_counts=True)
    spot = np.minimum(np.searchsorted(child_key, own), max(0, len(child_key) - 1))
    children = np.where(child_key[spot] == own, child_count[spot], 0) if len(child_key) else np.zeros(len(own), np.int64)

    members, ids_least = last - first + 1, least.of(first, last)
    lead, gained = prefix(first, above), over(new_bytes, first + 1)
    saved = over(all_bytes, first) - members * lead - (total[first] - lead + gained)
    open_ = (first == 0) | (last == n - 1)
    side = np.where(first == 0, LEFT, RIGHT)
    parent_open = (parent_first == 0) | (parent_last == n - 1)
    parent = pa.array(least.of(parent_first, parent_last), mask=parent_open)
    parent_side = pa.array(np.where(parent_first == 0, LEFT, RIGHT), mask=~parent_open)

    at = np.flatnonzero(~open_)
    yield _rows(NODE, block, len(at), depth=depth[at], conv_id=ids_least[at], parent_conv_id=parent.take(pa.array(at)), parent_side=parent_side.take(pa.array(at)), n_convs=members[at], n_children=children[at], n_leaves=over(leaves, first)[at], saved_tokens=saved[at])
    at = np.flatnonzero(open_)
    yield _rows(PART, block, len(at), side=side[at], depth=depth[at], conv_id=ids_least[at], n_convs=members[at], n_children=children[at], n_leaves=over(leaves, first)[at], all_bytes=over(all_bytes, first)[at], new_bytes=gained[at], first_bytes=total[first][at], prefix_bytes=lead[at])
    digests = lambda row: pa.array([[keys[i].tobytes() for i in range(offset[row], offset[row + 1])]], pa.list_(pa.binary()))
    inner = int(size[0]) if n == 1 else int(lcp[1:].min())
    inner = min(inner, int(size[0]))
    yield _rows(EDGE, block, 1, first_keys=digests(0), last_keys=digests(n - 1), first_sizes=pa.array([sizes[offset[0] : offset[1]].tolist()], pa.list_(pa.int64())), inner=np.array([inner]))

    # runs of equal sequences: the conversations that end at a node, which begins where the run does
    starts = np.flatnonzero(np.concatenate([[True], (lcp[1:] != size[1:]) | (size[1:] != size[:-1])]))
    stops = np.append(starts[1:], n)
    pieces = -(-(stops - starts) // PIECE)
    run = np.repeat(np.arange(len(starts)), pieces)
    number = np.arange(len(run)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    cut = np.append(starts[run] + number * PIECE, n).astype(np.int32)
    node = np.flatnonzero((depth == size[place]) & (first == place))  # in the order of the runs
    node = node[np.searchsorted(place[node], starts)][run]
    name, edge = pa.array(ids_least[node], mask=open_[node]), pa.array(side[node], mask=~open_[node])
    yield _rows(ENDS, block, len(run), side=edge, depth=depth[node], conv_id=name, piece=number, ids=pa.ListArray.from_arrays(pa.array(cut), pa.array(ids)))


def _block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition is a block: (id, turns, block), sorted."""
    ids, keys, sizes, counts, block = [], [], [], [], 0
    for batch in batches:
        if not len(batch):
            continue
        block = batch.column(2)[0].as_py()
        ids.append(batch.column(0).to_numpy())
        turns = batch.column(1)
        counts.append(np.diff(turns.offsets.to_numpy()))
        flat = turns.flatten()
        digests = pa.concat_arrays([flat.field(0)])
        ends = np.frombuffer(digests.buffers()[1], np.int32 if pa.types.is_binary(digests.type) else np.int64)[digests.offset : digests.offset + len(digests) + 1]
        raw = digests.buffers()[2]
        keys.append(np.frombuffer(raw, np.uint8)[ends[0] : ends[-1]].reshape(-1, 16).copy().view(np.uint64) if len(digests) else np.zeros((0, 2), np.uint64))
        sizes.append(flat.field(1).to_numpy(zero_copy_only=False))
    if ids:
        yield from block_rows(block, np.concatenate(ids), np.concatenate(keys), np.concatenate(sizes), _sums(np.concatenate(counts)))


PLACE = "block long, side long, depth long, home long, home_side long, begins boolean, more_children long, more_leaves long, more_bytes long, side_above long"


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every part: the block and side where its node begins, and what the block could not know. Blocks come in order."""
    block, first, last, sizes, inner = [], [], [], [], []
    for batch in batches:
        for name, out in (("block", block), ("first_keys", first), ("last_keys", last), ("first_sizes", sizes), ("inner", inner)):
            out.extend(batch.column(name).to_pylist())
    if not block:
        return
    lcp = np.full(2 * len(block), -1, np.int64)
    for b in range(len(block)):
        if b:
            one, two = last[b - 1], first[b]
            lcp[2 * b] = next((d for d, (x, y) in enumerate(zip(one, two, strict=False)) if x != y), min(len(one), len(two)))
        lcp[2 * b + 1] = inner[b]
    table = Minima(lcp)
    numbers = np.array(block)
    for b in range(len(block)):
        border, within, after = int(lcp[2 * b]), int(inner[b]), int(lcp[2 * b + 2]) if b + 1 < len(block) else -1
        before = _sums(np.array(sizes[b], np.int64))
        for side, depth in ((LEFT, np.arange(len(first[b]) + 1)), (RIGHT, np.arange(within + 1, len(last[b]) + 1))):
            place = np.full(len(depth), 2 * b + side)
            home = table.left(place, depth)
            begins = home == place
            holds_last = np.full(len(depth), True) if side == RIGHT else depth <= within
            grows = (side == LEFT) & (len(first[b]) > depth) & (border <= depth)
            known = before[-1] - before[min(max(border, 0), len(before) - 1)]
            columns = [
                np.full(len(depth), block[b]), np.full(len(depth), side), depth, numbers[home // 2], home % 2, begins, grows.astype(np.int64),
                (holds_last & (after < len(last[b]))).astype(np.int64), np.where(begins, 0, known),
                np.full(len(depth), LEFT) if side == LEFT else np.where(depth - 1 > within, RIGHT, LEFT),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[c.split()[0] for c in PLACE.split(", ")])


def prefix_trie(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and ends of the trie of all `conversations` (id, turns), as `sequences` gives them.

    Nodes: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens); a node is named by its smallest
    member and its depth, the root has depth 0 and no parent. `n_leaves` counts the childless nodes of its subtree, itself
    included, and `saved_tokens` is the sum over its subtree of (members - 1) times the bytes of the last turn.
    Ends: (conv_id, depth, block, piece, ids): the conversations that end at a node, ascending over blocks and pieces, at most
    `PIECE` in a row. A conversation without turns ends at the root. Without conversations there is no node.
    """
    spark = conversations.sparkSession
    known = cut_lineage(conversations.select("id", "turns"))
    turns = known.agg(F.sum(F.size("turns") + 1)).first()[0] or 1
    blocks = max(-(-turns // MOST_TURNS), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // LEAST_TURNS)))
    ordered = known.repartitionByRange(blocks, "turns", "id").sortWithinPartitions("turns", "id")
    # written, so that a block means the same rows to everyone who reads it
    blocked = cut_lineage(ordered.withColumn("block", F.spark_partition_id().cast("long")))
    found = cut_lineage(blocked.mapInArrow(_block, OUT))

    edges = found.filter(F.col("kind") == EDGE).select("block", "first_keys", "last_keys", "first_sizes", "inner")
    places = pin_small(edges.repartition(1).sortWithinPartitions("block").mapInArrow(_places, PLACE))
    part = found.filter(F.col("kind") == PART).join(places, ["block", "side", "depth"])
    crossing = part.groupBy("home", "home_side", "depth").agg(
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.sum(F.col("n_children") + F.col("more_children")).alias("n_children"),
        F.sum(F.col("n_leaves") + F.col("more_leaves")).alias("n_leaves"),
        (F.sum("all_bytes") - F.sum("n_convs") * F.max("prefix_bytes") - F.max(F.when(F.col("begins"), F.col("first_bytes") - F.col("prefix_bytes"))) - F.sum(F.col("new_bytes") + F.col("more_bytes"))).alias("saved_tokens"),
        F.max(F.when(F.col("begins"), F.col("side_above"))).alias("parent_side"),
    )
    crossing = cut_lineage(crossing)
    named = places.join(crossing.select("home", "home_side", "depth", "conv_id"), ["home", "home_side", "depth"]).select("block", "side", "depth", "conv_id")
    named = pin_small(named)

    measures = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    inside = found.filter(F.col("kind") == NODE).select("block", *measures, "parent_conv_id", "parent_side")
    across = crossing.select(F.col("home").alias("block"), *measures, F.lit(None).cast("long").alias("parent_conv_id"), "parent_side")
    above = named.select("block", F.col("side").alias("parent_side"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("open_parent"))
    nodes = inside.unionByName(across).join(above, ["block", "parent_side", "depth"], "left")
    nodes = nodes.select("conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "open_parent")).alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens")

    ended = found.filter(F.col("kind") == ENDS).select("block", "side", "depth", "conv_id", "piece", "ids")
    whole = ended.join(named.withColumnRenamed("conv_id", "open_node"), ["block", "side", "depth"], "left")
    return nodes, whole.select(F.coalesce("conv_id", "open_node").alias("conv_id"), "depth", "block", "piece", "ids")


def ends_digest(ends: DataFrame, name: str = "ends_sha256") -> DataFrame:
    """(conv_id, depth, digest): SHA-256 of the ids that end at a node, in decimal and joined by commas. Ids are hashed piece by
    piece as they come, so that a node at which very many end needs no memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            out = []
            conv, depth, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(4)
            for row, node in enumerate(zip(conv, depth, strict=True)):
                text = ",".join(map(str, ids[row].as_py())).encode()
                if node == now:
                    state.update(b"," + text)
                    continue
                if now is not None:
                    out.append((*now, state.hexdigest()))
                now, state = node, hashlib.sha256(text)
            yield pa.RecordBatch.from_pydict({"conv_id": pa.array([x[0] for x in out], pa.int64()), "depth": pa.array([x[1] for x in out], pa.int64()), name: pa.array([x[2] for x in out], pa.string())})
        if now is not None:
            yield pa.RecordBatch.from_pydict({"conv_id": pa.array([now[0]], pa.int64()), "depth": pa.array([now[1]], pa.int64()), name: pa.array([state.hexdigest()])})

    ordered = ends.select("conv_id", "depth", "block", "piece", "ids").repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "block", "piece")
    return ordered.mapInArrow(run, f"conv_id long, depth long, {name} string")
