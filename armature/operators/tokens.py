"""Token ids, labels and padded batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from armature.functions import actions as A
from armature.functions import text
from armature.functions import vectors as V
from armature.operators import prompts as P

# Fixed values of the default byte tokenizer: id = UTF-8 byte + 3.
PAD, BOS, EOS, FIRST_BYTE = 0, 1, 2, 3
#: Bytes of text that a plugged-in tokenizer gets in one call.
PIECE_BYTES = 1 << 20


def byte_encoder() -> Callable[[Column], Column]:
    """Column -> byte tokens: one pass over the bytes of an Arrow batch, no Python call per text."""

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        whole = texts.cast(pa.large_string())
        ends = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
        data = np.frombuffer(whole.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        values = pa.array(data.astype(np.int32) + FIRST_BYTE)
        starts = pa.array((ends - ends[0]).astype(np.int32), mask=np.append(whole.is_null().to_numpy(zero_copy_only=False), False))
        return pa.ListArray.from_arrays(starts, values)

    return ids


def encoder(
    encode: Callable[[str], Sequence[int]] | None = None, batch: Callable[[list[str]], Sequence[Sequence[int]]] | None = None
) -> Callable[[Column], Column]:
    """Column -> token ids with a pluggable tokenizer. The default is a token per byte.

    `batch` takes many texts in one call, which is how tokenizer libraries use their threads; `encode` takes one. A call gets
    the texts of an Arrow batch in pieces of about `PIECE_BYTES`, a longer text alone or last, and their ids become Arrow
    values before the next call: Python lists of a whole batch are never held. A null text has null ids.
    """
    if batch is None and encode is None:
        return byte_encoder()
    many = batch or (lambda texts: [encode(t) for t in texts])

    def piece_ids(texts: pa.Array) -> pa.Array:
        out = texts.to_pylist()
        known = [i for i, t in enumerate(out) if t is not None]
        for i, found in zip(known, many([out[i] for i in known]), strict=True):
            out[i] = list(found)
        return pa.array(out, pa.list_(pa.int32()))

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        sizes = pc.binary_length(texts).fill_null(0).to_numpy().astype(np.int64)
        piece = (np.cumsum(sizes) - sizes) // PIECE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(texts)]
        return pa.concat_arrays([piece_ids(texts.slice(a, b - a)) for a, b in zip(cuts, cuts[1:])])

    return ids


def ignore(ids: Column) -> Column:
    return F.array_repeat(F.lit(A.IGNORE_LABEL), F.size(ids))


def action_token_ids(action: Column, dims: int, vocab: int = A.VOCAB_SIZE) -> Column:
    return V.each(action, dims, lambda x, _: A.token_of_bin(A.action_bin(x), vocab))


def keep_last(ids: Column, n: Column | int, stop_token: bool = True) -> Column:
    """Labels: everything but the last `n` ids is ignored; without the stop token the very last one as well."""
    n = F.lit(n) if isinstance(n, int) else n
    kept = F.slice(ids, F.size(ids) - n + 1, n if stop_token else n - 1)
    head = F.array_repeat(F.lit(A.IGNORE_LABEL), F.size(ids) - n)
    return F.concat(head, kept) if stop_token else F.concat(head, kept, F.array(F.lit(A.IGNORE_LABEL)))


def with_empty_token(ids: Column) -> Column:
    done = F.element_at(ids, -1) == A.EMPTY_TOKEN
    return F.when(done, ids).otherwise(F.array_append(ids, F.lit(A.EMPTY_TOKEN)))


def action_examples(
    frames: DataFrame, keys: Sequence[str], dims: int, encode: Callable[[Column], Column] | None = None, stop_token: bool = True
) -> DataFrame:
    """Frames -> training examples: keys, dataset_name, image, input_ids, labels.

    Uses element 0 of the chunks: the current step when the window is 1.
    """
    encode = encode or encoder()
    prompt = F.concat(P.action_prompt(F.col("task.language_instruction")), F.lit(" "))
    chosen = frames.select(
        *keys,
        "dataset_name",
        F.col("observation")[0]["image_primary"].alias("image"),
        prompt.alias("__prompt"),
        F.col("action")[0].alias("__action"),
    )
    ids = F.concat(
        F.array(F.lit(BOS)), encode(F.col("__prompt")), action_token_ids(F.col("__action"), dims), F.array(F.lit(EOS))
    )
    tokens = chosen.withColumn("input_ids", ids).drop("__prompt", "__action")
    return tokens.withColumn("labels", keep_last(F.col("input_ids"), dims + 1, stop_token))


def chat_examples(
    turns: DataFrame,
    template: str,
    max_length: int,
    conversation: str = "conv_id",
    encode: Callable[[Column], Column] | None = None,
    trim: bool = True,
    bos: int | None = BOS,
) -> DataFrame:
    """Turns -> (conversation, image, input_ids, labels); replies are the labels, the rest is ignored.

    `bos` and `trim` say what the tokenizer does: the token it puts in front of a text (None: none), and whether blanks at the
    end of a turn go. Turns are cut where the running count of tokens reaches `max_length`, so what is gathered per
    conversation is bounded by the model's context.
    """
    encode = encode or encoder()
    t = F.col("turn_idx")
    piece = P.wrap_turn(F.col("text"), t, P.TEMPLATES[template])
    said = turns.select(conversation, "image", "turn_idx", encode(text.strip_right(piece) if trim else piece).alias("__ids"))
    ids = F.col("__ids") if bos is None else F.when(t == 0, F.concat(F.array(F.lit(bos)), F.col("__ids"))).otherwise(F.col("__ids"))
    w = Window.partitionBy(conversation).orderBy("turn_idx").rowsBetween(Window.unboundedPreceding, -1)
    placed = said.withColumn("__ids", ids).withColumn("__at", F.coalesce(F.sum(F.size("__ids")).over(w), F.lit(0)))
    room = F.greatest(F.lit(0), max_length - F.col("__at")).cast("int")
    cut = placed.filter(F.col("__at") < max_length).withColumn("__ids", F.slice("__ids", 1, room))
    labels = F.when(t % 2 == 0, ignore(F.col("__ids"))).otherwise(F.col("__ids"))
    nested = F.sort_array(F.collect_list(F.struct("turn_idx", F.col("__ids").alias("i"), labels.alias("l"))))
    flat = cut.groupBy(conversation, "image").agg(nested.alias("__t")).select(
        conversation, "image", F.flatten("__t.i").alias("input_ids"), F.flatten("__t.l").alias("__labels")
    )
    first_off = F.concat(F.array(F.lit(A.IGNORE_LABEL)), F.slice("__labels", 2, max_length))
    return flat.withColumn("labels", F.when(F.col("image").isNotNull(), first_off).otherwise(F.col("__labels"))).drop("__labels")


def caption_examples(turns: DataFrame, conversation: str = "conv_id", encode: Callable[[Column], Column] | None = None) -> DataFrame:
    """Two-turn examples -> caption tokens: the request is dropped, the BOS label is ignored.

    What is no such example comes out with a `problem` and without tokens: another number of turns, an image tag in the reply,
    or no image. Turn 2 already tells that there are too many, so three rows per conversation are enough to decide.
    """
    encode = encode or encoder()
    few = turns.filter(F.col("turn_idx") <= 2).groupBy(conversation, "image").agg(
        F.max("turn_idx").alias("__last"), F.max(F.when(F.col("turn_idx") == 1, F.col("text"))).alias("__reply")
    )
    problem = (
        F.when(F.col("image").isNull(), "no image")
        .when(F.col("__last") != 1, "not two turns")
        .when(F.col("__reply").isNull() | F.col("__reply").contains("<image>"), "image tag in the reply")
    )
    judged = few.withColumn("problem", problem)
    caption = F.when(F.col("problem").isNull(), F.concat(text.strip(F.col("__reply")), F.lit("</s>")))
    ids = judged.select(conversation, "image", "problem", F.concat(F.array(F.lit(BOS)), encode(caption)).alias("input_ids"))
    labels = F.concat(F.array(F.lit(A.IGNORE_LABEL)), F.slice("input_ids", 2, 1 << 30))
    return ids.withColumn("labels", labels)


def pad_batches(
    examples: DataFrame, batch: str, max_length: int, pad: int = PAD, image_required: bool = False, image: str = "image"
) -> DataFrame:
    """Right-pad ids and labels to the longest of their batch, cut to `max_length`, mark real tokens.

    The mask is "id differs from the pad id", so a genuine pad id inside a text is masked too. Batches are bounded groups.
    """
    widest = F.max(F.size("input_ids")).over(Window.partitionBy(batch))
    sized = examples.withColumn("__n", widest)

    def padded(ids: Column, filler: int) -> Column:
        return F.slice(F.concat(ids, F.array_repeat(F.lit(filler), F.col("__n") - F.size(ids))), 1, max_length)

    out = sized.withColumns(
        {"input_ids": padded(F.col("input_ids"), pad), "labels": padded(F.col("labels"), A.IGNORE_LABEL)}
    ).withColumn("attention_mask", F.transform("input_ids", lambda x: (x != pad).cast("int")))
    has_image = F.col(image).isNotNull()
    if image_required:
        has_image = F.when(has_image, True).otherwise(F.raise_error(F.lit("example without image")).cast("boolean"))
    return out.withColumn("has_image", has_image).drop("__n")


def choice_probabilities(scores: Column, candidates: Sequence[int]) -> Column:
    """Softmax over all scores, read at the candidates and rescaled to sum 1. Only the candidates' terms matter, so the
    full softmax is never built; subtracting the largest score keeps exp in range."""
    top = F.array_max(scores)
    terms = [F.exp(scores[i] - top) for i in candidates]
    total = terms[0]
    for x in terms[1:]:
        total = total + x
    return F.array(*[x / total for x in terms])
