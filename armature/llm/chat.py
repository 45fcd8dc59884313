"""Chat formatting with Spark expressions only.

Turns of a conversation are collected as structs and sorted; adjacent turns of a role become one message of several parts.
The output of a message is

    <|turn|>role<|says|>part<|more|>part<|end|>

Control strings inside roles and texts, ours and those of common templates, are escaped: a marker character goes in after their
first character, or one more where markers already stand there. No control string is left in escaped text, and taking
one marker away restores it, so the output can be read back exactly.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, SAYS, MORE, END = "<|turn|>", "<|says|>", "<|more|>", "<|end|>"
#: Control strings of common chat templates. None is a part of another or overlaps one.
FOREIGN = (
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>",
    "<|begin_of_text|>", "<|end_of_text|>", "<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>", "<|system|>", "<|user|>",
    "<|assistant|>", "<start_of_turn>", "<end_of_turn>", "<unk>", "<pad>",
)
CONTROLS = (TURN, SAYS, MORE, END, *FOREIGN)
#: U+2060, which has no width.
MARKER = "⁠"


def _pattern(markers: str) -> str:
    """First character, markers, rest: for every control string, grouped by first character."""
    ways = []
    for first in sorted({c[0] for c in CONTROLS}):
        rest = "|".join(re.escape(c[1:]).replace("/", "\\/") for c in CONTROLS if c[0] == first)
        ways.append(f"(?<={re.escape(first)}){markers}(?={MARKER}*(?:{rest}))")
    return "|".join(ways)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _pattern(""), MARKER)


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _pattern(MARKER), "")


def format_chats(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trained: str = "assistant", most_turns: int = 1 << 20
) -> DataFrame:
    """One row per conversation: its id, `formatted`, `n_messages` and `loss_spans` (start and length, in characters of
    `formatted`, of every part said by `trained`).

    Turns go by number, null first; equal numbers by role, then text. A null text or role is empty. Repeated rows are separate
    turns. Rows without a conversation id form one conversation. Other columns are not read. An empty table gives an empty
    result. A conversation is one row, so one of more than `most_turns` turns is an error.
    """
    # names of our own, so that no other column can clash
    source = turns.select(
        F.col(f"`{conversation}`").alias("id"),
        F.struct(F.col(f"`{turn}`").alias("turn"), F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")).alias("said"),
    )
    chats = source.groupBy("id").agg(F.sort_array(F.collect_list("said")).alias("turns"))
    chats = chats.withColumn("turns", F.when(F.size("turns") <= most_turns, F.col("turns")).otherwise(F.raise_error(F.lit(f"a conversation has more than {most_turns} turns"))))
    # where a message begins: the first turn, and every turn of another role than the one before
    begins = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: (i == 1) | (F.element_at("turns", i)["role"] != F.element_at("turns", F.greatest(i - 1, F.lit(1)))["role"]))
    chats = chats.withColumn("begins", begins)
    message = F.transform(
        "begins",
        lambda b, k: F.struct(
            F.element_at("turns", b)["role"].alias("role"),
            F.transform(F.slice("turns", b, F.coalesce(F.get("begins", k + 1), F.size("turns") + 1) - b), lambda t: escape(t["text"])).alias("parts"),
        ),
    )
    chats = chats.withColumn("messages", message)
    opened = lambda m: F.concat(F.lit(TURN), escape(m["role"]), F.lit(SAYS))
    written = F.concat_ws("", F.transform("messages", lambda m: F.concat(opened(m), F.concat_ws(MORE, m["parts"]), F.lit(END))))
    # spans: (length up to the part, length of the part, trained), then running sums
    pieces = F.flatten(
        F.transform(
            "messages",
            lambda m: F.transform(
                m["parts"],
                lambda p, k: F.struct(
                    F.when(k == 0, F.length(opened(m))).otherwise(F.lit(len(MORE))).alias("gap"),
                    F.length(p).alias("size"),
                    F.when(k == F.size(m["parts"]) - 1, F.lit(len(END))).otherwise(F.lit(0)).alias("tail"),
                    (m["role"] == trained).alias("trained"),
                ),
            ),
        )
    )
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def step(state: Column, p: Column) -> Column:
        begin = state["at"] + p["gap"]
        one = F.array(F.struct(begin.cast("long").alias("start"), p["size"].cast("long").alias("length")))
        return F.struct((begin + p["size"] + p["tail"]).alias("at"), F.when(p["trained"], F.concat(state["spans"], one)).otherwise(state["spans"]).alias("spans"))

    spans = F.aggregate(pieces, start, step)["spans"]
    return chats.select(F.col("id").alias(conversation), written.alias("formatted"), F.size("messages").cast("long").alias("n_messages"), spans.alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text), one per part."""
    bodies = F.filter(F.split(formatted, re.escape(TURN)), lambda x: x != "")
    cut = lambda x: F.split(F.regexp_replace(x, re.escape(END) + "$", ""), re.escape(SAYS), 2)
    return F.flatten(
        F.transform(
            F.transform(bodies, cut),
            lambda m: F.transform(F.split(m[1], re.escape(MORE)), lambda p: F.struct(unescape(m[0]).alias("role"), unescape(p).alias("text"))),
        )
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order and with nothing between."""
    return F.concat_ws("", F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))))


def digest(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)
