"""Chat prompts as columns: every turn is wrapped on its own row, then the pieces of a conversation are put together."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armature.functions import text

# Fixed values of the prompt formats.
ASSISTANT_SYSTEM = (
    "A chat between a curious user and an artificial intelligence assistant. "
    "The assistant gives helpful, detailed, and polite answers to the user's questions."
)
VISION_SYSTEM = (
    "You are a helpful language and vision assistant. "
    "You are able to understand the visual content that the user provides, "
    "and assist the user with a variety of tasks using natural language."
)


@dataclass(frozen=True)
class Template:
    """human = open + message + close, reply = message + end; `lead` precedes the first turn, `inner` its message."""

    open: str
    close: str
    end: str
    lead: str = ""
    inner: str = ""
    bos: str | None = "<s>"  # removed from the front of the prompt: the tokenizer adds it. None: keep what is there


TEMPLATES: dict[str, Template] = {
    "pure": Template("In: ", "\nOut: ", "</s>"),
    "vicuna": Template("USER: ", " ASSISTANT: ", "</s>", lead=ASSISTANT_SYSTEM + " "),
    "llama2": Template("[INST] ", " [/INST] ", "</s>", inner=f"<<SYS>\n{VISION_SYSTEM}\n<</SYS>>\n\n"),
    "mistral": Template("[INST] ", " [/INST] ", "</s>"),
    "phi": Template("Input: ", "\nOutput: ", "\n<|endoftext|>", lead="<|endoftext|>", bos=None),
}


def clean(message: Column) -> Column:
    return text.strip(text.without_image_tag(message))


def wrap_human(message: Column, template: Template, first: Column) -> Column:
    lead = F.when(first, F.lit(template.lead + template.open + template.inner)).otherwise(F.lit(template.open))
    return F.concat(lead, message, F.lit(template.close))


def wrap_turn(message: Column, turn: Column, template: Template) -> Column:
    """The text a turn adds to the prompt. Even turns are the human's; an empty reply is one space."""
    cleaned = clean(message)
    reply = F.concat(F.when(cleaned == "", " ").otherwise(cleaned), F.lit(template.end))
    return F.when(turn % 2 == 0, wrap_human(cleaned, template, turn == 0)).otherwise(reply)


def role_ok(role: Column, turn: Column) -> Column:
    return role == F.when(turn % 2 == 0, "human").otherwise("gpt")


def finished(prompt: Column, template: Template) -> Column:
    """Ends of the assembled prompt: no tokenizer-owned prefix, no trailing whitespace."""
    body = text.strip_right(prompt)
    if template.bos is None:
        return body
    return F.when(body.startswith(template.bos), F.substring(body, len(template.bos) + 1, 1 << 30)).otherwise(body)


def chat_prompts(turns: DataFrame, templates: Sequence[str], conversation: str = "conv_id", most_turns: int = 1 << 17) -> DataFrame:
    """(conversation, one prompt column per template): one row per conversation.

    A prompt is one value, so a conversation of more than `most_turns` turns is an error. `turns` may carry a boolean
    `verbatim`: such messages are wrapped as they are.
    """
    t = F.col("turn_idx")
    as_is = F.col("verbatim") if "verbatim" in turns.columns else F.lit(False)
    pieces = []
    for name in templates:
        template = TEMPLATES[name]
        # without history the phi opener gets no BOS on a message that is only being tried out
        first = (t == 0) & ~as_is if name == "phi" else t == 0
        raw = F.when(as_is, wrap_human(F.col("text"), template, first)).otherwise(wrap_turn(F.col("text"), t, template))
        pieces.append(raw.alias(name))
    rows = turns.select(conversation, "turn_idx", *pieces)
    nested = F.sort_array(F.collect_list(F.struct("turn_idx", *templates))).alias("__p")
    chats = rows.groupBy(conversation).agg(nested)
    bounded = F.when(F.size("__p") <= most_turns, F.col("__p")).otherwise(F.raise_error(F.lit(f"a conversation has more than {most_turns} turns")))
    return chats.withColumn("__p", bounded).select(
        conversation, *[finished(F.array_join(F.col(f"__p.{n}"), ""), TEMPLATES[n]).alias(n) for n in templates]
    )


def action_prompt(instruction: Column, checkpoint: Column | None = None) -> Column:
    """Question for a robot action; first-generation checkpoints ("v01" in the path) were trained on the chat format."""
    question = F.concat(F.lit("What action should the robot take to "), F.lower(instruction), F.lit("?"))
    plain = F.concat(F.lit("In: "), question, F.lit("\nOut:"))
    if checkpoint is None:
        return plain
    chat = F.concat(F.lit(ASSISTANT_SYSTEM + " USER: "), question, F.lit(" ASSISTANT:"))
    return F.when(checkpoint.contains("v01"), chat).otherwise(plain)
