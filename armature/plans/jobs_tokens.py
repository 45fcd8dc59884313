"""Token, prompt, label and padding jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from armature.functions import actions as A
from armature.functions import text
from armature.functions import vectors as V
from armature.operators import batching as B
from armature.operators import prompts as P
from armature.operators import statistics as T
from armature.operators import tokens as K
from armature.operators import trajectories as J
from armature.operators.ordering import counter_block, with_position
from armature.operators.smallside import pin_small
from armature.plans import views as W
from armature.plans.jobs_sources import ACTIONS
from armature.plans.jobs_trajectories import CENTRE, GRIPPER_MASK, KEYS, WIDE_STATS, normalized_sql
from armature.plans.registry import job, sql_wide, text_of, wide
from armature.sources import tables

# The 256 edges as a list, and the number of them that are <= x.
EDGES = "list_transform(range(0, 256), lambda i: CASE WHEN i = 255 THEN 1e0 ELSE -1 + i * (2e0 / 255) END)"


def bin_sql(x: str) -> str:
    return f"CAST(len(list_filter({EDGES}, lambda e: e <= greatest(-1e0, least(1e0, {x})))) AS INT)"


def byte_sql(s: str) -> str:
    """Byte tokens of a string."""
    h = f"hex(encode({s}))"
    return f"list_transform(range(0, len({h}) // 2), lambda i: CAST('0x' || substr({h}, CAST(2 * i + 1 AS BIGINT), 2) AS INT) + 3)"


def ignored(n: str) -> str:
    return f"list_transform(range(0, {n}), lambda i: -100)"


def sql_text(text_: str) -> str:
    return "'" + text_.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


SPACE = text.SPACE


def strip_right_sql(s: str) -> str:
    return f"regexp_replace({s}, '[{SPACE}]+\\z', '')"


def strip_sql(s: str) -> str:
    return f"regexp_replace({strip_right_sql(s)}, '\\A[{SPACE}]+', '')"


# Actions as tokens ----------------------------------------------------------------------------------------------------


@job(
    "discretize_action",
    W.sql("v_steps", "SELECT event_id AS id, 'step' AS source, " + ", ".join(f"{bin_sql(a)} AS b{i}" for i, a in enumerate(ACTIONS)) + " FROM v_steps UNION ALL SELECT vec_id, 'vector', "
          + ", ".join(bin_sql(f"CAST(embedding[{i + 1}] AS DOUBLE) * 5") for i in range(7)) + " FROM embeddings"),
)
def discretize_action(spark, d):
    bins = lambda v: [A.action_bin(v[i]).alias(f"b{i}") for i in range(7)]
    steps = W.step_rows(spark, d).select(F.col("event_id").alias("id"), F.lit("step").alias("source"), *bins(F.col("action")))
    scaled = V.each(V.doubles("embedding"), 7, lambda x, _: x * 5.0)
    vectors = tables.table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.lit("vector").alias("source"), scaled.alias("e"))
    return steps.unionByName(vectors.select("id", "source", *bins(F.col("e"))))


@job("action_to_token_ids", W.sql("v_steps", f"SELECT event_id, concat_ws(',', {', '.join(f'31936 - {bin_sql(a)}' for a in ACTIONS)}) AS ids FROM v_steps"))
def action_to_token_ids(spark, d):
    """The exported model's text vocabulary is padded to a multiple of 64: 32000 - 64."""
    return W.step_rows(spark, d).select("event_id", text_of(K.action_token_ids(F.col("action"), 7, 32000 - 64)).alias("ids"))


@job(
    "token_ids_to_action",
    W.sql("v_preds", f"SELECT sample_id, {sql_wide([CENTRE.format(b='pred_bin'), CENTRE.format(b='gt_bin')], 'x')} FROM v_preds"),
)
def token_ids_to_action(spark, d):
    x = F.array(*[A.action_of_token(A.token_of_bin(F.col(c))) for c in ("pred_bin", "gt_bin")])
    return W.predictions(spark, d).select("sample_id", *wide(x, "x", 2))


QUESTION = "'What action should the robot take to ' || lower(language_instruction) || '?'"
PLAIN = f"('In: ' || {QUESTION} || chr(10) || 'Out:')"


@job(
    "action_prompt",
    W.sql(
        "v_steps",
        f"""SELECT event_id, {PLAIN} AS plain, CASE WHEN event_id % 2 = 0 THEN {sql_text(P.ASSISTANT_SYSTEM + ' USER: ')} || {QUESTION} || ' ASSISTANT:' ELSE {PLAIN} END AS by_checkpoint FROM v_steps""",
    ),
)
def action_prompt(spark, d):
    checkpoint = F.when(F.col("event_id") % 2 == 0, "models/v01-7b").otherwise("models/7b")
    lang = F.col("language_instruction")
    return W.step_rows(spark, d).select(
        "event_id", P.action_prompt(lang).alias("plain"), P.action_prompt(lang, checkpoint).alias("by_checkpoint")
    )


# Chat prompts ---------------------------------------------------------------------------------------------------------

CLEAN = strip_sql("replace(text, '<image>', '')")


def piece_sql(name: str, message: str = "msg") -> str:
    t = P.TEMPLATES[name]
    first = f"CASE WHEN turn_idx = 0 THEN {sql_text(t.lead + t.open + t.inner)} ELSE {sql_text(t.open)} END"
    return f"""CASE WHEN turn_idx % 2 = 0 THEN {first} || {message} || {sql_text(t.close)}
      ELSE CASE WHEN {message} = '' THEN ' ' ELSE {message} END || {sql_text(t.end)} END"""


NAMES = list(P.TEMPLATES)
PIECES = f"SELECT *, {', '.join(f'{piece_sql(n)} AS {n}' for n in NAMES)} FROM (SELECT *, {CLEAN} AS msg FROM v_turns)"


def joined_sql(name: str) -> str:
    return strip_right_sql(f"string_agg({name}, '' ORDER BY turn_idx)") + f" AS {name}"


@job("build_chat_prompt", W.sql("v_turns", f"SELECT conv_id, {', '.join(joined_sql(n) for n in NAMES)} FROM p GROUP BY conv_id", p=PIECES))
def build_chat_prompt(spark, d):
    return P.chat_prompts(W.turns(spark, d), NAMES)


@job(
    "validate_turn_roles",
    """SELECT conv_id, count(*) AS n_turns, count(*) FILTER (who <> CASE WHEN i % 2 = 0 THEN 'human' ELSE 'gpt' END) AS n_bad
    FROM (SELECT conv_id, CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' ELSE role END AS who,
          row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM conversations) GROUP BY 1""",
)
def validate_turn_roles(spark, d):
    """Raw conversations: an opening system turn shifts every role."""
    who = F.when(F.col("role") == "user", "human").when(F.col("role") == "assistant", "gpt").otherwise(F.col("role"))
    rows = with_position(tables.table(spark, d, "conversations"), ["conv_id"], ["turn"], counter_block(F.col("turn"), 1024), "i")
    return rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"), F.count_if(~P.role_ok(who, F.col("i"))).alias("n_bad"))


@job(
    "potential_prompt",
    W.sql(
        "v_turns",
        "SELECT conv_id, "
        + ", ".join(strip_right_sql(f"string_agg({n}, '' ORDER BY turn_idx) || {sql_text(P.TEMPLATES[n].open)} || ' And now ' || CAST(conv_id AS VARCHAR) || '? ' || {sql_text(P.TEMPLATES[n].close)}") + f" AS {n}" for n in NAMES)
        + " FROM p GROUP BY conv_id",
        p=PIECES,
    ),
)
def potential_prompt(spark, d):
    """History plus one more human message, as it was typed."""
    turns = W.turns(spark, d).select("conv_id", "turn_idx", "text", F.lit(False).alias("verbatim"))
    asked = turns.groupBy("conv_id").agg((F.max("turn_idx") + 1).cast("int").alias("turn_idx")).select(
        "conv_id", "turn_idx", F.concat(F.lit(" And now "), F.col("conv_id").cast("string"), F.lit("? ")).alias("text"), F.lit(True).alias("verbatim")
    )
    return P.chat_prompts(turns.unionByName(asked), NAMES)


CHAT_LENGTH = 512
CHAT_TOKENS = {
    "p": PIECES,
    "tok": f"SELECT conv_id, image, turn_idx, CASE WHEN turn_idx = 0 THEN [1] ELSE CAST([] AS INT[]) END || {byte_sql(strip_right_sql('vicuna'))} AS ids FROM p",
    "lab": f"SELECT *, CASE WHEN turn_idx % 2 = 0 THEN {ignored('len(ids)')} ELSE ids END AS labels FROM tok",
    "ex": f"""SELECT conv_id, image, flatten(list(ids ORDER BY turn_idx))[1:{CHAT_LENGTH}] AS input_ids,
      CASE WHEN image IS NULL THEN flatten(list(labels ORDER BY turn_idx))[1:{CHAT_LENGTH}]
      ELSE [-100] || flatten(list(labels ORDER BY turn_idx))[2:{CHAT_LENGTH}] END AS labels FROM lab GROUP BY conv_id, image""",
}


@job("turn_tokens_with_labels", W.sql("v_turns", "SELECT conv_id, image, array_to_string(input_ids, ',') AS input_ids, array_to_string(labels, ',') AS labels FROM ex", **CHAT_TOKENS))
def turn_tokens_with_labels(spark, d):
    out = K.chat_examples(W.turns(spark, d), "vicuna", CHAT_LENGTH)
    return out.select("conv_id", "image", text_of(F.col("input_ids")).alias("input_ids"), text_of(F.col("labels")).alias("labels"))


PHI_TOKENS = {**CHAT_TOKENS, "tok": f"SELECT conv_id, image, turn_idx, {byte_sql(strip_right_sql('phi'))} AS ids FROM p"}


@job("turn_tokens_without_first", W.sql("v_turns", "SELECT conv_id, image, array_to_string(input_ids, ',') AS input_ids, array_to_string(labels, ',') AS labels FROM ex", **PHI_TOKENS))
def turn_tokens_without_first(spark, d):
    """A tokenizer that puts nothing in front of a text, called with many texts at once."""
    encode = K.encoder(batch=lambda texts: [[b + K.FIRST_BYTE for b in t.encode()] for t in texts])
    out = K.chat_examples(W.turns(spark, d), "phi", CHAT_LENGTH, encode=encode, bos=None)
    return out.select("conv_id", "image", text_of(F.col("input_ids")).alias("input_ids"), text_of(F.col("labels")).alias("labels"))


@job(
    "align_caption_labels",
    W.sql(
        "v_turns",
        f"""SELECT conv_id, problem, CASE WHEN problem IS NULL THEN array_to_string([1] || ids, ',') END AS input_ids,
          CASE WHEN problem IS NULL THEN array_to_string([-100] || ids, ',') END AS labels FROM
        (SELECT conv_id, problem, {byte_sql("reply || '</s>'")} AS ids FROM (SELECT conv_id, {strip_sql("max(text) FILTER (turn_idx = 1)")} AS reply,
           CASE WHEN max(image) IS NULL THEN 'no image' WHEN count(*) <> 2 THEN 'not two turns' WHEN contains(max(text) FILTER (turn_idx = 1), '<image>') THEN 'image tag in the reply' END AS problem
         FROM v_turns GROUP BY 1))""",
    ),
)
def align_caption_labels(spark, d):
    out = K.caption_examples(W.turns(spark, d))
    return out.select("conv_id", "problem", text_of(F.col("input_ids")).alias("input_ids"), text_of(F.col("labels")).alias("labels"))


def example_ctes(source: str, values: list[str]) -> dict[str, str]:
    tokens = ", ".join(f"32000 - {bin_sql(v)}" for v in values)
    return {
        "ids": f"SELECT *, [1] || {byte_sql(f"({PLAIN} || ' ')")} || [{tokens}] || [2] AS input_ids FROM {source}",
    }


def labels_sql(n: int, stop: bool) -> str:
    kept = f"input_ids[len(input_ids) - {n - 1}:{'len(input_ids)' if stop else 'len(input_ids) - 1'}]"
    return f"{ignored(f'len(input_ids) - {n}')} || {kept}" + ("" if stop else " || [-100]")


@job(
    "action_labels",
    W.sql(
        "v_steps",
        f"SELECT event_id, array_to_string({labels_sql(8, True)}, ',') AS labels, array_to_string({labels_sql(8, False)}, ',') AS labels_without_stop FROM ids",
        **example_ctes("v_steps", ACTIONS),
    ),
)
def action_labels(spark, d):
    frames = W.step_rows(spark, d).select(
        "event_id",
        "dataset_name",
        F.struct("language_instruction").alias("task"),
        F.array(F.struct("image_primary")).alias("observation"),
        F.array("action").alias("action"),
    )
    out = K.action_examples(frames, ["event_id"], 7)
    without = K.keep_last(F.col("input_ids"), 8, stop_token=False)
    return out.select("event_id", text_of(F.col("labels")).alias("labels"), text_of(without).alias("labels_without_stop"))


@job(
    "append_empty_token",
    W.sql("v_steps", f"SELECT event_id, array_to_string([1] || {byte_sql(PLAIN)} || [29871], ',') AS ids FROM v_steps"),
)
def append_empty_token(spark, d):
    """Prompts of even events end with the empty token already."""
    ids = F.concat(F.array(F.lit(K.BOS)), K.encoder()(P.action_prompt(F.col("language_instruction"))))
    some = F.when(F.col("event_id") % 2 == 0, F.array_append(ids, F.lit(A.EMPTY_TOKEN))).otherwise(ids)
    rows = W.step_rows(spark, d).select("event_id", some.alias("ids"))
    return rows.select("event_id", text_of(K.with_empty_token(F.col("ids"))).alias("ids"))


def token_frames(spark, d):
    """Normalized training frames of all supplied datasets, one step per frame."""
    steps = W.steps(spark, d)
    stats = pin_small(T.dataset_statistics(steps.withColumnRenamed("state", "proprio")))
    standard = T.normalize(steps, stats, "bounds_q99", 7, 0, GRIPPER_MASK).select(
        *KEYS, "event_id", F.struct("image_primary", "timestep").alias("observation"), F.struct("language_instruction").alias("task"), "action"
    )
    return J.transform(standard, J.TrajectoryOptions(skip_unlabeled=True))


NORMAL_FRAMES = {
    "st": WIDE_STATS,
    "f": f"""SELECT dataset_name, episode_id, timestep, event_id, language_instruction, image_primary, {', '.join(f"{normalized_sql(c, 'bounds_q99')} AS {c}" for c in ACTIONS)}
      FROM (SELECT *, bool_or(language_instruction <> '') OVER (PARTITION BY episode_id) AS keep FROM v_steps) JOIN st USING (dataset_name) WHERE keep""",
}


@job(
    "batch_transform",
    W.sql(
        "v_steps",
        f"SELECT event_id, dataset_name, image_primary AS image, array_to_string(input_ids, ',') AS input_ids, array_to_string({labels_sql(8, True)}, ',') AS labels FROM ids",
        **NORMAL_FRAMES,
        **example_ctes("f", ACTIONS),
    ),
)
def batch_transform(spark, d):
    out = K.action_examples(token_frames(spark, d), ["event_id"], 7)
    return out.select(
        "event_id", "dataset_name", "image", text_of(F.col("input_ids")).alias("input_ids"), text_of(F.col("labels")).alias("labels")
    )


@job(
    "choice_probabilities",
    "SELECT vec_id, " + sql_wide([f"exp(CAST(embedding[{i}] AS DOUBLE)) / (exp(CAST(embedding[4] AS DOUBLE)) + exp(CAST(embedding[18] AS DOUBLE)) + exp(CAST(embedding[43] AS DOUBLE)))" for i in (4, 18, 43)], "p") + " FROM embeddings",
)
def choice_probabilities(spark, d):
    scores = tables.table(spark, d, "embeddings").select("vec_id", V.doubles("embedding").alias("s"))
    return scores.select("vec_id", *wide(K.choice_probabilities(F.col("s"), [3, 17, 42]), "p", 3))


# Padded batches -------------------------------------------------------------------------------------------------------


def padded_sql(source: str, key: str, size: int, length: int) -> dict[str, str]:
    return {
        "placed": f"SELECT *, row_number() OVER (ORDER BY {key}) - 1 AS i FROM {source}",
        "sized": f"SELECT *, i // {size} AS batch_no, CAST(i % {size} AS INT) AS slot, max(len(input_ids)) OVER (PARTITION BY i // {size}) AS n FROM placed",
        "padded": f"""SELECT *, (input_ids || list_transform(range(0, n - len(input_ids)), lambda x: 0))[1:{length}] AS pids,
          (labels || list_transform(range(0, n - len(labels)), lambda x: -100))[1:{length}] AS plabels FROM sized""",
    }


PADDED = "array_to_string(pids, ',') AS input_ids, array_to_string(plabels, ',') AS labels, array_to_string(list_transform(pids, lambda x: CASE WHEN x <> 0 THEN 1 ELSE 0 END), ',') AS attention_mask"


def padded_text(df, *keys):
    return df.select(*keys, "batch_no", "slot", "has_image", *[text_of(F.col(c)).alias(c) for c in ("input_ids", "labels", "attention_mask")])


@job("pad_collate_lm", W.sql("v_turns", f"SELECT conv_id, batch_no, slot, image IS NOT NULL AS has_image, {PADDED} FROM padded", **CHAT_TOKENS, **padded_sql("ex", "conv_id", 8, 480)))
def pad_collate_lm(spark, d):
    examples = K.chat_examples(W.turns(spark, d), "vicuna", CHAT_LENGTH)
    return padded_text(K.pad_batches(B.in_batches(examples, "conv_id", 8), "batch_no", 480), "conv_id")


@job(
    "pad_collate_action",
    W.sql(
        "v_steps",
        f"SELECT event_id, dataset_name, batch_no, slot, TRUE AS has_image, {PADDED} FROM padded",
        **example_ctes("v_steps", ACTIONS),
        ex=f"SELECT *, {labels_sql(8, True)} AS labels FROM ids",
        **padded_sql("ex", "event_id", 32, 2048),
    ),
)
def pad_collate_action(spark, d):
    frames = W.step_rows(spark, d).select(
        "event_id",
        "dataset_name",
        F.struct("language_instruction").alias("task"),
        F.array(F.struct("image_primary")).alias("observation"),
        F.array("action").alias("action"),
    )
    # batches are cut on narrow rows; ids are made afterwards
    numbered = B.in_batches(frames, "event_id", 32)
    examples = K.action_examples(numbered, ["event_id", "batch_no", "slot"], 7)
    return padded_text(K.pad_batches(examples, "batch_no", 2048, image_required=True), "event_id", "dataset_name")
