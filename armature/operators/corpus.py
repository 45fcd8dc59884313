"""Instruction corpora: reformatting, reference checks, merging, shuffling, lengths, image format plans."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armature.functions import text
from armature.operators.ordering import with_random_position


def qa_to_chat(
    rows: DataFrame, image_id: Column, folder: str, named_files: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """question / answer rows -> id, image, conversations. Plain ids get `.jpg`; named files keep their name, and their
    stem is the id."""
    name = image_id.cast("string")
    turn = lambda who, value: F.struct(F.lit(who).alias("from"), value.alias("value"))
    human = F.concat(F.lit("<image>\n"), text.strip(F.col("question")))
    return rows.select(
        *keep,
        (text.file_stem(name) if named_files else name).alias("id"),
        F.concat(F.lit(folder + "/"), name if named_files else F.concat(name, F.lit(".jpg"))).alias("image"),
        F.array(turn("human", human), turn("gpt", text.strip(F.col("answer")))).alias("conversations"),
    )


def missing_images(references: DataFrame, key: str, files: DataFrame, file_key: str) -> DataFrame:
    """Referenced images that no file provides, with the number of references. References are counted before the join,
    so an image that everybody refers to is one row in it."""
    counted = references.groupBy(key).agg(F.count(F.lit(1)).alias("n_references"))
    present = files.select(F.col(file_key).alias(key)).distinct()
    return counted.join(present, key, "left_anti")


def merge_corpora(*corpora: DataFrame) -> DataFrame:
    """Concatenation: nothing is dropped, missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), corpora)


def shuffle_corpus(corpus: DataFrame, key: Sequence[str], seed: int, output: int) -> DataFrame:
    """Random order of one output file (several shuffles in a row are one)."""
    return with_random_position(corpus, [], list(key), seed, "position", [F.lit(output), *key])


def modality_lengths(turns: DataFrame, conversation: str, patches: int) -> DataFrame:
    """Per example: multimodal?, caption-stage length (no image tags, patches added), chat-stage length (as it is)."""
    said = F.col("text")
    per_turn = turns.select(
        conversation,
        F.col("image").isNotNull().alias("is_multimodal"),
        text.word_count(text.without_image_tag(said)).alias("__a"),
        text.word_count(said).alias("__f"),
    )
    return per_turn.groupBy(conversation, "is_multimodal").agg(F.sum("__a").alias("__a"), F.sum("__f").alias("finetune_length")).select(
        conversation,
        "is_multimodal",
        (F.col("__a") + F.when(F.col("is_multimodal"), patches).otherwise(0)).alias("align_length"),
        "finetune_length",
    )


def image_format_plan(files: DataFrame, name: str) -> DataFrame:
    """keep .jpg / .jpeg, skip what has a .jpg twin, convert gif and png, report the rest."""
    suffix = F.regexp_extract(name, r"(\.[^./]+)$", 1)
    split = files.select("*", suffix.alias("suffix"), text.file_stem(F.col(name)).alias("stem"))
    twins = split.filter(F.col("suffix") == ".jpg").select("stem").distinct().withColumn("__twin", F.lit(True))
    action = (
        F.when(F.col("suffix").isin(".jpg", ".jpeg"), "keep")
        .when(F.col("__twin"), "skip")
        .when(F.col("suffix") == ".gif", "convert first frame")
        .when(F.col("suffix") == ".png", "convert")
        .otherwise("error")
    )
    return split.join(twins, "stem", "left").withColumn("action", action).drop("__twin")
