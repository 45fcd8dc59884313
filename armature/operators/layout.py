"""Fixed step layout: image / depth / proprio key maps, language, masks, and schema-driven struct rewriting."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from armature.functions import vectors as V
from armature.operators.smallside import pin_small
from armature.sources import catalog


def quoted(path: str) -> Column:
    """Column of a dotted path whose parts may hold slashes."""
    return F.col(".".join(f"`{p}`" for p in path.split(".")))


def mapped_keys(prefix: str, keys: Mapping[str, str | None], source: str = "") -> list[Column]:
    """`{new: old}` -> columns prefix_new; a view without source is an empty string (padding)."""
    at = f"{source}." if source else ""
    return [(F.lit("") if old is None else quoted(at + old)).alias(f"{prefix}_{new}") for new, old in keys.items()]


def proprio(keys: Sequence[str | None | Column], source: str = "") -> Column:
    """Concatenate state vectors; None stands for one zero."""
    at = f"{source}." if source else ""
    parts = [V.zeros(1) if k is None else V.doubles(quoted(at + k) if isinstance(k, str) else k) for k in keys]
    return F.concat(*parts)


def restructure(
    df: DataFrame,
    images: Mapping[str, str | None],
    depths: Mapping[str, str | None] | None = None,
    state_keys: Sequence[str | None] = (),
    language: str | None = "language_instruction",
    absolute_mask: Sequence[bool] | None = None,
) -> DataFrame:
    """Standardized rows -> observation, task, action, dataset_name (+ keys). Fails at plan time on missing fields."""
    missing = {"observation", "action", *([language] if language else [])} - set(df.columns)
    if missing:
        raise ValueError(f"steps lack {sorted(missing)}; standardize them first")
    if language and df.schema[language].dataType != T.StringType():
        raise ValueError(f"{language} must be a string column")
    fields = mapped_keys("image", images, "observation") + mapped_keys("depth", depths or {}, "observation")
    if state_keys:
        fields.append(proprio(state_keys, "observation").cast("array<float>").alias("proprio"))
    fields.append(F.col("timestep").cast("int").alias("timestep"))
    columns = [
        "dataset_name", "episode_id", "timestep",
        F.struct(*fields).alias("observation"),
        (F.struct(F.col(language).alias("language_instruction")) if language else F.struct()).alias("task"),
        F.col("action").cast("array<float>").alias("action"),
    ]
    out = df.select(*columns)
    return out if absolute_mask is None else with_absolute_mask(out, absolute_mask)


def with_absolute_mask(df: DataFrame, mask: Sequence[bool]) -> DataFrame:
    """Attach the per-dimension mask; a row whose action has another length fails the job."""
    literal = F.array(*[F.lit(bool(b)) for b in mask])
    fits = F.size("action") == len(mask)
    return df.withColumn(
        "absolute_action_mask", F.when(fits, literal).otherwise(F.raise_error(F.lit("absolute_action_mask: wrong length")))
    )


def required_fields_report(df: DataFrame, action_dim: int, language: str, image: str) -> DataFrame:
    """One pass, one row per dataset: what is missing, of the wrong length, or not a number."""
    count = lambda cond: F.count_if(F.coalesce(cond, F.lit(True))).cast("long")
    bad_number = F.exists("action", lambda x: F.isnan(x) | x.isNull())
    return df.groupBy("dataset_name").agg(
        F.count(F.lit(1)).alias("n_rows"),
        count(F.col(language) == "").alias("n_no_language"),
        count(F.col(image) == "").alias("n_no_image"),
        count(F.size("action") != action_dim).alias("n_wrong_length"),
        count(bad_number).alias("n_not_a_number"),
    )


def select_cameras(config: catalog.DatasetConfig, views: Sequence[str], depth: bool = False):
    """Image and depth key maps restricted to the wanted views."""
    unknown = set(views) - set(config.images)
    if unknown:
        raise ValueError(f"{config.name} has no views {sorted(unknown)}")
    keep = lambda keys: {v: k for v, k in keys.items() if v in views}
    return keep(config.images), keep(config.depths) if depth else {}


def encoding_gate(steps: DataFrame, configs: DataFrame) -> DataFrame:
    """Keep datasets whose action layout can be loaded and attach both masks. `configs` is the catalog table."""
    gated = steps.join(pin_small(configs.filter("loadable").select("dataset_name", "action_encoding")), "dataset_name")

    def mask(last: bool) -> Column:
        chosen = F.lit(None).cast("array<boolean>")
        for encoding, dims in catalog.LOADABLE_ACTION_DIMS.items():
            values = [not last] * (dims - 1) + [last]
            chosen = F.when(F.col("action_encoding") == encoding, F.array(*map(F.lit, values))).otherwise(chosen)
        return chosen

    return gated.withColumn("absolute_action_mask", mask(True)).withColumn("action_normalization_mask", mask(False))


# Struct trees -------------------------------------------------------------------------------------------------------


def map_tree(struct: Column, schema: T.StructType, fn: Callable[[tuple[str, ...], Column, T.DataType], Column], path=()) -> Column:
    """Rewrite every leaf of a struct; `fn` sees the key path, the column and its type."""
    out = []
    for f in schema.fields:
        child, at = struct[f.name], (*path, f.name)
        nested = isinstance(f.dataType, T.StructType)
        out.append((map_tree(child, f.dataType, fn, at) if nested else fn(at, child, f.dataType)).alias(f.name))
    return F.struct(*out)


def merge_trees(left: Column, left_schema: T.StructType, right: Column, right_schema: T.StructType) -> Column:
    """Right wins; structs on both sides are merged."""
    theirs = {f.name: f.dataType for f in right_schema.fields}
    ours = {f.name: f.dataType for f in left_schema.fields}
    out = []
    for name, kind in ours.items():
        if name not in theirs:
            out.append(left[name].alias(name))
        elif isinstance(kind, T.StructType) and isinstance(theirs[name], T.StructType):
            out.append(merge_trees(left[name], kind, right[name], theirs[name]).alias(name))
        else:
            out.append(right[name].alias(name))
    return F.struct(*out, *[right[n].alias(n) for n in theirs if n not in ours])


def padding_of(value: Column, kind: T.DataType) -> Column:
    """Zero for numbers, "" for strings, element-wise for arrays; anything else has no padding."""
    if isinstance(kind, T.NumericType):
        return F.lit(0).cast(kind)
    if isinstance(kind, T.StringType):
        return F.lit("")
    if isinstance(kind, T.BinaryType):
        return F.lit(b"")
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.NumericType, T.StringType)):
        return F.array_repeat(padding_of(value, kind.elementType), F.size(value))
    raise ValueError(f"no padding for {kind.simpleString()}")


def pad_mask(struct: Column, schema: T.StructType) -> Column:
    """Struct of booleans: false where a string or binary field is empty, true for everything else."""
    marks = []
    for f in schema.fields:
        if f.name == "pad_mask_dict":
            continue
        textual = isinstance(f.dataType, (T.StringType, T.BinaryType))
        marks.append((F.length(struct[f.name]) != 0 if textual else F.lit(True)).alias(f.name))
    return F.struct(*marks)
