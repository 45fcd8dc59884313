"""Image-frame jobs: what to do with each frame, and linear pixel work on raw uint8 images.

Decoding and resampling are left to Spark's image source and to whoever reads the plan.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armature.functions.chance import uniform

# Fixed values of the training augmentation and of the image normalization.
CROP_AREA = 0.9
BRIGHTNESS, HUE = 0.2, 0.05
CONTRAST = SATURATION = (0.8, 1.2)
MEAN = (0.485, 0.456, 0.406)
STD = (0.229, 0.224, 0.225)


def per_camera(frames: DataFrame, cameras: Mapping[str, str], key: Sequence[str]) -> DataFrame:
    """(key, camera, image): cameras in name order."""
    cells = [F.struct(F.lit(n).alias("camera"), F.col(cameras[n]).alias("image")) for n in sorted(cameras)]
    return frames.select(*key, F.explode(F.array(*cells)).alias("c")).select(*key, "c.camera", "c.image")


def padding_plan(images: DataFrame, sizes: Mapping[str, tuple[int, int]]) -> DataFrame:
    """Per image: is it padding, and its output size; a camera without size gives 1x1 padding and keeps its own size."""
    known = F.lit(None).cast("struct<h:int,w:int>")
    for name, (h, w) in sizes.items():
        known = F.when(F.col("camera") == name, F.struct(F.lit(h).alias("h"), F.lit(w).alias("w"))).otherwise(known)
    padding = F.length("image") == 0
    side = lambda s: F.coalesce(known[s], F.when(padding, 1))
    return images.select("*", padding.alias("is_padding"), side("h").alias("out_h"), side("w").alias("out_w"))


def augment_plan(images: DataFrame, key: str, seed: int) -> DataFrame:
    """Replayable parameters of the random crop and colour changes of every real image."""
    draw = lambda op: uniform(seed, key, "camera", F.lit(op))
    between = lambda op, low, high: F.lit(low) + draw(op) * (high - low)
    side = CROP_AREA**0.5
    return images.filter(F.length("image") > 0).select(
        key,
        "camera",
        (draw("top") * (1 - side)).alias("crop_top"),
        (draw("left") * (1 - side)).alias("crop_left"),
        F.lit(side).alias("crop_side"),
        between("brightness", -BRIGHTNESS, BRIGHTNESS).alias("brightness"),
        between("contrast", *CONTRAST).alias("contrast"),
        between("saturation", *SATURATION).alias("saturation"),
        between("hue", -HUE, HUE).alias("hue"),
    )


def center_crop_box(area: Column) -> list[Column]:
    """top, left, bottom, right in relative coordinates of a centred square of the given area share."""
    side = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.sqrt(area)))
    offset = (1 - side) / 2
    return [offset, offset, offset + side, offset + side]


def letterbox(width: Column, height: Column) -> dict[str, Column]:
    """Padding on each side to make a square (an odd difference stays one pixel short) and the padded size."""
    longest = F.greatest(width, height)
    across = F.floor((longest - width) / 2).cast("long")
    down = F.floor((longest - height) / 2).cast("long")
    return {"pad_x": across, "pad_y": down, "padded_w": width + 2 * across, "padded_h": height + 2 * down}


def letterbox_fill(mean: Sequence[float] = MEAN) -> tuple[int, ...]:
    return tuple(int(m * 255) for m in mean)


def target_size(strategy: Column, width: Column, height: Column, size: int) -> tuple[Column, Column]:
    """Size after the resize step. "resize-crop" scales the shorter side and is cropped afterwards."""
    shorter = F.least(width, height)
    scaled = lambda side: F.floor(F.lit(size) * side / shorter).cast("long")
    fixed = F.lit(size).cast("long")
    crop = strategy == "resize-crop"
    return F.when(crop, scaled(width)).otherwise(fixed), F.when(crop, scaled(height)).otherwise(fixed)


def pixel_job(
    images: DataFrame,
    key: str,
    crop: tuple[int, int, int, int] | None = None,
    pad: int = 0,
    fill: int = 0,
    rotate: bool = False,
    brightness: float = 0.0,
    contrast: float = 1.0,
    normalize: bool = True,
    precision: str = "float32",
) -> DataFrame:
    """Crop (top, left, height, width), pad, rotate by 180 degrees, change brightness and contrast, normalize channels.

    Input columns: key, height, width, data (height * width * 3 bytes). One streaming pass, Arrow batch by Arrow batch;
    images of equal shape in a batch are handled as one array. Output: key, height, width, pixels, in `precision` ("float32" or
    "float64").
    """
    real = {"float32": np.float32, "float64": np.float64}[precision]
    kind = {"float32": "float", "float64": "double"}[precision]
    mean, std = np.array(MEAN, precision), np.array(STD, precision)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (h, w), part in batch.groupby(["height", "width"], sort=False):
                x = np.frombuffer(b"".join(part["data"]), "uint8").reshape(len(part), h, w, 3)
                if crop is not None:
                    top, left, ch, cw = crop
                    x = x[:, top : top + ch, left : left + cw]
                if pad:
                    x = np.pad(x, ((0, 0), (pad, pad), (pad, pad), (0, 0)), constant_values=fill)
                if rotate:
                    x = x[:, ::-1, ::-1]
                y = x.astype(precision) / real(255)
                if brightness:
                    y = np.clip(y + real(brightness), 0, 1)
                if contrast != 1.0:
                    middle = y.mean(axis=(1, 2), keepdims=True)
                    y = np.clip((y - middle) * real(contrast) + middle, 0, 1)
                if normalize:
                    y = (y - mean) / std
                yield pd.DataFrame(
                    {key: part[key].to_numpy(), "height": y.shape[1], "width": y.shape[2], "pixels": list(y.reshape(len(part), -1))}
                )

    schema = f"{key} {images.schema[key].dataType.simpleString()}, height int, width int, pixels array<{kind}>"
    return images.select(key, "height", "width", "data").mapInPandas(run, schema)
