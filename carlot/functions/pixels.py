"""Geometry, compositing and normalisation of images held as arrays."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from carlot.functions.arrays import let
from carlot.schema import CHANNEL_MEAN, CHANNEL_STD, IMAGE_BOX


def fit_box(width: Column, height: Column, box: tuple[int, int] = IMAGE_BOX) -> Column:
    """Struct of the size that fits the box with the aspect kept, cut to whole pixels."""
    box_w, box_h = box
    aspect = width / height
    wide = aspect > F.lit(box_w / box_h)
    return F.struct(
        F.when(wide, F.lit(box_w)).otherwise((F.lit(box_h) * aspect).cast("int")).alias("new_w"),
        F.when(wide, (F.lit(box_w) / aspect).cast("int")).otherwise(F.lit(box_h)).alias("new_h"),
    )


def white_composite(pixels: Column, mask: Column, channels: int = 3) -> Column:
    """Lay interleaved pixels over white by a mask of one weight per pixel."""

    def blend(x: Column, m: Column) -> Column:
        return F.floor(x * m + F.lit(255.0) * (F.lit(1.0) - m)).cast("int")

    def weight(m: Column, i: Column) -> Column:
        return F.get(m, F.floor(i / channels).cast("int"))

    return let(mask, lambda m: F.transform(pixels, lambda x, i: blend(x, weight(m, i))))


def normalize_pixels(pixels: Column, order: str = "rgb") -> Column:
    """Scale interleaved bytes to 0..1, then centre and scale every channel.

    ``order`` is the channel order of the input; image rows read by Spark are
    ``bgr``.
    """
    mean, std = list(CHANNEL_MEAN), list(CHANNEL_STD)
    if order == "bgr":
        mean, std = mean[::-1], std[::-1]
    means = F.array(*[F.lit(m) for m in mean])
    stds = F.array(*[F.lit(s) for s in std])

    def scale(x: Column, i: Column) -> Column:
        ch = (i % 3).cast("int")
        return (x / F.lit(255.0) - F.get(means, ch)) / F.get(stds, ch)

    return F.transform(pixels, scale)
