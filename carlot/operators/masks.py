"""Detection masks: vehicle classes, main mask and union mask of each image."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from carlot.functions.arrays import array_sum
from carlot.schema import VEHICLE_CLASSES

_WORD = 32  # mask cells packed in one number


def vehicle_filter(detections: DataFrame) -> DataFrame:
    return detections.where(F.col("class_id").isin(VEHICLE_CLASSES))


def main_mask(detections: DataFrame) -> DataFrame:
    """The vehicle mask with the largest area of each image.

    The first mask wins a tie; an image whose masks are all empty has no row.
    """
    areas = vehicle_filter(detections).select(
        "image_id", "mask_id", array_sum(F.col("mask")).alias("area")
    )
    best = F.max(F.struct(F.col("area"), (-F.col("mask_id")).alias("rank"))).alias("best")
    return (
        areas.where("area > 0")
        .groupBy("image_id")
        .agg(best)
        .select(
            "image_id",
            (-F.col("best.rank")).alias("mask_id"),
            F.col("best.area").alias("area"),
        )
    )


def union_mask(detections: DataFrame) -> DataFrame:
    """Cell-wise OR of all vehicle masks of an image, as an array of 0 and 1.

    Masks are packed 32 cells to a number and combined with ``bit_or``, which
    works before the shuffle; only the packed words of one image meet at the end.
    """
    starts = F.sequence(F.lit(1), F.size("mask"), F.lit(_WORD))

    def pack(start):
        return F.aggregate(
            F.slice(F.col("mask"), start, F.lit(_WORD)),
            F.lit(0).cast("long"),
            lambda acc, x: acc * 2 + F.when(x != 0, F.lit(1)).otherwise(F.lit(0)),
        )

    words = (
        vehicle_filter(detections)
        .where(F.size("mask") > 0)
        .select("image_id", F.size("mask").alias("cells"), F.transform(starts, pack).alias("w"))
        .select("image_id", "cells", F.posexplode("w").alias("word", "bits"))
        .groupBy("image_id", "word")
        .agg(F.bit_or("bits").alias("bits"), F.max("cells").alias("cells"))
    )
    here = F.least(F.lit(_WORD), F.col("cells") - F.col("word") * _WORD)
    unpacked = F.transform(
        F.sequence(F.lit(0), here - 1),
        lambda i: F.expr("bits").bitwiseAND(
            F.call_function("shiftleft", F.lit(1).cast("long"), (here - 1 - i).cast("int"))
        )
        != 0,
    )
    return (
        words.select("image_id", "word", unpacked.alias("part"))
        .groupBy("image_id")
        .agg(F.array_sort(F.collect_list(F.struct("word", "part"))).alias("parts"))
        .select(
            "image_id",
            F.transform(
                F.flatten(F.transform("parts", lambda p: p["part"])), lambda b: b.cast("int")
            ).alias("mask"),
        )
    )
