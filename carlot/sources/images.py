"""Image folders as tables, and the table of finished images."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from carlot.functions.text import basename


def scan_images(spark: SparkSession, folder: str) -> DataFrame:
    """Decode every ``*.jpg`` below a folder.

    An unreadable file keeps its row with ``readable`` false.  ``pixels`` holds
    the channels interleaved in BGR order.
    """
    image = F.col("image")
    return (
        spark.read.format("image")
        .option("pathGlobFilter", "*.jpg")
        .load(folder)
        .select(
            image["origin"].alias("path"),
            basename(image["origin"]).alias("basename"),
            image["width"].alias("width"),
            image["height"].alias("height"),
            image["nChannels"].alias("channels"),
            image["data"].alias("pixels"),
            (image["height"] > 0).alias("readable"),
        )
    )


def list_images(spark: SparkSession, folder: str) -> DataFrame:
    """Names and sizes of ``*.jpg`` files; the content is never read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.jpg")
        .load(folder)
        .select("path", basename(F.col("path")).alias("basename"), "length")
    )


def without_names(df: DataFrame, names: DataFrame) -> DataFrame:
    """Rows whose ``basename`` is not among some names.

    Joined by hash and name: names begin alike, and numbers sort faster.
    """
    left, right = df.alias("l"), names.select(F.col("basename").alias("_named")).alias("r")
    same = (F.xxhash64("l.basename") == F.xxhash64("r._named")) & (F.col("l.basename") == F.col("r._named"))
    return left.join(right, same, "left_anti")


def drop_stale_outputs(outputs: DataFrame, failed: DataFrame) -> DataFrame:
    """Finished images without those that failed in the latest run."""
    return without_names(outputs, failed)
