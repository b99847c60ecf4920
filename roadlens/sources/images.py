"""Image files: listing, bytes, decoded pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.functions.text import extension, file_name, is_image, stem


def _named(df: DataFrame) -> DataFrame:
    name = file_name(F.col("path"))
    return df.select("*", name.alias("file_name"), stem(name).alias("stem"), extension(name).alias("ext"), F.regexp_extract("path", r"/images/([^/]+)/", 1).alias("split"))


def list_images(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, file_name, stem, ext, split) of image files below a folder, or of one file.

    Suffixes count in any case. Contents aren't read: the column is pruned. Rows have no
    order; ``in_name_order`` gives them one where it is wanted.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    return _named(files).where(is_image(F.col("file_name")))


def hash_images(spark: SparkSession, path: str) -> DataFrame:
    """As ``list_images``, with the md5 of the contents."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.md5("content").alias("md5"))
    return _named(files).where(is_image(F.col("file_name")))


def decode_images(spark: SparkSession, path: str) -> DataFrame:
    """(path, height, width, nChannels, data, readable, ...): pixels in BGR order; unreadable files have readable false."""
    raw = spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", True).load(path)
    flat = raw.select(F.col("image.origin").alias("path"), "image.height", "image.width", "image.nChannels", "image.data", (F.col("image.height") > 0).alias("readable"))
    return _named(flat)


def in_name_order(images: DataFrame) -> DataFrame:
    """By split, then file name, then path."""
    return images.orderBy("split", "file_name", "path")
