"""Loose image files, decoded by Spark's own image source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """``shard, key, url, image``; files that cannot be decoded are dropped.

    The folder of a file stands for its shard, its base name for its key.
    """
    url = F.col("image.origin")
    name = F.substring_index(url, "/", -1)
    return spark.read.format("image").option("dropInvalid", True).load(path).select(
        F.element_at(F.split(url, "/"), -2).alias("shard"),
        F.regexp_replace(name, r"\.[^.]*$", "").alias("key"),
        url.alias("url"),
        "image",
    )
