"""New shards of a folder, each exactly once, as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tarweave.session import ship_package
from tarweave.sources.tar import shard_of

BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def new_shards(spark: SparkSession, data_path: str, max_files: int | None = None) -> DataFrame:
    """Stream of ``shard, path, bytes``; the contents are not read."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE).option("pathGlobFilter", "*.tar")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(data_path).select(
        shard_of(F.col("path")).alias("shard"),
        "path",
        F.col("length").alias("bytes"),
    )


def process_new_shards(
    spark: SparkSession,
    data_path: str,
    checkpoint: str,
    process: Callable[[DataFrame], None],
    max_files: int | None = None,
) -> StreamingQuery:
    """Run ``process(shards)`` on everything that arrived since the last call.

    The stream's checkpoint remembers the files taken. A batch that fails is
    offered again, and a shard whose files arrive in several batches comes in
    each of them, so ``process`` should replace its outputs by those of the whole
    shard. The jobs do that when they are given ``shards``.
    """
    ship_package(spark)

    def run(shards: DataFrame, _batch: int) -> None:
        process(shards)

    return (
        new_shards(spark, data_path, max_files)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(run)
        .start()
    )
