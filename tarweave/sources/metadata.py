"""Extra fields of the samples, stored in Parquet per shard."""

from __future__ import annotations

from collections.abc import Iterable
from urllib.parse import unquote

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarweave.session import split_uri


#: Columns that ``read_metadata`` adds, kept apart from the data's own.
SHARD, ORDER = "_meta_shard", "_meta_order"


def read_metadata(spark: SparkSession, path: str, shards: Iterable[str] | None = None) -> DataFrame:
    """All columns of the data plus the shard (text) as SHARD and the order of the rows as ORDER.

    Takes one file per shard (``<shard>.parquet``) or the folders this package's
    own sinks write (``shard=<shard>/``). Only files of ``shards`` are read, and a
    shard among them without any is an error. Rows of a file are in its order;
    rows of folders by the ``pos`` the sinks write, or without one by file and row.
    """
    fs, inner = split_uri(path)
    if fs.get_file_info(inner).type != pafs.FileType.Directory:
        raise FileNotFoundError(f"no metadata folder: {path}")
    base, files, folders = path.rstrip("/"), {}, {}
    for f in fs.get_file_info(pafs.FileSelector(inner)):
        if f.type == pafs.FileType.Directory and f.base_name.startswith("shard="):
            folders[unquote(f.base_name[len("shard="):])] = f"{base}/{f.base_name}"
        elif f.type == pafs.FileType.File and f.base_name.endswith(".parquet"):
            files[f.base_name.removesuffix(".parquet")] = f"{base}/{f.base_name}"
    found = folders or files
    if shards is not None:
        shards = set(shards)
        if missing := sorted(shards - found.keys()):
            raise FileNotFoundError(f"no metadata in {path} for {len(missing)} shards, first {missing[:5]}")
        # Without shards to look up, one file still tells the columns.
        found = {name: at for name, at in found.items() if name in shards} or dict(sorted(found.items())[:1])
    if not found:
        raise FileNotFoundError(f"no metadata in {path}")
    rows = spark.read.parquet(*sorted(found.values()))
    place = F.col("_metadata.row_index")
    if not folders:
        return rows.withColumn(SHARD, F.regexp_replace(F.col("_metadata.file_name"), r"\.parquet$", "")).withColumn(ORDER, F.struct(F.lit("").alias("file"), place.alias("row")))
    # The folder's name, as Spark writes it; inferred partition values would turn shard 00000 into 0.
    name = F.url_decode(F.replace(F.regexp_extract(F.col("_metadata.file_path"), r"/shard(?:=|%3D)([^/]*)/[^/]*$", 1), F.lit("+"), F.lit("%2B")))
    order = F.struct(F.lit("").alias("file"), F.col("pos").cast("long").alias("row")) if "pos" in rows.columns else F.struct(F.col("_metadata.file_name").alias("file"), place.alias("row"))
    return rows.withColumn(SHARD, name).withColumn(ORDER, order)
