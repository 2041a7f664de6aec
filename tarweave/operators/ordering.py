"""Row numbers, batches and previews over the order of a shard.

A shard may hold a third of all rows, so no window here spans a whole shard of
rows. Positions are cut into blocks of ``block`` consecutive values; a position
is unique in its shard, so a block holds at most ``block`` rows. Rows are
numbered inside their block, and one small row per block carries the count of
the blocks before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BLOCK = 1 << 16

# Up to this rank Spark prunes each map task to its own first rows per shard
# before the shuffle (spark.sql.optimizer.windowGroupLimitThreshold).
GROUP_LIMIT = 1000


def block_of(pos: Column, block: int = BLOCK) -> Column:
    return F.floor(pos / F.lit(block)) if block & (block - 1) else F.shiftright(pos, block.bit_length() - 1)


def number_rows(df: DataFrame, shard: str = "shard", pos: str = "pos", block: int = BLOCK) -> DataFrame:
    """Add ``row_num`` (from 0, per shard by position) and ``shard_rows``.

    ``df`` is read twice, the first time for shard and position only.
    """
    rows = df.withColumn("_block", block_of(F.col(pos), block))
    earlier = Window.partitionBy(shard).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(shard, "_block")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            shard,
            "_block",
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_n").over(Window.partitionBy(shard)).alias("shard_rows"),
        )
    )
    inside = Window.partitionBy(shard, "_block").orderBy(pos)
    return (
        rows.withColumn("_in_block", F.row_number().over(inside))
        .join(offsets, [shard, "_block"])
        .withColumn("row_num", F.col("_before") + F.col("_in_block") - 1)
        .drop("_block", "_before", "_in_block")
    )


def assign_batches(
    df: DataFrame,
    batch_size: int = 32,
    keep_partial: bool = True,
    shard: str = "shard",
    pos: str = "pos",
    block: int = BLOCK,
    before: DataFrame | None = None,
) -> DataFrame:
    """Add ``batch_id``: runs of ``batch_size`` rows of a shard, in order.

    Without ``keep_partial`` the rows of a last, smaller batch are dropped. With
    ``before`` (``shard, rows_out``) rows are numbered on after so many.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    numbered = number_rows(df, shard, pos, block)
    if before is not None:
        earlier = before.select(F.col("shard").alias(shard), F.col("rows_out").alias("_earlier"))
        later = F.coalesce("_earlier", F.lit(0))
        numbered = numbered.join(earlier, shard, "left").withColumns({c: F.col(c) + later for c in ("row_num", "shard_rows")}).drop("_earlier")
    batched = numbered.withColumn("batch_id", F.expr(f"row_num div {int(batch_size)}"))
    if not keep_partial:
        batched = batched.where((F.col("batch_id") + 1) * batch_size <= F.col("shard_rows"))
    return batched.drop("row_num", "shard_rows")


def first_rows(df: DataFrame, n: int = 32, shard: str = "shard", pos: str = "pos") -> DataFrame:
    """The first ``n`` rows of every shard with their ``row_num`` from 0.

    The position of each shard's last row to keep is found on the two order
    columns alone, so that the whole rows are neither sorted nor shuffled
    before they are down to the first ones. ``df`` is read twice.
    """
    if n < 1:
        return df.limit(0).withColumn("row_num", F.lit(0).cast("long"))
    if n > GROUP_LIMIT:
        return number_rows(df, shard, pos).where(F.col("row_num") < n).drop("shard_rows")
    rank = F.row_number().over(Window.partitionBy(shard).orderBy(pos))
    last = (
        df.select(shard, pos)
        .withColumn("_rn", rank)
        .where(F.col("_rn") <= n)
        .groupBy(shard)
        .agg(F.max(pos).alias("_last"))
    )
    return (
        df.join(last, shard)
        .where(F.col(pos) <= F.col("_last"))
        .withColumn("row_num", rank.cast("long") - 1)
        .drop("_last")
    )


def preview_grid(
    df: DataFrame,
    caption: str,
    batch_size: int = 32,
    columns: int = 4,
    original: str | None = None,
    score: str | None = None,
    shard: str = "shard",
    pos: str = "pos",
) -> DataFrame:
    """The first batch of every shard laid out on a grid, one row per cell."""
    keep = [shard, pos, F.col(caption).alias("caption")]
    if original:
        keep.append(F.col(original).alias("original_caption"))
    if score:
        keep.append(F.col(score).alias("score"))
    return (
        first_rows(df.select(*keep), batch_size, shard, pos)
        .withColumn("grid_row", F.expr(f"row_num div {int(columns)}").cast("int"))
        .withColumn("grid_col", (F.col("row_num") % columns).cast("int"))
        .drop("row_num")
    )
