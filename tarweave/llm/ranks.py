"""Places of rows in their groups without a window over a group, and checksums in SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarweave.llm.common import stage


def ranked(df: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Add ``i``, the place of a row in its ``group`` from 0, and ``n``, the rows of the group.

    Nulls come first, in the order as among the groups; a null group is a group.
    Rows equal in all of ``order`` take any places. Rows are dealt out by range,
    so a group of any size is spread, and written; a row's place is its line in
    the file and what earlier files hold of its group: one small row for each
    group in each file.
    """
    names = [group, *order]
    keys = [F.col(c).asc_nulls_first() for c in names]
    written = stage(df.repartitionByRange(*keys).sortWithinPartitions(*keys), "ranked")
    file = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("long")
    rows = written.select("*", file.alias("_file"), F.col("_metadata.row_index").alias("_row"))
    runs = rows.groupBy("_file", group).agg(F.min("_row").alias("_first"), F.count("*").alias("_size"))
    whole = Window.partitionBy(group)
    before = F.coalesce(F.sum("_size").over(whole.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(F.col("_file").alias("_f"), F.col(group).alias("_g"), (before - F.col("_first")).alias("_shift"), F.sum("_size").over(whole).alias("n"))
    same = (F.col("_file") == F.col("_f")) & F.col(group).eqNullSafe(F.col("_g"))
    return rows.join(runs, same).select(*df.columns, (F.col("_row") + F.col("_shift")).alias("i"), "n")


def crc32_sql(value: str) -> str:
    """DuckDB's expression for the unsigned CRC-32 of a number's decimal digits; null for null."""
    byte = "list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))"
    digits = f"list_transform(string_split(CAST({value} AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))"
    return f"CASE WHEN {value} IS NOT NULL THEN xor(list_reduce(list_prepend(4294967295, {digits}), lambda c, b: {byte}), 4294967295) END"
