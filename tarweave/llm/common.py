"""What the operators of this package share: staged tables, checked broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarweave.session import stage

__all__ = ["free_names", "lower_ascii", "pair_texts", "small_or_shuffled", "stage", "texts_of", "that_stay"]

#: Rows up to which keys are broadcast (24 bytes each); beyond, joins shuffle.
BROADCAST_ROWS = 200_000
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

def lower_ascii(column: Column) -> Column:
    """``column`` with A-Z in lower case and nothing else changed; null is empty."""
    return F.translate(F.coalesce(column, F.lit("")), _UPPER, _UPPER.lower())


def small_or_shuffled(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows; else a shuffle join is left to Spark.

    The count reads one row more than the bound, so ``df`` should be staged or cheap.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of ``df`` has, made of ``names``."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name in taken:
            name += "_"
        taken.add(name)
        found.append(name)
    return found


def that_stay(df: DataFrame, id_col: str, mark: Column, keys: DataFrame, broadcast_rows: int) -> DataFrame:
    """The rows of ``df``, whatever columns it has, that ``keys`` (``id, mark, stays, n``) lets stay.

    ``mark`` is the column that with the id tells a row's text. Rows of a key that
    doesn't stay go; of ``n`` rows repeated with a key that stays, one does. Rows
    without a key stay.
    """
    marked, id_, mark_ = free_names(df, "mark", "key_id", "key_mark")
    rows = df.withColumn(marked, mark)
    given = keys.withColumnsRenamed({"id": id_, "mark": mark_})
    same = rows[id_col].eqNullSafe(F.col(id_)) & (F.col(marked) == F.col(mark_))
    out = rows.join(small_or_shuffled(given.where("not stays").select(id_, mark_), broadcast_rows), same, "left_anti")
    repeats = stage(given.where("stays and n > 1").select(id_, mark_), "repeats")
    if not repeats.isEmpty():
        same = out[id_col].eqNullSafe(F.col(id_)) & (F.col(marked) == F.col(mark_))
        once = out.join(repeats, same, "left_semi").dropDuplicates([id_col, marked])
        out = out.join(repeats, same, "left_anti").unionByName(once)
    return out.drop(marked)


def texts_of(wanted: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, text`` of the nodes ``wanted``; ``nodes`` are ``node, text``, a node perhaps repeatedly.

    Up to BROADCAST_ROWS keys go to where the texts lie, so that only the texts wanted are shuffled.
    """
    wanted = small_or_shuffled(stage(wanted.select("node").distinct(), "wanted"), BROADCAST_ROWS)
    return nodes.join(wanted, "node", "left_semi").dropDuplicates(["node"])


def pair_texts(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``a, b, text_a, text_b`` of pairs of nodes; ``nodes`` are ``node, text``, a node perhaps repeatedly."""
    pairs = stage(pairs.select("a", "b"), "pairs")
    texts = stage(texts_of(pairs.select(F.col("a").alias("node")).union(pairs.select("b")), nodes), "texts")
    return (
        pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b")
    )
