"""Sample filters by name, and what happens to samples that fail."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarweave.functions.images import dominance
from tarweave.session import work_dir

#: Names the side of a split in its folders.
VERDICT = "_good"


@dataclass
class MonoConfig:
    """Keeps monochrome images unless ``is_monochromatic`` is false."""

    type: str
    threshold: float = 0.8
    is_monochromatic: bool = True


def mono(config: MonoConfig) -> Column:
    return keep_monochrome(F.col("dominance"), config.threshold, config.is_monochromatic)


def keep_monochrome(share: Column, threshold: float = 0.8, flag: bool = True) -> Column:
    """Strictly above the threshold equals ``flag``; null (no statistics) is null."""
    return (share > F.lit(threshold)) == F.lit(flag)


@dataclass
class FilterKind:
    """``build(config)`` is a condition on ``dominance`` and, with ``pixels``, on ``image``.

    Jobs measure ``dominance`` where they decode. Without ``pixels`` they do
    not have to pass the decoded images on.
    """

    config: type
    build: Callable[[object], Column]
    pixels: bool = True


FILTERS: dict[str, FilterKind] = {"mono": FilterKind(MonoConfig, mono, pixels=False)}


def register_filter(name: str, config: type, build: Callable[[object], Column], pixels: bool = True) -> None:
    """Add a filter: ``build(config)`` gives a boolean column over the sample."""
    FILTERS[name] = FilterKind(config, build, pixels)


def need_pixels(specs: Sequence[dict] | None) -> bool:
    return any(FILTERS[spec["type"]].pixels for spec in specs or ())


def build_filters(specs: Sequence[dict] | None) -> list[Column]:
    conditions = []
    for spec in specs or ():
        if spec.get("type") not in FILTERS:
            raise ValueError(f"unknown filter {spec.get('type')!r}; known: {sorted(FILTERS)}")
        kind = FILTERS[spec["type"]]
        conditions.append(kind.build(kind.config(**spec)))
    return conditions


def apply_filters(samples: DataFrame, specs: Sequence[dict] | None) -> DataFrame:
    """Keep the samples that pass every filter; a null verdict drops too."""
    conditions = build_filters(specs)
    if not conditions:
        return samples
    measured = samples
    if "dominance" not in samples.columns:
        measured = samples.withColumn("dominance", dominance(F.col("image")))
    return measured.where(reduce(lambda a, b: a & b, conditions)).select(*samples.columns)


def holds_bytes(kind: T.DataType) -> bool:
    """Whether values of a type hold binary data, such as pixels."""
    match kind:
        case T.BinaryType():
            return True
        case T.StructType():
            return any(holds_bytes(f.dataType) for f in kind.fields)
        case T.ArrayType():
            return holds_bytes(kind.elementType)
        case T.MapType():
            return holds_bytes(kind.keyType) or holds_bytes(kind.valueType)
    return False


def split_rejects(samples: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """Good samples (without the error column) and the failed ones, written by one job.

    What made the samples (a codec, a model) runs once; each side then reads its own
    files. Columns that hold bytes are left out, as pixels are many times the images
    they come from: what is to be known of them is a column to compute before, and
    bytes are read again by position (``fetch``) for the good samples alone.
    """
    slim = samples.select([f.name for f in samples.schema.fields if not holds_bytes(f.dataType)])
    path = work_dir(samples.sparkSession, "split")
    slim.withColumn(VERDICT, F.col(error).isNull()).write.mode("overwrite").partitionBy(VERDICT).parquet(path)
    split = samples.sparkSession.read.schema(T.StructType([*slim.schema.fields, T.StructField(VERDICT, T.BooleanType())])).parquet(path)
    return split.where(VERDICT).drop(error, VERDICT), split.where(f"NOT {VERDICT}").drop(VERDICT)
