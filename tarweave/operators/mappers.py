"""Mappers add a column to the samples, by name from a specification.

They see the slim sample rows (``shard, pos, key, url, parts`` as extents), so
their joins move no image bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarweave.operators.joins import last_per_key, lookup
from tarweave.sources.metadata import ORDER, SHARD, read_metadata


# Columns the samples already have and every later step relies on.
RESERVED = ("shard", "pos", "key", "url", "parts", "image", "json")


@dataclass
class AddFieldsConfig:
    type: str
    input_key: str
    output_key: str
    metadata_path: str
    data_path: str | None = None
    metadata_key: str = "key"


def add_fields(samples: DataFrame, metadata: DataFrame, config: AddFieldsConfig) -> DataFrame:
    """Copy ``input_key`` of the sample's row in its own shard's metadata.

    The last row of a key wins, samples without a row go, null values stay.
    ``metadata`` comes from ``read_metadata``, or has ``shard`` and ``pos``.
    """
    shard, order = (SHARD, ORDER) if SHARD in metadata.columns else ("shard", "pos")
    rows = metadata.select(
        F.col(shard).alias("shard"),
        F.col(config.metadata_key).alias("key"),
        F.col(config.input_key).alias("_value"),
        F.col(order).alias("_pos"),
    )
    right = last_per_key(rows, ["shard", "key"], ["_value"], "_pos")
    joined = lookup(samples, right, ["shard", "key"])
    return joined.withColumn(config.output_key, F.col("_value")).drop("_value")


def add_fields_from_files(samples: DataFrame, config: AddFieldsConfig, shards: Sequence[str] | None = None) -> DataFrame:
    """``add_fields`` from the files of ``shards``; one without a file is an error."""
    metadata = read_metadata(samples.sparkSession, config.metadata_path, shards)
    for name in (config.metadata_key, config.input_key):
        if name not in metadata.columns:
            raise ValueError(f"metadata in {config.metadata_path} has no column {name!r}")
    return add_fields(samples, metadata, config)


@dataclass
class MapperKind:
    """``build(samples, config)``, or with ``by_shard`` ``build(samples, config, names of the shards)``."""

    config: type
    build: Callable[..., DataFrame]
    by_shard: bool = False


MAPPERS: dict[str, MapperKind] = {"add_fields": MapperKind(AddFieldsConfig, add_fields_from_files, by_shard=True)}


def register_mapper(name: str, config: type, build: Callable[[DataFrame, object], DataFrame]) -> None:
    """Add a mapper: ``build(samples, config)`` adds column ``config.output_key``."""
    MAPPERS[name] = MapperKind(config, build)


def mapper_configs(specs: Sequence[dict] | None) -> list[tuple[MapperKind, object]]:
    found = []
    for spec in specs or ():
        if spec.get("type") not in MAPPERS:
            raise ValueError(f"unknown mapper {spec.get('type')!r}; known: {sorted(MAPPERS)}")
        kind = MAPPERS[spec["type"]]
        config = kind.config(**spec)
        if not getattr(config, "output_key", None):
            raise ValueError(f"mapper {spec['type']!r} must name an output_key")
        if config.output_key in RESERVED:
            raise ValueError(f"output_key {config.output_key!r} is a column of every sample")
        found.append((kind, config))
    return found


def apply_mappers(
    samples: DataFrame, specs: Sequence[dict] | None, shards: Sequence[str] | None = None
) -> tuple[DataFrame, list[str]]:
    """The mapped samples and the names of the added columns. ``shards`` are those the samples may be of."""
    outputs = []
    for kind, config in mapper_configs(specs):
        samples = samples.transform(kind.build, config, *([shards] if kind.by_shard else []))
        # The last mapper with an output_key wins.
        if config.output_key not in outputs:
            outputs.append(config.output_key)
    return samples, outputs
