"""The processing job: a specification in, key lists and tars out."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import yaml
from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarweave.functions.text import caption_from_meta
from tarweave.operators.filters import build_filters, need_pixels
from tarweave.operators.mappers import apply_mappers, mapper_configs
from tarweave.operators.ordering import assign_batches, preview_grid
from tarweave.operators.samples import RENAME_ORDER
from tarweave.plans.reading import HEADERS_DIR, found_samples, manifest_counts, shards_to_do, usable_samples, whole_shards, with_contents
from tarweave.plans.resume import add_before, all_of, record_files, to_do, write_found
from tarweave.schemas import REJECT
from tarweave.session import keep, scratch, split_uri, stage
from tarweave.sources.captions import REJECTS_DIR, add_manifest, adopt, read_manifest, read_rows, withdraw
from tarweave.sources.tar import fetch_parts, fetch_tasks, lay_out, parts_of, write_laid_out

KEY_ROW = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("txt", T.StringType()),
    T.StructField("pos", T.LongType()),
    T.StructField("batch_id", T.LongType()),
])


# Keeps mapper outputs apart from the job's own columns.
MAPPED = "mapped_"


@dataclass
class Spec:
    """The keys of a specification file; an unknown key is an error."""

    data_path: str
    batch_size: int
    num_workers: int  # accepted; Spark decides
    meta_key: str
    img_key: str
    filter_functions: list[dict] | None = None
    mapper_functions: list[dict] | None = None
    output_dir: str = "output"
    save_tar: bool = False
    txt_key: str | None = None
    make_visualization: bool = False
    convert_to_tuples: bool = True  # accepted; tars always hold every sample

    def __post_init__(self):
        build_filters(self.filter_functions)
        mapper_configs(self.mapper_functions)


def load_spec(source: str | dict) -> Spec:
    if isinstance(source, dict):
        return Spec(**source)
    fs, inner = split_uri(source)
    with fs.open_input_stream(inner) as handle:
        return Spec(**yaml.safe_load(handle.read()))


@dataclass
class Outcome:
    rows: DataFrame
    rejects: DataFrame
    counts: DataFrame
    preview: DataFrame | None
    seen: dict


def judge(read: DataFrame, spec: Spec) -> DataFrame:
    """Add ``passes``: no error and every filter agrees. Drops the pixels."""
    verdicts = [F.col("error").isNull(), *build_filters(spec.filter_functions)]
    agreed = F.coalesce(reduce(lambda a, b: a & b, verdicts), F.lit(False))
    return read.withColumn("passes", agreed).drop("image", "dominance")


def tar_rows(kept: DataFrame, spec: Spec, extra: list[str], tasks: int, cuts: str, after: DataFrame | None = None) -> DataFrame:
    """Rows for the tar sink, laid out by output file before any byte is read.

    Image and metadata come back under their configured names, mapper outputs
    become entries of their own, other parts stay.
    """
    fields = {name: F.col(f"`{MAPPED}{name}`") for name in extra}
    slim = kept.select("shard", "pos", "key", "url", *fields.values(), F.col("extents").alias("parts"))
    read = fetch_parts(lay_out(slim, tasks, after=after), strict=True, cuts=cuts)
    part = F.col("parts")
    image = F.coalesce(*[F.try_element_at("parts", F.lit(s)) for s in RENAME_ORDER])
    named = {spec.img_key: image, spec.meta_key: F.try_element_at("parts", F.lit(spec.meta_key))}
    named |= {name: field.cast("string").cast("binary") for name, field in fields.items()}
    replaced = F.array(*[F.lit(s) for s in {*RENAME_ORDER, *named}])
    others = F.map_filter(part, lambda name, _: ~F.array_contains(replaced, name))
    added = F.create_map(*[x for name, value in named.items() for x in (F.lit(name), value)])
    return read.withColumn("parts", F.map_concat(others, added))


def _recorded(spark: SparkSession, spec: Spec, seen: dict, preview: DataFrame | None = None) -> Outcome:
    base = spec.output_dir.rstrip("/")
    rows, rejects = read_rows(spark, f"{base}/rows", KEY_ROW), read_rows(spark, f"{base}/{REJECTS_DIR}", REJECT)
    return Outcome(rows=rows, rejects=rejects, counts=read_manifest(spark, base), preview=preview, seen=seen)


def run_spec(
    spark: SparkSession,
    source: str | dict | Spec,
    decode: Callable | None = None,
    debug: bool = False,
    limit: int | None = None,
    keep_partial: bool = True,
    shards: DataFrame | None = None,
    retry_rejected: bool = False,
    profile: ResourceProfile | None = None,
    resume: bool = False,
) -> Outcome:
    """Run one specification over the shards not yet done.

    ``decode`` is the image codec plug-in; filters that look at pixels need it.
    Pass ``shards`` (with a column ``shard``) to process just these, whole,
    whether done before or not. Their outputs are replaced, and the manifest
    has a new line for each. Rejected samples and damaged files are recorded
    beside the outputs; ``retry_rejected`` takes shards with such again.
    ``debug`` gives the first batch of every shard and writes no output. Images are
    read and decoded with the resources of ``profile``. With ``resume`` only files of
    ``shards`` that are new are read, where they come after those read before: their
    rows are added and batches numbered on. That needs ``keep_partial`` and no preview;
    otherwise, and where a file has changed or comes before others, shards are whole.
    """
    started = time.monotonic()
    spec = source if isinstance(source, Spec) else load_spec(source)
    if spec.filter_functions and decode is None:
        raise ValueError("filters look at pixels: pass a decode function")
    with scratch() as made:
        if not debug:
            adopt(spark, spec.output_dir)
        if shards is None:
            work = all_of(shards_to_do(spark, spec.data_path, spec.output_dir, limit, retry_rejected))
        else:
            adding = resume and keep_partial and not (debug or spec.make_visualization)
            work = to_do(spark, spec.data_path, spec.output_dir, shards) if adding else all_of(whole_shards(spark, spec.data_path, shards))
        shards, names = work.files, work.names
        if resume and not names:
            return _recorded(spark, spec, {"samples": 0, "failed": 0, "kept": 0})
        tasks = fetch_tasks(shards)
        base = spec.output_dir.rstrip("/")
        samples, damage, cuts = found_samples(shards, None if debug else f"{base}/{HEADERS_DIR}")
        # Filters cannot see a mapper's output and both only drop rows, so the join
        # runs first, on rows without pixels.
        mapped, extra = apply_mappers(usable_samples(samples, spec.meta_key), spec.mapper_functions, names)
        mapped = mapped.withColumnsRenamed({name: MAPPED + name for name in extra})

        seen = Observation()
        read = with_contents(
            mapped,
            tasks,
            decode,
            image=decode is not None,
            pixels=need_pixels(spec.filter_functions),
            measure=bool(spec.filter_functions),
            cuts=cuts,
            profile=profile,
        )
        judged = judge(read, spec).observe(
            seen,
            F.count(F.lit(1)).alias("samples"),
            F.count_if(F.col("error").isNotNull()).alias("failed"),
            F.count_if("passes").alias("kept"),
        )
        judged = stage(judged, "judged")
        rejects = judged.where(F.col("error").isNotNull()).select("shard", "pos", "key", "error", "url")

        kept = assign_batches(judged.where("passes"), spec.batch_size, keep_partial, before=work.before if work.more else None)
        if debug:
            kept = kept.where("batch_id = 0")
        kept = stage(kept.withColumn("txt", caption_from_meta(F.col("json"), spec.txt_key)), "kept")
        preview = keep(made, stage(preview_grid(kept, "key", spec.batch_size), "preview")) if spec.make_visualization else None

        if debug:
            return Outcome(
                rows=keep(made, stage(kept.select("shard", *KEY_ROW.fieldNames()), "rows")),
                rejects=keep(made, stage(rejects.drop("url"), "rejects")),
                counts=read_manifest(spark, base),
                preview=preview,
                seen=seen.get,
            )
        withdraw(spark, base, names)
        write_found(kept, f"{base}/rows", work, KEY_ROW)
        write_found(rejects, f"{base}/{REJECTS_DIR}", work, REJECT)
        if spec.save_tar:
            after = parts_of(spark, base, work.more) if work.more else None
            write_laid_out(tar_rows(kept, spec, extra, tasks, cuts, after), base, replaces=work.whole)
        record_files(work, samples, kept, rejects, base)
        counts = manifest_counts(shards, samples, kept, rejects, damage, spec.batch_size, time.monotonic() - started)
        add_manifest(add_before(counts, work, spec.batch_size), base)
        return _recorded(spark, spec, seen.get, preview)
