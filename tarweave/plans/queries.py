"""The registered queries, each with the SQL that gives the same rows.

There are no images in the tables, so tables stand in for shards: an ordered
table for the entries of a tar, vectors for pixels, documents for captions.
Every query reads its whole tables.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarweave.functions.images import channel_histogram, decode_image, dominance
from tarweave.functions.text import (
    TEMPLATES,
    caption_from_meta,
    chat_prompt,
    clean_caption,
    decoded_text,
    entry_prefix,
    entry_suffix,
    fill_prompt,
    model_key,
    score_label,
    shard_name,
    truncate_prompt,
)
from tarweave.operators.captions import caption_rows, output_columns, overlay
from tarweave.operators.filters import keep_monochrome, split_rejects
from tarweave.operators.generation import features, generate_captions
from tarweave.operators.joins import read_by_shard, store_by_shard
from tarweave.operators.mappers import AddFieldsConfig, add_fields, add_fields_from_files
from tarweave.operators.ordering import assign_batches, first_rows, preview_grid
from tarweave.operators.samples import group_in_order, group_samples, has_caption_and_image, has_image, named_entries, rename_parts
from tarweave.operators.scoring import align_captions, average_scores, clip_scores
from tarweave.operators.shards import pending_shards, run_counters, shard_counts, skip_done, union_done
from tarweave.plans.captioning import caption_shards
from tarweave.plans.spec import KEY_ROW, run_spec
from tarweave.schemas import IMAGE
from tarweave.session import ship_package, split_uri, work_dir
from tarweave.sources.captions import add_manifest, completed_shards, read_manifest, read_rows, write_rows
from tarweave.sources.metadata import ORDER, SHARD, read_metadata
from tarweave.sources.headers import cuts_of, stored_index
from tarweave.sources.tar import (
    EXTENT,
    FORMAT,
    Headers,
    fetch_parts,
    fetch_tasks,
    list_shards,
    register,
    scan,
    shard_of_file,
    write_tars,
)
from tarweave.streaming.intake import process_new_shards

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under the function's name."""

    def add(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return build(spark, sf_dir)

        QUERIES[build.__name__] = run
        if sql:
            SQL[build.__name__] = sql
        return build

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- names, prompts and captions -------------------------------------------


@query("""
    SELECT page_id,
           replace(replace(regexp_replace(html, '<[^\n]*?>', '', 'g'), '<', ''), '>', '') AS caption
    FROM pages""")
def clean_captions(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", clean_caption(F.col("html")).alias("caption"))


ENTRY_NAMES = """
    CASE page_id % 3 WHEN 0 THEN url || '.Info.JSON' WHEN 1 THEN url ELSE 'a.b/' || page_id || '.JPG' END"""


@query(f"""
    WITH named AS (SELECT page_id, {ENTRY_NAMES} AS fname FROM pages)
    SELECT page_id,
           regexp_extract(fname, '^((?:.*/|)[^.]+)[.]([^/]*)$', 1) AS prefix,
           lower(regexp_extract(fname, '^((?:.*/|)[^.]+)[.]([^/]*)$', 2)) AS suffix
    FROM named WHERE regexp_matches(fname, '^((?:.*/|)[^.]+)[.]([^/]*)$')""")
def split_entry_name(spark, sf_dir):
    named = table(spark, sf_dir, "pages").select("page_id", F.expr(ENTRY_NAMES).alias("fname"))
    return named.select(
        "page_id", entry_prefix(F.col("fname")).alias("prefix"), entry_suffix(F.col("fname")).alias("suffix")
    ).where("prefix is not null")


@query("""
    SELECT doc_id, source || '.v' || (doc_id % 3) AS shard FROM documents""")
def shard_names(spark, sf_dir):
    path = F.expr("'/data/' || lang || '/' || source || '.v' || (doc_id % 3) || '.tar'")
    return table(spark, sf_dir, "documents").select("doc_id", shard_name(path).alias("shard"))


MODELS = [*TEMPLATES, "someone/unknown-model"]


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _case(values: list[str], slot: str = "doc_id % 10") -> str:
    return f"CASE {slot} " + " ".join(f"WHEN {i} THEN {_sql_text(v)}" for i, v in enumerate(values)) + " END"


@query(f"""
    SELECT doc_id, {_case(MODELS)} AS model_key,
           replace({_case([*TEMPLATES.values(), '{question}'])}, '{{question}}', text) AS prompt
    FROM documents""")
def prompt_template(spark, sf_dir):
    path = F.concat(F.lit("/models/hub/"), F.expr(_case(MODELS)))
    return table(spark, sf_dir, "documents").select(
        "doc_id", model_key(path).alias("model_key"), chat_prompt(path, F.col("text")).alias("prompt")
    )


@query("""
    SELECT conv_id, turn, 'Rewrite {as is}: ' || text || chr(10) || 'Short:' AS prompt FROM conversations""")
def prompt_fill(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", fill_prompt("Rewrite {{as is}}: {txt}\nShort:", F.col("text")).alias("prompt")
    )


@query("SELECT doc_id, substring(text, 1, 4096) AS prompt FROM documents")
def prompt_truncate(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", truncate_prompt(F.col("text"), 4096).alias("prompt"))


MARKED = """
    CASE doc_id % 3 WHEN 0 THEN ' <start_of_text>' || text || chr(10) || ' <end_of_text> tail <end_of_text>'
                    WHEN 1 THEN text ELSE '<start_of_text> ' || text || chr(160) END"""


@query(f"""
    WITH marked AS (SELECT doc_id, {MARKED} AS raw FROM documents)
    SELECT doc_id,
           regexp_replace(replace(split_part(raw, '<end_of_text>', 1), '<start_of_text>', ''),
                          '^[\\s\\pZ]+|[\\s\\pZ]+$', '', 'g') AS caption
    FROM marked""")
def decoded_clean(spark, sf_dir):
    marked = F.expr(MARKED.replace("chr(160)", "decode(unhex('C2A0'), 'UTF-8')"))
    return table(spark, sf_dir, "documents").select("doc_id", decoded_text(marked).alias("caption"))


@query("""
    SELECT doc_id, source || printf(' [%.2f]', CAST(doc_id % 997 AS DOUBLE) / 997) AS label FROM documents""")
def score_labels(spark, sf_dir):
    score = (F.col("doc_id") % 997).cast("double") / 997
    return table(spark, sf_dir, "documents").select("doc_id", score_label(F.col("source"), score).alias("label"))


@query("""
    SELECT event_id, coalesce(json_extract_string(props, '$.k'), '') AS txt, '' AS no_txt FROM events""")
def caption_projection(spark, sf_dir):
    props = F.col("props")
    return table(spark, sf_dir, "events").select(
        "event_id", caption_from_meta(props, "k").alias("txt"), caption_from_meta(props, None).alias("no_txt")
    )


@query("""
    SELECT event_id, event_type AS ours,
           CASE event_id % 3 WHEN 0 THEN 'meta ' || user_id WHEN 1 THEN NULL ELSE event_type END AS meta_first
    FROM events""")
def metadata_overlay(spark, sf_dir):
    json = F.expr("""
        CASE event_id % 3 WHEN 0 THEN replace(props, '}', ', "txt": "meta ' || user_id || '"}')
                          WHEN 1 THEN replace(props, '}', ', "txt": null}') ELSE props END""")
    generated = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        "event_id",
        overlay(generated, json, "txt").alias("ours"),
        overlay(generated, json, "txt", meta_wins=True).alias("meta_first"),
    )


@query("""
    SELECT CAST(page_id % 4 AS VARCHAR) AS shard, page_id AS pos, CAST(length(html) AS VARCHAR) AS txt,
           'describe' AS prompt, '/data/' || (page_id % 4) || '.tar' AS url,
           CAST(page_id AS VARCHAR) AS key, url AS source_url
    FROM pages""")
def provenance(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(
        F.expr("cast(page_id % 4 as string)").alias("shard"),
        F.col("page_id").alias("pos"),
        F.col("page_id").cast("string").alias("key"),
        F.to_json(F.struct("url", F.lit("other").alias("key"))).alias("json"),
        F.expr("'/data/' || (page_id % 4) || '.tar'").alias("url"),
        F.lit("describe").alias("prompt"),
        F.length("html").alias("caption"),
    )
    return caption_rows(pages, "caption")


# --- entries and samples ----------------------------------------------------

SUFFIX = """
    CASE event_type WHEN 'view' THEN 'JPG' WHEN 'purchase' THEN 'png' WHEN 'signup' THEN 'webp'
                    WHEN 'click' THEN 'txt' ELSE 'Info.Json' END"""


def _grouped(shard: str, pos: str) -> str:
    return f"""
    WITH RECURSIVE entries AS (
        SELECT {shard} AS s, {pos} AS p, 'd/k' || (user_id % 2) AS prefix, lower({SUFFIX}) AS suffix
        FROM events),
    fold AS (
        SELECT s, p, prefix, suffix, p AS start, [suffix] AS held FROM entries WHERE p = 0
        UNION ALL
        SELECT e.s, e.p, e.prefix, e.suffix,
               CASE WHEN e.prefix = f.prefix AND NOT list_contains(f.held, e.suffix) THEN f.start ELSE e.p END,
               CASE WHEN e.prefix = f.prefix AND NOT list_contains(f.held, e.suffix)
                    THEN list_append(f.held, e.suffix) ELSE [e.suffix] END
        FROM fold f JOIN entries e ON e.s = f.s AND e.p = f.p + 1)
    SELECT CAST(s AS VARCHAR) AS shard, start AS pos, min(prefix) AS key, count(*) AS n_parts,
           string_agg(suffix || '@' || p, ' ' ORDER BY suffix) AS parts
    FROM fold GROUP BY s, start"""


def _event_entries(spark, sf_dir, shard: str, pos: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.expr(f"cast({shard} as string)").alias("shard"),
        F.expr(pos).alias("pos"),
        F.expr(f"'d/k' || (user_id % 2) || '.' || {SUFFIX}").alias("fname"),
        F.lit("").alias("url"),
    )


def _part_list(samples: DataFrame) -> DataFrame:
    parts = F.array_sort(F.map_entries("parts"))
    return samples.select(
        "shard",
        "pos",
        "key",
        F.size("parts").cast("long").alias("n_parts"),
        F.array_join(F.transform(parts, lambda p: F.concat(p["key"], F.lit("@"), p["value"])), " ").alias("parts"),
    )


@query(_grouped("event_id % 8", "event_id // 8"))
def group_entries(spark, sf_dir):
    """Entries of shards that are mixed with each other."""
    return _part_list(group_samples(named_entries(_event_entries(spark, sf_dir, "event_id % 8", "event_id div 8"))))


@query(_grouped("event_id // 1000", "event_id % 1000"))
def group_entries_in_order(spark, sf_dir):
    """Entries that lie in the order of their shards, cut into samples where they are."""
    return _part_list(group_in_order(_event_entries(spark, sf_dir, "event_id div 1000", "event_id % 1000")))


def _event_samples(spark, sf_dir) -> DataFrame:
    """Four events in a row as one sample, the last event of a suffix as its part."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.expr("event_id div 4").alias("sample_id"), F.expr(f"lower({SUFFIX})").alias("suffix"))
        .agg(F.max("event_id").alias("part"))
        .groupBy("sample_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("suffix", "part"))).alias("parts"))
    )


PIVOT = f"""
    SELECT event_id // 4 AS sample_id,
           max(event_id) FILTER (event_type = 'view') AS jpg,
           max(event_id) FILTER (event_type = 'purchase') AS png,
           max(event_id) FILTER (event_type = 'signup') AS webp,
           max(event_id) FILTER (event_type = 'click') AS txt,
           max(event_id) FILTER (event_type = 'error') AS json
    FROM events GROUP BY 1"""


@query(f"""
    WITH s AS ({PIVOT})
    SELECT sample_id, coalesce(jpg, png, webp) IS NOT NULL AS has_image,
           coalesce(jpg, png, webp) IS NOT NULL AND txt IS NOT NULL AS has_caption_and_image
    FROM s""")
def has_parts(spark, sf_dir):
    return _event_samples(spark, sf_dir).select(
        "sample_id", has_image().alias("has_image"), has_caption_and_image().alias("has_caption_and_image")
    )


@query(f"""
    WITH s AS ({PIVOT})
    SELECT sample_id, coalesce(jpg, png, webp) AS image, json FROM s
    WHERE coalesce(jpg, png, webp) IS NOT NULL AND json IS NOT NULL""")
def coalesce_rename(spark, sf_dir):
    renamed = rename_parts(_event_samples(spark, sf_dir).where(has_image()), "info.json")
    return renamed.select("sample_id", "image", "json")


@query(f"""
    WITH s AS ({PIVOT})
    SELECT CAST(sample_id % 8 AS VARCHAR) AS shard, sample_id AS pos, coalesce(jpg, png, webp) AS image, json,
           '/data/' || (sample_id % 8) || '.tar' AS url, CAST(sample_id AS VARCHAR) AS key, txt AS extra
    FROM s WHERE coalesce(jpg, png, webp) IS NOT NULL AND json IS NOT NULL""")
def output_projection(spark, sf_dir):
    renamed = rename_parts(_event_samples(spark, sf_dir), "info.json").select(
        "*",
        F.expr("cast(sample_id % 8 as string)").alias("shard"),
        F.col("sample_id").alias("pos"),
        F.expr("'/data/' || (sample_id % 8) || '.tar'").alias("url"),
        F.col("sample_id").cast("string").alias("key"),
        F.try_element_at("parts", F.lit("txt")).alias("extra"),
    )
    return output_columns(renamed, ["extra"])


# --- tars -------------------------------------------------------------------


def _text_samples(spark, sf_dir) -> DataFrame:
    """Documents as samples: text as caption, the rest as metadata."""
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("shard"),
        F.col("doc_id").alias("pos"),
        F.col("doc_id").cast("string").alias("key"),
        F.create_map(
            F.lit("txt"), F.col("text").cast("binary"),
            F.lit("jpg"), F.concat(F.lit("image of "), F.col("doc_id")).cast("binary"),
            F.lit("info.json"), F.to_json(F.struct("lang", "n_chars", "text")).cast("binary"),
        ).alias("parts"),
    )


def _text_tars(spark, sf_dir) -> str:
    path = work_dir(spark, "tars")
    write_tars(_text_samples(spark, sf_dir), path)
    return path


@query("""
    SELECT d.source AS shard,
           3 * (row_number() OVER (PARTITION BY d.source, s.i ORDER BY d.doc_id) - 1) + s.i AS pos,
           d.doc_id || '.' || s.suffix AS fname,
           CASE s.i WHEN 2 THEN octet_length(encode(d.text)) ELSE length('image of ' || d.doc_id) END AS size
    FROM documents d JOIN (VALUES (1, 'jpg'), (2, 'txt')) AS s(i, suffix) ON true""")
def tar_scan(spark, sf_dir):
    path = _text_tars(spark, sf_dir)
    register(spark)
    entries = spark.read.format(FORMAT).option("suffixes", "jpg,txt").load(path)
    return entries.select("shard", "pos", "fname", F.length("data").cast("long").alias("size"))


@query("""
    SELECT source AS shard, CAST(doc_id AS VARCHAR) || '.txt' AS fname, CAST(octet_length(encode(text)) AS BIGINT) AS size
    FROM documents WHERE CAST(substring(source, 4) AS INTEGER) % 2 = 1""")
def tar_scan_pruned(spark, sf_dir):
    """Texts of half of the shards: the files of others aren't opened, other bodies not read."""
    path = _text_tars(spark, sf_dir)
    odd = [r.shard for r in list_shards(spark, path).select("shard").distinct().collect() if int(r.shard[3:]) % 2]
    entries = scan(spark, path, F.col("shard").isin(odd) & F.col("fname").endswith(".txt"))
    return entries.select("shard", "fname", F.length("data").cast("long").alias("size"))


@query("SELECT source AS shard, CAST(doc_id AS VARCHAR) AS key, text, 'image of ' || doc_id AS image FROM documents")
def tar_roundtrip(spark, sf_dir):
    shards = list_shards(spark, _text_tars(spark, sf_dir))
    store = work_dir(spark, "headers")
    samples = group_in_order(stored_index(shards, store), payload=EXTENT)
    return fetch_parts(samples, fetch_tasks(shards), ["txt", "jpg"], cuts=cuts_of(store)).select(
        "shard",
        "key",
        F.try_element_at("parts", F.lit("txt")).cast("string").alias("text"),
        F.try_element_at("parts", F.lit("jpg")).cast("string").alias("image"),
    )


# --- joins ------------------------------------------------------------------


@query("""
    WITH meta AS (
        SELECT o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS priority,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn
        FROM orders)
    SELECT c_custkey, c_name, m.priority AS last_priority
    FROM customer JOIN meta m ON c_custkey = m.o_custkey AND m.rn = 1""")
def add_fields_last_wins(spark, sf_dir):
    samples = table(spark, sf_dir, "customer").select(
        F.expr("cast(c_custkey % 16 as string)").alias("shard"), F.col("c_custkey").alias("key"), "c_name"
    )
    metadata = table(spark, sf_dir, "orders").select(
        F.expr("cast(o_custkey % 16 as string)").alias("shard"),
        F.col("o_orderkey").alias("pos"),
        "o_custkey",
        F.expr("CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END").alias("priority"),
    )
    config = AddFieldsConfig("add_fields", "priority", "last_priority", "", metadata_key="o_custkey")
    return add_fields(samples, metadata, config).select(F.col("key").alias("c_custkey"), "c_name", "last_priority")


@query("""
    WITH meta AS (
        SELECT o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS priority,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn
        FROM orders)
    SELECT c_custkey, c_name, m.priority AS last_priority
    FROM customer JOIN meta m ON c_custkey = m.o_custkey AND m.rn = 1""")
def add_fields_in_place(spark, sf_dir):
    """The same lookup in tables that lie by shard on both sides, so that neither is shuffled."""
    samples = table(spark, sf_dir, "customer").select(
        F.expr("cast(c_custkey % 16 as string)").alias("shard"), F.col("c_custkey").alias("key"), "c_name"
    )
    metadata = table(spark, sf_dir, "orders").select(
        F.expr("cast(o_custkey % 16 as string)").alias("shard"), F.col("o_orderkey").alias("pos"), "o_custkey",
        F.expr("CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END").alias("priority"),
    )
    samples, metadata = (read_by_shard(spark, store_by_shard(df, 16)) for df in (samples, metadata))
    config = AddFieldsConfig("add_fields", "priority", "last_priority", "", metadata_key="o_custkey")
    return add_fields(samples, metadata, config).select(F.col("key").alias("c_custkey"), "c_name", "last_priority")


@query("SELECT d.doc_id, d.source AS shard, l.quality FROM documents d JOIN labels l USING (doc_id)")
def add_fields_drop_missing(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    samples = documents.select(F.col("source").alias("shard"), F.col("doc_id").alias("key"))
    metadata = table(spark, sf_dir, "labels").join(documents.select("doc_id", "source"), "doc_id").select(
        F.col("source").alias("shard"), F.col("doc_id").alias("key"), "quality", F.col("doc_id").alias("pos")
    )
    return add_fields(samples, metadata, AddFieldsConfig("add_fields", "quality", "quality", "")).select(
        F.col("key").alias("doc_id"), "shard", "quality"
    )


@query("""
    SELECT CAST(o_custkey % 4 AS VARCHAR) AS shard, o_orderkey AS pos, CAST(o_custkey AS VARCHAR) AS key,
           o_orderpriority AS txt
    FROM orders""")
def metadata_scan(spark, sf_dir):
    path = work_dir(spark, "metadata")
    rows = table(spark, sf_dir, "orders").select(
        F.expr("cast(o_custkey % 4 as string)").alias("shard"),
        F.col("o_orderkey").alias("pos"),
        F.col("o_custkey").cast("string").alias("key"),
        F.col("o_orderpriority").alias("txt"),
    )
    write_rows(rows, path, rows.drop("shard").schema)
    return read_metadata(spark, path).select(
        F.col(SHARD).alias("shard"), F.col(ORDER)["row"].alias("pos"), "key", "txt"
    )


def _one_file_each(rows: DataFrame, path: str, order: str) -> None:
    """Write ``<path>/<shard>.parquet`` for every shard, its rows in ``order``."""

    def write(group: pa.Table) -> pa.Table:
        fs, inner = split_uri(path)
        name = group.column("shard")[0].as_py()
        with fs.open_output_stream(f"{inner}/{name}.parquet") as out:
            pq.write_table(group.drop_columns(["shard"]).sort_by(order), out)
        return pa.table({"n": [group.num_rows]})

    rows.groupBy("shard").applyInArrow(write, "n long").agg(F.sum("n")).collect()


@query("""
    WITH meta AS (
        SELECT o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS priority,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn
        FROM orders)
    SELECT c_custkey, CAST(c_custkey % 8 AS VARCHAR) AS shard, m.priority AS last_priority
    FROM customer JOIN meta m ON c_custkey = m.o_custkey AND m.rn = 1""")
def metadata_files(spark, sf_dir):
    """One file per shard with repeated keys, nulls and a column ``pos`` of its own that runs backwards."""
    path = work_dir(spark, "metadata")
    shard = lambda key: F.expr(f"cast({key} % 8 as string)")
    _one_file_each(
        table(spark, sf_dir, "orders").select(
            shard("o_custkey").alias("shard"), "o_orderkey", F.col("o_custkey").alias("key"), (-F.col("o_orderkey")).alias("pos"),
            F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")).alias("priority"),
        ), path, "o_orderkey")
    samples = table(spark, sf_dir, "customer").select(shard("c_custkey").alias("shard"), F.col("c_custkey").alias("key"))
    config = AddFieldsConfig("add_fields", "priority", "last_priority", path)
    found = add_fields_from_files(samples, config, [str(i) for i in range(8)])
    return found.select(F.col("key").alias("c_custkey"), "shard", "last_priority")


@query("""
    SELECT e.vec_id AS pos, CAST(e.label AS VARCHAR) AS shard, d.text AS txt
    FROM embeddings e JOIN documents d ON e.vec_id = d.doc_id""")
def align_captions_to_images(spark, sf_dir):
    # The captions carry their images' shard, as the caption job writes them.
    images = table(spark, sf_dir, "embeddings").select(
        F.col("label").cast("string").alias("shard"), F.col("vec_id").alias("pos")
    )
    captions = table(spark, sf_dir, "documents").join(images, F.col("doc_id") == F.col("pos")).select(
        "shard", "pos", F.col("text").alias("txt")
    )
    return align_captions(images, captions)


# --- order ------------------------------------------------------------------


def _documents(spark, sf_dir, *columns) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("shard"), F.col("doc_id").alias("pos"), *columns
    )


BATCHED = """
    SELECT source AS shard, doc_id AS pos,
           (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 32 AS batch_id,
           count(*) OVER (PARTITION BY source) AS n, *
    FROM documents"""


@query(f"SELECT shard, pos, batch_id FROM ({BATCHED})")
def assign_batches_keep_tail(spark, sf_dir):
    return assign_batches(_documents(spark, sf_dir), 32)


@query(f"SELECT shard, pos, batch_id FROM ({BATCHED}) WHERE (batch_id + 1) * 32 <= n")
def assign_batches_drop_tail(spark, sf_dir):
    return assign_batches(_documents(spark, sf_dir), 32, keep_partial=False)


@query(f"SELECT shard, pos, text FROM ({BATCHED}) WHERE batch_id = 0")
def first_batch(spark, sf_dir):
    return first_rows(_documents(spark, sf_dir, "text"), 32).drop("row_num")


@query("""
    WITH r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i FROM documents)
    SELECT source AS shard, doc_id AS pos, lang AS caption, text AS original_caption, n_chars AS score,
           CAST(i // 4 AS INTEGER) AS grid_row, CAST(i % 4 AS INTEGER) AS grid_col
    FROM r WHERE i < 30""")
def preview_cells(spark, sf_dir):
    documents = _documents(spark, sf_dir, "lang", "text", "n_chars")
    return preview_grid(documents, "lang", batch_size=30, original="text", score="n_chars")


@query(f"SELECT shard, count(*) AS n_rows, max(batch_id) + 1 AS n_batches FROM ({BATCHED}) GROUP BY shard")
def run_counts(spark, sf_dir):
    return run_counters(assign_batches(_documents(spark, sf_dir), 32))


# --- shards -----------------------------------------------------------------


def _sources(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("source").alias("shard")).distinct()


def _third(shards: DataFrame, rest: int) -> DataFrame:
    return shards.where(F.substring("shard", 4, 10).cast("int") % 3 == rest)


@query("SELECT DISTINCT source AS shard FROM documents WHERE CAST(substring(source, 4) AS INTEGER) % 3 <> 0")
def skip_done_shards(spark, sf_dir):
    shards = _sources(spark, sf_dir)
    return skip_done(shards, _third(shards, 0))


@query("""
    WITH chosen AS (SELECT DISTINCT source AS shard FROM documents ORDER BY shard LIMIT 7)
    SELECT shard FROM chosen WHERE CAST(substring(shard, 4) AS INTEGER) % 3 <> 0""")
def limit_before_skip(spark, sf_dir):
    shards = _sources(spark, sf_dir)
    return pending_shards(shards, _third(shards, 0), limit=7)


@query("SELECT DISTINCT source AS shard FROM documents WHERE CAST(substring(source, 4) AS INTEGER) % 3 <> 2")
def completed_union(spark, sf_dir):
    shards = table(spark, sf_dir, "documents").select(F.col("source").alias("shard"))
    return union_done(_third(shards, 0), _third(shards, 1))


@query("""
    SELECT DISTINCT source AS shard FROM documents
    EXCEPT SELECT source FROM documents WHERE CAST(substring(source, 4) AS INTEGER) % 3 = 1""")
def shard_difference(spark, sf_dir):
    shards = _sources(spark, sf_dir)
    return shards.exceptAll(_third(shards, 1))


@query("SELECT DISTINCT source AS shard FROM documents")
def completed_listing(spark, sf_dir):
    """Some shards are in the manifest, some only known by their tar."""
    out = work_dir(spark, "out")
    documents = _documents(spark, sf_dir)
    done = documents.where(F.substring("shard", 4, 10).cast("int") % 3 != 1)
    add_manifest(shard_counts(done, done), out)
    rest = _text_samples(spark, sf_dir).where(F.substring("shard", 4, 10).cast("int") % 3 != 0)
    write_tars(rest, out)
    return completed_shards(spark, out)


@query("""
    SELECT d.source AS shard, count(*) AS rows_in, count(l.doc_id) AS rows_out
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id AND l.toxic = 1 GROUP BY 1""")
def manifest(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("shard"))
    kept = documents.join(table(spark, sf_dir, "labels").where("toxic = 1"), "doc_id")
    return shard_counts(documents, kept)


@query("""
    SELECT source AS shard, doc_id AS pos, CAST(doc_id AS VARCHAR) AS key, text AS txt, 'p' AS prompt,
           source || '.tar' AS url, lang AS source_url
    FROM documents""")
def caption_roundtrip(spark, sf_dir):
    path = work_dir(spark, "captions")
    rows = _documents(spark, sf_dir, "*").select(
        "shard", "pos", F.col("pos").cast("string").alias("key"), F.col("text").alias("txt"),
        F.lit("p").alias("prompt"), F.concat("shard", F.lit(".tar")).alias("url"), F.col("lang").alias("source_url"),
    )
    write_rows(rows, path)
    return read_rows(spark, path).select(rows.columns)


# --- pixels -----------------------------------------------------------------


def _pixels(vector: Column) -> Column:
    """Bytes of an 8 x 8 image: a pixel per component, coarser to finer over the channels."""

    def byte(x: Column, levels: int) -> Column:
        return F.lpad(F.hex(F.floor((x.cast("double") + 1) * levels)), 2, "0")

    pixel = F.transform(vector, lambda x: F.concat(byte(x, 8), byte(x, 16), byte(x, 32)))
    return F.unhex(F.array_join(pixel, ""))


def _images(spark, sf_dir) -> DataFrame:
    image = F.struct(
        F.lit("").alias("origin"), F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(3).alias("nChannels"),
        F.lit(16).alias("mode"), _pixels(F.col("embedding")).alias("data"),
    ).cast(IMAGE)
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", image.alias("image"))


BINS = """
    SELECT vec_id, channel, CAST(floor((x + 1) * levels) AS INTEGER) AS bin, count(*) AS n
    FROM (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)
    JOIN (VALUES (0, 8), (1, 16), (2, 32)) AS c(channel, levels) ON true
    GROUP BY ALL"""


@query(f"SELECT vec_id, channel, bin, n FROM ({BINS})")
def histogram(spark, sf_dir):
    counts = _images(spark, sf_dir).select("vec_id", channel_histogram(F.col("image")).alias("h"))
    channels = counts.select("vec_id", F.posexplode("h").alias("channel", "bins"))
    return channels.select("vec_id", "channel", F.posexplode("bins").alias("bin", "n")).where("n > 0")


@query(f"SELECT vec_id, round(max(n) / 64.0, 6) AS dominance FROM ({BINS}) GROUP BY vec_id")
def dominant_share(spark, sf_dir):
    return _images(spark, sf_dir).select("vec_id", F.round(dominance(F.col("image")), 6).alias("dominance"))


@query(f"SELECT vec_id FROM ({BINS}) GROUP BY vec_id HAVING max(n) / 64.0 > 0.390625")
def monochrome_filter(spark, sf_dir):
    """The threshold is one share that images do have: 25 of 64 pixels are not above it."""
    share = dominance(F.col("image"))
    return _images(spark, sf_dir).where(keep_monochrome(share, 25 / 64, True)).select("vec_id")


@query(f"SELECT vec_id FROM ({BINS}) GROUP BY vec_id HAVING NOT max(n) / 64.0 > 0.390625")
def colourful_filter(spark, sf_dir):
    share = dominance(F.col("image"))
    return _images(spark, sf_dir).where(keep_monochrome(share, 25 / 64, False)).select("vec_id")


def decode_raw(raw: bytes) -> np.ndarray:
    """Stand-in codec of the queries: a mark and 8 x 8 pixels."""
    if raw[:2] != b"RG":
        raise ValueError("not an image")
    return np.frombuffer(raw, np.uint8, offset=2).reshape(8, 8, 3)


RAW = "CASE WHEN vec_id % 5 = 0 THEN 'XX' ELSE 'RG' END"


@query("""
    SELECT vec_id, vec_id % 5 <> 0 AS decoded,
           CASE WHEN vec_id % 5 = 0 THEN 'ValueError: not an image' END AS error
    FROM embeddings""")
def decode_rejects(spark, sf_dir):
    raw = F.concat(F.expr(RAW).cast("binary"), _pixels(F.col("embedding")))
    read = table(spark, sf_dir, "embeddings").select("vec_id", decode_image(raw, decode_raw).alias("r"))
    samples = read.select("vec_id", F.col("r.image").alias("image"), F.col("r.image.data").isNotNull().alias("decoded"), F.col("r.error").alias("error"))
    good, bad = split_rejects(samples)
    return good.withColumn("error", F.lit(None).cast("string")).unionByName(bad)


# --- models -----------------------------------------------------------------


def standin_model():
    """Deterministic text in place of a caption model, from the whole prompt."""

    def model(prompts, images):
        return [f"<p>{hashlib.md5(p.encode()).hexdigest()}</p> {len(p)}>" for p in prompts]

    return model


@query("""
    SELECT doc_id, md5('Rewrite: ' || text) || ' ' || length('Rewrite: ' || text) AS caption,
           128 AS max_tokens, round(CAST(0.6 AS DOUBLE), 6) AS temperature
    FROM documents""")
def generate_text(spark, sf_dir):
    prompts = table(spark, sf_dir, "documents").select(
        "doc_id", fill_prompt("Rewrite: {txt}", F.col("text")).alias("prompt")
    )
    return generate_captions(prompts, standin_model, "standin", image=None).select(
        "doc_id", "caption", "max_tokens", "temperature"
    )


def image_model():
    def model(prompts, images):
        return [f"{p} {int(image.max())}" for p, image in zip(prompts, images)]

    return model


@query("""
    SELECT vec_id, 'Top ' || max(CAST(floor((x + 1) * 32) AS INTEGER)) AS caption
    FROM (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings) GROUP BY vec_id""")
def generate_from_images(spark, sf_dir):
    samples = _images(spark, sf_dir).withColumn("prompt", F.lit("Top"))
    return generate_captions(samples, image_model, "image-standin").select("vec_id", "caption")


def flaky_model():
    """Fails on the first try of every batch, and always on prompts of users."""
    state = {"calls": 0}

    def model(prompts, images):
        state["calls"] += 1
        if state["calls"] % 2 == 1 or "user" in prompts:
            raise RuntimeError("no memory")
        return prompts

    return model


@query("""
    SELECT conv_id, turn, CASE WHEN role <> 'user' THEN role END AS caption,
           CASE WHEN role = 'user' THEN 'RuntimeError: no memory' END AS error
    FROM conversations""")
def generate_with_retries(spark, sf_dir):
    prompts = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("role").alias("prompt"))
    answers = generate_captions(prompts, flaky_model, "flaky", image=None, batch_size=1, wait=0.0)
    return answers.select("conv_id", "turn", "caption", F.col("caption_error").alias("error"))


def text_encoder():
    def encode(text):
        return np.stack([[len(t), t.count(" "), t.count("\n")] for t in text])

    return encode


@query("""
    SELECT doc_id, CAST(length(text) AS FLOAT) AS n_chars,
           CAST(length(text) - length(replace(text, ' ', '')) AS FLOAT) AS n_spaces,
           CAST(length(text) - length(replace(text, chr(10), '')) AS FLOAT) AS n_breaks
    FROM documents""")
def text_features(spark, sf_dir):
    vector = features(text_encoder, F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", vector.alias("v")).select(
        "doc_id", F.col("v")[0].alias("n_chars"), F.col("v")[1].alias("n_spaces"), F.col("v")[2].alias("n_breaks")
    )


def image_encoder():
    def encode(vectors):
        return np.stack([vectors.max(axis=1), vectors.min(axis=1)], axis=1)

    return encode


@query("""
    SELECT vec_id, round(CAST(list_max(embedding) AS DOUBLE), 6) AS highest,
           round(CAST(list_min(embedding) AS DOUBLE), 6) AS lowest
    FROM embeddings""")
def image_features(spark, sf_dir):
    vector = features(image_encoder, F.col("embedding"), input_shapes=[[64]])
    rounded = [F.round(F.col("v")[i].cast("double"), 6).alias(n) for i, n in enumerate(("highest", "lowest"))]
    return table(spark, sf_dir, "embeddings").select("vec_id", vector.alias("v")).select("vec_id", *rounded)


def joint_encoder():
    def encode(vectors, texts):
        return np.stack([vectors.max(axis=1), [len(t) for t in texts]], axis=1)

    return encode


def pixel_encoder():
    def encode(pixels, heights, widths, channels):
        return np.array([[max(p), h * w * c] for p, h, w, c in zip(pixels, heights, widths, channels)], float)

    return encode


@query("""
    SELECT e.vec_id, round(CAST(list_max(embedding) AS DOUBLE), 6) AS highest, CAST(length(d.text) AS DOUBLE) AS n_chars,
           CASE WHEN vec_id % 5 <> 0 THEN CAST(list_max([floor((x + 1) * 32) FOR x IN CAST(embedding AS DOUBLE[])]) AS DOUBLE) END AS brightest,
           CASE WHEN vec_id % 5 <> 0 THEN CAST(192 AS DOUBLE) END AS n_bytes
    FROM embeddings e JOIN documents d ON e.vec_id = d.doc_id""")
def joint_features(spark, sf_dir):
    """Image and text to one encoder, and encoded images to an encoder that decodes them."""
    raw = F.concat(F.expr(RAW).cast("binary"), _pixels(F.col("embedding")))
    both = table(spark, sf_dir, "embeddings").join(table(spark, sf_dir, "documents"), F.col("vec_id") == F.col("doc_id"))
    found = both.select(
        "vec_id",
        features(joint_encoder, F.col("embedding"), F.col("text"), input_shapes=[[64], None]).alias("j"),
        features(pixel_encoder, raw, decode=decode_raw).alias("p"),
    )
    known = lambda c: F.when(~F.isnan(c), c)
    return found.select(
        "vec_id", F.round(F.col("j")[0].cast("double"), 6).alias("highest"), F.col("j")[1].cast("double").alias("n_chars"),
        known(F.get("p", 0).cast("double")).alias("brightest"), known(F.get("p", 1).cast("double")).alias("n_bytes"),
    )


# --- scores -----------------------------------------------------------------


def _scored(spark, sf_dir) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("label").cast("string").alias("shard"),
        F.col("vec_id").alias("pos"),
        F.col("embedding").alias("image_vec"),
        F.reverse("embedding").alias("text_vec"),
    )
    return clip_scores(assign_batches(vectors, 32))


SCORES = """
    WITH rows AS (
        SELECT label, vec_id, CAST(embedding AS DOUBLE[]) AS i, list_reverse(CAST(embedding AS DOUBLE[])) AS t,
               (row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1) // 32 AS batch_id
        FROM embeddings),
    logits AS (
        SELECT a.label, a.batch_id, a.vec_id, b.vec_id AS other, 100 * list_cosine_similarity(a.i, b.t) AS l
        FROM rows a JOIN rows b USING (label, batch_id)),
    shares AS (
        SELECT *, exp(l - max(l) OVER w) AS e, max(l) OVER w AS top FROM logits WINDOW w AS (PARTITION BY vec_id))
    SELECT CAST(label AS VARCHAR) AS shard, batch_id, vec_id AS pos,
           sum(e) FILTER (vec_id = other) / sum(e) AS clip_score
    FROM shares GROUP BY ALL"""


@query(f"SELECT shard, batch_id, pos, round(clip_score, 6) AS clip_score FROM ({SCORES})")
def clip_score(spark, sf_dir):
    return _scored(spark, sf_dir).withColumn("clip_score", F.round("clip_score", 6))


@query(f"SELECT shard, round(avg(clip_score), 6) AS avg_clip_score FROM ({SCORES}) GROUP BY shard")
def avg_clip_score(spark, sf_dir):
    return average_scores(_scored(spark, sf_dir)).withColumn("avg_clip_score", F.round("avg_clip_score", 6))


# --- whole jobs -------------------------------------------------------------


def _image_tars(spark, sf_dir) -> str:
    """Vectors as images in one tar per label; every fifth cannot be decoded."""
    path = work_dir(spark, "tars")
    samples = table(spark, sf_dir, "embeddings").select(
        F.col("label").cast("string").alias("shard"),
        F.col("vec_id").alias("pos"),
        F.concat(F.lit("v"), F.col("vec_id")).alias("key"),
        F.create_map(
            F.lit("png"), F.concat(F.expr(RAW).cast("binary"), _pixels(F.col("embedding"))),
            F.lit("info.json"), F.to_json(F.struct("label", F.lit("none").alias("key"))).cast("binary"),
        ).alias("parts"),
    )
    write_tars(samples, path)
    return path


def _vector_notes(spark, sf_dir) -> str:
    """Metadata of the shards: a note for the vectors that have a document label."""
    path = work_dir(spark, "notes")
    notes = table(spark, sf_dir, "labels").join(
        table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "label"), "doc_id"
    ).select(
        F.col("label").cast("string").alias("shard"), F.col("doc_id").alias("pos"),
        F.concat(F.lit("v"), F.col("doc_id")).alias("key"), F.concat(F.lit("q"), F.col("quality")).alias("note"),
    )
    write_rows(notes, path, notes.drop("shard").schema)
    return path


@query(f"""
    WITH passed AS (
        SELECT vec_id FROM ({BINS}) GROUP BY vec_id HAVING NOT max(n) / 64.0 > 0.390625),
    kept AS (
        SELECT e.vec_id, e.label, (row_number() OVER (PARTITION BY e.label ORDER BY e.vec_id) - 1) // 8 AS batch_id,
               count(*) OVER (PARTITION BY e.label) AS n
        FROM embeddings e JOIN passed USING (vec_id) JOIN labels l ON l.doc_id = e.vec_id
        WHERE e.vec_id % 5 <> 0)
    SELECT CAST(label AS VARCHAR) AS shard, 'v' || vec_id AS key, CAST(label AS VARCHAR) AS txt, batch_id
    FROM kept WHERE (batch_id + 1) * 8 <= n""")
def declarative_spec(spark, sf_dir):
    spec = {
        "data_path": _image_tars(spark, sf_dir),
        "output_dir": work_dir(spark, "out"),
        "batch_size": 8,
        "num_workers": 1,
        "meta_key": "info.json",
        "img_key": "png",
        "txt_key": "label",
        "filter_functions": [{"type": "mono", "threshold": 25 / 64, "is_monochromatic": False}],
        "mapper_functions": [{
            "type": "add_fields", "input_key": "note", "output_key": "note",
            "metadata_path": _vector_notes(spark, sf_dir),
        }],
    }
    return run_spec(spark, spec, decode=decode_raw, keep_partial=False).rows.select("shard", "key", "txt", "batch_id")


@query("""
    SELECT source AS shard, CAST(doc_id AS VARCHAR) AS key,
           md5('Shorten: ' || substring(text, 1, 4087)) || ' ' || least(4096, length(text) + 9) AS txt,
           'Shorten: ' || substring(text, 1, 4087) AS prompt
    FROM documents""")
def caption_job(spark, sf_dir):
    out = caption_shards(
        spark, "standin", _text_tars(spark, sf_dir), "Shorten: {txt}", lambda params: standin_model(),
        output_dir=work_dir(spark, "out"), language_only=True, language_only_key="text",
    )
    return out.rows.select("shard", "key", "txt", "prompt")


def scoring_model(params):
    def model(prompts, images):
        return [(f"{p} {int(image.max())}", int(image.max()) / 4) for p, image in zip(prompts, images)]

    return model


def same_vector():
    """Encoder of images and of texts: all alike, so that each caption has an equal share of its batch."""

    def encode(*columns):
        return np.ones((len(columns[0]), 2))

    return encode


def same_text_vector():
    def encode(text):
        return np.ones((len(text), 2))

    return encode


@query("""
    WITH m AS (
        SELECT vec_id, label, list_max([CAST(floor((x + 1) * 32) AS INTEGER) FOR x IN CAST(embedding AS DOUBLE[])]) AS top
        FROM embeddings WHERE vec_id % 5 <> 0)
    SELECT CAST(label AS VARCHAR) AS shard, 'v' || vec_id AS key, 'Top ' || top AS txt, 'Top' AS prompt,
           top / 4.0::DOUBLE AS score, CAST(64 AS DOUBLE) AS max_tokens,
           round(1.0 / least(8, count(*) OVER (PARTITION BY label)), 6)::DOUBLE AS avg_clip_score,
           (SELECT count(*) FROM embeddings e WHERE e.label = m.label AND vec_id % 5 = 0) AS rejected,
           (count(*) OVER (PARTITION BY label) + 7) // 8 AS batches
    FROM m""")
def caption_images_job(spark, sf_dir):
    """Tars of encoded images to captions with the model's scores, its parameters and clip scores."""
    out = caption_shards(
        spark, "standin", _image_tars(spark, sf_dir), "Top", scoring_model, max_tokens=64, batch_size=8,
        output_dir=work_dir(spark, "out"), decode=decode_raw, image_encoder=same_vector, text_encoder=same_text_vector,
    )
    rows = out.rows.select("shard", "key", "txt", "prompt", "score", F.col("params")["max_tokens"].alias("max_tokens"))
    average = out.average.withColumn("avg_clip_score", F.round("avg_clip_score", 6))
    return rows.join(average, "shard").join(out.counts.select("shard", "rejected", "batches"), "shard")


def _cut_last_entry(path: str) -> None:
    """Cut a tar in the middle of its last entry, copying blocks; a tar that is cut already stays as it is."""
    fs, inner = split_uri(path)
    length = fs.get_file_info(inner).size
    with fs.open_input_file(inner) as handle:
        headers, last = Headers(handle, length), None
        for last in headers:
            pass
    if headers.damage or last is None:
        return
    left = last[2] + last[3] // 2
    folder, name = inner.rsplit("/", 1)
    # Put in place when it is whole, so a task that is run again finds the one or the other.
    staged = f"{folder}/_cut-{uuid.uuid4().hex}-{name}.part"
    with fs.open_input_stream(inner) as whole, fs.open_output_stream(staged) as out:
        while left and (block := whole.read(min(left, 1 << 20))):
            out.write(block)
            left -= len(block)
    fs.move(staged, inner)


def _cut_last_entries(shards: DataFrame) -> None:
    """:func:`_cut_last_entry` for each ``path``, in tasks."""

    def cut(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                _cut_last_entry(path)
            yield batch

    paths = shards.select("path")
    paths.repartition(fetch_tasks(shards), "path").mapInArrow(cut, paths.schema).write.format("noop").mode("overwrite").save()


@query("""
    WITH d AS (
        SELECT *, CAST(substring(source, 4) AS INTEGER) % 3 = 0 AS damaged FROM documents)
    SELECT source AS shard, count(*) AS rows_in, count_if(doc_id % 7 <> 0 AND doc_id % 11 <> 0) AS rows_out,
           count_if(doc_id % 7 <> 0 AND doc_id % 11 = 0) AS rejected, any_value(damaged) AS damaged
    FROM d GROUP BY source""")
def shard_damage(spark, sf_dir):
    """Shards cut in their last entry (a caption), samples without metadata and with broken metadata, all accounted for."""
    path = work_dir(spark, "tars")
    meta = F.when(F.col("doc_id") % 7 != 0, F.when(F.col("doc_id") % 11 == 0, F.lit("{broken")).otherwise(F.to_json(F.struct("lang"))))
    write_tars(
        table(spark, sf_dir, "documents").select(
            F.col("source").alias("shard"), F.col("doc_id").alias("pos"), F.col("doc_id").cast("string").alias("key"),
            F.create_map(
                F.lit("txt"), F.concat(F.lit("."), F.col("text")).cast("binary"), F.lit("jpg"), F.lit("image").cast("binary"),
                F.lit("info.json"), meta.cast("binary"),
            ).alias("parts"),
        ), path)
    ship_package(spark)
    _cut_last_entries(list_shards(spark, path).where("cast(substring(shard, 4) as int) % 3 = 0"))
    spec = {"data_path": path, "output_dir": work_dir(spark, "out"), "batch_size": 32, "num_workers": 1, "meta_key": "info.json", "img_key": "jpg"}
    counts = run_spec(spark, spec).counts
    return counts.select("shard", "rows_in", "rows_out", "rejected", F.col("damage").isNotNull().alias("damaged"))


def _move_tars(path: str, inbox: str) -> None:
    """Move all tars of a folder into another; the files of a shard are numbered on after those that are there."""
    fs, inner = split_uri(path)
    _, target = split_uri(inbox)
    tars = lambda folder: sorted(shard_of_file(f.base_name) for f in fs.get_file_info(pafs.FileSelector(folder)) if f.base_name.endswith(".tar"))
    taken = {shard: number + 1 for shard, number in tars(target)}
    for shard, number in tars(inner):
        name = lambda n: f"{shard}{f'~{n:05d}' if n else ''}.tar"
        fs.move(f"{inner}/{name(number)}", f"{target}/{name(taken.get(shard, 0) + number)}")


@query("""
    SELECT CAST(doc_id % 2 AS VARCHAR) AS shard, CAST(doc_id AS VARCHAR) AS key, lang AS txt,
           (row_number() OVER (PARTITION BY doc_id % 2 ORDER BY doc_id) - 1) // 32 AS batch_id,
           count(*) OVER (PARTITION BY doc_id % 2) AS rows_in, count(*) OVER (PARTITION BY doc_id % 2) AS rows_out
    FROM documents""")
def incremental_intake(spark, sf_dir):
    """Two shards of two files or more arrive file by file and are processed as they do, the last batch twice."""
    inbox, base = work_dir(spark, "inbox"), work_dir(spark, "intake")
    samples = _text_samples(spark, sf_dir).withColumn("shard", F.expr("cast(pos % 2 as string)"))
    middle = samples.agg((F.max("pos") / 2).cast("long")).first()[0]
    # Written apart and then put together: the files of the second half of a shard follow those of the first.
    halves = [work_dir(spark, "half") for _ in range(2)]
    for half, path in enumerate(halves):
        write_tars(samples.where((F.col("pos") > middle) == bool(half)), path)
        _move_tars(path, inbox)
    spec = {"data_path": inbox, "output_dir": f"{base}/out", "batch_size": 32, "num_workers": 1, "meta_key": "info.json", "img_key": "jpg", "txt_key": "lang"}
    taken = []

    def process(shards):
        names = spark.createDataFrame([(r.shard,) for r in shards.select("shard").distinct().collect()], "shard string")
        run_spec(spark, spec, shards=names, resume=True)
        taken.append(names)

    process_new_shards(spark, inbox, f"{base}/checkpoint", process, max_files=1).awaitTermination()
    run_spec(spark, spec, shards=taken[-1], resume=True)
    rows = read_rows(spark, f"{base}/out/rows", KEY_ROW).select("shard", "key", "txt", "batch_id")
    counts = read_manifest(spark, f"{base}/out").select("shard", "rows_in", "rows_out")
    return rows.join(counts, "shard")
