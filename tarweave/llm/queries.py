"""The registered queries of this package, and SQL giving the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarweave.llm import bpe, chat, licenses, merkle, passages, quality, quotient, repeats, templates, token_files, trie, urls, weighted_minhash
from tarweave.session import ship_package, work_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(f"""
    WITH t AS (SELECT doc_id, {_LOWER} AS norm FROM documents),
    g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
    FROM t JOIN g USING (norm)
""")
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts by counting quotient filters; the row with the largest id stays."""
    return quotient.exact_copies(table(spark, sf_dir, "documents")).drop("fp")


@query()
def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every text and the bytes they decode to, as digests."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ship_package(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", bpe.round_trip(F.col("text"), path, public_tokenizers.PATTERN).alias("t"))
    return docs.select(
        "doc_id",
        F.size("t.ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("t.ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("t.raw", 256).alias("decoded_sha256"),
    )


@query()
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every text written in order of the ids, and what the files hold."""
    import public_tokenizers

    ship_package(spark)
    docs = token_files.in_order(table(spark, sf_dir, "documents"), "doc_id", "text")
    path = work_dir(spark, "tokens")
    token_files.write_tokens(docs.select("doc_id", token_files.encode(F.col("text"), public_tokenizers.path("word_bpe_49k.json"), end_id=2).alias("ids")), path)
    return token_files.positions(spark, path)


@query(licenses.brute_force_sql())
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and statements of every text."""
    return licenses.license_scan(table(spark, sf_dir, "documents"))


@query()
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text by a conditional random field over its lines."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    field = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, field).select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query()
def op7_benchmark_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in texts, as they are or with other numbers, units and names."""
    return templates.benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("print")


@query()
def op3_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near copies by consistent weighted sampling."""
    return weighted_minhash.near_copies(table(spark, sf_dir, "documents")).drop("print")


@query()
def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages that texts have in common, by compact windows."""
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


_LISTED = "(adult|casino|bets|pills|spam|ads)"


def _url_entries(pages: DataFrame) -> DataFrame:
    """A dated list made of the hosts of ``pages``: suspicious domains come, go and come again; of some hosts one section is listed."""
    hosts = pages.select(urls.host_of(F.col("url")).alias("host")).where("host IS NOT NULL").distinct()
    hosts = hosts.withColumn("day", F.expr("CAST(conv(substr(md5(host), 1, 6), 16, 10) AS BIGINT) % 200"))
    domain = hosts.where(F.col("host").rlike(_LISTED)).select(
        F.element_at(F.split("host", r"\."), -3).alias("name"), F.concat_ws(".", F.slice(F.split("host", r"\."), -3, 3)).alias("pattern"), "day"
    ).groupBy("pattern", "name").agg(F.min("day").alias("day"))
    dated = domain.select(
        "pattern", F.regexp_extract("name", _LISTED, 1).alias("category"),
        F.explode(F.array(*(F.struct((F.col("day") + d).alias("day"), F.lit(on).alias("listed")) for d, on in ((0, True), (60, False), (120, True))))).alias("e"),
    ).select("pattern", "category", F.col("e.day").alias("day"), F.col("e.listed").alias("listed"))
    section = hosts.where("day % 5 = 0").select(F.concat("host", F.lit("/de")).alias("pattern"), F.lit("section").alias("category"), "day", F.lit(True).alias("listed"))
    return dated.union(section).select("pattern", "category", (F.col("day") * 86400).alias("at"), "listed")


@query(f"""
    WITH p AS (
      SELECT page_id, url, (page_id * 7919) % 31536000 AS fetched_at, lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) AS host,
             regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path
      FROM pages),
    hosts AS (SELECT host, ('0x' || substr(md5(host), 1, 6))::BIGINT % 200 AS day FROM (SELECT DISTINCT host FROM p WHERE host <> '')),
    domain AS (
      SELECT array_to_string(string_split(host, '.')[-3:], '.') AS pattern, regexp_extract(string_split(host, '.')[-3], '{_LISTED}', 1) AS category, min(day) AS day
      FROM hosts WHERE regexp_matches(host, '{_LISTED}') GROUP BY ALL),
    e AS (
      SELECT pattern, category, day + unnest([0, 60, 120]) AS day, unnest([true, false, true]) AS listed FROM domain
      UNION ALL SELECT host || '/de', 'section', day, true FROM hosts WHERE day % 5 = 0),
    held AS (
      SELECT page_id, category, arg_max(listed, day) AS listed
      FROM p JOIN e ON day * 86400 <= fetched_at AND (host = pattern OR host LIKE '%.' || pattern OR host || path = pattern OR host || path LIKE pattern || '/%')
      GROUP BY page_id, category, pattern),
    c AS (SELECT page_id, string_agg(DISTINCT category, ',' ORDER BY category) AS categories FROM held WHERE listed GROUP BY page_id)
    SELECT page_id, url, fetched_at, coalesce(categories, '') AS categories, categories IS NULL AS kept FROM p LEFT JOIN c USING (page_id)
""")
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page against the list entries in force when it was fetched (a time made of its id)."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.select(F.col("page_id").alias("id"), "url", (F.col("page_id") * 7919 % 31536000).alias("fetched_at"))
    return urls.judge(captures, _url_entries(pages)).withColumnRenamed("id", "page_id")


@query("""
    WITH t AS (
      SELECT conv_id, count(*) AS turns, string_agg('<|' || role || '|>' || chr(10) || text || chr(10) || '<|end|>' || chr(10), '' ORDER BY turn) AS text
      FROM conversations GROUP BY conv_id)
    SELECT conv_id, turns, text FROM t
    WHERE NOT EXISTS (
      SELECT 1 FROM t u WHERE (u.turns > t.turns AND starts_with(u.text, t.text)) OR (u.text = t.text AND u.conv_id < t.conv_id))
""")
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations that no longer one begins with, rendered."""
    return chat.format_chats(table(spark, sf_dir, "conversations"))


@query(merkle.sql())
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf and proof in a Merkle tree of sources, verified against rows of which some are tampered with."""
    return merkle.verify(merkle.manifest(table(spark, sf_dir, "documents")))


@query(trie.sql())
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turn prefixes that rebuilt conversations share, with sums over the subtrees of each."""
    ship_package(spark)
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


@query(repeats.sql())
def op13_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without the strings that begin earlier as well."""
    ship_package(spark)
    return repeats.without_repeats(table(spark, sf_dir, "documents"))
