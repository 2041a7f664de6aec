"""License scans by an exact set-similarity join, in DataFrame functions only.

Text blocks are windows of ``2 * STRIDE`` words, ``STRIDE`` apart, so every run of
up to ``STRIDE`` words lies whole in one of them. A block meets a template when it
contains a share of the template's different words, the template's threshold at
least. Words of templates are ordered by how often the corpus has them, rarest
first. A block that meets a template of ``m`` words, ``need`` of them required, has
one of its first ``m - need + 1`` words (prefix filter) and ``need`` words of
templates at all (length filter). After the first word they share, in that order,
both have enough words left (positional filter). What passes is compared in full.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarweave.llm.common import lower_ascii, stage

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases whose words have to stand one after another: fixed values.
PHRASES = [
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
    ("mit", "under the mit license"),
]
#: Statements of which a block has to hold a share of the words.
STATEMENTS = [
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("proprietary", "all rights reserved no part of this may be reproduced without permission"),
]
THRESHOLD = 0.8
STRIDE = 32


def _templates() -> list[tuple[int, str, bool, list[str], int]]:
    """``(number, label, is a phrase, words, different words needed)``."""
    out = []
    for label, text in PHRASES + STATEMENTS:
        words, phrase = text.split(" "), len(out) < len(PHRASES)
        out.append((len(out), label, phrase, words, len(set(words)) if phrase else math.ceil(THRESHOLD * len(set(words)) - 1e-9)))
    return out


def words_of(text: Column) -> Column:
    """The words of ``text`` with A-Z in lower case; null has none."""
    return F.regexp_extract_all(lower_ascii(text), F.lit(f"({WORD})"), F.lit(1))


def _rarest_first(df: DataFrame, text: Column) -> list[str]:
    """The words of all templates by how often the texts have them: as many rows as the templates have words."""
    vocabulary = sorted({w for t in _templates() for w in t[3]})
    counts = df.select(F.explode(words_of(text)).alias("word")).where(F.col("word").isin(vocabulary)).groupBy("word").count()
    found = {r["word"]: r["count"] for r in counts.collect()}
    return sorted(vocabulary, key=lambda w: (found.get(w, 0), w))


def _index(spark: SparkSession, ordered: list[str]) -> DataFrame:
    """``word, place, template, label, phrase, words, need, m``: the prefix words of the templates."""
    rows = []
    for n, label, phrase, words, need in _templates():
        own = sorted(set(words), key=ordered.index)
        for place, word in enumerate(own[:len(own) - need + 1], 1):
            rows.append(F.struct(
                F.lit(word).alias("word"), F.lit(place).alias("place"), F.lit(n).alias("template"), F.lit(label).alias("label"),
                F.lit(phrase).alias("phrase"), F.array(*map(F.lit, words)).alias("words"), F.lit(need).alias("need"), F.lit(len(own)).alias("m"),
            ))
    return spark.range(1).select(F.explode(F.array(*rows)).alias("t")).select("t.*")


def license_blocks(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """All rows and the blocks that meet a template.

    The first frame has ``id, print, n_words`` for every row of ``df`` (``print`` is
    a hash of its text); the second ``id, print, block, template, label, containment,
    places``, where ``places`` are the first words of a phrase that stands there,
    and phrases without a place are left out. Null texts have no words. Rows
    repeated with one id and text have equal rows here.
    """
    spark = df.sparkSession
    text = F.col(text_col)
    ordered = _rarest_first(df, text)
    index = _index(spark, ordered)
    rare = sorted({w for _, _, _, words, need in _templates() for w in sorted(set(words), key=ordered.index)[:len(set(words)) - need + 1]})
    words = df.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("print"), words_of(text).alias("words"))
    hits = F.filter(F.transform("words", lambda w, i: F.when(w.isin(rare), i)), lambda p: p.isNotNull())
    at = F.transform(hits, lambda p: (p / STRIDE).cast("int"))
    blocks = F.filter(F.array_distinct(F.concat(at, F.transform(at, lambda b: b - 1))), lambda b: b >= 0)
    rows = stage(
        words.withColumn("n_words", F.size("words").cast("long")).withColumn("blocks", blocks)
        .withColumn("blocks", F.transform("blocks", lambda b: F.struct(b.alias("block"), F.slice("words", b * STRIDE + 1, 2 * STRIDE).alias("words"))))
        .drop("words"),
        "blocks",
    )
    known = F.array_intersect(F.array(*map(F.lit, ordered)), "held")  # words of templates, rarest first
    met = (
        rows.select("id", "print", F.explode("blocks").alias("b")).select("id", "print", "b.block", F.col("b.words").alias("held"))
        .withColumn("known", known)
        .withColumn("word", F.explode("known"))
        .join(F.broadcast(index), "word")  # at most the words of the templates
        .groupBy("id", "print", "block", "template")
        .agg(F.min("place").alias("place"), F.min_by("word", "place").alias("word"), *(F.first(c).alias(c) for c in ("held", "known", "label", "phrase", "words", "need", "m")))
        .where(F.size("known") >= F.col("need"))
        .where(1 + F.least(F.col("m") - F.col("place"), F.size("known") - F.array_position("known", F.col("word"))) >= F.col("need"))
        .withColumn("shared", F.size(F.array_intersect("words", "known")))
        .where("shared >= need")
        .withColumn("containment", F.col("shared") / F.col("m"))
    )
    starts = F.expr(
        "filter(transform(sequence(1, greatest(size(held) - size(words) + 1, 1)), "
        f"i -> IF(slice(held, i, size(words)) = words, CAST(block AS LONG) * {STRIDE} + i - 1, NULL)), p -> p IS NOT NULL)"
    )
    met = met.withColumn("places", F.when(F.col("phrase"), starts)).where("NOT phrase OR size(places) > 0")
    return rows.select("id", "print", "n_words"), met.select("id", "print", "block", "template", "label", "containment", "places")


def license_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: its license phrases and labels.

    ``<id_col>, n_words, n_base, first_word, last_word, base_labels, labels, score``:
    places of the phrases, their first and last word number (null without one), the
    labels of phrases, those of phrases and statements, and the largest
    containment found, 0 without any. Null texts are empty; other columns are not
    looked at.
    """
    rows, met = license_blocks(df, id_col, text_col)
    labels = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    found = met.withColumn("place", F.explode_outer("places")).groupBy("id", "print").agg(
        F.countDistinct("label", "place").alias("n_base"),
        F.min("place").alias("first_word"),
        F.max("place").alias("last_word"),
        labels(F.when(F.col("place").isNotNull(), F.col("label"))).alias("base_labels"),
        labels("label").alias("labels"),
        F.max("containment").alias("score"),
    )
    found = found.withColumnsRenamed({"id": "_id", "print": "_print"})
    return rows.join(found, F.col("id").eqNullSafe(F.col("_id")) & (F.col("print") == F.col("_print")), "left").select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def brute_force_sql() -> str:
    """DuckDB SQL for :func:`license_scan` over ``documents``: every block against every template."""
    quote = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    values = ", ".join(f"({n}, '{label}', {phrase}, {quote(words)}, {need})" for n, label, phrase, words, need in _templates())
    return rf"""
    WITH t AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS words
      FROM documents),
    templates(n, label, phrase, want, need) AS (VALUES {values}),
    b AS (
      SELECT doc_id, k, words[k * {STRIDE} + 1 : k * {STRIDE} + {2 * STRIDE}] AS held
      FROM (SELECT doc_id, words, unnest(range((len(words) + {STRIDE - 1}) // {STRIDE})) AS k FROM t)),
    met AS (
      SELECT doc_id, label, len(list_distinct(list_intersect(want, held))) / len(list_distinct(want)) AS containment,
             CASE WHEN phrase THEN [k * {STRIDE} + i - 1 FOR i IN range(1, len(held) + 1) IF held[i : i + len(want) - 1] = want] END AS places, phrase
      FROM b, templates WHERE len(list_distinct(list_intersect(want, held))) >= need),
    p AS (SELECT doc_id, label, containment, unnest(CASE WHEN phrase THEN places ELSE [NULL::BIGINT] END) AS place FROM met WHERE NOT phrase OR len(places) > 0),
    f AS (
      SELECT doc_id, count(DISTINCT (label, place)) FILTER (place IS NOT NULL) AS n_base, min(place) AS first_word, max(place) AS last_word,
             coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (place IS NOT NULL), '') AS base_labels,
             string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(containment) AS score
      FROM p GROUP BY doc_id)
    SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
           coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
    FROM t LEFT JOIN f USING (doc_id)
    """
