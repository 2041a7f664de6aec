"""Pixel statistics, decoding, scores and features against plain numpy."""

import os
import struct
import uuid
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import ppm, read_ppm, solid
from tarweave import submit
from tarweave.functions.images import (
    channel_histogram,
    decode_image,
    dominance,
    is_monochromatic,
    is_not_monochromatic,
)
from tarweave.functions.text import clean_caption
from tarweave.operators.filters import FILTERS, apply_filters, keep_monochrome, register_filter, split_rejects
from tarweave.operators.generation import _answering, answered_in_stage, features, generate_captions, sampling_params
from tarweave.operators.scoring import align_captions, average_scores, clip_scores
from tarweave.schemas import IMAGE
from tarweave.sources.images import read_images
from tarweave.sources.tar import fetch


def images(spark, arrays):
    rows = [(i, ("", a.shape[0], a.shape[1], a.shape[2], 16, a.astype(np.uint8).tobytes())) for i, a in enumerate(arrays)]
    return spark.createDataFrame(rows, f"id int, image {IMAGE.simpleString()}")


def test_dominance_on_both_sides_of_the_thresholds(spark):
    shares = [1.0, 0.1, 0.6, 0.61, 0.8, 0.81, 0.95, 0.96]
    df = images(spark, [solid(i + 1, s) for i, s in enumerate(shares)])
    image = F.col("image")
    got = df.select("id", dominance(image).alias("d"), is_monochromatic(image).alias("m"),
                    is_not_monochromatic(image).alias("n"), is_monochromatic(image, 0.6).alias("l")).orderBy("id").collect()
    assert [round(r.d, 6) for r in got] == shares
    assert [r.m for r in got] == [s > 0.95 for s in shares]
    assert [r.n for r in got] == [not s > 0.8 for s in shares]
    assert [r.l for r in got] == [s > 0.6 for s in shares]
    kept = apply_filters(df, [{"type": "mono", "threshold": 0.8, "is_monochromatic": False}])
    assert sorted(r.id for r in kept.collect()) == [1, 2, 3, 4]
    assert sorted(r.id for r in apply_filters(df, [{"type": "mono"}]).collect()) == [0, 5, 6, 7]
    assert keep_monochrome(F.lit(0.8), 0.8, True) is not None


def test_histograms_and_unusable_images(spark):
    rng = np.random.default_rng(1)
    colour, four = rng.integers(0, 256, (5, 7, 3)), rng.integers(0, 256, (4, 4, 4))
    df = images(spark, [colour, four, rng.integers(0, 256, (4, 4, 1))])
    broken = df.limit(1).withColumn("id", F.lit(9)).withColumn("image", F.col("image").withField("height", F.lit(6)))
    got = {r.id: (r.h, r.d) for r in df.union(broken).select(
        "id", channel_histogram(F.col("image")).alias("h"), dominance(F.col("image")).alias("d")).collect()}
    for i, a in ((0, colour), (1, four)):
        counts = [np.bincount(a[:, :, c].ravel(), minlength=256).tolist() for c in range(3)]
        assert got[i][0] == counts and got[i][1] == max(map(max, counts)) / (a.shape[0] * a.shape[1])
    assert got[2] == (None, None) and got[9] == (None, None)


def test_decode_keeps_errors_and_turns_to_bgr(spark):
    rgb = np.arange(24).reshape(2, 4, 3)
    raw = [ppm(rgb), b"junk", None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, raw binary")
    rows = df.select("i", decode_image(F.col("raw"), read_ppm).alias("r")).orderBy("i").collect()
    assert rows[0].r.image.height == 2 and rows[0].r.image.width == 4 and rows[0].r.error is None
    assert bytes(rows[0].r.image.data) == np.ascontiguousarray(rgb[:, :, ::-1]).astype(np.uint8).tobytes()
    assert rows[1].r.image is None and rows[1].r.error and rows[2].r.error == "no image bytes"


def test_own_filters(spark):
    class Wide:
        def __init__(self, type, least):
            self.least = least

    register_filter("wide", Wide, lambda config: F.col("image.width") >= config.least)
    try:
        df = images(spark, [np.zeros((2, 3, 3)), np.zeros((2, 9, 3))])
        assert [r.id for r in apply_filters(df, [{"type": "wide", "least": 5}]).collect()] == [1]
    finally:
        del FILTERS["wide"]


def softmax_diagonal(i, t, scale):
    i, t = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (i, t))
    logits = scale * i @ t.T
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return np.diagonal(e) / e.sum(axis=1)


def test_scores_per_batch(spark):
    rng = np.random.default_rng(2)
    vectors = {(s, b): (rng.normal(size=(n, 6)), rng.normal(size=(n, 6))) for s, b, n in
               [("x", 0, 4), ("x", 1, 3), ("y", 0, 1)]}
    rows = [(s, b, 10 * b + k, i[k].tolist(), t[k].tolist()) for (s, b), (i, t) in vectors.items() for k in range(len(i))]
    rows += [("x", 0, 99, None, [0.0] * 6), ("z", 0, 0, [1.0], [1.0, 2.0]), ("z", 0, 1, [1.0], [1.0]),
             ("w", 0, 0, [0.0] * 6, [1.0] * 6)]
    df = spark.createDataFrame(rows, "shard string, batch_id int, pos long, image_vec array<float>, text_vec array<float>")
    scores = clip_scores(df, logit_scale=10.0)
    got = {(r.shard, r.batch_id, r.pos): r.clip_score for r in scores.collect()}
    assert len(got) == len(rows)
    for (s, b), (i, t) in vectors.items():
        expected = softmax_diagonal(i, t, 10.0)
        assert np.allclose([got[s, b, 10 * b + k] for k in range(len(i))], expected, atol=1e-5)
    assert all(got[k] is None for k in [("x", 0, 99), ("z", 0, 0), ("z", 0, 1), ("w", 0, 0)])
    means = {r.shard: r.avg_clip_score for r in average_scores(scores).collect()}
    assert means["y"] == 1.0 and means["z"] is None


def test_alignment_by_key_takes_the_last_caption(spark):
    pictures = spark.createDataFrame([("s", "a", 0), ("s", "b", 1)], "shard string, key string, pos long")
    captions = spark.createDataFrame([("s", "a", 0, "old"), ("s", "a", 5, "new"), ("s", "c", 1, "x")],
                                     "shard string, key string, pos long, txt string")
    assert align_captions(pictures, captions, ["shard", "key"]).select("key", "txt").collect() == [("a", "new")]
    assert align_captions(pictures, captions).select("pos", "txt").orderBy("pos").collect() == [(0, "old"), (1, "x")]


def test_features_and_a_failing_encoder(spark):
    def lengths():
        return lambda texts, numbers: np.stack([[len(t), n] for t, n in zip(texts, numbers)])

    def broken():
        def encode(texts):
            raise RuntimeError("no")

        return encode

    df = spark.createDataFrame([("ab", 1.0), ("abc", 2.0)], "t string, n double")
    got = df.select(features(lengths, F.col("t"), F.col("n")).alias("v"), features(broken, F.col("t")).alias("e")).collect()
    assert sorted(r.v for r in got) == [[2.0, 1.0], [3.0, 2.0]] and all(r.e == [None] for r in got)


def test_parameter_names():
    assert sampling_params(15, 0.1) == {"max_tokens": 15, "temperature": 0.1}
    assert sampling_params(15, 0.1, "open_clip") == {"max_seq_len": 15, "temperature": 0.1}
    with pytest.raises(ValueError):
        sampling_params(backend="other")


def png(rgb) -> bytes:
    """A plain PNG: one filter byte before each row."""
    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    rows = b"".join(b"\0" + row.astype(np.uint8).tobytes() for row in rgb)
    head = struct.pack(">IIBBBBB", rgb.shape[1], rgb.shape[0], 8, 2, 0, 0, 0)
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b""))


def test_loose_image_files(spark, tmp_path):
    folder = tmp_path / "album"
    folder.mkdir()
    (folder / "plain.v1.png").write_bytes(png(solid(5, 1.0)))
    (folder / "mixed.png").write_bytes(png(solid(6, 0.2)))
    (folder / "broken.png").write_bytes(b"nothing")
    rows = read_images(spark, str(folder)).select("shard", "key", dominance(F.col("image")).alias("d")).collect()
    assert sorted((r.shard, r.key, round(r.d, 6)) for r in rows) == [("album", "mixed", 0.2), ("album", "plain.v1", 1.0)]


def test_rejects_and_good_samples_are_written_at_once(spark, tmp_path):
    """A codec runs once for each image, and no pixels are written."""
    calls = str(tmp_path / "calls")
    os.makedirs(calls)

    def codec(raw):
        with open(f"{calls}/{uuid.uuid4().hex}", "w"):
            pass
        return read_ppm(raw)

    rows = [(i, ppm(solid(i, 0.1)) if i % 3 else b"no image") for i in range(12)]
    samples = spark.createDataFrame(rows, "id int, raw binary").select("id", decode_image(F.col("raw"), codec).alias("r"))
    samples = samples.select("id", F.col("r.image").alias("image"), F.map_from_arrays(F.array(F.lit("x")), F.array("r.image.data")).alias("m"), F.col("r.image.width").alias("w"), F.col("r.error").alias("error"))
    good, bad = split_rejects(samples)
    assert good.columns == ["id", "w"] and bad.columns == ["id", "w", "error"]
    assert sorted(map(tuple, good.collect())) == [(i, 10) for i in range(12) if i % 3]
    assert sorted((r.id, r.w, "not a PPM" in r.error or "unpack" in r.error) for r in bad.collect()) == [(i, None, True) for i in range(0, 12, 3)]
    assert len(os.listdir(calls)) == 12
    none, every = split_rejects(samples.where("error IS NOT NULL"))
    assert none.count() == 0 and every.count() == 4


def _stage_profile(df):
    """The resources of the stage in which a plan runs Python over batches."""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() != "MapInArrow":
        node = node.children().head()
    return node.profile().get().taskResources().apply("cpus").amount() if node.profile().isDefined() else None


def test_stages_with_resources_of_their_own(spark):
    profile = submit.stage_resources({"task_cpus": 3, "task_gpus": 0.5, "executor_cores": 6, "executor_memory": "4g", "executor_gpus": None, "gpu_script": "/find"})
    assert {k: v.amount for k, v in profile.taskResources.items()} == {"cpus": 3.0, "gpu": 0.5}
    assert {k: (v.amount, v.discoveryScript) for k, v in profile.executorResources.items()}["gpu"] == (1, "/find")
    none = dict.fromkeys(("task_cpus", "task_gpus", "executor_cores", "executor_memory", "executor_gpus", "gpu_script"))
    assert submit.stage_resources(dict(none)) is None
    cpus = submit.stage_resources(none | {"task_cpus": 3})

    samples = spark.createDataFrame([(1, "a", ppm(solid(1))), (2, None, ppm(solid(2))), (3, "c", b"no image")], "id int, prompt string, image binary")
    model = lambda: lambda prompts, images: [(f"<b>{p} {i.shape[0]}", 0.5) for p, i in zip(prompts, images)]
    asked = generate_captions(samples, model, "own", decode=read_ppm, profile=cpus)
    assert _stage_profile(asked) == 3
    slim = spark.createDataFrame([("/x.tar", {"jpg": (0, 5)})], "url string, parts map<string,struct<offset:long,size:long>>")
    assert _stage_profile(fetch(slim, None, [T.StructField("n", T.LongType())], lambda parts: ([0], 0), profile=cpus)) == 3
    assert _stage_profile(fetch(slim, None, [T.StructField("n", T.LongType())], lambda parts: ([0], 0))) is None
    # The rows are those of the stage without resources, which a local master can run.
    columns = ["id", "caption", "caption_error", "score"]
    answer = _answering(model, "other", 32, 1, 0, read_ppm)
    plain = generate_captions(samples, model, "other", tries=1, decode=read_ppm).select(columns).orderBy("id").collect()
    staged = answered_in_stage(samples, answer, "prompt", "image", None).select(
        "id", clean_caption(F.col("_answer.text")).alias("caption"), F.col("_answer.error").alias("caption_error"), F.col("_answer.score").alias("score")
    )
    assert staged.orderBy("id").collect() == plain and [r.caption for r in plain] == ["a 10", None, None]
