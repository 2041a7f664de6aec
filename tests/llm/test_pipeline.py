"""The corpus pipeline, stage by stage, against brute force on a small corpus."""

import random

import public_tokenizers
import tiktoken

import corpus_pipeline
from tarweave.llm import bpe, quality, weighted_minhash
from tarweave.session import ship_package, stage
from test_copies import brute_near  # beside this file

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rnd = random.Random(12)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(2, 8))) for _ in range(600)]
    line = lambda k: " ".join(rnd.choice(words) for _ in range(k))
    good = ["\n".join(line(rnd.randrange(5, 20)) for _ in range(rnd.randrange(2, 9))) for _ in range(60)]
    bad = ["\n".join(line(rnd.randrange(5, 12)).upper().replace(" ", "!! ") for _ in range(4)) for _ in range(20)]
    items = [line(25).capitalize() + "." for _ in range(6)]
    texts = good + bad
    texts += [good[0], good[1].upper().lower(), good[2].replace(good[2].split()[20], "changed", 1)]
    texts += [f"{good[3]}\n{items[0]}", f"{line(30)} {items[1].lower()} {line(12)}", f"{good[4]} extra", ""]
    docs = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts)] + [(900, None, None, None, None)]
    labels = [(i, int(not 60 <= i < 80), 0) for i in range(80)]
    return docs, labels, list(enumerate(items))


def test_every_stage(spark, tmp_path):
    ship_package(spark)
    docs, labels, items = corpus()
    for name, rows, schema in (("documents", docs, SCHEMA), ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    now, given = spark.read.parquet(str(tmp_path / "documents.parquet")), {r[0]: r[1] for r in docs}
    seen = {}
    for name, apply in corpus_pipeline.STAGES[:-1]:
        now = stage(apply(spark, now, str(tmp_path)), name)
        assert now.columns == [c.split()[0] for c in SCHEMA.split(", ")]
        seen[name] = {r.doc_id for r in now.collect()}
    assert not seen["quality"] & set(range(60, 80)) and set(range(60)) <= seen["quality"]
    latest = {}
    for i in sorted(seen["quality"]):
        latest[(given[i] or "").lower()] = i
    assert seen["exact"] == set(latest.values())
    rows = [(i, given[i]) for i in sorted(seen["exact"])]
    weights = weighted_minhash.rarity(spark.createDataFrame(rows, "doc_id long, text string"))
    assert seen["near"] == set(brute_near(rows, weights).values())
    clean = {i for i in seen["near"] if not any(t.lower().rstrip(".") in (given[i] or "").lower() for _, t in items)}
    assert seen["benchmark"] == clean and clean < seen["near"]
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    assert {r.doc_id for r in out} == clean
    assert all(list(r.ids) == library.encode_ordinary(given[r.doc_id] or "") and r.round_trip and r.n_tokens == len(r.ids) for r in out)


def test_no_documents(spark, tmp_path):
    for name, schema in (("documents", SCHEMA), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert quality.train(spark.read.parquet(str(tmp_path / "documents.parquet")), spark.read.parquet(str(tmp_path / "labels.parquet"))) == 0.5
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
