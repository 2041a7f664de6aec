"""Files of a shard that arrive one by one: each is read once, and the outcome is that of a run over all."""

import os

import pytest

from helpers import read_ppm, sample, solid, write_tar
from tarweave.plans.captioning import caption_shards
from tarweave.plans.spec import run_spec
from tarweave.sources import tar


def arrive(folder, name, start, n=5):
    """A tar of samples, one of them without readable metadata."""
    entries = [e for i in range(start, start + n) for e in sample(f"k{i:03d}", solid(i % 7, 0.1), b"{broken" if i % 9 == 4 else {"i": i, "caption": f"c{i}"})]
    return write_tar(folder, name, entries)


FILES = [("a.tar", 0), ("b.tar", 100), ("a~00001.tar", 10), ("a~00002.tar", 20), ("b~00001.tar", 110)]


def config(folder, out, **more):
    return {"data_path": str(folder), "output_dir": str(out), "batch_size": 4, "num_workers": 1, "meta_key": "info.json", "img_key": "png", "txt_key": "caption", **more}


def table(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def same(one, other):
    assert table(one.rows, "shard", "pos", "key", "txt") == table(other.rows, "shard", "pos", "key", "txt")
    assert table(one.rejects, "shard", "pos", "key", "error") == table(other.rejects, "shard", "pos", "key", "error")
    assert table(one.counts, "shard", "rows_in", "rows_out", "rejected", "batches") == table(other.counts, "shard", "rows_in", "rows_out", "rejected", "batches")


def names(spark, *shards):
    return spark.createDataFrame([(s,) for s in shards], "shard string")


def test_each_entry_is_processed_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    step, seen = config(folder, tmp_path / "steps", save_tar=True), []
    for name, start in FILES:
        arrive(folder, name, start)
        out = run_spec(spark, step, shards=names(spark, name[0]), resume=True)
        seen.append(out.seen["samples"])
        # Offered again: nothing is new.
        if name in ("a~00001.tar", "b~00001.tar"):
            assert run_spec(spark, step, shards=names(spark, name[0]), resume=True).seen["samples"] == 0
    whole = run_spec(spark, config(folder, tmp_path / "once", save_tar=True))
    assert seen == [5] * 5 and whole.seen["samples"] == 25
    same(out, whole)
    assert table(out.rows, "shard", "key", "batch_id") == table(whole.rows, "shard", "key", "batch_id")
    # The tars hold the same samples, in files numbered on.
    keys = lambda at: {(r.shard, r.fname) for r in tar.scan(spark, str(at)).select("shard", "fname").collect()}
    assert keys(tmp_path / "steps") == keys(tmp_path / "once")
    assert sorted(f for f in os.listdir(tmp_path / "steps") if f.endswith(".tar")) == ["a.tar", "a~00001.tar", "a~00002.tar", "b.tar", "b~00001.tar"]
    # A file that has changed, or comes before others, makes its shard whole again.
    arrive(folder, "a~00001.tar", 30, n=6)
    again = run_spec(spark, step, shards=names(spark, "a", "b"), resume=True)
    assert again.seen["samples"] == 16
    same(again, run_spec(spark, config(folder, tmp_path / "twice")))
    arrive(folder, "b~00000.tar", 50)
    os.rename(folder / "b~00000.tar", folder / "c~00003.tar")
    run_spec(spark, step, shards=names(spark, "c"), resume=True)
    arrive(folder, "c~00002.tar", 60)
    assert run_spec(spark, step, shards=names(spark, "c"), resume=True).seen["samples"] == 10


def test_a_run_that_failed_is_not_gone_on_with(spark, tmp_path, monkeypatch):
    from tarweave.plans import spec as module

    folder = tmp_path / "in"
    folder.mkdir()
    step = config(folder, tmp_path / "steps")
    arrive(folder, "a.tar", 0)
    run_spec(spark, step, shards=names(spark, "a"), resume=True)
    arrive(folder, "a~00001.tar", 10)
    # Rows are added, then the run dies before the shard is finished.
    for lost in ("record_files", "add_manifest"):
        with monkeypatch.context() as patch:
            def die(*_):
                raise RuntimeError("lost")
            patch.setattr(module, lost, die)
            with pytest.raises(RuntimeError):
                run_spec(spark, step, shards=names(spark, "a"), resume=True)
        assert run_spec(spark, step, limit=0).counts.count() == 0
    out = run_spec(spark, step, shards=names(spark, "a"), resume=True)
    assert out.seen["samples"] == 10
    same(out, run_spec(spark, config(folder, tmp_path / "once")))


def test_captions_go_on(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    # Made here, so that workers get it whole: they don't know this module.
    make_model = lambda params: lambda prompts, images: [f"{p}!" for p in prompts]
    ask = lambda out, **kw: caption_shards(spark, "m", str(folder), "Say {txt}", make_model, output_dir=str(out), decode=read_ppm, batch_size=4, language_only_key="caption", **kw)
    for name, start in FILES[:4]:
        arrive(folder, name, start)
        out = ask(tmp_path / "steps", shards=names(spark, name[0]), resume=True)
    assert ask(tmp_path / "steps", shards=names(spark, "a"), resume=True).rows.count() == out.rows.count() > 0
    same(out, ask(tmp_path / "once"))
