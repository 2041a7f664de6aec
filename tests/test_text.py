"""Column functions against plain Python on awkward strings."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tarweave.functions import text as X

NAME = re.compile(r"^((?:.*/|)[^.]+)[.]([^/]*)$")


def column(spark, values, build):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r.out for r in rows.select("i", build(F.col("v")).alias("out")).orderBy("i").collect()]


def without_tags(text):
    """A tag is from "<" to the next ">" of the line; what is left of these signs goes too."""
    out, i = [], 0
    while i < len(text):
        if text[i] == "<":
            end, line = text.find(">", i), text.find("\n", i)
            if end >= 0 and not 0 <= line < end:
                i = end
        elif text[i] != ">":
            out.append(text[i])
        i += 1
    return "".join(out)


def test_clean_caption(spark):
    rng = random.Random(5)
    texts = ["a<b\nc>d", "<<x>>y", "a<b\rc>d", "1 < 2", "</p>", "<", "é<b>ü</b>", ""]
    texts += ["".join(rng.choice("<>/ab\n\r é") for _ in range(rng.randrange(30))) for _ in range(300)]
    plain = [without_tags(t) for t in texts]
    assert plain[:4] == ["ab\ncd", "y", "ad", "1  2"]
    assert column(spark, texts, X.clean_caption) == plain


def test_entry_names(spark):
    rng = random.Random(6)
    names = ["b/c.info.json", "nodot", "d.e/f.g.h", "a/.hidden", "a.", ".x", "x.JPG", "p.q/r"]
    names += ["".join(rng.choice("ab./ -_é") for _ in range(rng.randrange(1, 12))) for _ in range(300)]
    matches = [NAME.match(n) for n in names]
    assert column(spark, names, X.entry_prefix) == [m and m.group(1) for m in matches]
    assert column(spark, names, X.entry_suffix) == [m and m.group(2).lower() for m in matches]
    assert column(spark, ["A.JPG"], lambda c: X.entry_suffix(c, lower=False)) == ["JPG"]


def test_shard_and_model_names(spark):
    assert column(spark, ["/a/b/00000.tar", "x.y.tar", "s"], X.shard_name) == ["00000", "x.y", "s"]
    assert column(spark, ["/m/org/name", "org/name", "name"], X.model_key) == ["org/name", "org/name", "name"]


def test_decoded_text(spark):
    texts = ["<start_of_text> a b \x85　<end_of_text>x<end_of_text>", "\x1c\xa0a<start_of_text>", "<end_of_text>a", "a​b"]
    plain = [t.split("<end_of_text>")[0].replace("<start_of_text>", "").strip() for t in texts]
    assert column(spark, texts, X.decoded_text) == plain
    every = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    assert sorted(every) == sorted(X.WHITE_SPACE)


def test_prompts(spark):
    assert column(spark, ["{txt}!", None], lambda c: X.fill_prompt("a {{x}} {txt}", c)) == ["a {x} {txt}!", None]
    assert column(spark, ["é" * 5], lambda c: X.truncate_prompt(c, 3)) == ["ééé"]
    assert column(spark, ["q {question}"], lambda c: X.chat_prompt(F.lit("x/OpenGVLab/InternVL2_5-2B"), c)) == [
        "Image: <image>\nCaption: q {question}\n\n"]
    assert column(spark, ["q"], lambda c: X.chat_prompt(F.lit("no/body"), c)) == ["q"]
    for template in ("{other}", "{}", "{txt!r}", "{txt:>3}"):
        with pytest.raises(ValueError):
            X.fill_prompt(template, F.lit(""))


def test_captions_from_metadata(spark):
    texts = ['{"a": 1}', '{"a": null}', '{"b": 2}', "not json", '{"a": "x y"}', None]
    assert column(spark, texts, lambda c: X.caption_from_meta(c, "a")) == ["1", "", "", "", "x y", ""]
    assert column(spark, texts[:1], lambda c: X.caption_from_meta(c, None)) == [""]
    assert column(spark, texts, lambda c: X.has_json_field(c, "a")) == [True, True, False, False, True, False]


def test_score_label(spark):
    assert column(spark, ["c"], lambda c: X.score_label(c, F.lit(0.1249))) == ["c [0.12]"]
