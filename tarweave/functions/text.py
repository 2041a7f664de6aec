"""Column expressions for names, prompts and captions. All stay in the JVM."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prompt shapes the supported models were trained with, and the
# models each belongs to. ``{question}`` is the only slot.
DEEPSEEK_VL2 = "<|User|>: <image>\n{question}\n\n<|Assistant|>:"
IDEFICS3 = "<|begin_of_text|>User:<image>{question}<end_of_utterance>\nAssistant:"
INTERNVL = "Image: <image>\nCaption: {question}\n\n"
QWEN2_5_VL = (
    "<|im_start|>system\nYou are a helpful assistant.<|im_end|>\n"
    "<|im_start|>user\n<|vision_start|><|image_pad|><|vision_end|>{question}<|im_end|>\n"
    "<|im_start|>assistant\n"
)
PALIGEMMA = "caption en"
PHI3V = "<|user|>\n<|image_1|>\n{question}<|end|>\n<|assistant|>\n"
TEMPLATES = {
    "Qwen/Qwen2.5-VL-3B-Instruct": QWEN2_5_VL,
    "BytedanceDouyinContent/SAIL-VL-2B": QWEN2_5_VL,
    "OpenGVLab/InternVL2_5-2B-MPO": INTERNVL,
    "OpenGVLab/InternVL2_5-2B": INTERNVL,
    "OpenGVLab/InternVL2_5-1B": INTERNVL,
    "microsoft/Phi-3.5-vision-instruct": PHI3V,
    "deepseek-ai/deepseek-vl2-tiny": DEEPSEEK_VL2,
    "HuggingFaceTB/SmolVLM-Instruct": IDEFICS3,
    "google/paligemma2-3b-pt-448": PALIGEMMA,
}

# Greedy folders, then the base name up to its first dot, then the extension.
# ``[^\n]`` because Java's dot also stops at other line ends.
ENTRY_NAME = r"^((?:[^\n]*/|)[^.]+)[.]([^/]*)$"

# The characters Python's ``str.strip`` removes.
WHITE_SPACE = (
    "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def entry_prefix(fname: Column) -> Column:
    """Sample key of a tar entry; null when the name has no extension."""
    return F.when(F.rlike(fname, F.lit(ENTRY_NAME)), F.regexp_extract(fname, ENTRY_NAME, 1))


def entry_suffix(fname: Column, lower: bool = True) -> Column:
    """Part name of a tar entry; null when the name has no extension."""
    suffix = F.regexp_extract(fname, ENTRY_NAME, 2)
    return F.when(F.rlike(fname, F.lit(ENTRY_NAME)), F.lower(suffix) if lower else suffix)


def shard_name(path: Column) -> Column:
    return F.regexp_replace(F.substring_index(path, "/", -1), r"\.tar$", "")


def model_key(path: Column) -> Column:
    return F.substring_index(path, "/", -2)


def clean_caption(caption: Column) -> Column:
    """Drop tags that close on their own line, then any angle bracket left."""
    return F.translate(F.regexp_replace(caption, r"<[^>\n]*>", ""), "<>", "")


def chat_prompt(model_path: Column, question: Column, templates: dict[str, str] = TEMPLATES) -> Column:
    """The question in its model's prompt shape; as it is for other models."""
    table = F.create_map(*[F.lit(x) for pair in templates.items() for x in pair])
    template = F.coalesce(F.try_element_at(table, model_key(model_path)), F.lit("{question}"))
    return F.replace(template, F.lit("{question}"), question)


def fill_prompt(template: str, txt: Column) -> Column:
    """``template`` with the row's text in ``{txt}``; doubled braces are literal.

    The template is parsed while the plan is built, so braces inside the text
    are never read as slots.
    """
    pieces = []
    for literal, field, spec, conversion in Formatter().parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if field is not None:
            if field != "txt" or spec or conversion:
                raise ValueError(f"only a plain {{txt}} slot is allowed, got {field!r}")
            pieces.append(txt.cast("string"))
    return F.concat(*pieces) if pieces else F.lit("")


def truncate_prompt(prompt: Column, max_chars: int = 4096) -> Column:
    return F.substring(prompt, 1, max_chars)


def strip_text(text: Column) -> Column:
    return F.trim(text, F.lit(WHITE_SPACE))


def decoded_text(text: Column) -> Column:
    """Token-decoder output: up to the end mark, without start marks, stripped."""
    body = F.substring_index(text, "<end_of_text>", 1)
    return strip_text(F.replace(body, F.lit("<start_of_text>"), F.lit("")))


def score_label(caption: Column, score: Column) -> Column:
    return F.format_string("%s [%.2f]", caption, score)


def caption_from_meta(json: Column, txt_key: str | None) -> Column:
    """The metadata field as text; an absent, null or unset field gives ``''``."""
    if not txt_key:
        return F.lit("")
    return F.coalesce(json_field(json, txt_key), F.lit(""))


def json_field(json: Column, name: str) -> Column:
    """One top-level field as text; null when absent, null or not JSON."""
    if "'" in name:
        raise ValueError(f"no quotes in metadata fields: {name!r}")
    return F.get_json_object(json, f"$['{name}']")


def has_json_field(json: Column, name: str) -> Column:
    """True when the object has the field, even as null."""
    return F.coalesce(F.array_contains(F.json_object_keys(json), name), F.lit(False))
