"""Token ids in Parquet list columns that can be read in part.

Documents lie in order of their ids over files in order of their names. Ids of
tokens are dictionary-encoded, document ids and lengths as deltas. Row groups
and pages are small enough, and carry indexes, that a range of documents or a
metadata column is read without the rest.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarweave.llm.spans import Numbered, Spans, id_lists, text_slices, worker_state
from tarweave.llm.words import text_bytes

#: Chunks of text that a worker remembers the ids of.
REMEMBERED = 800_000
FORMAT = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",  # deltas for whole numbers without a dictionary
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "5000",
}


#: Signs of which a run at the end of a chunk is a chunk of its own after a letter or digit.
TAILS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_TAIL, _PLAIN, _LATIN = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_TAIL[list(TAILS.encode())] = True
_PLAIN[ord("0"):ord("9") + 1] = _PLAIN[ord("a"):ord("z") + 1] = _PLAIN[ord("A"):ord("Z") + 1] = True
#: Second bytes, after 0xC3, of the letters from U+00C0 to U+00FF; two signs lie between them.
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False


class _Whole:
    """A text that is encoded whole, and known for as long as that takes."""

    def __init__(self, text: str):
        self.text = text


def _byte_signs() -> list[str]:
    """The sign that stands for each byte in byte-level vocabularies: itself where it is printable, else the next of those from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(others)) for b in range(256)]


class _Encoder:
    """Ids of texts by a tokenizer that drops white space, so that chunks between spaces and line ends encode alone.

    Different chunks of a block of texts are looked up once. A run of TAILS at the end
    of one, after a letter or digit, is a chunk of its own, as no piece has both. Latin
    words in lower case go to the tokenizer's model as they are, if its
    configuration says that a run of letters is a piece; the rest goes to the library.
    """

    #: A sign that between spaces is a piece by itself; it parts chunks that are encoded together.
    MARK = "\x01"
    TOGETHER = 256
    #: Up to here letters are composed, and their classes settled.
    LATIN = "\u024f"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Strings of added tokens are found anywhere in a text, before it is cut.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        normalizer = self.tokenizer.normalizer
        self.lowers = normalizer is not None and normalizer.normalize_str(letters) == letters.lower()
        self.model = self.tokenizer.model if self._words_are_pieces() else None
        self.signs = _byte_signs()
        self.mark = self._ids(self.MARK)
        self._forget()

    def _words_are_pieces(self) -> bool:
        """Whether texts are cut into runs of letters and others, and then taken byte by byte."""
        config = json.loads(self.tokenizer.to_str())
        steps = (config.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if [s.get("type") for s in steps] != ["Split", "ByteLevel"] or not self.lowers:
            return False
        cut, signs = steps
        runs = cut["pattern"].get("Regex", "").split("|")
        whole = cut["behavior"] == "Removed" and cut["invert"] and r"[\p{L}]+" in runs and all(r.startswith(("'", "[")) for r in runs)
        return whole and not signs["add_prefix_space"] and not signs["use_regex"] and config["model"]["type"] == "BPE" and not config["model"].get("dropout")

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _forget(self) -> None:
        self.known, self.spans = Numbered(), Spans()

    def _learn(self) -> None:
        new = self.known.take_new()
        found: list[list[int]] = [[]] * len(new)
        others = []
        for k, part in enumerate(new):
            if isinstance(part, _Whole):
                found[k], part.text = self._ids(part.text), None
            elif self.model is not None and part.isalpha() and (part.isascii() or max(part) <= self.LATIN) and part == part.lower():
                found[k] = [t.id for t in self.model.tokenize(part if part.isascii() else "".join(self.signs[b] for b in part.encode()))]
            elif part:
                others.append(k)
        for at in range(0, len(others), self.TOGETHER):
            own = others[at:at + self.TOGETHER]
            for k, ids in zip(own, self._together([new[k] for k in own])):
                found[k] = ids
        counts = np.fromiter(map(len, found), np.int64, len(found))
        self.spans.add(np.fromiter(chain.from_iterable(found), np.int32, counts.sum()), counts)

    def _together(self, chunks: list[str]) -> list[list[int]]:
        joined = f" {self.MARK} ".join(chunks)
        if len(self.mark) != 1 or joined.count(self.MARK) != len(chunks) - 1:
            return [self._ids(c) for c in chunks]
        found: list[list[int]] = [[]]
        for i in self._ids(joined):
            if i == self.mark[0]:
                found.append([])
            else:
                found[-1].append(i)
        if len(found) != len(chunks):
            raise ValueError("the tokenizer doesn't keep chunks between spaces apart")
        return found

    def encode(self, texts: pa.Array | list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts one after another, ``end_id`` after each, and how many each has."""
        if len(self.known) > REMEMBERED:
            self._forget()
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        special = np.zeros(len(texts), bool)
        for content in self.added:
            # In any case, as chunks are put into lower case and would become them.
            special |= pc.match_substring(texts, content, ignore_case=True).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(special), pa.scalar("", texts.type), texts) if special.any() else texts
        lists = pc.split_pattern(pc.replace_substring(plain, "\n", " "), " ")
        chunks = lists.flatten()
        chunks = (pc.ascii_lower(chunks) if self.lowers else chunks).dictionary_encode()
        raw, offsets = text_bytes(chunks.dictionary)
        ends = offsets[1:]
        # The last byte of each chunk that is none of TAILS; of an empty first chunk, there is none.
        last = np.append(np.maximum.accumulate(np.where(_TAIL[raw], -1, np.arange(len(raw)))), -1)[ends - 1]
        own = last >= offsets[:-1]
        after = own & _PLAIN[np.append(raw, 0)[last]]
        wide = np.flatnonzero(own & ~after & (last > offsets[:-1]))
        after[wide] = (raw[last[wide] - 1] == 0xC3) & _LATIN[raw[last[wide]]]
        length = np.where(after, ends - 1 - last, 0)
        cut = length > 0
        words = chunks.dictionary.to_pylist()
        tails = [self.known[words[k][-n:]] for k, n in zip(np.flatnonzero(cut).tolist(), length[cut].tolist())]
        heads = [c[:-n] if n else c for c, n in zip(words, length.tolist())]
        head = np.fromiter(map(self.known.__getitem__, heads), np.int32, len(heads))
        del heads, words, raw  # a worker holds little beside what it remembers
        tail = np.full(len(head), -1, np.int32)
        tail[cut] = tails
        codes = chunks.indices.to_numpy(zero_copy_only=False)
        first, second = head[codes], tail[codes]
        del codes, chunks
        size = 1 + (second >= 0)
        ends = np.cumsum(size)
        numbers = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
        numbers[ends - size] = first
        numbers[ends[second >= 0] - 1] = second[second >= 0]
        del first, second, size
        bounds = np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))
        at = np.append(0, ends)[bounds]
        for k in np.flatnonzero(special).tolist():
            numbers[at[k]] = self.known[_Whole(texts[k].as_py())]
        self._learn()
        ids, sizes = self.spans.gather(numbers, np.diff(at))
        return np.insert(ids, np.cumsum(sizes), end_id), sizes + 1


def encode(text: Column, path: str, end_id: int, block: int = 4 << 20) -> Column:
    """Ids of ``text`` by the tokenizer file at ``path`` and ``end_id`` after them; null is empty.

    For tokenizers that drop white space. No special tokens are added; strings of
    added tokens in a text are these tokens, as the library has it.
    """

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        known = worker_state("token files")
        if path not in known:
            known[path] = _Encoder(path)
        encoder = known[path]
        for texts in batches:
            yield id_lists([encoder.encode(part, end_id) for part in text_slices(texts, block)])

    return ids(text)


def in_order(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text`` dealt out and sorted by id; equal ids by their texts, so that many rows of one id spread."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    tie = F.xxhash64("text")
    return rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")


def write_tokens(df: DataFrame, path: str) -> None:
    """Write ``doc_id, ids`` (sorted, partition after partition) and their lengths."""
    df.select("doc_id", F.size("ids").alias("n_tokens"), "ids").write.mode("overwrite").options(**FORMAT).parquet(path)


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids`` of the files, or of the documents with ids from ``first`` to ``last``."""
    df = spark.read.schema("doc_id long, n_tokens int, ids array<int>").parquet(path)
    if first is not None:
        df = df.where(F.col("doc_id") >= first)
    return df if last is None else df.where(F.col("doc_id") <= last)


def _crc32(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        view, starts = memoryview(flat).cast("B"), np.append(0, ends[:-1])
        crcs = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(crcs, pa.int64())], ["doc_id", "n_tokens", "file", "row", "ids_crc32"])


def positions(spark: SparkSession, path: str) -> DataFrame:
    """What the files hold: ``doc_id, start, n_tokens, ids_crc32`` of each document.

    ``start`` counts the ids of all documents before. It is summed within each
    file, and over the totals of files: one row for each file.
    """
    rows = (
        read_tokens(spark, path)
        .select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"), "ids")
        .mapInArrow(_crc32, "doc_id long, n_tokens long, file string, row long, ids_crc32 long")
    )
    lengths = spark.read.schema("n_tokens int").parquet(path).select("n_tokens", F.col("_metadata.file_name").alias("file"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = lengths.groupBy("file").agg(F.sum("n_tokens").alias("total")).select("file", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("within", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(files, "file")
        .select("doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
    )
