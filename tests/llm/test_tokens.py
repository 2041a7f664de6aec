"""Encoders against the libraries they agree with, decoding, and the token files."""

import inspect
import random
import re
import resource
import tracemalloc
import weakref
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import tiktoken
from pyspark.sql import functions as F

from tarweave.llm import bpe, spans, token_files
from tarweave.session import ship_package, split_uri, work_dir

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
SIGNS = "ab cdé \n\t  日本'sll12½Ⅷ!?.,\x1c\x85  ́𝒳\r\n<|endoftext|>\x01"


def odd_texts(n=1500, seed=3):
    rnd = random.Random(seed)
    made = ["".join(rnd.choice(SIGNS) for _ in range(rnd.randrange(60))) for _ in range(n)]
    return made + ["", " ", "   ", "a ", " a", "\n\n a", "a  b", "x" * 3000, "abcdefgh" * 900, "we're they'll I'd", "<|endoftext|>", "a \x01 b"]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_ids_are_those_of_the_library(library):
    texts = odd_texts()
    encoder = bpe._Encoder(RANKS, public_tokenizers.PATTERN)
    for _ in range(2):  # the second time from memory
        ids, counts = encoder.encode(texts)
        ends = np.cumsum(counts)
        for text, count, end in zip(texts, counts, ends):
            assert ids[end - count:end].tolist() == library.encode_ordinary(text), repr(text)
    assert bpe.vocabulary(RANKS).decode(ids, counts) == [t.encode() for t in texts]


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    encoder = bpe._Encoder(RANKS, public_tokenizers.PATTERN)
    for text in odd_texts(60, 5):
        assert encoder.encode([text])[0].tolist() == library.encode_ordinary(text)


def test_few_queries_merge_many_pieces():
    words, met = bpe.vocabulary(RANKS), []
    rnd = random.Random(4)
    pieces = list({"".join(rnd.choice("abcdeé") for _ in range(9)).encode() for _ in range(20_000)})
    for own, ids, counts in words.encode(pieces):
        if counts.size and own:
            ends = np.cumsum(counts)
            met.append([(pieces[i], ids[e - c:e]) for i, c, e in zip(own, counts.tolist(), ends.tolist())])
    assert sum(map(len, met)) == len(pieces)
    tokens = {i: t for t, i in words.ranks.items()}
    assert all(b"".join(tokens[i] for i in ids.tolist()) == piece for block in met for piece, ids in block)
    assert len(met) <= 2  # those that are tokens, and one query for all others


def test_a_step_joins_the_tokens_of_pieces_once_with_the_merges_and_once_with_what_goes():
    words = bpe.vocabulary(RANKS)
    pieces = {name: pa.array([0, 0], kind) for name, kind in (("w", pa.int32()), ("pos", pa.int32()), ("id", pa.int32()), ("pair", pa.int64()))}
    words.db.register("pieces", pa.table(pieces))
    ((_, plan),) = words.db.execute("EXPLAIN " + bpe._ENCODE).fetchall()
    words.db.unregister("pieces")
    assert re.sub("[ _]", "", plan).upper().count("HASHJOIN") == 2


def test_rows_of_a_block_go_out_before_the_next_is_encoded(library, monkeypatch):
    done, encode = [], bpe._Encoder.encode
    monkeypatch.setattr(bpe._Encoder, "encode", lambda self, texts: done.append(len(texts)) or encode(self, texts))
    texts = pa.array(["one two", None, "three", "", "four five"])
    rows, ends = [], []
    for part in bpe._round_trips(iter([texts, texts[:0]]), RANKS, public_tokenizers.PATTERN, 8):
        rows += part.to_pylist()
        ends.append((len(rows), sum(done)))
    assert len(ends) > 1 and all(out == read for out, read in ends)
    assert [(r["ids"], r["raw"]) for r in rows] == [(library.encode_ordinary(t or ""), (t or "").encode()) for t in texts.to_pylist()]


def test_long_pieces_merge_in_the_same_order(library):
    words = bpe.vocabulary(RANKS)
    rnd = random.Random(1)
    for size in (1, 2, 50, 399, 1200):
        piece = "".join(rnd.choice("abcdeé") for _ in range(size)).encode()
        assert words._merge_long(piece) == library._core_bpe.encode_single_piece(piece)


def test_round_trip_with_nulls_and_other_columns(spark):
    ship_package(spark)
    rows = [(1, None, "x"), (2, "", "y"), (None, "Hello  world\n", None), (4, "a" * 50_000 + " b" * 50_000, "z"), (4, "twice", "z"), (4, "twice", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, decoded string")
    out = df.withColumn("ids", bpe.encode(F.col("text"), RANKS, public_tokenizers.PATTERN)).withColumn("raw", bpe.decode(F.col("ids"), RANKS))
    got = sorted((r.text or "", bytes(r.raw).decode()) for r in out.collect())
    assert got == sorted((t or "", t or "") for _, t, _ in rows)
    both = df.withColumn("t", bpe.round_trip(F.col("text"), RANKS, public_tokenizers.PATTERN)).collect()
    assert sorted((r.text or "", bytes(r.t.raw).decode()) for r in both) == got
    assert sorted(tuple(r.t.ids) for r in both) == sorted(tuple(r.ids) for r in out.collect())
    nothing = spark.createDataFrame([], "ids array<int>")
    assert nothing.select(bpe.decode(F.col("ids"), RANKS)).count() == 0
    assert bytes(spark.createDataFrame([(None,)], "ids array<int>").select(bpe.decode(F.col("ids"), RANKS)).first()[0]) == b""


def test_word_ids_are_those_of_the_library():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(WORDS)
    texts = odd_texts(seed=8) + ["hello <|endoftext|> world", "<|endoftext|><|startoftext|>a", "<|ENDOFTEXT|> <|endoftext|", "x. y.. z?! Ärger, über. ñandú; l'été: it's. 3.5, ﬁne. ÀÉ İs ΣΑΣ. σας, 日本. ª.", "K. K, É. É."]
    texts += ["".join(chr(c) for c in range(a, a + 64)) for a in range(33, 0x2000, 64)] + [" ".join(chr(c) + "." for c in range(33, 0x400))]
    ids, counts = token_files._Encoder(WORDS).encode(texts, 2)
    ends = np.cumsum(counts)
    for text, count, end in zip(texts, counts, ends):
        assert ids[end - count:end].tolist() == plain.encode(text, add_special_tokens=False).ids + [2], repr(text)


def test_blocks_take_little_memory_beside_what_is_remembered():
    size = inspect.signature(token_files.encode).parameters["block"].default
    texts, encoder = ["so it is, as we are. " * (size // 21 // 4)] * 4, token_files._Encoder(WORDS)
    tracemalloc.start()
    encoder.encode(texts, 2)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 160 << 20


def test_a_block_of_a_round_trip_takes_little_memory():
    size = inspect.signature(bpe.round_trip).parameters["block"].default
    texts = pa.array(["so it is, as we are. " * (size // 21 // 4)] * 4)
    next(bpe._round_trips(iter([texts[:1]]), RANKS, public_tokenizers.PATTERN, size))
    tracemalloc.start()
    assert sum(map(len, bpe._round_trips(iter([texts]), RANKS, public_tokenizers.PATTERN, size))) == 4
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 60 << 20, peak


def test_token_files(spark):
    ship_package(spark)
    rows = [(i * 7 % 2003, f"text number {i} " * (i % 9)) for i in range(2003)] + [(5, "again"), (5, "again"), (None, "no id"), (3000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash"))
    path = work_dir(spark, "tokens")
    docs = token_files.in_order(df, "doc_id", "text")
    token_files.write_tokens(docs.select("doc_id", token_files.encode(F.col("text"), WORDS, 2).alias("ids")), path)
    encoder, start = token_files._Encoder(WORDS), 0
    want = []
    found = sorted(token_files.positions(spark, path).collect(), key=lambda r: r.start)
    by_text = {t: encoder.encode([t or ""], 2)[0] for _, t in rows}
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.ids_crc32) for r in found) == sorted((i is not None, i or 0, zlib.crc32(by_text[t].astype("<u4").tobytes())) for i, t in rows)
    for row in found:
        assert row.start == start
        start += row.n_tokens
        want.append(row.doc_id)
    assert want == sorted(want, key=lambda i: (i is not None, i or 0))
    part = token_files.read_tokens(spark, path, 100, 110)
    assert sorted(r.doc_id for r in part.collect()) == list(range(100, 111))
    fs, inner = split_uri(path)
    names = [f.path for f in fs.get_file_info(__import__("pyarrow.fs").fs.FileSelector(inner)) if f.path.endswith(".parquet")]
    column = pq.ParquetFile(names[0], filesystem=fs).metadata.row_group(0)
    assert {column.column(k).path_in_schema: column.column(k).has_offset_index for k in range(3)}["doc_id"]
    assert any("DICTIONARY" in e for e in column.column(2).encodings) and "DELTA_BINARY_PACKED" in column.column(0).encodings


def test_no_documents(spark):
    ship_package(spark)
    path = work_dir(spark, "tokens")
    empty = spark.createDataFrame([], "doc_id long, text string")
    token_files.write_tokens(token_files.in_order(empty, "doc_id", "text").select("doc_id", token_files.encode(F.col("text"), WORDS, 2).alias("ids")), path)
    assert token_files.positions(spark, path).count() == 0


def test_a_worker_lets_go_of_what_another_operator_remembers():
    first = spans.worker_state("a")
    first["x"] = 1
    assert spans.worker_state("a") is first
    assert spans.worker_state("b") == {} and spans.worker_state("a") == {}
    words = bpe.vocabulary(RANKS)
    assert bpe.vocabulary(RANKS) is words
    gone = weakref.ref(words)
    del words
    spans.worker_state("near copies")
    assert gone() is None


def test_a_worker_gives_back_what_was_freed_between_what_it_holds():
    held = lambda: int(open("/proc/self/statm").read().split()[1]) * resource.getpagesize()
    spans.worker_state("c")
    before = held()
    blocks = [np.ones(60 << 10, np.uint8) for _ in range(2000)]
    blocks = blocks[::100]
    spans.worker_state("d")
    assert held() - before < 60 << 20 and len(blocks) == 20


def test_signs_after_a_word_do_not_send_it_to_the_library(monkeypatch):
    encoder, sent, together = token_files._Encoder(WORDS), [], token_files._Encoder._together
    monkeypatch.setattr(token_files._Encoder, "_together", lambda self, chunks: sent.extend(chunks) or together(self, chunks))
    texts = ["", "word$$$ été. größe.,%%% Word!! naïve\n(986)", "a×, b÷- ab…. é́, it's. 'tis' x' $$$ x÷", "\u0301. e\u0301.", ".", "É!!! ȿ,", "don't.\"", "a_b__ <|x|> 2½.", ""]
    ids, sizes = encoder.encode(texts, 2)
    want = [[*encoder._ids(t), 2] for t in texts]
    assert ids.tolist() == [i for w in want for i in w] and sizes.tolist() == [len(w) for w in want]
    assert encoder.encode([""], 2)[0].tolist() == [2] and encoder.encode([], 2)[1].tolist() == []
    assert not {"word$$$", "été.", "größe.,%%%", "word!!"} & set(sent)
