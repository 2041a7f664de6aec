"""Byte-level BPE encoding and decoding by recursive queries in DuckDB.

Within a task, texts are cut into pieces by the pattern, and pieces not met
before are encoded together: one row per token of a piece and its position,
joined with the merge table (pairs of tokens whose bytes together are a token).
Each step of the recursion contracts, in every piece, the leftmost pair of the
smallest rank, until no pair merges. Decoding joins token rows with the
vocabulary and concatenates in order of position.

Pieces are short (a word and the space before it). What a Python worker has
encoded it keeps up to a bound, as words come again in later batches.
"""

from __future__ import annotations

import base64
import heapq
import re
import tempfile
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from tarweave.llm.spans import Numbered, Spans, id_lists, text_blocks, worker_state
from tarweave.llm.words import ragged

#: Pieces that one recursive query encodes; its rows fit in MEMORY. Each step builds on the whole merge table, so few queries are better.
PIECES = 24_000
#: Pieces and chunks that a worker remembers.
REMEMBERED = 600_000
#: Beyond so many bytes a piece is merged with a heap, as one contraction a step costs the square of its length.
LONG_PIECE = 400
MEMORY = "200MB"
#: Stands for the id after a piece's last token.
NO_ID = (1 << 32) - 1
#: Token rows that one decoding query handles.
DECODE_ROWS = 250_000

#: A row is a token of a piece: where it starts and ends, and its id and the next token's in one number. The token that goes
#: takes the other's start, so a step needs no join of a piece's tokens with each other; those of a piece without a pair are done.
_ENCODE = """
WITH RECURSIVE t(w, pos, nxt, pair, done) AS (
  SELECT w, pos, pos + 1, pair, false FROM pieces
  UNION ALL
  (WITH best AS (
     SELECT w, min((n::BIGINT << 32) | (pos << 16) | nxt) AS k FROM t JOIN merges USING (pair) WHERE NOT done GROUP BY w),
   cut AS (
     SELECT w, k >> 32 AS n, ((k >> 16) & 65535)::INTEGER AS head, (k & 65535)::INTEGER AS gone FROM best)
   SELECT t.w, CASE WHEN pos = gone THEN head ELSE pos END, nxt,
          CASE WHEN pos = gone THEN (n << 32) | (pair & 4294967295) WHEN nxt = head THEN (pair >> 32 << 32) | n ELSE pair END,
          head IS NULL
   FROM t LEFT JOIN cut USING (w) WHERE NOT done AND (head IS NULL OR pos <> head))
)
SELECT w, list((pair >> 32)::INTEGER) AS ids FROM (SELECT w, pair FROM t WHERE done ORDER BY w, pos) GROUP BY w ORDER BY w
"""
_DECODE = """
SELECT d, unhex(string_agg(hex, '')) AS raw
FROM (SELECT d, pos, hex FROM tokens JOIN vocab USING (id) ORDER BY d, pos)
GROUP BY d ORDER BY d
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class _Vocabulary:
    """The tables of one vocabulary file in a DuckDB of this process."""

    def __init__(self, path: str):
        import duckdb

        self.ranks = read_ranks(path)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": tempfile.mkdtemp(prefix="bpe-")})
        splits = [
            (self.ranks[token[:i]], self.ranks[token[i:]], rank)
            for token, rank in self.ranks.items()
            for i in range(1, len(token))
            if token[:i] in self.ranks and token[i:] in self.ranks
        ]
        left, right, rank = np.array(splits, np.int64).reshape(-1, 3).T
        self._fill("merges", pair=(left << 32) + right, n=rank.astype(np.int32))
        self._fill("vocab", id=np.fromiter(self.ranks.values(), np.int32), hex=[t.hex() for t in self.ranks])
        self.byte_ids = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], np.int32)

    def _fill(self, name: str, **columns) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def encode(self, pieces: list[bytes]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
        """Blocks of pieces, by their places in the list, with all their ids and how many each has.

        A piece that is a token is that token.
        """
        ranks = self.ranks
        known = [i for i, p in enumerate(pieces) if p in ranks]
        yield known, np.fromiter((ranks[pieces[i]] for i in known), np.int32, len(known)), np.ones(len(known), np.int64)
        todo = []
        for i, piece in enumerate(pieces):
            if piece in ranks:
                continue
            if len(piece) > LONG_PIECE:
                ids = self._merge_long(piece)
                yield [i], np.array(ids, np.int32), np.array([len(ids)])
            else:
                todo.append(i)
        for k in range(0, len(todo), PIECES):
            own = todo[k:k + PIECES]
            lengths = np.fromiter((len(pieces[i]) for i in own), np.int64, len(own))
            ids = self.byte_ids[np.frombuffer(b"".join(pieces[i] for i in own), np.uint8)].astype(np.int64)
            follows = np.append(ids[1:], 0)
            follows[np.cumsum(lengths) - 1] = NO_ID
            self.db.register("pieces", pa.table({
                "w": np.repeat(np.arange(len(own), dtype=np.int32), lengths),
                "pos": ragged(np.zeros(len(own), np.int64), lengths).astype(np.int32),
                "pair": (ids << 32) | (follows & NO_ID),
            }))
            lists = self.db.sql(_ENCODE).to_arrow_table().column("ids").combine_chunks()
            self.db.unregister("pieces")
            yield own, lists.flatten().to_numpy(), pc.list_value_length(lists).to_numpy().astype(np.int64)

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same contraction order, smallest rank and then leftmost, by a heap of pairs."""
        ranks, n = self.ranks, len(piece)
        ends, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        alive = bytearray(b"\1") * n
        while heap:
            _, i, end = heapq.heappop(heap)
            if not alive[i] or ends[i] >= n or not alive[ends[i]] or ends[ends[i]] != end:
                continue
            alive[ends[i]], ends[i] = 0, end
            if end < n:
                before[end] = i
            for a in (before[i], i):
                if a >= 0 and ends[a] < n and (r := ranks.get(piece[a:ends[ends[a]]])) is not None:
                    heapq.heappush(heap, (r, a, ends[ends[a]]))
        return [ranks[piece[i:ends[i]]] for i in range(n) if alive[i]]

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """The bytes of each run of ids; a run without ids is empty."""
        out = [b""] * len(lengths)
        ends = np.cumsum(lengths)
        first = 0
        while first < len(lengths):
            base = ends[first] - lengths[first]
            last = max(int(np.searchsorted(ends, base + DECODE_ROWS, "right")), first + 1)
            own = lengths[first:last]
            self.db.register("tokens", pa.table({
                "d": np.repeat(np.arange(first, last), own),
                "pos": ragged(np.zeros(len(own), np.int64), own),
                "id": ids[base:ends[last - 1]],
            }))
            for d, raw in self.db.execute(_DECODE).fetchall():
                out[d] = raw
            self.db.unregister("tokens")
            first = last
        return out


class _Encoder:
    """Ids of texts, remembering those of pieces and of space-separated chunks."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.vocabulary = vocabulary(path)
        self.cut = regex.compile(pattern).findall
        self._forget()

    def _forget(self) -> None:
        self.pieces: dict[str, int] = {}  # a piece -> its span of ids
        self.ids = Spans()
        # A piece of text as it is, or a chunk after a space -> its span of pieces.
        self.plain, self.spaced = (Numbered(), Spans()), (Numbered(), Spans())

    def _learn(self, known: Numbered, spans: Spans, before: str) -> None:
        """Note the pieces of texts that were met for the first time, and the ids of their pieces."""
        cuts = [self.cut(before + t) for t in known.take_new()]
        pieces = list(set(chain.from_iterable(cuts)).difference(self.pieces))
        for own, ids, counts in self.vocabulary.encode([p.encode() for p in pieces]):
            self.pieces.update(zip([pieces[i] for i in own], self.ids.add(ids, counts)))
        numbers = list(map(self.pieces.__getitem__, chain.from_iterable(cuts)))
        spans.add(np.array(numbers, np.int32), np.fromiter(map(len, cuts), np.int64, len(cuts)))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each text has."""
        if len(self.pieces) + len(self.plain[0]) + len(self.spaced[0]) > REMEMBERED:
            self._forget()
        plain, spaced = self.plain[0].__getitem__, self.spaced[0].__getitem__
        heads: list[int] = []
        rests: list[int] = []
        counts = []
        for text in texts:
            # White space and then a space: where runs of white space end, only the pattern on the whole text can say.
            head, rest = (self.cut(text), []) if _RUN(text) else ([(parts := text.split(" "))[0]], parts[1:])
            heads.extend(map(plain, head))
            rests.extend(map(spaced, rest))
            counts.append((len(head), len(rest)))
        self._learn(*self.plain, "")
        self._learn(*self.spaced, " ")
        # Each text's head and then its rest.
        n = np.array(counts, np.int64).reshape(-1, 2)
        parts = [self.plain[1].gather(heads, n[:, 0]), self.spaced[1].gather(rests, n[:, 1])]
        numbers, sizes = zip(*parts)
        starts = np.column_stack([np.cumsum(sizes[0]) - sizes[0], len(numbers[0]) + np.cumsum(sizes[1]) - sizes[1]])
        lengths = np.column_stack(sizes)
        pieces = np.concatenate(numbers)[ragged(starts.ravel(), lengths.ravel())]
        return self.ids.gather(pieces, lengths.sum(1))


_RUN = re.compile(r"\s ").search


def vocabulary(path: str) -> _Vocabulary:
    known = worker_state("bpe")
    if path not in known:
        known[path] = _Vocabulary(path)
    return known[path]


def _encoder(path: str, pattern: str) -> _Encoder:
    known = worker_state("bpe")
    if (path, pattern) not in known:
        known[path, pattern] = _Encoder(path, pattern)
    return known[path, pattern]


def encode(text: Column, path: str, pattern: str, block: int = 1 << 20) -> Column:
    """Token ids of ``text`` as an array; null and empty text have none.

    ``path`` is a rank file (base64 token and rank a line) that every executor can
    read. Each match of ``pattern`` is encoded by itself, without special tokens.
    """

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(path, pattern)
        for texts in batches:
            for part in text_blocks(texts, block):
                yield id_lists([encoder.encode(part)])

    return ids(text)


def decode(ids: Column, path: str) -> Column:
    """The bytes that an array of token ids stands for; null and empty arrays give none.

    An id without a token in the vocabulary stands for no bytes.
    """

    @F.arrow_udf("binary")
    def raw(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = vocabulary(path)
        for lists in batches:
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False)
            yield pa.array(tokens.decode(flat, lengths), pa.binary())

    return raw(ids)


def round_trip(text: Column, path: str, pattern: str, block: int = 1 << 20) -> Column:
    """``struct<ids array<int>, raw binary>``: what ``encode`` gives and what ``decode`` makes of it, in one Python worker."""

    @F.arrow_udf("struct<ids: array<int>, raw: binary>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _round_trips(batches, path, pattern, block)

    return both(text)


def _round_trips(batches: Iterator[pa.Array], path: str, pattern: str, block: int) -> Iterator[pa.Array]:
    """Rows of a block go out before the next one is encoded: ids and bytes of a whole batch are several times its text."""
    encoder, tokens = _encoder(path, pattern), vocabulary(path)
    for texts in batches:
        for part in text_blocks(texts, block):
            found = encoder.encode(part)
            yield pa.StructArray.from_arrays([id_lists([found]), pa.array(tokens.decode(*found), pa.binary())], ["ids", "raw"])
