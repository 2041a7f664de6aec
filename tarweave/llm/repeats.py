"""Repeated substrings of texts, found in common-prefix interval trees of a sparse suffix array.

Any LENGTH bytes hold an anchor: of the runs of GRAM bytes in them the first with
the smallest hash. Equal strings have the same anchor at the same place, so only
suffixes that begin at anchors are sorted, and an anchor needs no more context than
the strings it can be the anchor of: REACH bytes to its left and LENGTH from it on.

Occurrences of an anchor are brought together by a sort by range. Those in the same
context are a group of repeats as they are; every context then goes on with its
first occurrence alone. Anchors in several contexts get a suffix array each: a scan
with a stack finds its intervals of common prefixes, and in each of them the
intervals of common left extensions, wherever the bytes to the left are diverse.
A prefix and an extension of LENGTH bytes together are a maximal repeat (as far as
the context goes), given with all its occurrences.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarweave.llm.common import small_or_shuffled, stage
from tarweave.llm.ranks import ranked
from tarweave.llm.words import _BASE, _BYTE, _STEP, _powers, mix, ragged, text_bytes

#: Bytes of the shortest repeat, of an anchor, and to the left of an anchor in such a repeat.
LENGTH, GRAM = 100, 50
REACH = LENGTH - GRAM
#: Fills contexts where a text begins or ends; no byte of UTF-8.
FILL = 0xFF
#: Contexts of one anchor that one task compares; those of others are compared window by window.
HOT = 50_000
#: Rows up to which copies, or anchors that need another way, are broadcast.
BROADCAST_ROWS = 200_000
#: Rows of whole anchors that are compared together.
CHUNK = 20_000

_INVERSE = pow(_BASE, -1, 1 << 64)
_HIGH = np.uint64(0xFFFFFFFF00000000)


# Anchors of texts.

def _pieces(offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """``row, low, high, first, last``: rows of LENGTH bytes or more with their bounds, long ones cut by window starts."""
    low, high = offsets[:-1], offsets[1:]
    rows = np.flatnonzero(high - low >= LENGTH)
    step = _STEP - 4 * LENGTH
    counts = -(-(high[rows] - low[rows] - LENGTH + 1) // step)
    row = np.repeat(rows, counts)
    first = low[row] + ragged(np.zeros(len(rows), np.int64), counts) * step
    return row, low[row], high[row], first, np.minimum(first + step, high[row] - LENGTH + 1)


def anchors(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """``row, start, anchor, context``: places of anchors in their texts, in order, and hashes of anchor and context."""
    row, low, high, first, last = _pieces(offsets)
    begin, end = np.maximum(low, first - REACH), np.minimum(high, last + LENGTH + REACH)
    found: list[list[np.ndarray]] = [[], [], [], []]
    at = 0
    while at < len(row):
        base = begin[at]
        upto = max(int(np.searchsorted(end, base + _STEP, "right")), at + 1)
        piece = raw[base:end[upto - 1]]
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_BYTE[piece] * _powers(_BASE, len(piece))[:len(piece)], out=sums[1:])
        inverse = _powers(_INVERSE, len(piece))
        hashes = mix((sums[GRAM:] - sums[:-GRAM]) * inverse[:len(piece) - GRAM + 1])
        # The least of the windows' hashes, and of equal ones the first.
        least = (hashes & _HIGH) | np.arange(len(hashes), dtype=np.uint64)
        width = 1
        while 2 * width <= REACH + 1:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = REACH + 1 - width
        least = np.minimum(least[:-rest], least[rest:]) if rest else least
        own = slice(at, upto)
        sizes = last[own] - first[own]
        places = (least[ragged(first[own] - base, sizes)] & ~_HIGH).astype(np.int64)
        part = np.repeat(np.arange(at, upto), sizes)
        new = np.ones(len(places), bool)
        new[1:] = np.diff(places) != 0
        places, part = places[new], part[new]
        left, right = np.maximum(low[part] - base, places - REACH), np.minimum(high[part] - base, places + LENGTH)
        shape = (places - left).astype(np.uint64) * np.uint64(_BASE) + (right - places).astype(np.uint64)
        for values, got in zip(found, (row[part], places + base - low[part], hashes[places], mix((sums[right] - sums[left]) * inverse[left] + shape))):
            values.append(got)
        at = upto
    row, start, anchor, context = (np.concatenate(v) if v else np.zeros(0, np.uint64 if k > 1 else np.int64) for k, v in enumerate(found))
    # Pieces of one text have anchors in common where they meet.
    new = np.ones(len(row), bool)
    new[1:] = (np.diff(row) != 0) | (np.diff(start) != 0)
    return row[new], start[new], anchor[new], context[new]


def merged(starts: np.ndarray, stops: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans that meet or overlap within their row as one; spans are in order of rows and starts, and of one length or nested."""
    if not len(starts):
        return starts, stops, rows
    shift = rows * (int(stops.max()) + 2)  # so that the furthest stop so far is one of the same row
    furthest = np.maximum.accumulate(stops + shift)
    new = np.ones(len(starts), bool)
    new[1:] = (starts + shift)[1:] > furthest[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return starts[first], furthest[last] - shift[last], rows[first]


OCCURRENCES = "anchor long, context long, ord long, start long, stop long"


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``ord, text``: anchors with the first place of each of their contexts in a text; without an anchor, spans that the text holds earlier itself."""
    for batch in batches:
        ords = batch.column("ord").to_numpy(zero_copy_only=False)
        raw, offsets = text_bytes(batch.column("text"))
        row, start, anchor, context = anchors(raw, offsets)
        order = np.lexsort((start, context, anchor, row))
        again = np.zeros(len(order), bool)
        if len(order):
            a, b = order[1:], order[:-1]
            again[a] = (row[a] == row[b]) & (anchor[a] == anchor[b]) & (context[a] == context[b])
        size = np.diff(offsets)[row]
        spans = merged(np.maximum(start[again] - REACH, 0), np.minimum(start[again] + LENGTH, size[again]), row[again])
        new = ~again
        none = np.zeros(len(spans[0]), np.uint64)
        is_span = np.concatenate([np.zeros(new.sum(), bool), np.ones(len(none), bool)])
        column = lambda here, there, mask: pa.array(np.concatenate([here, there]).view(np.int64), mask=mask)
        yield pa.RecordBatch.from_arrays([
            column(anchor[new], none, is_span), column(context[new], none, is_span), column(ords[row[new]], ords[spans[2]], None),
            column(start[new], spans[0], None), column(np.zeros(new.sum(), np.int64), spans[1], ~is_span),
        ], ["anchor", "context", "ord", "start", "stop"])


# Groups of equal contexts, and contexts of one anchor.

FOUND = "anchor long, context long, ord long, start long, earlier_ord long, earlier_start long"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``anchor, context, ord, start`` in order: which of them have an earlier one of their context, and which have to be compared.

    The former come with the first of their context here. The latter, without, are
    the first ones of contexts whose anchor has several contexts here, or may have
    others in the task before or after.
    """
    names = ["anchor", "context", "ord", "start"]
    edge = None  # this task's first anchor
    last = np.zeros((4, 0), np.int64)  # the first row of the context now open
    held = np.zeros((4, 0), np.int64)  # a context without another one of its anchor so far
    several = None  # an anchor now open that has several

    def batch_of(rows, earlier):
        none = np.zeros(rows.shape[1], bool) if earlier is not None else np.ones(rows.shape[1], bool)
        pair = earlier if earlier is not None else np.zeros((2, rows.shape[1]), np.int64)
        return pa.RecordBatch.from_arrays([*(pa.array(c) for c in rows), *(pa.array(c, mask=none) for c in pair)], [*names, "earlier_ord", "earlier_start"])

    for batch in batches:
        rows = np.stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names])
        if not rows.shape[1]:
            continue
        if edge is None:
            edge = several = int(rows[0, 0])
        both = np.concatenate([last, rows], axis=1)
        new = np.ones(both.shape[1], bool)
        new[1:] = (np.diff(both[0]) != 0) | (np.diff(both[1]) != 0)
        firsts = np.flatnonzero(new)
        leader = firsts[np.cumsum(new) - 1]
        again = ~new
        if again.any():
            yield batch_of(both[:, again], both[2:, leader[again]])
        fresh = firsts[last.shape[1]:]
        last = both[:, firsts[-1:]]
        rows = np.concatenate([held, both[:, fresh]], axis=1)
        if not rows.shape[1]:
            continue
        opens = np.ones(rows.shape[1], bool)
        opens[1:] = np.diff(rows[0]) != 0
        group = np.cumsum(opens) - 1
        keep = (np.bincount(group)[group] > 1) | (rows[0] == several)
        final = rows[0] == rows[0, -1]
        if keep[-1]:
            several, held = int(rows[0, -1]), np.zeros((4, 0), np.int64)
        else:
            several, held = None, rows[:, final]
        if keep.any():
            yield batch_of(rows[:, keep], None)
    if held.shape[1]:
        yield batch_of(held, None)


# Suffix arrays of anchors.

def intervals(common: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """``(length, first, last)`` of the intervals of suffixes with a common prefix of ``least`` or more, inner ones first.

    ``common[i]`` is what suffix i has in common with the one before (the first: 0).
    """
    stack = [(0, 0)]
    for i in range(1, len(common) + 1):
        value, first = (common[i] if i < len(common) else 0), i - 1
        while value < stack[-1][0]:
            length, first = stack.pop()
            if length >= least:
                yield length, first, i - 1
        if value > stack[-1][0]:
            stack.append((value, first))


def _agreeing(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """How many bytes rows of two matrices have in common from the front, before either text ends."""
    differ = (one != other) | (one == FILL)
    return np.where(differ.any(axis=1), differ.argmax(axis=1), one.shape[1])


def _in_common(rows: np.ndarray) -> np.ndarray:
    """How many bytes each row of a matrix has in common with the one before; the first has none."""
    return np.concatenate([np.zeros(1, np.int64), _agreeing(rows[1:], rows[:-1])])


def _order(rows: np.ndarray) -> np.ndarray:
    """Order of the rows of a byte matrix."""
    padded = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    padded[:, :rows.shape[1]] = rows
    return np.lexsort(padded.view(">u8").T[::-1])


def _repeats_of(right: np.ndarray, left: np.ndarray, age: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """``(extension, prefix, members)`` of the maximal repeats of one anchor; the first member is the earliest.

    ``right`` are its suffixes in order, ``left`` what precedes them, backwards, and ``age`` their places in the order of the texts.
    """
    common = _in_common(right).tolist()
    rank = np.empty(len(left), np.int64)
    rank[_order(left)] = np.arange(len(left))
    for prefix, first, last in intervals(common, GRAM):
        members = np.arange(first, last + 1)
        members = members[np.argsort(rank[first:last + 1])]
        shared = _in_common(left[members]).tolist()
        # Where suffixes of the interval part: a repeat inside one part is a longer one's.
        parts = np.cumsum([0, *(c == prefix for c in common[first + 1:last + 1])]) if prefix < LENGTH else None
        for extension, a, b in intervals(shared, max(LENGTH - prefix, 1)) if LENGTH > prefix else [*intervals(shared, 1), (0, 0, len(members) - 1)]:
            group = members[a:b + 1]
            if parts is None or len(set(parts[group - first].tolist())) > 1:
                yield extension, prefix, group[np.argsort(age[group])]


def _compare(rows: dict[str, np.ndarray], context: np.ndarray) -> Iterator[tuple]:
    """Occurrences of the maximal repeats of some anchors; rows are in order of anchors and suffixes."""
    anchor, ords, start = rows["anchor"], rows["ord"], rows["start"]
    left, right = context[:, REACH - 1::-1], context[:, REACH:]
    age = np.empty(len(ords), np.int64)
    age[np.lexsort((start, ords))] = np.arange(len(ords))
    bounds = np.flatnonzero(np.concatenate([[True], np.diff(anchor) != 0, [True]]))
    size = np.diff(bounds)

    def spans(extension, prefix, members):
        first = members[0]
        for m in members[1:]:
            yield int(ords[m]), int(start[m] - extension), int(start[m] + prefix), int(ords[first]), int(start[first] - extension)

    # Two contexts are one interval.
    pairs = bounds[:-1][size == 2]
    if len(pairs):
        prefix, extension = (_agreeing(side[pairs], side[pairs + 1]) for side in (right, left))
        for k in np.flatnonzero((prefix >= GRAM) & (prefix + extension >= LENGTH)):
            two = (pairs[k], pairs[k] + 1)
            yield from spans(int(extension[k]), int(prefix[k]), two if age[two[0]] < age[two[1]] else two[::-1])
    for a, n in zip(bounds[:-1][size > 2].tolist(), size[size > 2].tolist()):
        for extension, prefix, members in _repeats_of(right[a:a + n], left[a:a + n], age[a:a + n]):
            yield from spans(extension, prefix, members + a)


SPANS = "ord long, start long, stop long, earlier_ord long, earlier_start long"


def _suffix_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``anchor, ord, start, context`` in order of anchors and suffixes: occurrences of repeats but the first, each with the first."""
    held: list[pa.RecordBatch] = []
    schema = pa.schema([(n, pa.int64()) for n in ("ord", "start", "stop", "earlier_ord", "earlier_start")])

    def compared(table: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = {n: table.column(n).combine_chunks().to_numpy(zero_copy_only=False) for n in ("anchor", "ord", "start")}
        raw = b"".join(table.column("context").to_pylist())
        # Repeats within repeats: an anchor of many contexts can give far more rows than it has.
        for found in batched(_compare(rows, np.frombuffer(raw, np.uint8).reshape(-1, REACH + LENGTH)), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], schema=schema)

    count = 0
    for batch in batches:
        held.append(batch)
        count += len(batch)
        if count < CHUNK:
            continue
        table = pa.Table.from_batches(held)
        anchor = table.column("anchor").combine_chunks().to_numpy(zero_copy_only=False)
        whole = int(np.flatnonzero(anchor != anchor[-1])[-1]) + 1 if (anchor != anchor[-1]).any() else 0
        if whole:
            yield from compared(table.slice(0, whole))
        held, count = table.slice(whole).to_batches(), len(table) - whole
    if count:
        yield from compared(pa.Table.from_batches(held))


# The whole.

def in_order(docs: DataFrame) -> DataFrame:
    """``ord, doc_id, text``: texts in the order in which one is earlier than another.

    The order is that of ``doc_id``. Where ids are null or repeated, nulls come first
    and equal ids go by their texts' digests; rows equal in both come in any order.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    if rows.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").isEmpty():
        return rows.select(F.col("doc_id").alias("ord"), "doc_id", "text")
    rows = stage(ranked(rows.withColumn("all", F.lit(0)).withColumn("print", F.sha2("text", 256)), "all", ["doc_id", "print"]), "ordered")
    return rows.select(F.col("i").alias("ord"), "doc_id", "text")


def contexts(members: DataFrame, texts: DataFrame, hot: int) -> DataFrame:
    """``anchor, hot, ord, start, room, context`` of first occurrences of contexts: REACH bytes before and LENGTH after ``start``, filled up with FILL.

    Members of an anchor with one context are left out; ``hot`` are those of an anchor with more than ``hot``.
    """
    counts = members.groupBy("anchor").agg(F.count("*").alias("n"))
    odd = stage(counts.where((F.col("n") == 1) | (F.col("n") > hot)), "odd")
    chosen = members.join(small_or_shuffled(odd, BROADCAST_ROWS), "anchor", "left").where("n IS NULL OR n > 1")
    wanted = chosen.groupBy("ord").agg(F.collect_list(F.struct("anchor", F.col("n").isNotNull().alias("hot"), "start")).alias("w"))
    raw = "CAST(text AS BINARY)"
    context = (
        f"concat(lpad(substring({raw}, CAST(greatest(m.start - {REACH}, 0) + 1 AS INT), CAST(least(m.start, {REACH}) AS INT)), {REACH}, X'{FILL:X}'), "
        f"rpad(substring({raw}, CAST(m.start + 1 AS INT), {LENGTH}), {LENGTH}, X'{FILL:X}'))"
    )
    each = f"transform(w, m -> named_struct('anchor', m.anchor, 'hot', m.hot, 'start', m.start, 'room', octet_length(text) - m.start, 'context', {context}))"
    return texts.select("ord", "text").join(wanted, "ord").select("ord", F.inline(F.expr(each)))


def by_window(rows: DataFrame) -> DataFrame:
    """Spans of repeats between contexts, every window of LENGTH bytes compared by its hash: for anchors of too many contexts for a task."""
    window = f"substring(context, CAST({REACH + 1} - a AS INT), {LENGTH})"
    windows = rows.select("ord", "start", "context", F.explode(F.expr(f"sequence(greatest(0L, {LENGTH} - room), least({REACH}L, start))")).alias("a"))
    windows = windows.select("ord", (F.col("start") - F.col("a")).alias("start"), F.expr(f"xxhash64({window})").alias("x"), F.expr(f"xxhash64(7, {window})").alias("y"))
    classes = windows.groupBy("x", "y").agg(F.count("*").alias("n"), F.min(F.struct("ord", "start")).alias("first"))
    classes = stage(classes.where("n > 1").select("x", "y", F.col("first.ord").alias("earlier_ord"), F.col("first.start").alias("earlier_start")), "windows")
    joined = windows.join(small_or_shuffled(classes, BROADCAST_ROWS), ["x", "y"]).where("ord != earlier_ord OR start != earlier_start")
    return joined.select("ord", "start", (F.col("start") + LENGTH).alias("stop"), "earlier_ord", "earlier_start")


def repeats(texts: DataFrame, hot: int = HOT) -> DataFrame:
    """``ord, start, stop, earlier_ord, earlier_start``: spans of texts that begin earlier as well, in bytes.

    ``texts`` are ``ord, text``. A group of repeats has a row for each occurrence but
    the first, which the others name; a long repeat comes as overlapping groups, one
    for each anchor in it. ``stop`` may lie behind the end of the text. Within a text
    spans come merged, without naming what they repeat.
    """
    found = stage(texts.select("ord", "text").mapInArrow(_occurrences, OCCURRENCES), "anchors")
    keys = ["anchor", "context", "ord"]
    sorted_ = found.where("anchor IS NOT NULL").select(*keys, "start").repartitionByRange(*keys).sortWithinPartitions(*keys)
    scanned = stage(sorted_.mapInArrow(_scan, FOUND), "scanned")
    none = F.lit(None).cast("long")
    inside = found.where("anchor IS NULL").select("ord", "start", "stop", none.alias("earlier_ord"), none.alias("earlier_start"))

    def whole(rows: DataFrame) -> DataFrame:
        left = F.least("start", F.lit(REACH))
        return rows.select("ord", (F.col("start") - left).alias("start"), (F.col("start") + LENGTH).alias("stop"), "earlier_ord", (F.col("earlier_start") - left).alias("earlier_start"))

    # A context that a border between tasks cut has a first row in each; the window holds one row a task.
    along = Window.partitionBy("anchor", "context").orderBy("ord")
    firsts = scanned.where("earlier_ord IS NULL").select("anchor", "context", "ord", "start")
    firsts = firsts.withColumn("earlier_ord", F.lag("ord").over(along)).withColumn("earlier_start", F.lag("start").over(along))
    firsts = stage(firsts, "firsts")
    members = firsts.where("earlier_ord IS NULL").select("anchor", "ord", "start")
    near = stage(contexts(members, texts, hot), "contexts")
    suffix = F.expr(f"substring(context, {REACH + 1}, {LENGTH})")
    plain = near.where("NOT hot").select("anchor", "ord", "start", "context").repartition("anchor").sortWithinPartitions("anchor", suffix)
    compared = plain.mapInArrow(_suffix_arrays, SPANS)
    return inside.unionAll(whole(scanned.where("earlier_ord IS NOT NULL"))).unionAll(whole(firsts.where("earlier_ord IS NOT NULL"))).unionAll(compared).unionAll(by_window(near.where("hot")))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``ord, text, spans``: what is removed and the digest of what stays."""
    names = ["ord", "n_removed", "n_spans", "kept_sha256"]
    for batch in batches:
        raw, offsets = text_bytes(batch.column("text"))
        lists = batch.column("spans")
        counts = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten()
        row = np.repeat(np.arange(len(batch)), counts)
        size = np.diff(offsets)
        start, stop = (flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        stop = np.minimum(stop, size[row])
        order = np.lexsort((stop, start, row))
        start, stop, row = merged(start[order], stop[order], row[order])
        removed = np.bincount(row, stop - start, len(batch)).astype(np.int64)
        spans = np.bincount(row, minlength=len(batch))
        stays = np.ones(len(raw), bool)
        stays[ragged(offsets[row] + start, stop - start)] = False
        ends = np.append(0, np.cumsum(size - removed))
        view = memoryview(raw[stays])
        prints = [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        yield pa.RecordBatch.from_arrays([batch.column("ord"), pa.array(removed), pa.array(spans), pa.array(prints)], names)


def sql() -> str:
    """The rows of ``without_repeats`` in DuckDB's SQL, from every window of every text; ids have to be unique."""
    return f"""
    WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
    b AS (SELECT doc_id, h, n, unnest(range(0, n)) AS p FROM t),
    w AS (SELECT doc_id, p, CASE WHEN p + {LENGTH} <= n THEN md5_number(substr(h, 2 * p + 1, {2 * LENGTH})) END AS s, substr(h, 2 * p + 1, 2) AS byte FROM b),
    f AS (SELECT doc_id, p, byte, s IS NOT NULL AND row_number() OVER (PARTITION BY s ORDER BY doc_id, p) > 1 AS again FROM w),
    c AS (SELECT *, bool_or(again) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN {LENGTH - 1} PRECEDING AND CURRENT ROW) AS gone FROM f),
    g AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), false) AS opens FROM c),
    k AS (
      SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans, coalesce(string_agg(byte, '' ORDER BY p) FILTER (NOT gone), '') AS kept
      FROM g GROUP BY doc_id)
    SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
    FROM t LEFT JOIN k USING (doc_id)
    """


def without_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row of ``docs`` (``doc_id, text``; null: empty).

    Removed is every byte of a string of LENGTH bytes that begins earlier too, in
    the order of ``in_order``; strings may overlap and don't cross texts. Of texts that
    are equal as a whole, only the first is searched.
    """
    rows = in_order(docs)
    prints = stage(rows.select("ord", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("print")), "prints")
    groups = prints.where(F.col("n_bytes") >= LENGTH).groupBy("print").agg(F.min("ord").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    groups = stage(groups, "groups")
    copies = prints.join(small_or_shuffled(groups, BROADCAST_ROWS), "print").where("ord != first").select("ord", F.col("n_bytes").alias("n_removed"))
    copies = stage(copies, "copies")
    texts = rows.where(F.octet_length("text") >= LENGTH).select("ord", "text").join(small_or_shuffled(copies.select("ord"), BROADCAST_ROWS), "ord", "left_anti")
    spans = repeats(texts, hot).groupBy("ord").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    cut = texts.join(spans, "ord").select("ord", "text", "spans").mapInArrow(_kept, "ord long, n_removed long, n_spans long, kept_sha256 string")
    changed = cut.unionAll(copies.select("ord", "n_removed", F.lit(1).cast("long").alias("n_spans"), F.sha2(F.lit(""), 256).alias("kept_sha256")))
    zero = F.lit(0).cast("long")
    return prints.join(changed, "ord", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha256", "print").alias("kept_sha256")
    )
