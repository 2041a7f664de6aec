"""Benchmark decontamination by canonical templates.

Words of texts become templates: numbers, units and names turn into typed
placeholders. Windows of WINDOW words are hashed; those of documents that a bit
map of fixed size says may be a benchmark's are joined with them on the hash. A
benchmark item is in a document when enough of its windows are found at one
distance and the values in the placeholders agree: each value of the item
stands for one value in the document throughout. So a question whose numbers or
names were exchanged is found, and a chance meeting of templates isn't.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarweave.llm.common import small_or_shuffled, stage, that_stay
from tarweave.llm.spans import text_slices, worker_state
from tarweave.llm.words import Words, find_words, mix
from tarweave.session import ship_package

WINDOW = 8
#: Words other than placeholders that a window needs to tell anything.
LITERALS = 4
#: Share of an item's windows that have to be found.
COVERAGE = 0.5
#: Bytes of text whose windows are made at once; they take some 30 times as much.
SLICE = 1 << 20
#: Bits of the map: of a power of two of places, whatever the sizes of the tables.
MAP_BITS = 24
#: Windows of the benchmark up to which they are broadcast (some 100 bytes each); beyond, the join shuffles.
BROADCAST_ROWS = 200_000
#: Units that become a placeholder: fixed values.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg ton tons tonne tonnes gram grams kilogram kilograms "
    "pound pounds ounce ounces ml l litre litres liter liters gallon gallons second seconds minute minutes hour hours day days "
    "week weeks month months year years dollar dollars cent cents euro euros percent degree degrees kmh mph watt watts volt volts"
).split()

_ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_DIGIT, _UPPER, _SPACE = (np.zeros(256, bool) for _ in range(3))
_DIGIT[list(b"0123456789")] = _UPPER[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = _SPACE[list(b" \t")] = True
_END = np.zeros(256, bool)
_END[list(b".!?:;\n\r\"'([{")] = True
NUMBER, UNIT, NAME = 1, 2, 3
_PLAIN = np.uint64(0xD1342543DE82EF95)
_PLACEHOLDERS = mix(np.arange(1, 4, dtype=np.uint64))


def _word_hashes(words: list[str]) -> np.ndarray:
    return np.unique(find_words(pa.array([" ".join(words)])).hashes())


def kinds(words: Words, hashes: np.ndarray, units: np.ndarray) -> np.ndarray:
    """0 for a literal word, or which placeholder it becomes.

    A number has digits only. A name starts with one of A-Z, goes on with another
    sign than those, and follows a space that doesn't follow the end of a sentence.
    """
    if not len(words.starts):
        return np.zeros(0, np.int8)
    raw, starts, ends = words.raw, words.starts, words.ends
    digits = np.append(0, np.cumsum(_DIGIT[raw]))
    digits = digits[ends] - digits[starts]
    inside = starts >= 2
    inside[words.rows[:-1][words.rows[:-1] < len(starts)]] = False
    before, earlier = raw[np.maximum(starts - 1, 0)], raw[np.maximum(starts - 2, 0)]
    second = raw[np.minimum(starts + 1, len(raw) - 1)]
    name = inside & _UPPER[raw[starts]] & (ends - starts > 1) & ~_UPPER[second] & _SPACE[before] & ~_END[earlier] & ~_SPACE[earlier]
    out = np.where(digits == ends - starts, NUMBER, 0).astype(np.int8)
    out[np.isin(hashes, units)] = UNIT
    out[(out == 0) & name] = NAME
    return out


@dataclass
class Windows:
    """Windows of some rows: their hashes, first words (counted over all rows), rows, and the kinds their words have there."""

    hashes: np.ndarray
    at: np.ndarray
    row: np.ndarray
    named: np.ndarray  # which of the two arrays in ``kinds``
    words: np.ndarray
    kinds: tuple[np.ndarray, np.ndarray]
    rows: np.ndarray
    exact: np.ndarray  # the words as they are

    def slots(self, i: int) -> np.ndarray:
        """The values in the placeholders of window ``i``: each a word's hash with its kind in the last two bits."""
        if self.exact[i]:
            return np.zeros(0, np.int64)
        a, kinds = self.at[i], self.kinds[int(self.named[i])]
        k = a + np.flatnonzero(kinds[a:a + WINDOW])
        return ((self.words[k] & ~np.uint64(3)) | kinds[k].astype(np.uint64)).view(np.int64)


def windows(texts: pa.Array, units: np.ndarray) -> Windows:
    """All windows of a string column.

    A window with names counts twice, with names as placeholders and as words, since
    a name at the start of a sentence elsewhere isn't known for one. A window whose
    words are placeholders in the main tells nothing as a template, so it has a hash
    of its words as they are, and no slots.
    """
    words = find_words(texts)
    hashes = find_words(pc.utf8_lower(texts)).hashes()  # as many words: only letters change
    what = kinds(words, hashes, units)
    plain = np.where(what == NAME, 0, what)
    size = max(len(hashes) - WINDOW + 1, 0)
    row = np.repeat(np.arange(len(words.rows) - 1), words.counts())
    whole = row[:size] == row[WINDOW - 1:][:size]
    found = []
    for named, own in ((False, plain), (True, what)):
        canonical = np.where(own > 0, _PLACEHOLDERS[own - 1], hashes)
        literal = np.append(0, np.cumsum(own == 0))
        fit = whole & (literal[WINDOW:][:size] - literal[:size] >= LITERALS)
        if named:
            names = np.append(0, np.cumsum(what == NAME))
            fit &= names[WINDOW:][:size] > names[:size]
        at = np.flatnonzero(fit)
        out = np.zeros(len(at), np.uint64)
        for k in range(WINDOW):
            out = mix(out + canonical[at + k])
        found.append((out, at, np.full(len(at), named), np.zeros(len(at), bool)))
        if not named:
            # A place has a template without names, or its words as they are.
            at = np.flatnonzero(whole & ~fit)
            found.append((_plain(hashes, at, WINDOW), at, np.zeros(len(at), bool), np.ones(len(at), bool)))
    out, at, named, exact = (np.concatenate(parts) for parts in zip(*found))
    return Windows(out, at, row[at], named, hashes, (plain, what), words.rows, exact)


def _plain(hashes: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """A hash of ``length`` words as they are from each place ``at``, unlike those of templates and of other lengths."""
    out = np.full(len(at), length, np.uint64) * _PLAIN
    for k in range(length):
        out = mix(out + hashes[at + k])
    return out


def short_runs(w: Windows, lengths: set[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, first words and rows of all runs of so many words; lengths are less than WINDOW."""
    row = np.repeat(np.arange(len(w.rows) - 1), np.diff(w.rows))
    found = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    for n in sorted(lengths):
        size = max(len(w.words) - n + 1, 0)
        at = np.flatnonzero(row[:size] == row[n - 1:][:size])
        found.append((_plain(w.words, at, n), at))
    out, at = (np.concatenate(parts) for parts in zip(*found))
    return out, at, row[at]


def whole_short(w: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As :func:`short_runs`: all words of the rows that have fewer than WINDOW."""
    counts = np.diff(w.rows)
    found = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    for n in range(1, WINDOW):
        row = np.flatnonzero(counts == n)
        found.append((_plain(w.words, w.rows[row], n), row))
    out, row = (np.concatenate(parts) for parts in zip(*found))
    return out, w.rows[row], row


_WINDOWS = "id long, print long, n long, hash long, pos long, slots array<long>"


def _windows_of(df: DataFrame, id_col: str, text_col: str, bits: np.ndarray | None, lengths: set[int] | None = None) -> DataFrame:
    """Windows of a table's texts, those that ``bits`` may hold if it is given, with the values in their placeholders.

    ``n`` is the number of places a window can stand at. A text of fewer than WINDOW
    words has one, all of its words as they are; with ``lengths`` (less than WINDOW)
    so have runs of so many words in any text.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("benchmark")
        units = _word_hashes(UNITS)
        for batch in batches:
            done = 0
            for block in text_slices(batch.column("text"), SLICE):
                w = windows(block, units)
                counts = np.diff(w.rows)
                total = np.maximum(counts - WINDOW + 1, np.minimum(counts, 1))
                hashes, at, row = whole_short(w) if lengths is None else short_runs(w, lengths)
                hashes, at, row = np.concatenate([w.hashes, hashes]), np.concatenate([w.at, at]), np.concatenate([w.row, row])
                kept = np.arange(len(at))
                if bits is not None:
                    place = hashes & np.uint64((1 << MAP_BITS) - 1)
                    kept = np.flatnonzero((bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1)
                hashes, at, row = hashes[kept], at[kept], row[kept]
                slots = [w.slots(i) if i < len(w.at) else np.zeros(0, np.int64) for i in kept.tolist()]
                own = pa.array(row + done, pa.int64())
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").take(own), batch.column("print").take(own), pa.array(total[row], pa.int64()),
                    pa.array(hashes.view(np.int64)), pa.array(at - w.rows[row], pa.int64()), pa.array(slots, pa.list_(pa.int64())),
                ], ["id", "print", "n", "hash", "pos", "slots"])
                done += len(block)

    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("print"), text.alias("text")).mapInArrow(cut, _WINDOWS)


def _bit_map(hashes: DataFrame) -> np.ndarray:
    """A map of 2^MAP_BITS bits with those of the hashes set; the driver gets 2^(MAP_BITS - 6) rows at most."""
    place = F.col("hash").bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    rows = (
        hashes.groupBy(F.shiftright(place, 6).alias("at"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(hash & 63 AS INT))")).alias("bits")).toArrow()
    )
    out = np.zeros(1 << (MAP_BITS - 6), np.int64)
    out[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return out.view(np.uint8)


def benchmark_matches(
    df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """Rows ``<id_col>, <item_col>, windows, coverage, slots, exchanged, first_word, places, print``: the items in documents.

    ``windows`` of the item were found (different ones, their share is
    ``coverage``), with ``slots`` values in placeholders of which ``exchanged``
    differ from the item's; ``first_word`` is where the first window stands, and
    ``places`` the number of distances at which values agree. ``print`` is a
    hash of the text (rows repeated with one id and text give one row). Null is
    empty. An item of fewer than WINDOW words is found where all its words stand in
    a row; windows with fewer than LITERALS words that are no placeholders are found
    as they are. Items of one id and different texts count as one for each text.
    """
    spark = df.sparkSession
    ship_package(spark)
    items = stage(
        _windows_of(benchmark, item_col, item_text, None)
        .select(F.col("id").alias("item"), F.col("print").alias("item_print"), F.col("n").alias("item_windows"), "hash", F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots"))
        .distinct(),
        "items",
    )
    bits = _bit_map(items.select("hash").distinct())
    # A short item has one window, whose length its hash holds: which lengths there are is WINDOW - 1 numbers at most.
    words = F.least(F.size(F.regexp_extract_all(F.coalesce(F.col(item_text), F.lit("")), F.lit(_ANY_WORD), F.lit(0))), F.lit(WINDOW))
    lengths = {r.n for r in benchmark.select(words.alias("n")).distinct().collect()} - {0, WINDOW}
    found = _windows_of(df, id_col, text_col, bits, lengths).select("id", "print", "hash", "pos", "slots")
    met = found.join(small_or_shuffled(items, BROADCAST_ROWS), "hash").withColumn("distance", F.col("pos") - F.col("item_pos"))
    key = ["id", "print", "item", "item_print", "distance"]
    # For each distance: the item's windows found, and which value of the document each value of the item stands for.
    pairs = F.transform(F.sequence(F.lit(1), F.size("slots")), lambda i: F.struct(
        F.element_at("item_slots", i).alias("item_value"), F.element_at("slots", i).alias("value")))
    runs = (
        met.withColumn("pairs", F.when(F.size("slots") > 0, pairs).otherwise(F.array()))
        .groupBy(*key)
        .agg(
            F.collect_set("item_pos").alias("found"),
            F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),
            F.first("item_windows").alias("item_windows"),
            F.min("pos").alias("first_word"),
        )
        .withColumn("values", F.size(F.array_distinct(F.transform("pairs", lambda p: p["item_value"]))))
        .where(F.col("values") == F.size("pairs"))
        .withColumn("exchanged", F.size(F.filter("pairs", lambda p: p["item_value"] != p["value"])))
    )
    return (
        runs.withColumn("window", F.explode("found"))
        .groupBy("id", "print", "item", "item_print")
        .agg(
            F.countDistinct("window").alias("windows"),
            F.countDistinct("distance").alias("places"),
            F.first("item_windows").alias("item_windows"),
            F.max(F.struct(F.size("found").alias("most"), (-F.col("exchanged")).alias("same"), "values")).alias("best"),
            F.min("first_word").alias("first_word"),
        )
        .withColumn("coverage", F.col("windows") / F.col("item_windows"))
        .where(F.col("coverage") >= COVERAGE)
        .select(
            F.col("id").alias(id_col), F.col("item").alias(item_col), "windows", "coverage",
            F.col("best.values").cast("long").alias("slots"), (-F.col("best.same")).cast("long").alias("exchanged"), "first_word", "places", "print",
        )
    )


def drop_contaminated(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` in which :func:`benchmark_matches` finds nothing, with the columns of ``df``."""
    found = benchmark_matches(df, benchmark, id_col, text_col)
    gone = found.select(F.col(id_col).alias("id"), F.col("print").alias("mark"), F.lit(False).alias("stays"), F.lit(1).alias("n"))
    return that_stay(df, id_col, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), stage(gone.distinct(), "contaminated"), BROADCAST_ROWS)
