"""Document quality by a linear-chain conditional random field over lines.

Each line is good or bad. Its features are shares of kinds of bytes, lengths and
repetitions of words in it, in the line before and in the line after. Learnt from
labelled documents (all lines of one get its label), the field gives each line the
marginal probability of being good; their mean, weighted by the lengths of the
lines, is the quality of the document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarweave.llm.spans import text_slices
from tarweave.llm.words import find_words, text_bytes

#: Labelled documents that the field is fitted on at most: those whose ids hash lowest.
TRAIN_DOCS = 3_000
#: Longer documents are scored like all others but not fitted on.
TRAIN_LINES = 60
TRAIN_BYTES = 20_000
THRESHOLD = 0.7
STEPS = 150
RIDGE = 1e-4

_KINDS = 8
_KIND = np.full(256, 6, np.uint8)  # control and rare signs
for _kind, _bytes in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b".,;:?'\"()-", b"!", b"|")):
    _KIND[list(_bytes)] = _kind
_KIND[[*range(ord("a"), ord("z") + 1), *range(128, 256)]] = 7
#: Kinds whose shares are features: all but lower-case letters.
_SHARES = 7
FEATURES = _SHARES + 4


@dataclass
class Lines:
    """Lines of some rows: features of each, its length in bytes, and the bounds of rows."""

    features: np.ndarray
    lengths: np.ndarray
    rows: np.ndarray


def find_lines(texts: pa.Array) -> Lines:
    """Lines of a string column; every row has one at least. Null is empty."""
    raw, offsets = text_bytes(texts)
    breaks = np.flatnonzero(raw == 10)
    # A line starts at each row and behind each line feed; of starts that coincide, rows come in order.
    starts = np.concatenate([offsets[:-1], breaks + 1])
    row_of = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, "right") - 1])
    order = np.lexsort((starts, row_of))
    starts, row_of = starts[order], row_of[order]
    rows = np.searchsorted(row_of, np.arange(len(offsets)))
    ends = np.append(starts[1:], len(raw))
    lengths = ends - starts - np.append(row_of[1:] == row_of[:-1], False)[:len(starts)]
    n, lengths_1 = len(starts), np.maximum(lengths, 1)
    # Bytes of a line and its line feed; the feed counts as none of the shares.
    line_of = np.repeat(np.arange(n), np.diff(np.append(starts, len(raw))) if n else 0)
    kinds = _KIND[raw]
    kinds[breaks] = 7
    counts = np.bincount(line_of * _KINDS + kinds, minlength=n * _KINDS).reshape(n, _KINDS)
    words = find_words(texts)
    hashes, word_line = words.hashes(), line_of[words.starts]
    n_words = np.bincount(word_line, minlength=n)
    again = np.flatnonzero((hashes[1:] == hashes[:-1]) & (word_line[1:] == word_line[:-1])) + 1
    repeats = np.bincount(word_line[again], minlength=n)
    sums = np.zeros(n, np.uint64)
    np.add.at(sums, word_line, hashes)
    same = np.zeros(n)
    same[1:] = (sums[1:] == sums[:-1]) & (row_of[1:] == row_of[:-1]) & (n_words[1:] > 0)
    features = np.column_stack([
        counts[:, :_SHARES] / lengths_1[:, None],
        np.log1p(lengths) / 5,
        np.log1p(lengths / np.maximum(n_words, 1)) / 3,
        repeats / np.maximum(n_words, 1),
        same,
    ]).astype(np.float32)
    return Lines(features, lengths, rows)


def with_neighbours(lines: Lines) -> np.ndarray:
    """Features of each line, of the one before, and of the one after; nothing beyond the row's ends. A one comes first."""
    before, after = np.zeros_like(lines.features), np.zeros_like(lines.features)
    before[1:], after[:-1] = lines.features[:-1], lines.features[1:]
    firsts = lines.rows[:-1]
    before[firsts] = 0
    after[lines.rows[1:] - 1] = 0
    return np.column_stack([np.ones(len(before), np.float32), lines.features, before, after])


@dataclass
class Field:
    """Weights of the features for "good" against "bad", and for each change between neighbouring lines."""

    weights: np.ndarray
    change: np.ndarray  # [from, to], 0 bad, 1 good

    def marginals(self, x: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Of each line the probability of good; expected changes; the sum of log partition functions.

        Forward and backward over all rows at once, line number by line number.
        """
        unary = np.zeros((len(x), 2))
        unary[:, 1] = x @ self.weights
        counts = np.diff(rows)
        order = np.argsort(-counts, kind="stable")
        starts, counts = rows[:-1][order], counts[order]
        alive = np.searchsorted(-counts, -np.arange(1, counts[0] + 1 if len(counts) else 1), "right")
        forward, backward = unary.copy(), np.zeros_like(unary)
        for t in range(1, len(alive)):
            at = starts[:alive[t]] + t
            step = forward[at - 1][:, :, None] + self.change
            forward[at] += np.logaddexp(step[:, 0], step[:, 1])
        for t in range(len(alive) - 1, 0, -1):
            at = starts[:alive[t]] + t
            step = self.change + (unary[at] + backward[at])[:, None, :]
            backward[at - 1] = np.logaddexp(step[:, :, 0], step[:, :, 1])
        both = forward + backward
        total = np.logaddexp(both[:, 0], both[:, 1])
        good = np.exp(both[:, 1] - total)
        first = np.zeros(len(x), bool)
        first[rows[:-1]] = True
        at = np.flatnonzero(~first)
        pair = forward[at - 1][:, :, None] + self.change + (unary[at] + backward[at])[:, None, :] - total[at][:, None, None]
        return good, np.exp(pair).sum(0), float(total[rows[:-1]].sum())


def fit(lines: Lines, labels: np.ndarray) -> Field:
    """The field of the largest penalised likelihood, by gradient steps with momentum (Adam).

    Features are scaled to a deviation of one for the fit.
    """
    x = with_neighbours(lines)
    scale = 1 / np.maximum(x.std(0), 1e-3)
    scale[0] = 1
    x = x * scale
    counts = np.diff(lines.rows)
    truth = np.repeat(labels, counts)
    first = np.zeros(len(x), bool)
    first[lines.rows[:-1]] = True
    at = np.flatnonzero(~first)
    seen = np.zeros((2, 2))
    np.add.at(seen, (truth[at - 1], truth[at]), 1)
    flat = np.zeros(x.shape[1] + 4)
    mean, square = np.zeros_like(flat), np.zeros_like(flat)
    for step in range(1, STEPS + 1):
        field = Field(flat[:-4], flat[-4:].reshape(2, 2))
        good, changes, _ = field.marginals(x, lines.rows)
        slope = np.append(x.T @ (truth - good), (seen - changes).ravel()) / len(x) - RIDGE * flat
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        flat = flat + 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return Field(flat[:-4] * scale, flat[-4:].reshape(2, 2))


def held_out(id_col: Column) -> Column:
    """Rows that no label is learnt from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Field | float:
    """Fit on at most TRAIN_DOCS labelled documents; without both labels, the share of label 1 (0.5 without any).

    Only texts of the sample come to the driver. Of an id labelled twice the
    larger label counts; of a text repeated under one id, one is taken.
    """
    known = (
        labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
        .where(F.col("_label").isin(0, 1) & F.col("_id").isNotNull() & ~held_out(F.col("_id")))
        .groupBy("_id").agg(F.max("_label").alias("_label"))
    )
    # TRAIN_DOCS rows at most: small enough to broadcast.
    sample = F.broadcast(known.orderBy(F.xxhash64("_id"), "_id").limit(TRAIN_DOCS))
    text = F.coalesce(F.col(text_col), F.lit(""))
    breaks = F.length("_text") - F.length(F.replace("_text", F.lit("\n"), F.lit("")))
    rows = (
        df.select(F.col(id_col).alias("_id"), text.alias("_text")).join(sample, "_id")
        .groupBy("_id", "_label").agg(F.max("_text").alias("_text"))
        # After the aggregation, so that only texts of the sample are measured.
        .where((F.octet_length("_text") <= TRAIN_BYTES) & (breaks < TRAIN_LINES))
        .orderBy("_id").toArrow()
    )
    truth = rows.column("_label").to_numpy()
    if len(set(truth.tolist())) < 2:
        return float(truth[0]) if len(truth) else 0.5
    return fit(find_lines(rows.column("_text").combine_chunks()), truth.astype(np.int64))


def score(text: Column, field: Field | float) -> Column:
    """The mean of the lines' probabilities of good, weighted by their lengths; null is empty."""
    if isinstance(field, float):
        return F.lit(field)
    weights, change = field.weights, field.change

    @F.arrow_udf("double")
    def quality(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Field(weights, change)
        for texts in batches:
            parts = []
            for block in text_slices(texts):
                lines = find_lines(block)
                good, _, _ = own.marginals(with_neighbours(lines), lines.rows)
                weight = np.maximum(lines.lengths, 1e-9)
                sums = np.add.reduceat(good * weight, lines.rows[:-1]) / np.add.reduceat(weight, lines.rows[:-1])
                parts.append(np.clip(sums, 0, 1))
            yield pa.array(np.concatenate([np.zeros(0), *parts]), pa.float64())

    return quality(text)


def judge(df: DataFrame, field: Field | float, text_col: str = "text") -> DataFrame:
    """``df`` with ``score double`` and ``predicted int`` (1 from THRESHOLD on); columns of these names are replaced."""
    return df.withColumn("score", score(F.col(text_col), field)).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
