"""Exact dedup by counting quotient filters.

Every partition puts the 64-bit fingerprints of its texts into counting
quotient filters, one for each range of fingerprints. A filter keeps, for each
quotient (the leading bits), the sorted run of remainders (the other bits) with
their counts, so nothing is lost and filters merge by walking their sorted
remainders. The filters of one range meet in one task. Only fingerprints that
were counted more than once go on to the comparison of whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarweave.llm.common import lower_ascii, small_or_shuffled, stage, that_stay
from tarweave.llm.words import ragged
from tarweave.session import ship_package

#: Repeated fingerprints, or dropped rows, up to which their keys are broadcast (16 bytes each); beyond, the join shuffles.
BROADCAST_ROWS = 200_000


def _pack(prints: np.ndarray, counts: np.ndarray, range_bits: int) -> bytes:
    """A counting quotient filter of sorted, different fingerprints that share their first ``range_bits``.

    Layout: quotient bits, number of slots, remainder bytes (8-byte numbers), then the
    bit vectors of occupied quotients and of run ends, remainders, counts.
    """
    q_bits = max(int(len(prints) * 1.1).bit_length(), 1)
    r_bits = 64 - range_bits - q_bits
    width = (r_bits + 7) // 8
    own = prints & np.uint64((1 << (64 - range_bits)) - 1)
    quotients = (own >> np.uint64(r_bits)).astype(np.int64)
    remainders = own & np.uint64((1 << r_bits) - 1)
    order = np.arange(len(prints))
    slots = order + np.maximum.accumulate(quotients - order)
    size = max(1 << q_bits, int(slots[-1]) + 1)
    occupied, ends = np.zeros(size, bool), np.zeros(size, bool)
    occupied[quotients] = True
    ends[slots[np.append(quotients[1:] != quotients[:-1], True)]] = True
    head = np.array([q_bits, size, width], np.int64).tobytes()
    small = remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return b"".join([head, np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(), small.tobytes(), counts.astype("<i8").tobytes()])


def _unpack(data: bytes, part: int, range_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted fingerprints of a filter and their counts."""
    q_bits, size, width = np.frombuffer(data, np.int64, 3).tolist()
    bits = (size + 7) // 8
    vector = lambda at: np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, bits, at), count=size))
    quotients, ends = vector(24), vector(24 + bits)
    starts = np.maximum(quotients, np.append(-1, ends[:-1]) + 1)
    lengths = ends - starts + 1
    n, at = int(lengths.sum()), 24 + 2 * bits
    remainders = np.zeros((n, 8), np.uint8)
    remainders[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(n, width)
    r_bits = 64 - range_bits - q_bits
    high = np.uint64(part << q_bits) + np.repeat(quotients, lengths).astype(np.uint64)
    counts = np.frombuffer(data, "<i8", n, at + n * width)
    return (high << np.uint64(r_bits)) | remainders.view("<u8").ravel(), counts


def merge(prints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different fingerprints in order, counts of equal ones added."""
    order = np.argsort(prints, kind="stable")
    prints, counts = prints[order], counts[order]
    first = np.flatnonzero(np.append(True, prints[1:] != prints[:-1]))
    return prints[first], np.add.reduceat(counts, first)


def _ranges(spark) -> int:
    """Bits of the ranges: two ranges at least for each shuffle partition."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")) * 2 - 1, 1).bit_length()


def repeated_fingerprints(prints: DataFrame) -> DataFrame:
    """``fp long, n long``: the fingerprints that ``prints`` (``fp long, n long``) counts more than once."""
    range_bits = _ranges(prints.sparkSession)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64), b.column(1).to_numpy(zero_copy_only=False)) for b in batches if b.num_rows]
        if not seen:
            return
        values, counts = merge(np.concatenate([s[0] for s in seen]), np.concatenate([s[1] for s in seen]))
        parts = (values >> np.uint64(64 - range_bits)).astype(np.int64)
        bounds = np.flatnonzero(np.append(True, parts[1:] != parts[:-1])).tolist() + [len(parts)]
        for k in range(0, len(bounds) - 1, 256):
            own = list(zip(bounds[k:k + 256], bounds[k + 1:k + 257]))
            yield pa.RecordBatch.from_arrays([
                pa.array([parts[a] for a, _ in own], pa.int64()),
                pa.array([_pack(values[a:b], counts[a:b], range_bits) for a, b in own], pa.binary()),
            ], ["part", "filter"])

    def meet(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        every = [_unpack(f.as_py(), part, range_bits) for f in table.column("filter")]
        values, counts = merge(np.concatenate([e[0] for e in every]), np.concatenate([e[1] for e in every]))
        more = counts > 1
        return pa.table({"fp": values[more].view(np.int64), "n": counts[more]})

    filters = prints.select("fp", "n").mapInArrow(build, "part long, filter binary")
    return filters.groupBy("part").applyInArrow(meet, "fp long, n long")


def exact_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: which row of its group of equal texts stays.

    Texts are equal when identical after lower-casing A-Z; null is empty, and
    empty texts equal each other. Returns ``<id_col>, keep_id, group_size, kept,
    text_sha256, fp``. The row with the largest id stays, null being the smallest;
    of whole rows repeated with one id, one stays. Other columns of ``df`` are
    not looked at.
    """
    ship_package(df.sparkSession)
    text = lower_ascii(F.col(text_col))
    rows = stage(
        df.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("fp"), F.sha2(text, 256).alias("sha"))
        .groupBy("id", "fp", "sha").agg(F.count("*").alias("n")),
        "prints",
    )
    repeated = small_or_shuffled(stage(repeated_fingerprints(rows), "repeated"), BROADCAST_ROWS)
    # The comparison: texts themselves are the key, so unequal texts with one fingerprint part.
    groups = (
        df.select(F.col(id_col).alias("id"), text.alias("norm"))
        .withColumn("fp", F.xxhash64("norm"))
        .join(repeated.select("fp"), "fp")
        .groupBy("fp", "norm").agg(F.max("id").alias("keep"), F.count("*").alias("size"))
        .select("fp", F.sha2("norm", 256).alias("sha"), "keep", "size")
    )
    return (
        rows.join(groups, ["fp", "sha"], "left")
        .withColumn("keep_id", F.coalesce("keep", "id"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
        .select(
            F.col("id").alias(id_col),
            "keep_id",
            F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
            (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
            F.col("sha").alias("text_sha256"),
            "fp",
        )
    )


def drop_exact_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that :func:`exact_copies` keeps, with the columns of ``df``."""
    found = stage(exact_copies(df, id_col, text_col).where("group_size > 1").select(F.col(id_col).alias("id"), F.col("fp").alias("mark"), "kept"), "copies")
    keys = found.groupBy("id", "mark").agg(F.max("kept").alias("stays"), F.count("*").alias("n"))
    return that_stay(df, id_col, F.xxhash64(lower_ascii(F.col(text_col))), keys, BROADCAST_ROWS)
