"""Near-duplicate documents by improved consistent weighted sampling.

A document is its shingles of SHINGLE words, each weighted by how often it has it
and by how rare it is. SAMPLES samples are consistent: two documents draw the same
with the probability of their weighted Jaccard similarity. Documents that agree in
all samples of one of the bands share a bucket and are candidates. Candidates are
verified by their weighted Jaccard similarity, SIMILARITY or more.

Equal texts are one node from the start. A sketch of each text, a byte of every
sample, tells most pairs apart that share a bucket by chance; whole texts are compared
of the others. In a bucket not all pairs are compared:
its members are compared with a leader; two of which each is linked with the
leader are in one class already. In buckets with several classes left, every pair
of members of two classes is decided, but by tasks that hold the members, so no row
is made for a pair: sketches first, in blocks of members, and then the texts of
those members that have someone to be compared with. Members whose distances to the
leader, where these are known, differ by more than the distance allowed are not
compared (that distance is a metric, so they cannot be near), nor are those that
share an earlier bucket, which decides them, or are linked by then. A task hands on
only links that join two classes.

The rarity of a shingle is taken from document frequencies summed in 2^DF_BITS
places by hash, over all documents: a table of fixed size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarweave.llm.common import BROADCAST_ROWS, pair_texts, stage, texts_of, that_stay
from tarweave.llm.graph import components, joined
from tarweave.llm.spans import text_slices, worker_state
from tarweave.llm.words import find_words, mix, ragged, shingles
from tarweave.session import ship_package

SHINGLE = 5
SIMILARITY = 0.8
SAMPLES, BANDS = 64, 16
DF_BITS = 20
#: Numbers of a sketch, each of a byte of eight samples.
SKETCH = SAMPLES // 8
#: Standard deviations below their mean at which the samples agree of texts that are too unlike to be
#: compared: 3 in 10,000 pairs of the least similarity that counts have fewer.
SLACK = 3.5
#: Bytes of texts and shingles that a comparing worker holds.
HELD = 16 << 20
#: Bytes of texts that are cut into shingles at once, with some twenty times as many beside them.
SLICE = 1 << 20
#: Members of a block, and bytes of their texts: a task holds two blocks at once.
BLOCK_ROWS, BLOCK_BYTES = 4096, 4 << 20
#: Entries of the frequency table that travel in one row.
_CELL = 1 << 12
#: The weight of a shingle that every document has; 1 is that of the rarest.
FLOOR = 0.8

_rng = np.random.default_rng(11)
_R = _rng.standard_gamma(2, 1 << 16).astype(np.float32)
_LOG_C = np.log(_rng.standard_gamma(2, 1 << 16)).astype(np.float32)
_SEEDS = _rng.integers(0, 1 << 63, SAMPLES, np.uint64) * np.uint64(2) + np.uint64(1)


def counted_shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hash, count, bounds of rows)``: the different shingles of each row, in order of their hashes."""
    words = find_words(pc.utf8_lower(texts))
    hashes, _, rows = shingles(words.hashes(), words.rows, SHINGLE)
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    order = np.argsort(hashes, kind="stable")
    order = order[np.argsort(row[order], kind="stable")]
    hashes, row = hashes[order], row[order]
    first = np.flatnonzero(np.append(np.ones(min(len(row), 1), bool), (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])))
    return hashes[first], np.diff(np.append(first, len(row))), np.searchsorted(row[first], np.arange(len(rows)))


def _cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - DF_BITS)).astype(np.int64)


def rarity(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """A weight from FLOOR (in every document) to 1 (in one at most) for each place of the frequency table.

    The weight grows with the logarithm of the inverse document frequency. The floor
    keeps copies of a text that is copied often from becoming unlike for the few
    words in which they differ, as only those are rare.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("near copies")
        sums, docs = np.zeros(1 << DF_BITS, np.int64), 0
        for batch in batches:
            docs += batch.num_rows
            for texts in text_slices(batch.column(0), SLICE):
                sums += np.bincount(_cell(counted_shingles(texts)[0]), minlength=len(sums))
        if docs:
            # A partition's counts fit in 32 bits.
            cells = sums.astype(np.uint32).reshape(-1, _CELL)
            yield pa.RecordBatch.from_arrays([
                pa.array(range(-1, len(cells)), pa.int64()), pa.array([np.int64(docs).tobytes(), *(c.tobytes() for c in cells)], pa.binary()),
            ], ["cell", "counts"])

    def add(table: pa.Table) -> pa.Table:
        cell = table.column("cell")[0].as_py()
        kind = np.int64 if cell < 0 else np.uint32
        total = sum(np.frombuffer(c.as_py(), kind).astype(np.int64) for c in table.column("counts"))
        return pa.table({"cell": pa.array([cell], pa.int64()), "counts": pa.array([total.tobytes()], pa.binary())})

    cells = df.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(count, "cell long, counts binary")
    # 2^DF_BITS numbers, whatever the corpus.
    parts = dict(cells.groupBy("cell").applyInArrow(add, "cell long, counts binary").collect())
    if not parts:
        return np.ones(1 << DF_BITS, np.float32)
    (docs,) = np.frombuffer(parts.pop(-1), np.int64)
    seen = np.concatenate([np.frombuffer(parts[k], np.int64) for k in range(len(parts))])
    return (FLOOR + (1 - FLOOR) * np.log((1 + docs) / (1 + np.minimum(seen, docs))) / math.log(1 + docs)).astype(np.float32)


def signatures(hashes: np.ndarray, logs: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Samples ``[row, sample]`` of rows that all have shingles, given the logarithms of their weights.

    A sample is the smallest value, as bits: it stands for a shingle and its
    quantised weight, of which no two have the same values but by chance.
    """
    out = np.empty((len(rows) - 1, SAMPLES), np.uint32)
    smallest = np.full(out.shape, np.inf, np.float32)
    step = 1 << 16
    for a in range(0, len(hashes), step):
        b = min(a + step, len(hashes))
        lo, hi = np.searchsorted(rows, a, "right") - 1, np.searchsorted(rows, b, "left")
        at = np.maximum(rows[lo:hi] - a, 0)
        h, log = hashes[a:b], logs[a:b]
        for j in range(SAMPLES):
            x = h * _SEEDS[j]
            r = _R[(x >> np.uint64(48)).view(np.int64)]
            value = _LOG_C[((x >> np.uint64(32)) & np.uint64(0xFFFF)).view(np.int64)]
            beta = ((x >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.float32) * np.float32(2**-16)
            t = np.floor(log / r + beta)
            t += 1
            t -= beta
            t *= r
            value = value - t
            smallest[lo:hi, j] = np.minimum(smallest[lo:hi, j], np.minimum.reduceat(value, at))
    out[:] = smallest.view(np.uint32)
    return out


def bands(samples: np.ndarray) -> np.ndarray:
    """A hash of each band of the samples, different between bands."""
    width = SAMPLES // BANDS
    out = np.empty((len(samples), BANDS), np.uint64)
    for k in range(BANDS):
        h = np.full(len(samples), k, np.uint64)
        for j in range(k * width, (k + 1) * width):
            h = mix(h + samples[:, j].astype(np.uint64))
        out[:, k] = h
    return out


def node_of(text: Column) -> Column:
    """What stands for a text: equal texts are one node. Null is empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def sketch(samples: np.ndarray) -> np.ndarray:
    """A byte of each sample, eight to a number: ``[row, SKETCH]``."""
    return (samples * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8).view("<i8")


def _signed(texts: DataFrame, weights: np.ndarray) -> DataFrame:
    """``node, buckets, bytes, s0, s1, ...`` of every text that has words (``node, text``): a bucket for each band, its length, the sketch."""
    names = ["node", "buckets", "bytes", *(f"s{k}" for k in range(SKETCH))]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("near copies")
        for batch in batches:
            done = 0
            for part in text_slices(batch.column("text"), SLICE):
                hashes, counts, rows = counted_shingles(part)
                own = np.flatnonzero(np.diff(rows))
                if len(own):
                    logs = np.log(counts * weights[_cell(hashes)]).astype(np.float32)
                    samples = signatures(hashes, logs, np.append(rows[own], len(hashes)))
                    bounds = pa.array(np.arange(len(own) + 1) * BANDS, pa.int32())
                    buckets = pa.ListArray.from_arrays(bounds, pa.array(bands(samples).ravel().view(np.int64)))
                    size = pc.cast(pc.binary_length(part), pa.int64()).take(pa.array(own))
                    yield pa.RecordBatch.from_arrays([batch.column("node").take(pa.array(own + done)), buckets, size, *map(pa.array, sketch(samples).T.copy())], names)
                done += len(part)

    schema = "node binary, buckets array<long>, bytes long, " + ", ".join(f"s{k} long" for k in range(SKETCH))
    return texts.select("node", "text").mapInArrow(sign, schema)


def _agreeing(a: str, b: str) -> Column:
    """How many samples of two sketches agree, by their columns' prefixes: bytes of the exclusive or that are zero."""
    total = []
    for k in range(SKETCH):
        x = f"({a}{k} ^ {b}{k})"
        for shift in (4, 2, 1):
            x = f"({x} | shiftrightunsigned({x}, {shift}))"
        total.append(f"bit_count({x} & 72340172838076673)")  # the lowest bit of every byte
    return F.expr(f"{8 * SKETCH} - ({' + '.join(total)})")


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], weights: np.ndarray) -> float:
    """Weighted Jaccard similarity of two rows of counted shingles (hashes in order, counts)."""
    wa, wb = a[1] * weights[_cell(a[0])].astype(np.float64), b[1] * weights[_cell(b[0])].astype(np.float64)
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = float(np.minimum(wa[i], wb[j]).sum())
    return both / (float(wa.sum()) + float(wb.sum()) - both)


def _verified(pairs: DataFrame, nodes: DataFrame, weights: np.ndarray) -> DataFrame:
    """``a, b, far``: the distance of each pair of nodes, by their whole texts."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("near copies")
        for batch in batches:
            far, known, held = [], {}, 0
            for text_a, text_b in zip(batch.column("text_a"), batch.column("text_b")):
                sides = []
                for text in (text_a.as_py(), text_b.as_py()):
                    if text not in known:
                        if held > HELD:
                            known, held = {}, 0
                        known[text] = counted_shingles(pa.array([text]))[:2]
                        held += len(text) + sum(side.nbytes for side in known[text])
                    sides.append(known[text])
                far.append(1 - similarity(*sides, weights))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(far, pa.float64())], ["a", "b", "far"])

    return pair_texts(pairs, nodes).mapInArrow(compare, "a binary, b binary, far double")


#: What a group of rows is compared as: the blocks ``lo`` and ``hi`` of a bucket.
_GROUP = ["bucket", "lo", "hi"]


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows in order of their groups, as tables of whole groups and where each group starts and ends."""
    held, last = [], None

    def table(batches: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
        rows = pa.Table.from_batches(batches).combine_chunks()
        keys = np.stack([rows.column(c).to_numpy() for c in _GROUP], 1)
        return rows, np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, [len(keys)]])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in _GROUP], 1)
        change = (keys[1:] != keys[:-1]).any(1)
        starts = np.flatnonzero(np.append(last is not None and bool((keys[0] != last).any()), change))
        last = keys[-1]
        if len(starts):
            first, cut = int(starts[0]), int(starts[-1])
            held.append(batch.slice(0, first))
            if any(b.num_rows for b in held):
                yield table(held)
            if cut > first:
                yield table([batch.slice(first, cut - first)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield table(held)


class _Group:
    """Members of a block, or of two blocks that are compared with each other, the commonest class last."""

    def __init__(self, rows: pa.Table, alike: int, limit: float):
        _, root = np.unique(rows.column("root").combine_chunks().cast(pa.binary()).to_numpy(zero_copy_only=False), return_inverse=True)
        self.order = np.lexsort((root, np.bincount(root)[root]))
        self.root = root[self.order]
        self.alike, self.limit = alike, limit
        self.bucket = rows.column("bucket")[0].as_py()
        self.sketch = np.stack([rows.column(f"s{k}").to_numpy()[self.order].view(np.uint8).reshape(-1, 8) for k in range(SKETCH)])
        self.buckets = rows.column("buckets").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)[self.order]
        self.far = rows.column("far").to_numpy()[self.order]  # unknown: not a number
        across = rows.column("lo")[0].as_py() != rows.column("hi")[0].as_py()
        self.block = rows.column("block").to_numpy()[self.order] if across else None

    def others(self, i: int) -> np.ndarray:
        """Members after member ``i`` that it has to be compared with."""
        open_ = self.root[i + 1:] != self.root[i]
        if self.block is not None:
            open_ &= self.block[i + 1:] != self.block[i]
        open_ &= ~(np.abs(self.far[i + 1:] - self.far[i]) > self.limit)
        at = np.flatnonzero(open_) + i + 1
        if not len(at):
            return at
        # Eight bytes of zeros and ones at once: their sums fit in a byte.
        same = (self.sketch[:, at] == self.sketch[:, i:i + 1]).view(np.uint64)[:, :, 0].sum(0, dtype=np.uint64)
        at = at[(same * np.uint64(0x0101010101010101) >> np.uint64(56)) >= self.alike]
        if len(at):
            # Of the buckets that two share, the first decides.
            first = (self.buckets[at] == self.buckets[i]).argmax(1)
            at = at[self.buckets[i][first] == self.bucket]
        return at

    def done(self, i: int) -> bool:
        """Whether the members from ``i`` on are in one class."""
        return bool((self.root[i:] == self.root[i]).all())


def _with_others(rows: DataFrame, alike: int, limit: float) -> DataFrame:
    """The rows of groups that have another row of their group to be compared with."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("near copies")
        for table, bounds in _whole_groups(batches):
            stay = np.zeros(len(table), bool)
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                group = _Group(table.slice(a, b - a), alike, limit)
                for i in range(b - a - 1):
                    if group.done(i):
                        break
                    at = group.others(i)
                    if len(at):
                        stay[a + group.order[i]] = True
                        stay[a + group.order[at]] = True
            if stay.any():
                yield from table.filter(pa.array(stay)).to_batches()

    return rows.repartition(*_GROUP).sortWithinPartitions(*_GROUP).mapInArrow(keep, rows.schema)


def _links(rows: DataFrame, weights: np.ndarray, alike: int, limit: float) -> DataFrame:
    """``a, b`` of nodes whose texts are near, for rows of groups with their ``text``: no more than join the classes of a group."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("near copies")
        for table, bounds in _whole_groups(batches):
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                found_a, found_b = [], []
                rows = table.slice(a, b - a)
                group = _Group(rows, alike, limit)
                texts = rows.column("text").combine_chunks().take(pa.array(group.order))
                parts = [counted_shingles(part) for part in text_slices(texts, SLICE)]
                hashes = np.concatenate([p[0] for p in parts])
                weight = np.concatenate([p[1] for p in parts]) * weights[_cell(hashes)].astype(np.float64)
                size = np.concatenate([np.diff(p[2]) for p in parts])
                start = np.cumsum(size) - size
                total = np.add.reduceat(weight, start)
                known, number = np.unique(hashes, return_inverse=True)
                own = np.zeros(len(known))
                for i in range(b - a - 1):
                    if group.done(i):
                        break
                    at = group.others(i)
                    if not len(at):
                        continue
                    mine = slice(start[i], start[i] + size[i])
                    own[number[mine]] = weight[mine]
                    theirs = ragged(start[at], size[at])
                    both = np.add.reduceat(np.minimum(weight[theirs], own[number[theirs]]), np.cumsum(size[at]) - size[at])
                    own[number[mine]] = 0
                    at = at[1 - both / (total[i] + total[at] - both) <= limit]
                    classes, first = np.unique(group.root[at], return_index=True)
                    if len(classes):
                        found_a += [group.order[i]] * len(classes)
                        found_b += group.order[at[first]].tolist()
                        group.root[np.isin(group.root, classes)] = group.root[i]
                if found_a:
                    nodes = rows.column("node").combine_chunks()
                    yield pa.RecordBatch.from_arrays([nodes.take(pa.array(found_a)), nodes.take(pa.array(found_b))], ["a", "b"])

    return rows.repartition(*_GROUP).sortWithinPartitions(*_GROUP).mapInArrow(link, "a binary, b binary")


def _blocks(members: DataFrame) -> DataFrame:
    """Each member once for every two blocks of its bucket that it is compared in: ``block, lo, hi``."""
    earlier = Window.partitionBy("bucket").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    before = F.count("*").over(earlier) / BLOCK_ROWS + F.coalesce(F.sum("bytes").over(earlier), F.lit(0)) / BLOCK_BYTES
    return (
        members.withColumn("block", F.floor(before).cast("long"))
        .withColumn("last", F.max("block").over(Window.partitionBy("bucket")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))))
        .withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")).drop("last", "other", "bytes")
    )


def near_classes(nodes: DataFrame, weights: np.ndarray, similarity: float = SIMILARITY) -> DataFrame:
    """``node, root`` of the ``nodes`` (``node, text``) that have near copies: one root for all that hang together."""
    limit = 1 - similarity + 1e-12
    sketches = [f"s{k}" for k in range(SKETCH)]
    signed = stage(_signed(nodes, weights).dropDuplicates(["node"]), "signed")
    members = signed.select("node", F.explode("buckets").alias("bucket"))
    leaders = members.groupBy("bucket").agg(F.min("node").alias("lead"), F.count("*").alias("n")).where("n > 1").drop("n")
    members = stage(members.join(leaders, "bucket"), "members")
    # Only pairs whose sketches are alike are compared by their texts.
    enough = math.floor(SAMPLES * similarity - SLACK * math.sqrt(SAMPLES * similarity * (1 - similarity)))
    lead = signed.select(F.col("node").alias("lead"), *[F.col(c).alias(f"l{c}") for c in sketches])
    pairs = (
        members.where("node != lead").select("lead", "node").distinct()
        .join(signed.select("node", *sketches), "node").join(lead, "lead")
        .where(_agreeing("s", "ls") >= enough).select(F.col("lead").alias("a"), F.col("node").alias("b"))
    )
    far = stage(_verified(pairs, nodes, weights), "distances")
    labels = components(far.where(F.col("far") <= limit).select("a", "b"))
    # Members that a bucket's first leader did not decide: with their distance to it, if it is known. The leader itself is done.
    marked = (
        members.where("node != lead").join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    )
    several = marked.groupBy("bucket").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least != most").select("bucket")
    open_ = (
        marked.join(several, "bucket")
        .join(far.select(F.col("a").alias("lead"), F.col("b").alias("node"), "far"), ["lead", "node"], "left").drop("lead")
        .join(signed, "node")
    )
    rows = stage(_with_others(_blocks(open_), enough, limit), "open")
    if rows.isEmpty():
        return labels
    found = _links(rows.join(texts_of(rows, nodes), "node"), weights, enough, limit)
    return joined(labels, stage(found.distinct(), "more"))


def near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``df``: the class of near copies it belongs to.

    ``<id_col>, class_id, class_size, kept, print``. A class is all documents that
    hang together by links; ``class_id`` is its smallest id (null being the
    largest), and the row with it is ``kept``; of rows with one id, the smallest
    ``print`` (a hash of the text) decides, of whole rows repeated one stays.
    Texts without words (null is empty) are in a class with equal texts only.
    """
    ship_package(df.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    weights = rarity(df, text_col)
    rows = stage(df.select(F.col(id_col).alias("id"), node_of(F.col(text_col)).alias("node")).groupBy("id", "node").agg(F.count("*").alias("n")), "nodes")
    labels = near_classes(df.select(node_of(F.col(text_col)).alias("node"), text.alias("text")), weights, similarity)
    rooted = stage(rows.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted")
    classes = rooted.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node")).alias("first"), F.sum("n").alias("class_size")
    )
    return (
        rooted.join(classes, "root")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
        .select(
            F.col("id").alias(id_col),
            F.col("first.id").alias("class_id"),
            "class_size",
            (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("node") == F.col("first.node")) & (F.col("copy") == 1)).alias("kept"),
            F.col("node").alias("print"),
        )
    )


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class of :func:`near_copies`, with the columns of ``df``."""
    found = near_copies(df, id_col, text_col, similarity).where("class_size > 1").select(F.col(id_col).alias("id"), F.col("print").alias("mark"), "kept")
    keys = stage(found.groupBy("id", "mark").agg(F.max("kept").alias("stays"), F.count("*").alias("n")), "copies")
    return that_stay(df, id_col, node_of(F.col(text_col)), keys, BROADCAST_ROWS)
