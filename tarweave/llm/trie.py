"""A trie of the turn prefixes that conversations share, with sums over its subtrees.

A node is a distinct prefix, known by a 128-bit digest: the exclusive or of the
hashes of its turns with their depths, summed in segments of turns. Conversations,
long ones by segments, are dealt out to shards. A shard enumerates the distinct
digests of its rows and gives each a slot by a minimal perfect hash, verified
against the digest in the slot; counts are scattered into flat arrays by slot, and
sums go up the array of parents' slots from the deepest nodes on. A node that
several shards hold has one row for each of them, and these are summed by digest;
its own share of a sum is counted in the shard of its smallest member alone. What
lies below a segment of a long conversation is added at the segment's last turn.
So no shard holds more than its share of rows, however many conversations begin
alike and however long one is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarweave.llm.common import stage
from tarweave.llm.perfect_hash import PerfectHash
from tarweave.llm.ranks import crc32_sql, ranked

#: Turns of a segment; rows of a shard on average.
SEGMENT, SHARD_ROWS = 1 << 12, 200_000
#: Turns that a conversation can take over from the first of its hundred.
BORROWED = 5


def segment(depth: str, size: int) -> Column:
    return F.expr(f"{depth} div {size}")


def ordered_turns(turns: DataFrame) -> DataFrame:
    """``conv, i, n, print, size``: turns by their place from 0 of ``n``, a digest of role and text, and the text's characters.

    ``turns`` are ``conv_id, turn, role, text``. Turns without a number come first,
    equal numbers go by digest, repeated rows are turns of their own, a null role or
    text is empty. Rows without a ``conv_id`` belong to no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    both = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    slim = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), F.unhex(F.sha2(both, 256)).alias("print"), F.char_length(text).alias("size")
    )
    return ranked(slim, "conv", ["turn", "print"]).drop("turn")


def rebuilt(turns: DataFrame, size: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """``conv, depth, print, size`` of rebuilt conversations, depths from 1, and ``conv, m``: their lengths, of turnless ones too.

    Conversation c begins with the first h turns of c - c % 100, as far as there
    are, h being the CRC-32 of c's digits modulo 6, and goes on with its own turns
    after its first h.
    """
    turns = stage(turns, "turns")
    convs = turns.where("i = 0").select("conv", "n")
    convs = convs.withColumn("h", F.crc32(F.col("conv").cast("string")) % (BORROWED + 1)).withColumn("base", F.expr("conv - conv % 100"))
    bases = convs.select(F.col("conv").alias("base"), F.col("n").alias("nb"))
    # At most 199 conversations have a base in common.
    convs = convs.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("nb", F.lit(0))))
    convs = stage(convs.select("conv", "base", "n", "h", "taken", (F.col("taken") + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("m")), "convs")
    # Lengths are repeated for each segment, so that a long conversation's turns meet them in many tasks.
    spread = convs.select("conv", "h", "taken", F.explode(F.sequence(F.lit(0).cast("long"), segment("n", size))).alias("seg"))
    own = turns.withColumn("seg", segment("i", size)).join(spread, ["conv", "seg"]).where("i >= h")
    own = own.select("conv", (F.col("i") - F.col("h") + F.col("taken") + 1).alias("depth"), "print", "size")
    wanted = convs.where("taken > 0").select("conv", "base", F.explode(F.expr("sequence(0L, taken - 1)")).alias("i"))
    lent = turns.where(F.col("i") < BORROWED).select(F.col("conv").alias("base"), "i", "print", "size")
    taken = wanted.join(lent, ["base", "i"]).select("conv", (F.col("i") + 1).alias("depth"), "print", "size")
    return own.unionByName(taken), convs.select("conv", "m")


def prefixes(turns: DataFrame, convs: DataFrame, size: int = SEGMENT) -> DataFrame:
    """Every prefix of every conversation and its parent's digest; the root has none.

    ``turns`` and ``convs`` are those of ``rebuilt``. The columns are ``conv, seg,
    depth, x, y, px, py, size, last, head, foot``: whether the conversation ends
    there, and whether its segment begins or ends there and others come before or after.
    """
    rows = turns.select("conv", segment("depth", size).alias("seg"), "depth", "size", F.xxhash64("depth", "print").alias("tx"), F.xxhash64(F.lit(7), "depth", "print").alias("ty"))
    rows = stage(rows, "rows")
    blocks = rows.groupBy("conv", "seg").agg(F.bit_xor("tx").alias("bx"), F.bit_xor("ty").alias("by"))
    along = Window.partitionBy("conv").orderBy("seg")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    # The last segment knows that it is the last; a conversation has a row for each segment here.
    blocks = blocks.select(
        "conv", "seg", F.coalesce(F.bit_xor("bx").over(earlier), F.lit(0)).alias("bx"), F.coalesce(F.bit_xor("by").over(earlier), F.lit(0)).alias("by"),
        F.lead("seg").over(along).isNull().alias("final"),
    )
    inside = Window.partitionBy("conv", "seg").orderBy("depth")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    found = (
        rows.join(blocks, ["conv", "seg"])
        .withColumn("x", F.bit_xor("tx").over(upto).bitwiseXOR(F.col("bx")))
        .withColumn("y", F.bit_xor("ty").over(upto).bitwiseXOR(F.col("by")))
        .withColumn("last", F.col("final") & F.lead("depth").over(inside).isNull())
        .select("conv", "seg", "depth", "x", "y", F.col("x").bitwiseXOR(F.col("tx")).alias("px"), F.col("y").bitwiseXOR(F.col("ty")).alias("py"), "size", "last",
                (F.col("depth") % size == 0).alias("head"), ((F.col("depth") % size == size - 1) & ~F.col("last")).alias("foot"))
    )
    none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    root = convs.select("conv", zero.alias("seg"), zero.alias("depth"), zero.alias("x"), zero.alias("y"), none.alias("px"), none.alias("py"), F.lit(0).alias("size"), (F.col("m") == 0).alias("last"), F.lit(True).alias("head"), ((F.col("m") > 0) & F.lit(size == 1)).alias("foot"))
    return found.unionByName(root)


def _words(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().to_numpy(zero_copy_only=False)


def _enumerate(rows: pa.Table) -> pa.Table:
    """The distinct nodes of a shard's rows by slot, with members counted and the slot of the parent (-1: in another shard, or none)."""
    x, y = _words(rows, "x"), _words(rows, "y")
    order = np.lexsort((y, x))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(x[order]) != 0) | (np.diff(y[order]) != 0)
    first = order[new]
    nodes = PerfectHash(x[first], y[first])
    slot = nodes.slots(x, y)
    counts, least = np.zeros(len(nodes), np.int64), np.full(len(nodes), np.iinfo(np.int64).max)
    np.add.at(counts, slot, 1)
    np.minimum.at(least, slot, _numbers(rows, "conv"))
    some = np.zeros(len(nodes), np.int64)
    some[slot] = np.arange(len(slot))  # a row of each node
    table = rows.take(some)
    parent = np.where(_numbers(table, "head"), -1, nodes.slots(_words(table, "px"), _words(table, "py")))
    columns = {"shard": table.column("shard"), "slot": np.arange(len(nodes)), "parent": parent, "n": counts, "conv": least}
    return pa.table(columns | {c: table.column(c) for c in ("x", "y", "px", "py", "depth", "head", "size")})


def _accumulate(nodes: pa.Table) -> pa.Table:
    """Sums over subtrees as far as the shard knows them, and for nodes counted here the parent's smallest member."""
    slot, parent, depth = _numbers(nodes, "slot"), _numbers(nodes, "parent"), _numbers(nodes, "depth")
    up, leaves, saved, least = (np.zeros(len(slot), np.int64) for _ in range(4))
    up[slot], leaves[slot], saved[slot], least[slot] = parent, _numbers(nodes, "leaves"), _numbers(nodes, "saved"), _numbers(nodes, "conv")
    order = slot[np.argsort(-depth, kind="stable")]
    for at in np.split(order, np.flatnonzero(np.diff(-np.sort(-depth))) + 1):
        at = at[up[at] >= 0]
        np.add.at(leaves, up[at], leaves[at])
        np.add.at(saved, up[at], saved[at])
    known = (parent >= 0) & _numbers(nodes, "own")
    above = pa.array(np.where(known, least[parent], 0), mask=~known)
    return pa.table({"x": nodes.column("x"), "y": nodes.column("y"), "leaves": leaves[slot], "saved": saved[slot], "parent_conv": above})


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``x, y, conv`` in order: of consecutive equal digests the ids as one text."""
    for batch in batches:
        x, y, conv = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("x", "y", "conv"))
        starts = np.flatnonzero(np.concatenate([[True], (np.diff(x) != 0) | (np.diff(y) != 0)]) if len(x) else np.zeros(0, bool))
        ids = conv.tolist()
        texts = [",".join(map(str, ids[a:b])) for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)])]
        yield pa.RecordBatch.from_arrays([pa.array(x[starts]), pa.array(y[starts]), pa.array(conv[starts]), pa.array(texts, pa.string())], ["x", "y", "conv", "ids"])


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``x, y, ids`` in order: the digest of each node's texts, commas between, one text at a time."""
    now, state, names = None, None, ["x", "y", "ends_sha256"]
    done: list[tuple] = []
    for batch in batches:
        for x, y, ids in zip(*(batch.column(n) for n in ("x", "y", "ids"))):
            key = (x.as_py(), y.as_py())
            if key != now:
                if now is not None:
                    done.append((*now, state.hexdigest()))
                now, state = key, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.as_buffer())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.int64(), pa.int64(), pa.string()))], names)
            done = []
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*now, state.hexdigest())], names)


def ends(rows: DataFrame) -> DataFrame:
    """``x, y, ends_sha256``: SHA-256 of the ids, ascending and comma-joined, of the conversations that end at a node.

    Ids become texts where a sort by range has brought them, thousands in a row.
    Only the digest itself needs all of a node's texts one after another, and is
    taken while they pass.
    """
    keys = ["x", "y", "conv"]
    ids = rows.where("last").select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys)
    pieces = stage(ids.mapInArrow(_joined_ids, "x long, y long, conv long, ids string"), "ids")
    counts = pieces.groupBy("x", "y").agg(F.count("*").alias("pieces"), F.first("ids").alias("ids"))
    whole = counts.where("pieces = 1").select("x", "y", F.sha2("ids", 256).alias("ends_sha256"))
    several = pieces.join(counts.where("pieces > 1").select("x", "y"), ["x", "y"], "left_semi")
    cut = several.repartition("x", "y").sortWithinPartitions(*keys).select("x", "y", "ids").mapInArrow(_hash_pieces, "x long, y long, ends_sha256 string")
    return whole.unionAll(cut)


def nodes(rows: DataFrame, size: int = SEGMENT, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The nodes of the trie of ``rows`` (see ``prefixes``): ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``saved_tokens`` sums over the subtree, for every node, the characters of its
    last text for each member but one. Without conversations there is no node.
    """
    rows = stage(rows, "prefixes")
    shards = -(-rows.count() // shard_rows) or 1
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("conv", "seg"), F.lit(shards)))
    schema = "shard long, slot long, parent long, n long, conv long, x long, y long, px long, py long, depth long, head boolean, size int"
    local = stage(rows.groupBy("shard").applyInArrow(_enumerate, schema), "slots")

    same = [F.first(c).alias(c) for c in ("px", "py", "depth", "head", "size")]
    total = local.groupBy("x", "y").agg(F.sum("n").alias("n"), F.min("conv").alias("conv"), *same)
    total = stage(total, "nodes")
    children = total.where("depth > 0").groupBy(F.col("px").alias("x"), F.col("py").alias("y")).agg(F.count("*").alias("n_children"))
    total = total.join(children, ["x", "y"], "left").na.fill(0, ["n_children"])
    total = stage(total.withColumn("leaf", (F.col("n_children") == 0).cast("long")).withColumn("save", (F.col("n") - 1) * F.col("size")), "counted")

    below = total.where(F.col("depth") >= size).groupBy("conv", (segment("depth", size) - 1).alias("seg")).agg(F.sum("leaf").alias("leaf"), F.sum("save").alias("save"))
    after = Window.partitionBy("conv").orderBy(F.desc("seg")).rowsBetween(Window.unboundedPreceding, 0)
    later = rows.where("foot").select("shard", "conv", "seg", "x", "y").join(below, ["conv", "seg"], "left").na.fill(0, ["leaf", "save"])
    later = later.select("shard", "x", "y", F.sum("leaf").over(after).alias("leaf"), F.sum("save").over(after).alias("save"))
    later = later.groupBy("shard", "x", "y").agg(F.sum("leaf").alias("more_leaves"), F.sum("save").alias("more_saved"))

    own = F.col("l.conv") == F.col("t.conv")
    share = lambda c: F.when(own, F.col(f"t.{c}")).otherwise(0)
    joined = local.alias("l").join(total.alias("t"), ["x", "y"]).select(
        F.col("l.shard").alias("shard"), "slot", "parent", "x", "y", F.col("l.depth").alias("depth"), F.col("t.conv").alias("conv"), own.alias("own"), share("leaf").alias("leaf"), share("save").alias("save")
    )
    joined = joined.join(later, ["shard", "x", "y"], "left").select(
        "shard", "slot", "parent", "x", "y", "depth", "conv", "own",
        (F.col("leaf") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"), (F.col("save") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
    )
    parts = joined.groupBy("shard").applyInArrow(_accumulate, "x long, y long, leaves long, saved long, parent_conv long")
    sums = parts.groupBy("x", "y").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"), F.max("parent_conv").alias("parent_conv"))

    # Parents on the other side of a segment's border.
    cut = total.where("head AND depth > 0").select("x", "y", F.col("px").alias("qx"), F.col("py").alias("qy"))
    parents = total.select(F.col("x").alias("qx"), F.col("y").alias("qy"), F.col("conv").alias("cut_parent"))
    cut = cut.join(parents, ["qx", "qy"]).select("x", "y", "cut_parent")
    found = total.join(sums, ["x", "y"]).join(ends(rows), ["x", "y"], "left").join(cut, ["x", "y"], "left")
    return found.select(
        F.col("conv").alias("conv_id"), "depth", F.coalesce("parent_conv", "cut_parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def conversation_trie(turns: DataFrame, size: int = SEGMENT, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The trie of rebuilt conversations (see ``ordered_turns``, ``rebuilt`` and ``nodes``); columns but ``conv_id, turn, role, text`` are not looked at."""
    return nodes(prefixes(*rebuilt(ordered_turns(turns), size), size), size, shard_rows)


def sql() -> str:
    """The same rows in DuckDB's SQL, every node summed over all its descendants."""
    key = lambda path: f"array_to_string(list_transform({path}, lambda e: e.p), ',')"
    return f"""
    WITH t AS (
      SELECT conv_id AS c, turn, coalesce(text, '') AS text, sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS p
      FROM conversations WHERE conv_id IS NOT NULL),
    o AS (SELECT c, {crc32_sql('c')} % 6 AS h, list({{'p': p, 'k': length(text)}} ORDER BY turn NULLS FIRST, p) AS ts FROM t GROUP BY c),
    r AS (SELECT o.c, list_concat(coalesce(b.ts[1:o.h], []), o.ts[(o.h + 1):]) AS ts FROM o LEFT JOIN o b ON b.c = o.c - o.c % 100),
    m AS (SELECT c, ts, unnest(range(0, len(ts) + 1)) AS depth FROM r),
    k AS (SELECT c, depth, ts[1:depth] AS path, len(ts) = depth AS ends FROM m),
    n AS (
      SELECT {key('path')} AS key, any_value(path) AS path, min(c) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs,
             sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
      FROM k GROUP BY 1),
    a AS (SELECT *, CASE WHEN depth > 0 THEN {key('path[1:(depth - 1)]')} END AS up FROM n),
    ch AS (SELECT up, count(*) AS n_children FROM a WHERE up IS NOT NULL GROUP BY up),
    v AS (SELECT a.*, coalesce(ch.n_children, 0) AS n_children, CASE WHEN depth > 0 THEN (n_convs - 1) * path[depth].k ELSE 0 END AS saved FROM a LEFT JOIN ch ON a.key = ch.up),
    u AS (SELECT unnest(list_transform(range(0, depth + 1), lambda d: {key('path[1:d]')})) AS top, saved, n_children FROM v),
    s AS (SELECT top, CAST(sum(saved) AS BIGINT) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM u GROUP BY top)
    SELECT v.conv_id, v.depth, w.conv_id AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves, s.saved_tokens, v.ends_sha256
    FROM v JOIN s ON v.key = s.top LEFT JOIN v w ON v.up = w.key
    """
