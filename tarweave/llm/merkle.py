"""A Merkle manifest of a dataset: what a row's digest, its proof and one root say.

Rows are the leaves of a tree for each source, in order of their ids; the roots of
the sources are the leaves of a tree of their own. Every node but a root has 15
siblings at most, which lag and lead columns of fixed offsets bring beside it,
masked by its slot in the run and the run's length; the first row of a run hashes
the run's parent. A window holds one run, so no source is too big for a task, and
the rows then lie where their parents' proofs are joined to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarweave.llm.common import lower_ascii, stage
from tarweave.llm.ranks import crc32_sql, ranked

#: Children of a node.
WIDTH = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """SHA-256 of texts one after another, as lowercase hex."""
    return F.sha2(F.concat(*parts), 256)


def leaf(fields: dict[str, Column]) -> Column:
    """Digest of a row: of every field its length in bytes, a colon and itself, or a hyphen for null."""
    texts = (c.cast("string") for c in fields.values())
    return digest(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts))


def leaves(docs: DataFrame) -> DataFrame:
    """``doc_id, source, leaf, tampered``: the digest of each row, and that of the row as tampered with (null: it isn't)."""
    fields = {name: F.col(name) for name in FIELDS}
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    changed = F.when(F.col("text").isNotNull(), lower_ascii(F.col("text")))
    return docs.select("doc_id", "source", leaf(fields).alias("leaf"), F.when(chosen, leaf(fields | {"text": changed})).alias("tampered"))


# A node's run, its slot in the run, and the run's length.
RUN, SLOT = f"i div {WIDTH}", f"i % {WIDTH}"
LENGTH = f"least({WIDTH}, n - i + {SLOT})"


def _beside(tree: str, shift: str, offsets: range, inside: str) -> Column:
    """The hashes at fixed offsets from a node, as far as they are in its run, joined to one text."""
    window = f"OVER (PARTITION BY `{tree}`, run ORDER BY i)"
    return F.expr("concat(" + ", ".join(f"if({inside.format(k=k)}, {shift}(hash, {k}) {window}, '')" for k in offsets) + ")")


def _before(tree: str) -> Column:
    return _beside(tree, "lag", range(WIDTH - 1, 0, -1), f"{SLOT} >= {{k}}")


def _after(tree: str) -> Column:
    return _beside(tree, "lead", range(1, WIDTH), f"{SLOT} + {{k}} < {LENGTH}")


def parents(nodes: DataFrame, tree: str) -> DataFrame:
    """``tree, i, n, hash`` of the nodes above ``nodes``."""
    rows = nodes.withColumn("run", F.expr(RUN)).withColumn("_after", _after(tree)).where(f"{SLOT} = 0")
    return rows.selectExpr(f"`{tree}`", "run AS i", f"(n + {WIDTH - 1}) div {WIDTH} AS n", "sha2(concat(hash, _after), 256) AS hash")


def levels(nodes: DataFrame, tree: str) -> list[DataFrame]:
    """``nodes`` and the levels above; a level holds the trees that had several nodes below, and a tree's last node is alone."""
    built, most = [nodes], nodes.agg(F.max("n").alias("n")).first()["n"] or 0
    while most > 1:
        built.append(stage(parents(built[-1].where("n > 1"), tree), "level"))
        most = -(-most // WIDTH)
    return built


def tops(built: list[DataFrame], tree: str) -> DataFrame:
    """``tree, hash``: the root of every tree."""
    found = built[0].where("n = 1").select(tree, "hash")
    for level in built[1:]:
        found = found.unionAll(level.where("n = 1").select(tree, "hash"))
    return found


def proofs(built: list[DataFrame], tree: str, above: DataFrame) -> DataFrame:
    """The lowest level with ``above``'s columns for its tree, and in front of ``path`` its own siblings up to the root.

    ``above`` has ``tree, path`` and more, for every tree. A step of a path has the
    hashes to the left and to the right of a node, each joined to one text.
    """
    found = None
    more = [c for c in above.columns if c not in (tree, "path")]
    above = above.withColumnRenamed(tree, "_tree")
    for level in reversed(built):
        alone = level.where("n = 1").join(above, F.col(tree).eqNullSafe(F.col("_tree"))).drop("_tree")
        if found is None:
            found = alone
            continue
        step = F.struct(_before(tree).alias("left"), _after(tree).alias("right")).alias("_step")
        several = level.where("n > 1").withColumn("run", F.expr(RUN)).select("*", step)
        upper = found.select(F.col(tree).alias("_tree"), F.col("i").alias("_run"), "path", *more)
        joined = several.join(upper, F.col(tree).eqNullSafe(F.col("_tree")) & (F.col("run") == F.col("_run")))
        joined = joined.withColumn("path", F.concat(F.array("_step"), "path")).drop("_tree", "_run", "run", "_step")
        found = alone.unionByName(joined)
    return found


def manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, source, leaf, tampered, subroot, root, path`` of every row of ``docs``.

    Ties of ids go by the digests of the rows, so equal rows are leaves beside each
    other; null ids come first, and a null source is a source. Without rows there is
    no root. Columns other than FIELDS are not looked at.
    """
    rows = ranked(leaves(docs), "source", ["doc_id", "leaf"]).withColumnRenamed("leaf", "hash")
    built = levels(rows, "source")
    subroots = stage(tops(built, "source"), "subroots")
    whole = ranked(subroots.withColumn("all", F.lit(0)), "all", ["source"])
    upper = levels(whole, "all")
    root = tops(upper, "all").select("all", F.col("hash").alias("root"), F.expr("CAST(array() AS array<struct<left: string, right: string>>)").alias("path"))
    above = proofs(upper, "all", root).select("source", F.col("hash").alias("subroot"), "root", "path")
    return proofs(built, "source", stage(above, "above")).select("doc_id", "source", F.col("hash").alias("leaf"), "tampered", "subroot", "root", "path")


def folded(first: Column, path: Column) -> Column:
    """The root that a leaf and a path of siblings lead to."""
    return F.aggregate(path, first, lambda now, step: digest(step["left"], now, step["right"]))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def verify(found: DataFrame) -> DataFrame:
    """Every row's proof, checked with the leaf as tampered with where it is: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``."""
    found = found.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("path")))
    same = (F.col("folded_root") == F.col("root")).alias("verified")
    return found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", same)


def sql(heights: tuple[int, int] = (8, 6)) -> str:
    """The rows of ``verify`` in DuckDB's SQL, for trees of these heights at most (4 billion rows a source)."""
    upper = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    part = lambda c: f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || {c}, '-')"
    whole = lambda text: "sha256(" + " || ".join(part(c) for c in (*FIELDS[:-1], text)) + ")"
    ctes = [
        f"d AS (SELECT doc_id, source, {whole('text')} AS leaf, CASE WHEN {crc32_sql('doc_id')} % 5 = 0 THEN {whole(upper)} END AS tampered FROM documents)",
        "f0 AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n, "
        "coalesce(tampered, leaf) AS acc, '' AS proof FROM d)",
        "l0 AS (SELECT source AS tree, i, n, leaf AS h FROM f0)",
    ]

    def tree(prefix: str, key: str, height: int) -> None:
        for k in range(height):
            l, f = f"{prefix}l{k}", f"{prefix}f{k}"
            ctes.append(f"{prefix}r{k} AS (SELECT tree, i // {WIDTH} AS run, any_value(n) AS n, list(h ORDER BY i) AS hs FROM {l} GROUP BY tree, i // {WIDTH})")
            ctes.append(
                f"{prefix}l{k + 1} AS (SELECT tree, run AS i, (n + {WIDTH - 1}) // {WIDTH} AS n, CASE WHEN n = 1 THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h FROM {prefix}r{k})"
            )
            left, right = f"array_to_string(hs[1:(f.i % {WIDTH})], '')", f"array_to_string(hs[(f.i % {WIDTH} + 2):], '')"
            ctes.append(
                f"{prefix}f{k + 1} AS (SELECT f.* EXCLUDE (i, n, acc, proof), f.i // {WIDTH} AS i, (f.n + {WIDTH - 1}) // {WIDTH} AS n, "
                f"CASE WHEN f.n = 1 THEN acc ELSE sha256({left} || acc || {right}) END AS acc, proof || {left} || {right} AS proof "
                f"FROM {f} f JOIN {prefix}r{k} r ON f.{key} IS NOT DISTINCT FROM r.tree AND f.i // {WIDTH} = r.run)"
            )

    tree("", "source", heights[0])
    ctes.append(f"s AS (SELECT tree AS source, h, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM l{heights[0]})")
    ctes.append("tl0 AS (SELECT 0 AS tree, i, n, h FROM s)")
    ctes.append(
        f"tf0 AS (SELECT f.doc_id, f.leaf, f.acc, f.proof, s.h AS subroot, s.i, s.n, 0 AS top FROM f{heights[0]} f JOIN s ON f.source IS NOT DISTINCT FROM s.source)"
    )
    tree("t", "top", heights[1])
    return (
        "WITH " + ", ".join(ctes) + f" SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = h AS verified "
        f"FROM tf{heights[1]} CROSS JOIN (SELECT h FROM tl{heights[1]})"
    )
