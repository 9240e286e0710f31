"""Merkle manifest of a dataset as a persistent tree whose versions copy paths.

Leaves are ordered within their group and cut into aligned blocks of ARITY ** height places. The
upward sweep raises every block to one node, block by block, and repeats that on the blocks' nodes
until each group has one; the groups' nodes make the tree above in the same way. The downward sweep
hands every block its path: the siblings on the way from its node to the root, one row per block.
A changed leaf makes a version of the tree: inside its block only its ancestors are copied, all
other nodes are shared, and the version goes on above the block along the block's path. Blocks are
dealt over the cluster, so a group of any size is spread and no task holds more than a block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfold.llm.common import join_few, kept_table
from sparkfold.llm.shingles import runs_of
from sparkfold.operators.order import value_buckets

#: Children of a node.
ARITY = 3
#: Levels of a block: 3 ** 7 = 2,187 leaves.
HEIGHT = 7
#: Fields of a leaf, in the order they are hashed.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Stands for a missing id in the order of leaves: before every other one.
LOWEST = -1.7976931348623157e308


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf_digest(fields: dict[str, Column]) -> Column:
    """Digest of a record: '-' for NULL, else byte count, colon and value of every field."""
    parts = []
    for value in fields.values():
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(doc_id, grp, leaf, changed): one leaf per row of docs; changed is NULL where it is the leaf.

    ``tampered`` is the text that a changed version of the row would have. grp names the source in
    a form that sorts as the source does in UTF-8, a NULL one first.
    """
    own = {name: F.col(name) for name in FIELDS}
    leaf = leaf_digest(own)
    other = F.lit(None).cast("string")
    if tampered is not None:
        other = F.when(~tampered.eqNullSafe(F.col("text")), leaf_digest(own | {"text": tampered}))
    grp = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-"))
    return docs.select("doc_id", grp.alias("grp"), leaf.alias("leaf"), other.alias("changed"))


def ranked(rows: DataFrame, bucket_rows: int = 50_000) -> DataFrame:
    """Add pos, the place of a leaf in its group by (doc_id, leaf), NULL first, and n, their number.

    Leaves are cut into ordered buckets; an id that fills whole buckets is cut by its leaves. Equal
    rows get places next to each other. No window sees more than one bucket of one group.
    """
    rows = rows.withColumn("_leading", F.coalesce(F.col("doc_id").cast("double"), F.lit(LOWEST)))
    rows = rows.withColumn("_leaf", F.conv(F.substring("leaf", 1, 13), 16, 10).cast("long"))
    cut, _ = value_buckets(rows, F.col("_leading"), "_leaf", rows.count(), bucket_rows)
    keys = ["grp", "_b1", "_b2"]
    counts = kept_table(cut.groupBy(*keys).agg(F.count("*").alias("_n")), "buckets")
    # a group has at most as many buckets as there are cuts
    offsets = counts.selectExpr(
        *keys,
        "coalesce(sum(_n) OVER (PARTITION BY grp ORDER BY _b1, _b2 "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _before",
        "sum(_n) OVER (PARTITION BY grp) AS n",
    )
    placed = cut.selectExpr(
        "doc_id", "leaf", "changed", *keys,
        "row_number() OVER (PARTITION BY grp, _b1, _b2 ORDER BY _leading, doc_id, leaf) - 1 AS _at",
    )
    return join_few(placed, kept_table(offsets, "offsets"), keys).selectExpr(
        "grp", "_before + _at AS pos", "n", "doc_id", "leaf", "changed"
    )


def raised(nodes: list[str], n: int, height: int) -> list[list[str]]:
    """Levels of a block from its nodes up; n nodes make the whole group."""
    levels = [nodes]
    for _ in range(height):
        if n == 1:
            break
        below = levels[-1]
        levels.append([digest("".join(below[i : i + ARITY])) for i in range(0, len(below), ARITY)])
        n = -(-n // ARITY)
    return levels


def steps(levels: list[list[str]], at: int) -> list[str]:
    """The way of a node to the top of its block: 'siblings on its left|those on its right'."""
    way = []
    for level in levels[:-1]:
        start = at - at % ARITY
        way.append("".join(level[start:at]) + "|" + "".join(level[at + 1 : start + ARITY]))
        at //= ARITY
    return way


def fold(node: str, way: list[str]) -> list[str]:
    """Copies of a node's ancestors, from it up, along its way."""
    copies = [node]
    for step in way:
        left, right = step.split("|")
        copies.append(digest(left + copies[-1] + right))
    return copies


def _raise_blocks(nodes: DataFrame, height: int) -> DataFrame:
    """(grp, pos, n, node) of the blocks of (grp, pos, n, node)."""
    size = ARITY**height

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in runs_of(batches, ["grp", "block"]):
            n = block.column("n")[0].as_py()
            top = raised(block.column("node").to_pylist(), n, height)[-1][0]
            row = [[block.column("grp")[0].as_py()], [block.column("block")[0].as_py()], [-(-n // size)], [top]]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(row, kinds)], ["grp", "pos", "n", "node"]
            )

    dealt = nodes.select("grp", F.expr(f"pos div {size}").alias("block"), "pos", "n", "node")
    dealt = dealt.repartition("grp", "block").sortWithinPartitions("grp", "block", "pos")
    return dealt.mapInArrow(run, "grp string, pos long, n long, node string")


def _with_paths(nodes: DataFrame, paths: DataFrame, height: int, extra: list[str]) -> DataFrame:
    """nodes (grp, pos, n, node, *extra) dealt by block behind the row of their block's path."""
    size = ARITY**height
    null = F.lit(None)
    kinds = dict(paths.dtypes)
    low = nodes.select(
        "grp", F.expr(f"pos div {size}").alias("block"), "pos", "n", "node", *extra,
        *[null.cast(kinds[c]).alias(c) for c in ("path", "subroot", "root")],
    )
    kinds = dict(nodes.dtypes)
    high = paths.select(
        "grp", "block", F.lit(-1).cast("long").alias("pos"),
        *[null.cast(kinds[c]).alias(c) for c in ("n", "node", *extra)], "path", "subroot", "root",
    )
    both = low.union(high).repartition("grp", "block")
    return both.sortWithinPartitions("grp", "block", "pos")


def _hand_down(nodes: DataFrame, paths: DataFrame, height: int) -> DataFrame:
    """(grp, block, path, subroot, root) of every node, taken as a block of the tier below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in runs_of(batches, ["grp", "block"]):
            head, rows = block.slice(0, 1), block.slice(1)
            levels = raised(rows.column("node").to_pylist(), rows.column("n")[0].as_py(), height)
            above = head.column("path")[0].as_py()
            ways = [steps(levels, k) + above for k in range(rows.num_rows)]
            same = [head.column(c)[0].as_py() for c in ("grp", "subroot", "root")]
            grp, subroot, root = ([v] * rows.num_rows for v in same)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(grp, pa.string()), rows.column("pos").combine_chunks(),
                    pa.array(ways, pa.list_(pa.string())), pa.array(subroot, pa.string()),
                    pa.array(root, pa.string()),
                ],
                ["grp", "block", "path", "subroot", "root"],
            )

    dealt = _with_paths(nodes, paths, height, [])
    return dealt.mapInArrow(run, "grp string, block long, path array<string>, subroot string, root string")


@dataclass
class Tree:
    """Tiers of a sweep: nodes (grp, pos, n, node) per tier, and tops (grp, node, tier)."""

    tiers: list[DataFrame]
    tops: DataFrame


def sweep_up(nodes: DataFrame, height: int) -> Tree:
    """Raise the nodes of every group to one."""
    tiers, tops = [], []
    while True:
        tiers.append(nodes)
        done = kept_table(_raise_blocks(nodes, height), "tier")
        tops.append(done.where("n = 1").select("grp", "node", F.lit(len(tiers) - 1).alias("tier")))
        nodes = done.where("n > 1")
        if nodes.isEmpty():
            return Tree(tiers, reduce(DataFrame.union, tops))


def sweep_down(tree: Tree, starts: DataFrame, height: int) -> DataFrame:
    """Paths (grp, block, path, subroot, root) of the blocks of the lowest tier.

    starts: (grp, tier, path, subroot, root) of the way above each group's top.
    """
    paths = None
    for tier in range(len(tree.tiers) - 1, -1, -1):
        first = starts.where(F.col("tier") == tier).select(
            "grp", F.lit(0).cast("long").alias("block"), "path", "subroot", "root"
        )
        paths = first if paths is None else first.union(paths)
        if tier:
            paths = kept_table(_hand_down(tree.tiers[tier], paths, height), "paths")
    return paths


def manifest(rows: DataFrame, *, height: int = HEIGHT) -> tuple[DataFrame, DataFrame]:
    """Ranked leaves (grp, pos, n, doc_id, node, changed) and the path of each of their blocks.

    rows: (doc_id, grp, leaf, changed) as from ``leaves``. Groups are ordered bytewise by grp and
    make the upper tree. Paths are (grp, block, path, subroot, root): a block's way from its node
    to the root. Empty rows give two empty tables.
    """
    bottom = kept_table(ranked(kept_table(rows, "leaves")).withColumnRenamed("leaf", "node"), "ranked")
    tree = sweep_up(bottom.select("grp", "pos", "n", "node"), height)
    tops = kept_table(tree.tops, "tops")
    # the upper tree takes groups for leaves; their names make the order
    upper = kept_table(_ranked_names(tops), "groups")
    top_tree = sweep_up(upper.select("grp", "pos", "n", "node"), height)
    root = top_tree.tops.select(
        "grp", "tier", F.array().cast("array<string>").alias("path"), F.lit(None).cast("string").alias("subroot"),
        F.col("node").alias("root"),
    )
    ways = sweep_down(top_tree, root, height)
    by_name = kept_table(_hand_down(upper.select("grp", "pos", "n", "node"), ways, height), "ways")
    starts = by_name.join(upper.select(F.col("pos").alias("block"), "name", "node"), "block")
    starts = starts.select(F.col("name").alias("grp"), "path", F.col("node").alias("subroot"), "root")
    starts = kept_table(starts.join(tops.select("grp", "tier"), "grp"), "starts")
    return bottom, sweep_down(tree, starts, height)


def _ranked_names(tops: DataFrame, run_rows: int = 50_000) -> DataFrame:
    """(grp, pos, n, node, name) of groups in the order of their names; grp is '' for all.

    Names are cut into at most 2,000 ordered runs, the runs are counted, each is numbered by itself.
    """
    n = tops.count()
    parts = max(1, min(2000, -(-n // run_rows)))
    # names chosen by hash only place the cuts
    every = max(1, n // (parts * 50))
    some = []
    if parts > 1:
        sample = tops.where(F.pmod(F.xxhash64("grp"), F.lit(every)) == 0).select("grp")
        some = sorted((r.grp for r in sample.collect()), key=str.encode)
    cuts = sorted({some[k * len(some) // parts] for k in range(1, parts)} if some else set(), key=str.encode)
    run = F.size(F.filter(F.lit(cuts), lambda c: c <= F.col("grp"))) if cuts else F.lit(0)
    cut = tops.select(run.alias("run"), F.col("grp").alias("name"), "node")
    counts = cut.groupBy("run").agg(F.count("*").alias("c"))
    before = counts.selectExpr(
        "run",
        "coalesce(sum(c) OVER (ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before",
    )
    placed = cut.selectExpr(
        "run", "name", "node", "row_number() OVER (PARTITION BY run ORDER BY name) - 1 AS at"
    )
    return placed.join(F.broadcast(before), "run").selectExpr(
        "'' AS grp", "before + at AS pos", f"{n}L AS n", "node", "name"
    )


def versions(bottom: DataFrame, paths: DataFrame, *, height: int = HEIGHT) -> DataFrame:
    """(doc_id, leaf, subroot, root, siblings, copied, folded_root) per leaf of a manifest.

    siblings is the digest of the siblings on the leaf's way to the root, in order. A changed leaf
    makes a version: copied lists its nodes that are not shared with the tree, from the leaf to the
    version's root; NULL for an unchanged leaf. folded_root is recomputed from the changed (else
    the own) leaf and the siblings.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in runs_of(batches, ["grp", "block"]):
            head, rows = block.slice(0, 1), block.slice(1)
            above, subroot, root = (head.column(c)[0].as_py() for c in ("path", "subroot", "root"))
            nodes = rows.column("node").to_pylist()
            levels = raised(nodes, rows.column("n")[0].as_py(), height)
            proofs, copied, folded = [], [], []
            for k, changed in enumerate(rows.column("changed").to_pylist()):
                way = steps(levels, k) + above
                proofs.append(digest("".join(way).replace("|", "")))
                chain = fold(changed or nodes[k], way)
                copied.append(chain if changed else None)
                folded.append(chain[-1])
            count = rows.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id").combine_chunks(), rows.column("node").combine_chunks(),
                    pa.array([subroot] * count, pa.string()), pa.array([root] * count, pa.string()),
                    pa.array(proofs, pa.string()), pa.array(copied, pa.list_(pa.string())),
                    pa.array(folded, pa.string()),
                ],
                ["doc_id", "leaf", "subroot", "root", "siblings", "copied", "folded_root"],
            )

    dealt = _with_paths(bottom, paths, height, ["doc_id", "changed"])
    kind = bottom.schema["doc_id"].dataType.simpleString()
    return dealt.mapInArrow(
        run,
        f"doc_id {kind}, leaf string, subroot string, root string, siblings string, "
        "copied array<string>, folded_root string",
    )


def verify(docs: DataFrame, tampered: Column | None = None, *, height: int = HEIGHT) -> DataFrame:
    """``versions`` of the manifest of docs (doc_id, source, lang, n_chars, text), one row per row.

    Leaves stand by doc_id within their source, a NULL id first, rows of one id by their digest;
    repeated rows are leaves of their own. A NULL source is a group of its own and the first. NULL
    fields are hashed as '-', empty texts as '0:', texts of any length whole. A group of one leaf
    has that leaf for subroot. An empty table gives an empty result. Other columns are ignored.
    """
    docs = docs.select(*FIELDS)
    return versions(*manifest(leaves(docs, tampered), height=height), height=height)
