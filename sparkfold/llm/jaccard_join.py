"""N-gram Jaccard join by chosen paths.

Every run draws, by hash, about one token in lambda * |set| from each set; sets that drew the same
token meet in a node. Small nodes are compared by brute force on sketches; larger ones are split
again on tokens drawn from the sets' min-hash tokens, until they are small. A pair of similarity
lambda shares one drawn token of the first level in expectation, so a run finds it with a known
probability, and runs are repeated until the target recall. Below the first level a node has the
same one or two bins drawn for all of its sets: with that a run's chance to hold a pair down to the
deepest level stays above the one for which the runs were counted. A node of which few
sets are outside one cluster is not split further: these are compared with all of it. What passes the sketches only forms candidate
clusters: inside a cluster all sets are compared exactly, block against block, so every link
between its members is counted, and no pair is ever a row.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfold.llm.common import components, join_few, kept_table
from sparkfold.llm.shingles import forgetting, mix, runs_of, shingle_set, stars as _stars

#: Bins of a sketch; each holds the low byte of its least hash, or zero if it is empty.
BINS = 128
#: Nodes up to this size are compared by brute force.
SMALL = 256
#: A node is not split if at most WIDE * SMALL of its records are outside its main cluster.
WIDE = 4
#: Levels after which what is still together is taken for one candidate cluster.
DEPTH = 10
#: Records per block of the exact comparison.
BLOCK = 192
#: Share of the nodes below the first level in which a second bin is drawn. With 15 runs a pair at
#: similarity 0.8 is then missed with a probability of at most 0.00001 on any of the DEPTH levels
#: (0.000006 on the tenth, averaged over how many bins of its sketches agree), beside SLACK.
SECOND = 0.75
#: Shingles drawn from at a time, and columns of an incidence matrix at a time.
CHUNK = 1 << 16
COLUMNS = 4096
#: Sketches may disagree by so many standard deviations from the threshold.
SLACK = 4.5


def runs_for(recall: float) -> int:
    """Runs that reach a recall for pairs at the threshold, if one in e is lost below the first level.

    The draws of candidate_clusters lose less than that at every depth (see SECOND).
    """
    first = math.exp(-1)
    second = math.exp(-(1 - first))
    return math.ceil(math.log(1 - recall) / math.log(second))


def name_of(hashes: np.ndarray) -> bytes | None:
    """Name of a set of shingles; None for the empty set."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None


def sketch(hashes: np.ndarray) -> bytes:
    """One byte per bin of the hash range: from the least hash that falls into it."""
    edges = (np.arange(BINS + 1, dtype=np.float64) * (2.0**64 / BINS))[:-1].astype(np.uint64)
    at = np.searchsorted(hashes, edges)
    ends = np.append(at[1:], len(hashes))
    full = at < ends
    out = np.zeros(BINS, dtype=np.uint8)
    out[full] = mix(hashes[at[full]]) % np.uint64(255) + np.uint64(1)
    return out.tobytes()


def drawn(hashes: np.ndarray, runs: int, threshold: float) -> np.ndarray:
    """First-level nodes of a set: the tokens that each run draws, tagged with the run."""
    if not len(hashes):
        return np.zeros(0, dtype=np.uint64)
    limit = np.uint64(min(2.0**64 - 2048, 2.0**64 / (threshold * len(hashes))))
    seeds = mix(np.arange(1, runs + 1, dtype=np.uint64))[:, None]
    found = []
    for start in range(0, len(hashes), CHUNK):
        spread = mix(hashes[None, start : start + CHUNK] ^ seeds)
        run, at = np.nonzero(spread < limit)
        found.append(mix(spread[run, at] + run.astype(np.uint64)))
    return np.concatenate(found)


def _records(docs: DataFrame, runs: int, threshold: float) -> DataFrame:
    """(doc_id, record, n, sketch, nodes): record names the shingle set, NULL without words."""

    @forgetting
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                names, counts, sketches, nodes = [], [], [], []
                for text in part.column(1):
                    s = shingle_set(text.as_py())
                    counts.append(len(s))
                    names.append(name_of(s))
                    sketches.append(sketch(s))
                    nodes.append(drawn(s, runs, threshold).view(np.int64))
                offsets = np.cumsum([0, *map(len, nodes)], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(names, pa.binary()),
                        pa.array(counts, pa.int64()),
                        pa.array(sketches, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(nodes))),
                    ],
                    ["doc_id", "record", "n", "sketch", "nodes"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, record binary, n long, sketch binary, nodes array<long>"
    )


def _near(sketches: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the sketches of the pairs allow a similarity of at least the threshold."""
    a, b = sketches[i], sketches[j]
    used = ((a > 0) | (b > 0)).sum(axis=1)
    same = ((a == b) & (a > 0)).sum(axis=1)
    deviation = np.sqrt(threshold * (1 - threshold) * used)
    return same >= threshold * used - SLACK * deviation


def _near_columns(threshold: float) -> Column:
    """The same for the columns sketch and first_sketch."""
    pairs = F.transform(
        F.sequence(F.lit(1), F.lit(BINS)),
        lambda b: F.struct(
            F.substring("sketch", b, F.lit(1)).alias("a"),
            F.substring("first_sketch", b, F.lit(1)).alias("b"),
        ),
    )
    empty = F.lit(b"\x00")
    counts = F.aggregate(
        pairs,
        F.struct(F.lit(0).alias("used"), F.lit(0).alias("same")),
        lambda t, p: F.struct(
            (t["used"] + ((p["a"] != empty) | (p["b"] != empty)).cast("int")).alias("used"),
            (t["same"] + ((p["a"] == p["b"]) & (p["a"] != empty)).cast("int")).alias("same"),
        ),
        lambda t: t["same"]
        >= threshold * t["used"] - SLACK * F.sqrt(threshold * (1 - threshold) * t["used"]),
    )
    return counts


def _pairs_within(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j inside consecutive runs of the given sizes."""
    starts = np.cumsum(sizes) - sizes
    after = np.repeat(starts + sizes, sizes) - np.arange(sizes.sum()) - 1
    i = np.repeat(np.arange(sizes.sum()), after)
    j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(after) - after, after)
    return i, j


def _compare_small(nodes: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) that join what is near inside each small node (node, record, sketch, outside).

    Only pairs of which one is marked `outside` are compared.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[pa.Table] = []
        held = 0
        for one in runs_of(batches, ["node"]):
            if one.num_rows < 2:
                continue
            group.append(one)
            held += one.num_rows
            if held >= 4096:
                yield links(group)
                group, held = [], 0
        if group:
            yield links(group)

    def links(group: list[pa.Table]) -> pa.RecordBatch:
        rows = pa.concat_tables(group)
        sizes = np.array([g.num_rows for g in group])
        data = b"".join(rows.column("sketch").to_pylist())
        sketches = np.frombuffer(data, dtype=np.uint8).reshape(-1, BINS)
        names = rows.column("record").combine_chunks()
        outside = rows.column("outside").combine_chunks().to_numpy(zero_copy_only=False)
        i, j = _pairs_within(sizes)
        asked = outside[i] | outside[j]
        i, j = i[asked], j[asked]
        near = [
            _near(sketches, i[k : k + CHUNK], j[k : k + CHUNK], threshold)
            for k in range(0, len(i), CHUNK)
        ]
        keep = np.concatenate(near) if near else np.zeros(0, dtype=bool)
        found = i[keep], j[keep]
        label = _stars(len(names), *found)
        leaf = np.flatnonzero(label != np.arange(len(names)))
        return pa.RecordBatch.from_arrays(
            [names.take(pa.array(leaf)), names.take(pa.array(label[leaf]))], ["a", "b"]
        )

    sorted_rows = nodes.repartition("node").sortWithinPartitions("node")
    return sorted_rows.select("node", "record", "sketch", "outside").mapInArrow(run, "a binary, b binary")


def _chunks(large: DataFrame) -> DataFrame:
    """(node, record, sketch, outside): nodes cut up so that all pairs but those inside the main cluster meet.

    large: (node, record, sketch, component, main, others, size). A node's main cluster and its others
    are cut into blocks of about WIDE * SMALL by hash; every block of the others meets every other one.
    """
    block = WIDE * SMALL
    outside = F.col("component") != F.col("main")
    kept, cut = F.ceil((F.col("size") - F.col("others")) / block), F.ceil(F.col("others") / block)
    own = F.when(outside, kept + F.pmod(F.xxhash64("record"), cut)).otherwise(F.pmod(F.xxhash64("record"), kept))
    met = F.sequence(F.when(outside, F.lit(0).cast("long")).otherwise(kept), kept + cut - 1)
    rows = large.select("node", "record", "sketch", outside.alias("outside"), own.alias("own"), F.explode(met).alias("at"))
    return rows.where("own <> at").select(
        F.xxhash64("node", F.lit("chunk"), F.least("own", "at"), F.greatest("own", "at")).alias("node"),
        "record", "sketch", "outside",
    )


def _drawn_bins() -> Column:
    """The bins of a row (node, sketch) to split its node by: one or two full ones, least by hash.

    Sets of a node choose alike, so a pair shares the first with the similarity as probability.
    """
    full = F.filter(
        F.sequence(F.lit(1), F.lit(BINS)),
        lambda b: F.substring("sketch", b, F.lit(1)) != F.lit(b"\x00"),
    )
    order = F.array_sort(
        F.transform(full, lambda b: F.struct(F.xxhash64("node", b).alias("h"), b.alias("bin")))
    )
    second = (F.pmod(F.xxhash64("node"), F.lit(1 << 20)) < int(SECOND * (1 << 20))).cast("int")
    return F.transform(F.slice(order, F.lit(1), second + 1), lambda x: x["bin"])


def _merged(clusters: DataFrame | None, links: DataFrame) -> DataFrame:
    """(id, component) of the linked records after more links (a, b): the least record of each cluster.

    Only links between different clusters so far are followed, as links between their names.
    """
    if clusters is None:
        return components(links)
    ends = links
    for side in ("a", "b"):
        names = clusters.select(F.col("id").alias(side), F.col("component").alias(f"{side}_of"))
        ends = join_few(ends, names, side, "left").withColumn(side, F.coalesce(f"{side}_of", side)).drop(f"{side}_of")
    joined = components(ends.where("a <> b").distinct())
    moved = joined.select(F.col("id").alias("component"), F.col("component").alias("now"))
    old = join_few(clusters, moved, "component", "left").select("id", F.coalesce("now", "component").alias("component"))
    new = join_few(joined, clusters, "id", "left_anti")
    return kept_table(old.union(new.select("id", "component")), "clusters")


def candidate_clusters(records: DataFrame, threshold: float) -> DataFrame:
    """(id, component): clusters that hold every pair of records that the paths brought together.

    records: distinct (record, sketch, nodes). Nodes are counted before their rows are brought
    together, so only small ones ever meet in a task. A large node all of whose records are in one
    cluster already has no pair left to find; one with at most WIDE * SMALL records outside its main cluster
    is settled by comparing these with all of it. The others are split: a large group of near copies
    is not drawn again on every level because of the few that are unlike the rest. As soon as the
    nodes left hold no more pairs outside their main clusters than SMALL for each record, all of
    these are compared, so that the time of that stays in proportion to the records.
    """
    level = records.select(F.explode("nodes").alias("node"), "record")
    sketches = records.select("record", "sketch")
    clusters, rest = None, None
    bound = SMALL * records.count()
    for depth in range(DEPTH):
        count = level.groupBy("node").agg(F.count("*").alias("size"), F.min("record").alias("first"))
        shared = kept_table(level.join(count.where("size > 1"), "node"), "nodes")
        small = shared.where(F.col("size") <= SMALL).join(sketches, "record")
        small = small.select("node", "record", "sketch", F.lit(True).alias("outside"))
        links = _compare_small(small if rest is None else small.union(rest), threshold)
        large = shared.where(F.col("size") > SMALL)
        # what is near the first record of its node is linked to it
        firsts = kept_table(
            large.groupBy("node").agg(F.min("first").alias("record")).join(sketches, "record")
            .select("node", F.col("record").alias("first"), F.col("sketch").alias("first_sketch")), "firsts",
        )
        more = not firsts.isEmpty()
        if more:
            large = join_few(large.select("node", "record").join(sketches, "record"), firsts, "node")
            large = kept_table(
                large.select("node", "record", "first", "sketch", _near_columns(threshold).alias("near")), "large"
            )
            star = large if depth == DEPTH - 1 else large.where("near")
            links = links.union(
                star.where("record <> first").select(F.col("record").alias("a"), F.col("first").alias("b"))
            )
        links = kept_table(links.distinct(), "links")
        if clusters is None or not links.isEmpty():
            clusters = _merged(clusters, links)
        if not more or depth == DEPTH - 1:
            break
        named = clusters.select(F.col("id").alias("record"), "component")
        placed = join_few(large.select("node", "record", "sketch"), named, "record", "left").select(
            "node", "record", "sketch", F.coalesce("component", "record").alias("component")
        )
        parts = placed.groupBy("node", "component").agg(F.count("*").alias("n")).groupBy("node").agg(
            F.max_by("component", F.struct("n", "component")).alias("main"),
            (F.sum("n") - F.max("n")).alias("others"), F.sum("n").alias("size"),
        )
        mixed = kept_table(parts.where("others > 0"), "mixed")
        pairs = mixed.agg(F.sum(F.col("others").cast("double") * F.col("size"))).first()[0] or 0
        large = join_few(placed, mixed, "node")
        if pairs <= bound:
            links = kept_table(_compare_small(_chunks(large), threshold).distinct(), "links")
            return clusters if links.isEmpty() else _merged(clusters, links)
        rest = _chunks(large.where(F.col("others") <= WIDE * SMALL))
        large = large.where(F.col("others") > WIDE * SMALL)
        level = kept_table(
            large.select("node", "record", "sketch", F.explode(_drawn_bins()).alias("bin"))
            .select(F.xxhash64("node", "bin", F.substring("sketch", F.col("bin"), F.lit(1))).alias("node"), "record"),
            "level",
        )
    return clusters


def _exact(group: pa.Table, threshold: float) -> list[tuple]:
    """Links of one block, or between two: (record, linked documents, least linked neighbour)."""
    first = {name: k for k, name in reversed(list(enumerate(group.column("record").to_pylist())))}
    group = group.take(pa.array(sorted(first.values())))
    names, copies = group.column("record").to_pylist(), np.array(group.column("copies").to_pylist())
    side = np.array(group.column("side").to_pylist())
    sets = [shingle_set(t) for t in group.column("text").to_pylist()]
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    tokens, column = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    shared = np.zeros((len(sets), len(sets)), dtype=np.float64)
    for start in range(0, len(tokens), COLUMNS):
        a, b = np.searchsorted(column, [start, start + COLUMNS])
        part = np.zeros((len(sets), min(COLUMNS, len(tokens) - start)), dtype=np.float32)
        part[owner[a:b], column[a:b] - start] = 1
        shared += part @ part.T
    union = sizes[:, None] + sizes[None, :] - shared
    linked = shared >= threshold * union - 1e-9
    np.fill_diagonal(linked, False)
    if side.max() != side.min():
        linked &= side[:, None] != side[None, :]
    i, j = np.nonzero(np.triu(linked))
    label = _stars(len(sets), i, j)
    counts = linked @ copies
    return [(names[k], int(counts[k]), names[label[k]]) for k in range(len(sets))]


def exact_links(clustered: DataFrame, threshold: float) -> DataFrame:
    """(record, links, root) per comparison of clustered (component, members, record, copies, text).

    A cluster of more than BLOCK records is cut into blocks by hash, and every two blocks meet in
    a task of their own; links are counted there and come back as one row per record.
    """
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    rows = clustered.select(
        "component", "record", "copies", "text", blocks.alias("blocks"),
        F.pmod(F.xxhash64("record"), blocks).cast("int").alias("own"),
    )
    meets = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "component",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        F.col("own").alias("side"), "record", "copies", "text",
    )
    keys = ["component", "low", "high"]

    @forgetting
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs_of(batches, keys):
            if group.num_rows > 1:
                done = _exact(group, threshold)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x[0] for x in done], pa.binary()),
                        pa.array([x[1] for x in done], pa.int64()),
                        pa.array([x[2] for x in done], pa.binary()),
                    ],
                    ["record", "links", "root"],
                )

    return (
        meets.repartition(*keys).sortWithinPartitions(*keys)
        .mapInArrow(run, "record binary, links long, root binary")
    )


def jaccard_join(docs: DataFrame, *, threshold: float = 0.8, recall: float = 0.9999) -> DataFrame:
    """(doc_id, class_id, n_links) per row of docs (doc_id, text).

    Two rows are linked if the sets of their five-word shingles have a Jaccard similarity of at
    least the threshold (shingles are compared by 64-bit hashes). n_links counts the other rows
    linked to a row; class_id is the smallest doc_id of its connected component. A pair at the
    threshold is found with at least the given recall, more similar ones more surely; what is in a
    class is compared exactly.

    NULL and empty texts have no shingles: no links, a class of their own. Repeated rows are copies
    of each other. A NULL doc_id takes part; its class is NULL only if no member has an id. An
    empty table gives an empty result; other columns are ignored.
    """
    all_rows = kept_table(_records(docs, runs_for(recall), threshold), "records")
    rows = all_rows.select("doc_id", "record")
    distinct = all_rows.where("record IS NOT NULL").groupBy("record").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("least"),
        F.first("sketch").alias("sketch"), F.first("nodes").alias("nodes"),
    )
    distinct = kept_table(distinct, "sets")
    sets = distinct.select("record", "copies", "least")
    clusters = candidate_clusters(distinct, threshold).withColumnRenamed("id", "record")
    # one text per record of a cluster: that of a row with its least id
    named = kept_table(
        clusters.join(sets, "record").select("component", "record", "copies", "least"), "clusters"
    )
    size = kept_table(named.groupBy("component").agg(F.count("*").alias("members")), "sizes")
    wanted = kept_table(join_few(named, size, "component"), "wanted")
    found = kept_table(exact_links(_texts_of(docs, wanted), threshold), "exact")
    classes = components(found.selectExpr("record AS a", "root AS b")).withColumnRenamed("id", "record")
    linked = found.groupBy("record").agg(F.sum("links").alias("links"))
    per_set = sets.join(linked, "record", "left").join(classes, "record", "left").select(
        "record", "least", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "record").alias("component"),
    )
    least = per_set.groupBy("component").agg(F.min("least").alias("class_id"))
    per_set = kept_table(per_set.join(least, "component").select("record", "class_id", "n_links"), "classes")
    return rows.join(per_set, "record", "left").select(
        "doc_id",
        F.when(F.col("record").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(component, members, record, copies, text): the text of each wanted record.

    Rows are found by the record's least doc_id and kept if their text has the record's shingles,
    for ids may repeat. Rows that repeat both id and text stay repeated.
    """

    @forgetting
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                fits = [
                    name_of(shingle_set(text.as_py())) == record.as_py()
                    for record, text in zip(part.column("record"), part.column("text"))
                ]
                yield part.filter(pa.array(fits, pa.bool_()))

    texts = docs.select(F.col("doc_id").alias("id"), "text")
    return join_few(texts, wanted, F.col("id").eqNullSafe(F.col("least"))).select(
        "component", "members", "record", "copies", "text"
    ).mapInArrow(
        run, "component binary, members long, record binary, copies long, text string"
    )
