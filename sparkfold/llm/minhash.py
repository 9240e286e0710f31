"""Near-duplicates by MinHash: universal hash minima, banding, verification, star components.

Every set of shingles gets the minima of many multiply-add hash functions. Bands of them are
buckets: each member is a candidate of the bucket's least member only, so a bucket of any size
yields as many pairs as members. Candidates must agree in enough minima, then in their full sets.
Verified links make components by alternating large-star and small-star steps. Buckets whose
members are then still in several components are compared block against block, members outside
the largest component against all others, so that no link between two components is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfold.llm.common import FEW_ROWS, join_few, kept_table
from sparkfold.llm.jaccard_join import name_of
from sparkfold.llm.shingles import mix, runs_of, shingle_set

#: Bands and minima per band: a pair at similarity 0.85 misses all bands with a probability of
#: (1 - 0.85 ** 6) ** 28 = 0.000002.
BANDS = 28
ROWS = 6
#: Words per shingle.
WIDTH = 3
#: Minima may disagree by so many standard deviations from the threshold.
SLACK = 4.5
#: Shingles hashed at a time.
CHUNK = 4096
#: Members compared at a time, and bytes of text that meet in a task.
BLOCK = 512
BLOCK_BYTES = 8_000_000
#: A key is hot if it holds more than one part in so many of the rows: there are at most so many.
HOT = 2000
#: Pairs a member has with its bucket's least one, per task.
STAR = 2048


def universal(count: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Factors and summands of hash functions (a * x + b) mod 2**64 >> 32 of 32-bit integers."""
    draw = np.random.default_rng(seed)
    a, b = draw.integers(0, 2**64, (2, count), dtype=np.uint64)
    return a[:, None], b[:, None]


def minima(hashes: np.ndarray, functions: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Least value of every hash function over a set that is not empty."""
    a, b = functions
    least = np.full(len(a), np.iinfo(np.uint64).max, dtype=np.uint64)
    x = hashes >> np.uint64(32)
    for start in range(0, len(x), CHUNK):
        values = a * x[None, start : start + CHUNK] + b
        np.minimum(least, values.min(axis=1) >> np.uint64(32), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of ROWS minima, told apart by the band's number."""
    table = least.reshape(-1, ROWS)
    keys = mix(np.arange(1, len(table) + 1, dtype=np.uint64))
    for column in table.T:
        keys = mix(keys ^ column) + column
    return keys


def lowered(text: str | None) -> str:
    """A text with A-Z in lower case and all else as it is."""
    return (text or "").encode().lower().decode()


def _records(docs: DataFrame) -> DataFrame:
    """(doc_id, record, n, size, signs, bands): record names the set, NULL without words."""
    functions = universal(BANDS * ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                out: list[list] = [[], [], [], [], []]
                for text in part.column("text"):
                    text = text.as_py()
                    s = shingle_set(lowered(text), WIDTH)
                    least = minima(s, functions) if len(s) else None
                    row = (
                        name_of(s), len(s), len(text or ""),
                        None if least is None else least.astype(np.uint8).tobytes(),
                        [] if least is None else band_keys(least).view(np.int64),
                    )
                    for column, value in zip(out, row):
                        column.append(value)
                kinds = [pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(v, k) for v, k in zip(out, kinds)]],
                    ["doc_id", "record", "n", "size", "signs", "bands"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, record binary, n long, size long, signs binary, bands array<long>"
    )


def join_keys(rows: DataFrame, keyed: DataFrame, key: str, weight: str, total: int, how: str = "inner") -> DataFrame:
    """Join rows with a kept table that has each key once and the number of its rows.

    A small table is broadcast. Else keys with more than a HOT-th part of all rows, of which there
    can be HOT at most, are broadcast, and the rest, even by that bound, is shuffled.
    """
    if keyed.count() <= FEW_ROWS:
        return rows.join(F.broadcast(keyed.drop(weight)), key, how)
    hot = keyed.where(F.col(weight) > total // HOT).drop(weight)
    cold = keyed.where(F.col(weight) <= total // HOT).drop(weight)
    some = rows.join(F.broadcast(hot), key)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key, how)
    return some.unionByName(rest)


def _counted(rows: DataFrame, key: str, *more: Column) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("weight"), *more)


def enough(n: np.ndarray, m: np.ndarray, common: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of n and m elements with so many common ones reach the similarity."""
    return 100 * common >= percent * (n + m - common)


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether the minima of rows a and b allow the similarity."""
    s, count = percent / 100, a.shape[1]
    return (a == b).sum(axis=1) >= s * count - SLACK * np.sqrt(s * (1 - s) * count)


def signs_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), -1)


def candidates(distinct: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Buckets (key, record) with several members, and pairs (center, record) that may be linked.

    distinct: (record, n, signs, bands). The pairs are those of a bucket's least member with each
    other one whose size and minima allow the similarity.
    """
    members = distinct.select(F.explode("bands").alias("key"), "record")
    shared = _counted(members, "key", F.min("record").alias("center")).where("weight > 1")
    shared = kept_table(shared, "shared")
    total = shared.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    buckets = kept_table(join_keys(members, shared, "key", "weight", total), "members")
    pairs = kept_table(buckets.where("center <> record").select("center", "record").distinct(), "pairs")
    signs = distinct.select("record", "n", "signs")
    half = pairs.join(signs, "record")
    centers = kept_table(
        _counted(pairs, "center").join(
            signs.select(F.col("record").alias("center"), F.col("n").alias("m"), F.col("signs").alias("others")),
            "center",
        ),
        "centers",
    )
    both = join_keys(half, centers, "center", "weight", pairs.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n, m = (batch.column(c).to_numpy() for c in ("n", "m"))
                fits = enough(n, m, np.minimum(n, m), percent)
                fits &= alike(signs_of(batch.column("signs")), signs_of(batch.column("others")), percent)
                yield batch.select(["center", "record"]).filter(pa.array(fits))

    both = both.select("center", "record", "n", "m", "signs", "others")
    return buckets, both.mapInArrow(run, "center binary, record binary")


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(record, text) of wanted records (record, least), one row each.

    The text is found by the record's least doc_id and has the record's shingles; rows of one id
    and one set are taken once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                fits = [
                    name_of(shingle_set(lowered(text.as_py()), WIDTH)) == record.as_py()
                    for record, text in zip(part.column("record"), part.column("text"))
                ]
                yield part.filter(pa.array(fits, pa.bool_()))

    rows = docs.select(F.col("doc_id").alias("id"), "text")
    found = join_few(rows, wanted, F.col("id").eqNullSafe(F.col("least"))).select("record", "text")
    return found.mapInArrow(run, "record binary, text string")


def verified_stars(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (center, record) whose full sets are linked.

    The pairs of a center are dealt in parts of about STAR; each part streams behind the center's text.
    """
    parts = kept_table(
        _counted(pairs, "center").select(
            "center", "weight", F.ceil(F.col("weight") / STAR).cast("int").alias("parts")
        ),
        "stars",
    )
    total = pairs.count()
    dealt = join_keys(pairs, parts, "center", "weight", total).select(
        "center", F.pmod(F.xxhash64("record"), F.col("parts")).cast("int").alias("part"), "record"
    )
    rows = dealt.join(texts, "record").select("center", "part", F.lit(1).alias("side"), "record", "text")
    heads = parts.select(
        F.col("center").alias("record"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    ).join(texts, "record").select(
        F.col("record").alias("center"), "part", F.lit(0).alias("side"), "record", "text"
    )
    both = heads.union(rows).repartition("center", "part").sortWithinPartitions("center", "part", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            centers, names = [], []
            columns = [batch.column(c) for c in ("center", "side", "record", "text")]
            for center, side, record, text in zip(*columns):
                s = shingle_set(lowered(text.as_py()), WIDTH)
                if side.as_py() == 0:
                    own = s
                elif enough(len(s), len(own), len(np.intersect1d(s, own, True)), percent):
                    centers.append(center.as_py())
                    names.append(record.as_py())
            yield pa.RecordBatch.from_arrays(
                [pa.array(centers, pa.binary()), pa.array(names, pa.binary())], ["a", "b"]
            )

    return both.mapInArrow(run, "a binary, b binary")


def star_components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(record, component) of the records of links (a, b): the least record reachable.

    Each round links a record's greater neighbours to its least one (large star), then its lesser
    ones (small star), until nothing changes; every round is written.
    """
    edges = kept_table(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    before = None
    for _ in range(rounds):
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("a").alias("record"), F.col("b").alias("component")).union(
                edges.select("b", "b").distinct()
            )
        before = state
        both = edges.union(edges.select("b", "a"))
        least = kept_table(_counted(both, "a", F.least(F.col("a"), F.min("b")).alias("m")), "least")
        large = join_keys(both.where("b > a"), least, "a", "weight", 2 * state[0])
        edges = kept_table(large.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")
        least = kept_table(_counted(edges, "a", F.min("b").alias("m")), "least")
        count = least.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
        small = join_keys(edges, least, "a", "weight", count)
        small = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = kept_table(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "small")
    raise RuntimeError(f"components did not settle in {rounds} rounds.")


def _partners(group: pa.Table, percent: int) -> list[tuple[int, np.ndarray]]:
    """Per row of the few, the rows of the group that it has to be compared with in full.

    They are of another component and alike, and no other bucket compares the two: of the bands in
    which both meet, the least key is the group's own. Two of the few meet once.
    """
    key = group.column("key")[0].as_py()
    side = np.array(group.column("side").to_pylist())
    few = np.array(group.column("few").to_pylist(), dtype=bool)
    label, names = (
        group.column(c).combine_chunks().dictionary_encode().indices.to_numpy() for c in ("label", "record")
    )
    n = group.column("n").to_numpy()
    signs = signs_of(group.column("signs").combine_chunks())
    bands = group.column("bands").combine_chunks().flatten().to_numpy().reshape(len(n), -1)
    spread = np.flatnonzero(side == 1)
    found = []
    for i in np.flatnonzero(side == 0).tolist():
        j = spread[(label[spread] != label[i]) & (~few[spread] | (names[spread] > names[i]))]
        j = j[enough(n[j], n[i], np.minimum(n[j], n[i]), percent)]
        j = j[alike(signs[j], signs[i : i + 1], percent)]
        met = np.where(bands[j] == bands[i], bands[j], np.iinfo(np.int64).max)
        j = j[met.min(axis=1, initial=np.iinfo(np.int64).max) == key]
        if len(j):
            found.append((i, j))
    return found


def _linked_labels(group: pa.Table, percent: int) -> list[tuple[bytes, bytes]]:
    """Links between components of a group, just enough to connect what its full sets connect."""
    sets: dict[int, np.ndarray] = {}
    label, text = group.column("label").to_pylist(), group.column("text")
    root = {x: x for x in label}

    def top(x: bytes) -> bytes:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    def own(i: int) -> np.ndarray:
        if i not in sets:
            sets[i] = shingle_set(lowered(text[i].as_py()), WIDTH)
        return sets[i]

    links = []
    for i, partners in _partners(group, percent):
        for j in partners.tolist():
            a, b = top(label[i]), top(label[j])
            if a != b:
                x, y = own(i), own(j)
                if enough(len(x), len(y), len(np.intersect1d(x, y, True)), percent):
                    root[a] = b
                    links.append((label[i], label[j]))
    return links


def mixed_links(
    buckets: DataFrame, labels: DataFrame, distinct: DataFrame, docs: DataFrame, percent: int
) -> DataFrame:
    """Links (a, b) between components that meet in a bucket, enough to connect what is linked.

    buckets: (key, record); labels: (record, component). The members of a bucket are dealt in blocks
    of bounded rows and text, and those outside its largest component go to every block; where they
    fill more than one block they are dealt as well. Pairs stay inside the tasks: the first pass
    only tells which members have to be compared, the second compares their texts.
    """
    info = distinct.select("record", "size").join(labels, "record", "left").select(
        "record", "size", F.coalesce("component", "record").alias("label")
    )
    named = kept_table(buckets.select("key", "record").join(info, "record"), "named")
    per = named.groupBy("key", "label").agg(F.count("*").alias("c"), F.sum("size").alias("s"))
    # a bucket of two is one pair, which has been compared
    mixed = per.groupBy("key").agg(
        F.count("*").alias("labels"), F.sum("c").alias("weight"), F.sum("s").alias("bytes"),
        F.max(F.struct("c", "s", "label")).alias("main"),
    ).where("labels > 1 AND weight > 2").selectExpr(
        "key", "weight", "main.label AS main",
        f"CAST(greatest(ceil(weight / {BLOCK}), ceil(bytes / {BLOCK_BYTES})) AS INT) AS blocks",
        f"CAST(greatest(ceil((weight - main.c) / {BLOCK}), ceil((bytes - main.s) / {BLOCK_BYTES}), 1) AS INT) AS fews",
    )
    mixed = kept_table(mixed, "mixed")
    total = mixed.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    rows = join_keys(named, mixed, "key", "weight", total).selectExpr(
        "key", "record", "label", "label <> main AS few", "pmod(xxhash64(record), blocks) AS block",
        "pmod(xxhash64(record), fews) AS part", "blocks", "fews",
    )
    signs = distinct.select("record", "n", "signs", "bands")
    rows = kept_table(rows.join(signs, "record"), "rows")
    keys = ["key", "part", "block"]
    columns = ["record", "label", "few", "n", "signs", "bands"]
    spread = rows.selectExpr(
        "key", "explode(sequence(0L, fews - 1L)) AS part", "block", "1 AS side", *columns
    )
    few = rows.where("few").selectExpr(
        "key", "part", "explode(sequence(0L, blocks - 1L)) AS block", "0 AS side", *columns
    )
    dealt = spread.union(few).repartition(*keys).sortWithinPartitions(*keys)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs_of(batches, keys):
            found = _partners(group, percent)
            if found:
                some = np.unique(np.concatenate([[i for i, _ in found], *[j for _, j in found]]))
                yield from group.take(pa.array(some)).combine_chunks().to_batches()

    chosen = kept_table(dealt.mapInArrow(choose, dealt.schema), "chosen")
    texts = texts_of(docs, _least(chosen.select("record"), distinct))
    again = chosen.join(texts, "record").select(*dealt.columns, "text")
    again = again.repartition(*keys).sortWithinPartitions(*keys)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs_of(batches, keys):
            links = _linked_labels(group, percent)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in links], pa.binary()) for k in (0, 1)], ["a", "b"]
            )

    return kept_table(again.mapInArrow(compare, "a binary, b binary"), "between")


def _least(names: DataFrame, distinct: DataFrame) -> DataFrame:
    """(record, least) of the records named."""
    return kept_table(names.distinct().join(distinct.select("record", "least"), "record"), "wanted")


def linked_sets(distinct: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """(record, component) of all records that are linked with another one."""
    buckets, pairs = candidates(distinct, percent)
    pairs = kept_table(pairs, "candidates")
    names = pairs.select("record").union(pairs.select("center"))
    texts = kept_table(texts_of(docs, _least(names, distinct)), "texts")
    labels = star_components(kept_table(verified_stars(pairs, texts, percent), "verified"))
    between = mixed_links(buckets, labels, distinct, docs, percent)
    if between.isEmpty():
        return labels
    tops = star_components(between).withColumnRenamed("component", "top")
    alone = tops.join(labels, "record", "left_anti")
    above = labels.join(tops.withColumnRenamed("record", "component"), "component", "left")
    return above.select("record", F.coalesce("top", "component").alias("component")).union(alone)


def near_duplicates(docs: DataFrame, *, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of docs (doc_id, text).

    A text's words, A-Z in lower case, are what ASCII white space separates; its set holds its runs
    of three words, or the run of all if there are fewer (compared by 64-bit hashes). Two rows are
    linked if 100 * common >= percent * union. component_id is the smallest doc_id of the rows
    reachable over links, kept tells whether it is the row's own.

    NULL texts and texts without words have no shingles and no links. Repeated rows and texts of
    one set are copies of each other; rows of one id are judged by their own texts. A NULL doc_id
    takes part: its component is NULL, and the row kept, only if no row reachable has an id. An
    empty table gives an empty result; other columns are ignored. Texts of any length are taken whole.
    """
    all_rows = kept_table(_records(docs), "records")
    distinct = kept_table(
        all_rows.where("record IS NOT NULL").groupBy("record").agg(
            F.count("*").alias("copies"), F.min("doc_id").alias("least"),
            *[F.first(c).alias(c) for c in ("n", "size", "signs", "bands")],
        ),
        "sets",
    )
    linked = kept_table(linked_sets(distinct, docs, percent), "linked")
    sets = distinct.select("record", "copies", "least").join(linked, "record", "left")
    ids = sets.where("component IS NOT NULL").groupBy("component").agg(F.min("least").alias("component_id"))
    special = sets.where("copies > 1 OR component IS NOT NULL").join(ids, "component", "left").select(
        "record", F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("component_id"))
        .alias("component_id"), F.col("copies").alias("weight"),
    )
    special = kept_table(special, "special")
    rows = all_rows.select("doc_id", "record", F.col("n").alias("n_shingles"))
    named = rows.where("record IS NOT NULL")
    joined = join_keys(named, special, "record", "weight", named.count(), "left")
    none = rows.where("record IS NULL").withColumn("component_id", F.col("doc_id"))
    component = F.coalesce("component_id", "doc_id")
    return joined.unionByName(none).select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )
