"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks, exact verification.

A window has as many words as the item it is held against. Only windows are formed in which enough
five-word shingles occur in some item of that size; with fewer, the similarity cannot reach the
threshold. Each window and item gets a 64-bit SimHash. A radius of r is searched by r + 1 blocks of
bits: two fingerprints within the radius agree in at least one block. Pairs within the radius are
verified by the weighted Jaccard similarity of their shingles, a shingle's weight being how often
it occurs; the fingerprints take every occurrence for a shingle of its own, so that they follow the
same similarity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfold.llm.common import join_few, kept_table, ngram_hashes, words

WIDTH = 5
BITS = 64
#: At similarity 0.8 (8 of 9 shingles in common) two fingerprints differ in 9.8 bits on average,
#: with a standard deviation of 2.9; more than 20 differ with a probability of about 1 in 10,000.
RADIUS = 20


def shingled(df: DataFrame, *keep: str) -> DataFrame:
    """Columns `keep`, the words w and the 64-bit shingle codes h of a column text."""
    df = df.select(*keep, words(F.col("text")).alias("w"))
    df = df.withColumn("c", F.transform("w", lambda x: F.xxhash64(x)))
    return ngram_hashes(df, "c", WIDTH, "h").drop("c")


def fingerprint(codes: str) -> Column:
    """SimHash of a column of codes: each bit is the majority of the codes' bits.

    The 64 counters are kept two to a long, so 32 sums are needed.
    """
    sums = (
        "transform(sequence(0, 31), k -> aggregate({0}, 0L, (a, c) -> "
        "a + (shiftrightunsigned(c, k) & 4294967297L)))"
    )
    bits = (
        f"transform({sums}, (s, k) -> "
        "if(2 * (s & 4294967295L) > size({0}), shiftleft(1L, k), 0L) | "
        "if(2 * shiftrightunsigned(s, 32) > size({0}), shiftleft(1L, k + 32), 0L))"
    )
    return F.expr(f"aggregate({bits}, 0L, (a, b) -> a | b)".format(codes))


def numbered(codes: str) -> Column:
    """The codes as a set: of the occurrences of one code all but the first get a code of their own."""
    return F.expr(
        "if(size(array_distinct({0})) = size({0}), {0}, transform(array(sort_array({0})), r -> "
        "transform(r, (x, i) -> if(i < array_position(r, x), x, "
        "xxhash64(x, i + 1 - array_position(r, x)))))[0])".format(codes)
    )


def blocks(mark: Column | str, radius: int) -> Column:
    """The radius + 1 disjoint blocks of a fingerprint, as (block, value)."""
    count = radius + 1
    edges = [BITS * i // count for i in range(count + 1)]
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("block"),
                F.shiftrightunsigned(mark, a).bitwiseAND(
                    (1 << (b - a)) - 1 if b - a < BITS else -1
                ).alias("value"),
            )
            for i, (a, b) in enumerate(zip(edges, edges[1:]))
        ]
    )


def _runs(word_list: str) -> Column:
    """Sorted shingles of a column of words."""
    w = F.col(word_list)
    at = F.sequence(F.lit(1), F.size(w) - (WIDTH - 1))
    return F.sort_array(F.transform(at, lambda i: F.array_join(F.slice(w, i, WIDTH), " ")))


def _counted(runs: str) -> Column:
    """Sorted shingles, each with the number of its occurrence: a set."""
    r = F.col(runs)
    return F.transform(
        r, lambda x, i: F.concat_ws(" ", x, (i - F.array_position(r, x)).cast("string"))
    )


def _windows(hits: DataFrame, threshold: float) -> DataFrame:
    """Places (key, size, start, width) where a window may reach the threshold, from the hits.

    hits: one row (key, n, size, at) per document and item size, n its number of shingles and at
    the sorted positions of shingles of items of `size` shingles. A window of `width` shingles needs
    `need` hits: common >= threshold * (width + size - common). Its first hit is at[k], so its last
    needed one is at[k + need - 1].
    """
    width = F.least("size", "n")
    sized = hits.withColumn("width", width).withColumn(
        "need",
        F.ceil(F.lit(threshold / (1 + threshold)) * (F.col("width") + F.col("size")) - 1e-9)
        .cast("int"),
    ).where("need <= width AND size(at) >= need")
    # the positions are turned into ranges inside the row: exploded rows carry no array
    at, need, wide = F.col("at"), F.col("need"), F.col("width")
    ranges = F.transform(
        F.slice(at, 1, F.size(at) - need + 1),
        lambda first, k: F.struct(
            F.greatest(
                F.when(k > 0, F.get(at, k - 1)).otherwise(-1) + 1,
                first - (wide - need),
                F.get(at, k + need - 1) - wide + 1,
            ).alias("low"),
            F.least(first, F.col("n") - wide).alias("high"),
        ),
    )
    ranged = sized.select("key", "size", "width", F.explode(ranges).alias("r")).select(
        "key", "size", "width", "r.low", "r.high"
    )
    return ranged.where("low <= high").select(
        "key", "size", "width", F.explode(F.sequence("low", "high")).alias("start")
    )


def contamination(
    docs: DataFrame, items: DataFrame, *, threshold: float = 0.8, radius: int = RADIUS
) -> DataFrame:
    """(doc_id, item_id, similarity, start_word) for every document and item that overlap.

    docs (doc_id, text), items (item_id, text). A pair is returned if some window of the document
    with as many words as the item (all of a shorter document) has a weighted shingle Jaccard
    similarity of at least the threshold to it; similarity is that of the best window, start_word
    the first word of the first such window. A pair exactly at the threshold is missed with a
    probability of about 1 in 10,000 (see RADIUS), a verbatim copy never.

    Items and documents of fewer than five words and NULL or empty texts have no shingles and match
    nothing. Rows with the same doc_id (NULL is one too) count as one document with the best of
    their windows, equal items are reported each. Empty tables give an empty result; other columns
    are ignored.
    """
    rows = docs.select("doc_id", "text").where("text IS NOT NULL")
    rows = rows.withColumn("key", F.struct("doc_id", F.xxhash64("text").alias("version")))
    marked = shingled(items.select("item_id", "text"), "item_id").where(F.size("w") >= WIDTH)
    marked = kept_table(
        marked.withColumn("set", numbered("h")).select(
            "item_id", "w", "h", F.size("h").alias("size"), fingerprint("set").alias("mark")
        ),
        "items",
    )
    codes = kept_table(marked.select(F.explode("h").alias("code"), "size").distinct(), "codes")

    # the outer form, since the optimizer would put a filter on the codes below their computation,
    # which would then run many times; the join drops the empty rows
    found = shingled(rows, "key").select(
        "key", F.size("h").alias("n"), F.posexplode_outer("h").alias("at", "code")
    )
    hits = join_few(found, codes, "code").groupBy("key", "n", "size").agg(
        F.sort_array(F.collect_set("at")).alias("at")
    )
    windows = kept_table(
        _windows(hits, threshold).groupBy("key")
        .agg(F.collect_set(F.struct("size", "width", "start")).alias("windows")),
        "windows",
    )
    cut = shingled(join_few(rows, windows, "key").select("key", "windows", "text"), "key", "windows")
    cut = cut.select("key", "w", "h", F.explode("windows").alias("x")).select(
        "key", "x.size", "x.start",
        F.expr("slice(h, x.start + 1, x.width)").alias("h"),
        F.expr(f"slice(w, x.start + 1, x.width + {WIDTH - 1})").alias("w"),
    )
    cut = cut.withColumn("set", numbered("h"))
    cut = kept_table(cut.select("key", "size", "start", "w", fingerprint("set").alias("mark")), "cut")

    # the words wait in the table of windows while fingerprints meet
    probe = cut.select("key", "size", "start", "mark", F.explode(blocks("mark", radius)).alias("b"))
    index = kept_table(
        marked.select(
            "item_id", "size", F.col("mark").alias("item_mark"),
            F.explode(blocks("mark", radius)).alias("b"),
        ),
        "index",
    )
    distance = F.bit_count(F.col("mark").bitwiseXOR(F.col("item_mark")))
    # a pair that agrees in several blocks is taken from the first of them only
    agree = F.transform(
        blocks(F.col("mark").bitwiseXOR(F.col("item_mark")), radius), lambda x: x["value"] == 0
    )
    near = (
        join_few(probe, index, ["size", "b"])
        .where(distance <= radius)
        .where(F.array_position(agree, True) == F.col("b.block") + 1)
        .select("key", "size", "start", "item_id")
    )
    near = cut.join(near, ["key", "size", "start"]).join(
        marked.select("item_id", F.col("w").alias("item_w")), "item_id"
    )
    both = near.select("key", "item_id", "start", _runs("w").alias("u"), _runs("item_w").alias("v"))
    both = both.select("key", "item_id", "start", _counted("u").alias("a"), _counted("v").alias("b"))
    common = F.size(F.array_intersect("a", "b"))
    similarity = common / (F.size("a") + F.size("b") - common)
    # the threshold comes after the aggregate: below it, the filter would be pushed down and would
    # evaluate the shingles again for each of its references
    best = (
        both.groupBy(F.col("key.doc_id").alias("doc_id"), "item_id")
        .agg(F.min(F.struct((-similarity).alias("s"), F.col("start").alias("at"))).alias("best"))
        .where(F.col("best.s") <= 1e-9 - threshold)
    )
    return best.select(
        "doc_id", "item_id", F.round(-F.col("best.s"), 6).alias("similarity"),
        F.col("best.at").cast("long").alias("start_word"),
    )
