"""Quality rules: a hashed n-gram likelihood ratio of trusted against raw text, with base rules.

The ratio compares two multinomials over hash buckets of word unigrams and bigrams: one counted
on trusted documents, one on the whole corpus. A document's score is the mean log ratio of its
n-grams in micro-nats, summed as integers, so that it never depends on the order of rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfold.llm.common import kept_table, ngram_hashes, words

#: Width of the windows whose repetition is counted, in words.
WINDOW = 8
#: Scores are binned by this many micro-nats when the threshold is chosen, within +-20 nats.
BIN = 1000
SYMBOL = "[#*$%&|<>]"
#: Multiplier that joins two word codes (below 2**32) to a bigram code.
PAIR = 1_000_003
BIN_LIMIT = 20_000


def word_codes(word_list: str) -> Column:
    """crc32 of every word of a column of words."""
    return F.transform(word_list, lambda x: F.crc32(x))


def gram_codes(codes: str) -> Column:
    """Codes of the unigrams and bigrams, from a column of word codes."""
    c = F.col(codes)
    count = F.greatest(F.size(c) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(c, 1, count), F.slice(c, 2, count), lambda x, y: x * PAIR + y)
    return F.concat(c, pairs)


def bucket_counts(docs: DataFrame, size: int) -> tuple[list[int], list[int]]:
    """How often each bucket occurs in all texts and in trusted ones (text, is_trusted).

    Counts are combined on the map side; the driver receives `size` rows, whatever the corpus.
    """
    found = (
        docs.select(words(F.col("text")).alias("w"), "is_trusted")
        .select(word_codes("w").alias("c"), "is_trusted")
        .select(F.explode(gram_codes("c")).alias("code"), "is_trusted")
        .groupBy((F.col("code") % size).alias("bucket"))
        .agg(F.count("*").alias("n"), F.count_if("is_trusted").alias("t"))
    )
    raw, trusted = [0] * size, [0] * size
    for bucket, n, t in found.collect():
        raw[bucket], trusted[bucket] = n, t
    return raw, trusted


def log_ratios(trusted: list[int], raw: list[int], smoothing: float) -> list[int]:
    """Micro-nats of ln(p_trusted / p_raw) per bucket, both with additive smoothing."""
    total_t = sum(trusted) + smoothing * len(trusted)
    total_r = sum(raw) + smoothing * len(raw)
    return [
        round(1e6 * math.log((t + smoothing) / total_t * total_r / (r + smoothing)))
        for t, r in zip(trusted, raw)
    ]


def base_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the words, their codes and the counts of the base rules; a NULL text counts as empty.

    Repeated windows are found by hash and then compared as text, inside the row.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    first = docs.select(
        "doc_id",
        words(F.col("text")).alias("w"),
        F.when(
            text.rlike(SYMBOL), F.length(text) - F.length(F.regexp_replace(text, SYMBOL, ""))
        ).otherwise(0).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )
    chars = F.aggregate("w", F.lit(0), lambda total, x: total + F.length(x))
    first = first.withColumns({"c": word_codes("w"), "word_chars": chars.cast("long")})
    first = ngram_hashes(first, "c", WINDOW, "h")
    w = F.col("w")
    base = ["doc_id", "w", "c", "word_chars", "n_symbols"]
    second = first.select(
        *base,
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "h",
    )
    base.append("n_dup_lines")
    h = F.col("h")

    def repeated(sorted_name: str) -> Column:
        s = F.col(sorted_name)
        return F.filter(
            s,
            lambda x, i: F.coalesce(F.get(s, i + 1)["k"] == x["k"], F.lit(False))
            | ((i > 0) & F.coalesce(F.get(s, i - 1)["k"] == x["k"], F.lit(False))),
        )

    third = second.select(
        *base,
        F.when(
            F.size(F.array_distinct(h)) < F.size(h),
            F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("k"), i.alias("i")))),
        ).alias("s"),
    )
    fourth = third.select(*base, repeated("s").alias("again"))
    fifth = fourth.select(
        *base,
        F.sort_array(
            F.transform(
                "again",
                lambda x: F.struct(
                    F.array_join(F.slice(w, x["i"] + 1, WINDOW), " ").alias("k"),
                    x["i"].alias("i"),
                ),
            )
        ).alias("s"),
    )
    sixth = fifth.select(
        *base, F.sort_array(F.transform(repeated("s"), lambda x: x["i"])).alias("p")
    )
    p = F.col("p")
    covered = F.aggregate(
        F.transform(
            p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))
        ),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    return sixth.select(
        *base,
        F.size("w").cast("long").alias("n_words"),
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
    )


def quality_rules(
    docs: DataFrame,
    trusted: DataFrame,
    *,
    size: int = 10_000,
    smoothing: float = 1.0,
    trusted_loss: float = 0.005,
    calibration: int = 5,
    min_words: int = 20,
    max_repeat_percent: int = 30,
) -> DataFrame:
    """Score and judge every document: one row per row of docs (doc_id, text).

    trusted (doc_id) names the trusted documents. Those whose crc32(doc_id as text) is divisible
    by ``calibration`` stay out of the trusted counts; the threshold is the highest binned score
    that loses at most ``trusted_loss`` of them (of those that pass the base rules). Without such
    documents the threshold is zero. ``kept`` is false for a document that fails the base rules,
    otherwise whether its mean log ratio reaches the threshold.

    NULL and empty texts have no words, score zero and fail the base rules. NULL ids match no
    trusted id and are judged like any other row; repeated rows are judged alike; an empty table
    gives an empty result. Columns other than doc_id and text are ignored.
    """
    docs = docs.select("doc_id", "text")
    held = F.crc32(F.col("doc_id").cast("string")) % calibration == 0
    ids = trusted.select("doc_id").where("doc_id IS NOT NULL").distinct()
    # labels grow with the corpus: the same plan at every size, texts are shuffled once
    flags = ids.where(~held).withColumn("is_trusted", F.lit(True)).hint("merge")
    marked = docs.join(flags, "doc_id", "left")
    raw, counted = bucket_counts(marked, size)
    ratios = ",".join(map(str, log_ratios(counted, raw, smoothing)))
    table = F.split(F.lit(ratios), ",").cast("array<bigint>")

    based = base_rules(docs).withColumn("b", gram_codes("c"))
    summed = F.aggregate("b", F.lit(0).cast("long"), lambda total, x: total + F.get(table, (x % size).cast("int")))
    scored = based.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < min_words)
         | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")))
        .alias("base_failed"),
        F.when(F.size("b") > 0, F.floor(summed / F.size("b"))).otherwise(0)
        .cast("long").alias("score_micro"),
    )
    scored = kept_table(scored, "quality")

    binned = F.greatest(
        F.lit(-BIN_LIMIT), F.least(F.lit(BIN_LIMIT), F.floor(F.col("score_micro") / BIN))
    )
    histogram = sorted(
        scored.where("NOT base_failed")
        .join(ids.where(held), "doc_id", "left_semi")
        .groupBy(binned.alias("bin")).count().collect()
    )
    allowed = trusted_loss * sum(r["count"] for r in histogram)
    threshold, lost = 0, 0
    for i, row in enumerate(histogram):
        if i == 0 or lost <= allowed:
            threshold = row["bin"] * BIN
        lost += row["count"]
    return scored.withColumn(
        "kept", ~F.col("base_failed") & (F.col("score_micro") >= F.lit(threshold))
    )
