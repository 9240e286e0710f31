"""A corpus from documents to token ids: five stages, each written as Parquet and read again."""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfold.llm import decontaminate, jaccard_join, line_dedup, pieces, toxicity
from sparkfold.llm.common import FEW_ROWS, Scratch, join_few, kept_table, load

#: Documents with at least this score are rejected as toxic if no label tells a better bound.
TOXIC = 0.3
#: Share of the confirmed clean documents that the bound keeps.
KEPT = 0.98

#: Rows of an Arrow batch at most: whole texts pass through Python, and a task holds a few batches on either side.
BATCH_ROWS = 1024
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Removes the shuffle files of an execution when it ends; nothing is executed twice, for steps are written.
CLEAN_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Scratch tables of the stages made so far.
_FINISHED: list[Scratch] = []


def _stage(make):
    """A stage that first removes the scratch tables of earlier ones, unless its documents read them.

    Stages are written and read again, so nothing reads an earlier one's tables by then. The session's
    Arrow batches are made small and its shuffle files are removed early, and both stay so, because
    what a stage returns is computed when it is written.
    """

    @functools.wraps(make)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for scratch in _FINISHED:
            scratch.remove_unless_read(docs)
        _FINISHED[:] = [s for s in _FINISHED if s.paths]
        rows = int(spark.conf.get(BATCH_CONF))
        spark.conf.set(BATCH_CONF, min(rows, BATCH_ROWS) if rows > 0 else BATCH_ROWS)
        spark.conf.set(CLEAN_CONF, "true")
        with Scratch() as own:
            _FINISHED.append(own)
            return make(spark, docs, sf_dir)

    return run_stage


def _keyed(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text) of every row, kept: row is whole, doc_id a key that no two rows share.

    Keys are ordered by id (NULL last), then by text hash; the number that ends them is drawn once.
    """
    key = F.struct(
        F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.xxhash64("text").alias("version"),
        F.monotonically_increasing_id().alias("number"),
    )
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return kept_table(docs.select(row.alias("row"), key.alias("doc_id"), "text"), "keyed")


def _without(keyed: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of keyed without those of the given keys."""
    gone = kept_table(keys.select("doc_id.number").distinct(), "gone")
    left = join_few(keyed.select("row", "doc_id.number"), gone, "number", "left_anti")
    return left.select("row.*")


def toxic_bound(docs: DataFrame, labels: DataFrame, model) -> float:
    """The score that KEPT of the confirmed clean documents stay below, TOXIC at most.

    All of them count. A few are looked up before they are scored; of more the scores are looked up,
    so that no text is shuffled.
    """
    clean = kept_table(labels.where("toxic = 0").select("doc_id").distinct(), "clean")
    if clean.count() <= FEW_ROWS:
        scored = toxicity.score(docs.join(F.broadcast(clean), "doc_id", "left_semi"), model)
    else:
        scored = toxicity.score(docs, model).join(clean.hint("merge"), "doc_id", "left_semi")
    # an aggregate of bounded size; it is exact for few scores
    bound = scored.agg(F.percentile_approx("score", KEPT, 10_000)).first()[0]
    return TOXIC if bound is None else min(TOXIC, bound)


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled model does not reject; all rows are scored.

    It learns from the labelled documents outside the held-out quarter, and so does the bound
    (see toxic_bound), which is TOXIC at most. NULL texts and texts of no word get the score of
    none, which is near the prior; with a bound above it they stay. Rows of one id are judged by
    their own texts, repeated rows alike. An empty table gives an empty result.
    """
    learnt = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 != 2, F.lit(False))
    labels = load(spark, sf_dir, "labels").where(learnt)
    known = docs.where(learnt)
    model = toxicity.fit(known, labels)
    scored = toxicity.with_score(docs, model).where(F.col("score") <= toxic_bound(known, labels, model))
    return scored.select(*[f"`{c}`" for c in docs.columns])


@_stage
def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat earlier ones; every document stays.

    Copies as a whole lose what the first of them loses: they stay equal, and the next stage decides
    about them. Whatever else repeats goes, however much of a document it is. n_chars follows.
    """
    short = line_dedup.remove_lines(docs, most=1.0)
    if "n_chars" in docs.columns:
        short = short.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return short


@_stage
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates one row: that with the smallest id, NULL last.

    Rows are told apart where they share an id or have none.
    """
    keyed = _keyed(docs)
    classes = jaccard_join.jaccard_join(keyed.select("doc_id", "text"))
    return _without(keyed, classes.where("doc_id <> class_id"))


@_stage
def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark, each row judged by its own text.

    NULL and empty texts have no passage and stay.
    """
    keyed = _keyed(docs)
    leaks = decontaminate.contamination(keyed.select("doc_id", "text"), load(spark, sf_dir, "benchmark"))
    return _without(keyed, leaks)


@_stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text): token ids of every document and the text they decode to.

    One row per row; NULL and empty texts have the end id only and decode to an empty text, texts
    of any length are encoded whole. An empty table gives an empty result. The ids are kept before
    they are decoded: a task then has one Python worker and its Arrow buffers at a time, not two.
    """
    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = pieces.decode_ids(kept_table(pieces.encode_texts(docs, model), "ids"), model)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "text")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("jaccard_join", drop_copies),
    ("decontamination", drop_leaks),
    ("sentencepiece", encode),
]

#: A trained classifier decides in the first stage, which SQL cannot state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
