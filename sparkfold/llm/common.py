"""Words, scratch tables and connected components shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from sparkfold.llm.shingles import stars
from sparkfold.runtime import scratch_path

#: What separates words: ASCII white space.
GAP = r"[\x20\x09-\x0D]+"
#: Rows up to which a table of ids is broadcast.
FEW_ROWS = 100_000


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text in order; an empty array for NULL."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def ngram_hashes(df: DataFrame, hashes: str, n: int, name: str) -> DataFrame:
    """Add a column with the 64-bit hash of every run of n word hashes, by doubling.

    Each round pairs hashes of runs of m words to runs of 2m; what n lacks is paired at the end.
    """
    run, wide = hashes, 1
    while wide * 2 <= n:
        df = _paired(df, run, wide, run, wide, f"{name}_{wide * 2}")
        run, wide = f"{name}_{wide * 2}", wide * 2
    while wide < n:
        step = 1
        while wide + step * 2 <= n:
            step *= 2
        part = hashes if step == 1 else f"{name}_{step}"
        df = _paired(df, run, wide, part, step, f"{name}_{wide + step}")
        run, wide = f"{name}_{wide + step}", wide + step
    extra = [c for c in df.columns if c.startswith(f"{name}_") and c != run]
    return df.drop(*extra).withColumnRenamed(run, name)


def _paired(df: DataFrame, left: str, m: int, right: str, k: int, name: str) -> DataFrame:
    """Column `name`: hash of left[i] and right[i + m], for every run of m + k words."""
    a, b = F.col(left), F.col(right)
    count = F.greatest(F.size(a) - k, F.lit(0))
    pairs = F.zip_with(
        F.slice(a, 1, count), F.slice(b, m + 1, count), lambda x, y: F.xxhash64(x, y)
    )
    return df.withColumn(name, pairs)


class Scratch:
    """The scratch tables that are written while it is open, to be removed once nothing needs them.

    A stage opens one. Its result reads the tables until it is written itself, so they are removed
    by whoever knows that: the next stage, if what it is given does not read them.
    """

    open_: list[Scratch] = []

    def __init__(self) -> None:
        self.paths: list[str] = []

    def __enter__(self) -> Scratch:
        Scratch.open_.append(self)
        return self

    def __exit__(self, *_) -> None:
        Scratch.open_.remove(self)

    def remove_unless_read(self, docs: DataFrame) -> None:
        """Remove the tables if docs names its files and none of them lies in a table."""
        files = docs.inputFiles() if self.paths else []
        read = any(f"/{path.rsplit('/', 1)[1]}/" in file for file in files for path in self.paths)
        if not files or read:
            return
        spark = docs.sparkSession
        for path in self.paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        self.paths = []


def kept_table(df: DataFrame, name: str) -> DataFrame:
    """Write a table below the shared scratch folder and read it back: lineage ends there."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if Scratch.open_:
        Scratch.open_[-1].paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_few(df: DataFrame, few: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join with a kept table that is usually small: broadcast if its rows are counted to be few.

    Beyond the bound both sides are shuffled and merged; the result is the same.
    """
    if few.count() <= FEW_ROWS:
        return df.join(F.broadcast(few), on, how)
    return df.join(few.hint("merge"), on, how)


def _few_components(links: DataFrame) -> DataFrame:
    """The components of links that are few enough for a broadcast: they meet in one group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches, schema)
        ids = pc.unique(pa.chunked_array(rows.column("a").chunks + rows.column("b").chunks, schema.field("a").type))
        ids = ids.take(pc.sort_indices(ids))
        label = stars(len(ids), *(pc.index_in(rows.column(c), ids).to_numpy() for c in ("a", "b")))
        yield pa.RecordBatch.from_arrays([ids, ids.take(pa.array(label))], ["id", "component"])

    schema = to_arrow_schema(links.schema)
    kind = links.schema["a"].dataType.simpleString()
    return links.coalesce(1).mapInArrow(run, f"id {kind}, component {kind}")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of the links (a, b): one row (id, component) per linked id.

    The component is its smallest id. Up to FEW_ROWS links are settled in one job. Of more, every
    round sends each id the smallest label among its neighbours and then follows labels one step
    (pointer jumping), so that long chains need a number of rounds near the logarithm of their
    length. Labels are written every round.
    """
    links = kept_table(edges.select("a", "b").where("a <> b"), "links")
    if links.count() <= FEW_ROWS:
        return kept_table(_few_components(links), "labels")
    both = kept_table(links.union(links.selectExpr("b", "a")).distinct(), "links")
    labels = both.groupBy(F.col("a").alias("id")).agg(
        F.least(F.col("id"), F.min("b")).alias("component")
    )
    labels = kept_table(labels, "labels")
    for _ in range(rounds):
        near = (
            join_few(both, labels.select(F.col("id").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("component").alias("near"))
        )
        better = near.join(labels, "id").select(
            "id", F.least("component", "near").alias("target"), F.col("component").alias("was")
        )
        jump = labels.select(F.col("id").alias("target"), F.col("component").alias("jump"))
        step = kept_table(
            join_few(better, jump, "target", "left").select(
                "id", F.least("target", F.coalesce("jump", "target")).alias("component"), "was"
            ),
            "labels",
        )
        labels = step.select("id", "component")
        if step.where("component <> was").isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds.")
    return labels
