"""Scoring an unbounded table, and watching the predictions per time window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkfold.operators.models import Model
from sparkfold.operators.score import monitor_columns, score_batch


FAN = 16  # folders of a level of the monitor's table before they are merged


def score_stream(
    stream: DataFrame, model: Model, version: str, *, per_class: bool = False, invalid: str = "raise"
) -> DataFrame:
    """The batch scoring projection on a stream; it keeps no state. With ``invalid="null"`` a row
    that cannot be scored does not stop the stream but gets NULL outputs."""
    return score_batch(stream, model, version, per_class=per_class, invalid=invalid)


def write_scores(scored: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append scored rows to a Parquet table, each input row exactly once."""
    return (
        scored.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def utc_instant(ts: Column) -> Column:
    """A zone-less timestamp read as UTC, whatever the session's time zone."""
    local = F.convert_timezone(F.lit("UTC"), F.current_timezone(), ts)
    return local.cast("timestamp")


def monitor_stream(
    scored: DataFrame, time_col: str, n_features: int, *, window: str, delay: str
) -> DataFrame:
    """Monitoring values per tumbling window; the watermark bounds the state."""
    return (
        scored.withWatermark(time_col, delay)
        .groupBy(F.window(time_col, window).alias("window"))
        .agg(*monitor_columns(n_features))
    )


def write_monitor(
    monitor: DataFrame, path: str, checkpoint: str, *, fan: int = FAN, **trigger
) -> StreamingQuery:
    """Store every window that changes in a trigger, the open ones included.

    Update mode: the watermark drops closed windows from the state. A trigger writes one folder of
    the lowest level, which a repeated trigger replaces. Every ``fan`` folders of a level are
    merged into one of the next, with the latest value of each window, and removed: there are fewer
    than fan folders a level, and a window is written again once a level, however long the stream
    runs. A merge is a folder of its own and counts once it is complete, so a trigger that is
    repeated after it neither loses nor doubles a value.
    """

    def store(batch: DataFrame, epoch: int) -> None:
        own = batch.withColumn("epoch", F.lit(epoch).cast("long"))
        own.write.mode("overwrite").parquet(_folder(path, 0, epoch))
        merge_levels(batch.sparkSession, path, epoch, fan)

    return (
        monitor.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _folder(path: str, level: int, last: int) -> str:
    return f"{path.rstrip('/')}/level={level}/last={last}"


def merge_levels(spark: SparkSession, path: str, epoch: int, fan: int) -> None:
    """Merge every level that is full at the end of an epoch."""
    level, span = 1, fan
    while (epoch + 1) % span == 0:
        merge_folders(spark, path, level, epoch, span // fan, fan)
        level, span = level + 1, span * fan


def merge_folders(spark: SparkSession, path: str, level: int, epoch: int, step: int, fan: int) -> None:
    """Merge the folders of the level below that end at ``epoch``, one every ``step`` epochs."""
    files = spark._jvm.org.apache.hadoop.fs
    target = _folder(path, level, epoch)
    system = files.Path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    parts = [_folder(path, level - 1, epoch - k * step) for k in range(fan)]
    if not system.exists(files.Path(f"{target}/_SUCCESS")):
        there = [p for p in parts if system.exists(files.Path(p))]
        _latest(spark.read.parquet(*there)).write.mode("overwrite").parquet(target)
    for part in parts:
        system.delete(files.Path(part), True)


def _latest(stored: DataFrame) -> DataFrame:
    """The row of the latest epoch per window."""
    values = [c for c in stored.columns if c not in ("window", "level", "last")]
    latest = F.max_by(F.struct(*values), "epoch").alias("v")
    return stored.groupBy("window").agg(latest).select("window", "v.*")


def read_monitor(spark: SparkSession, path: str) -> DataFrame:
    """The current value of every window that ``write_monitor`` stored."""
    return _latest(spark.read.parquet(path)).drop("epoch")


def append_monitor(monitor: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append every window once it is closed by the watermark."""
    return (
        monitor.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
