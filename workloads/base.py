"""Registry, and the given tables seen as learning tables (in Spark and in SQL)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; without SQL only its rows are checked."""

    def register(run):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice.")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(value: Column | str, digits: int = 6) -> Column:
    """Rounded for comparison; adding zero removes a negative zero."""
    column = F.col(value) if isinstance(value, str) else value
    return F.round(column, digits) + F.lit(0.0)


def round_columns(df: DataFrame, names: Sequence[str], digits: int = 6) -> DataFrame:
    return df.select(
        *[rounded(c, digits).alias(c) if c in names else F.col(c) for c in df.columns]
    )


# Binary scores with ties: events.
EV = """ev AS (
    SELECT event_id AS id, CAST(event_type = 'purchase' AS INTEGER) AS y,
           value / (50 + value) AS p, CAST(value >= 50 AS INTEGER) AS yhat, value, user_id, ts
    FROM events)"""


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        (F.col("event_type") == "purchase").cast("int").alias("y"),
        (F.col("value") / (50 + F.col("value"))).alias("p"),
        (F.col("value") >= 50).cast("int").alias("yhat"),
        "value",
        "user_id",
        "ts",
    )


# Three classes, a binary label and a regression target with a unique id: orders.
OD = """od AS (
    SELECT o_orderkey AS id,
           CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS y3,
           CAST(o_orderstatus = 'F' AS INTEGER) AS y,
           CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS pr,
           CAST(substr(o_orderpriority, 1, 1) AS INTEGER) % 3 AS p3,
           (o_totalprice - 250000) / 150000 AS x1,
           date_diff('day', DATE '1998-04-01', CAST(o_orderdate AS DATE)) / 1000.0 AS x2,
           o_totalprice / 1000 AS t, o_custkey AS cust
    FROM orders)"""


def orders(spark: SparkSession, folder: str) -> DataFrame:
    status = F.col("o_orderstatus")
    priority = F.substring("o_orderpriority", 1, 1).cast("int")
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1998-04-01").cast("date"))
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(status == "F", 0).when(status == "O", 1).otherwise(2).alias("y3"),
        (status == "F").cast("int").alias("y"),
        priority.alias("pr"),
        (priority % 3).alias("p3"),
        ((F.col("o_totalprice") - 250000) / 150000).alias("x1"),
        (days / 1000.0).alias("x2"),
        (F.col("o_totalprice") / 1000).alias("t"),
        F.col("o_custkey").alias("cust"),
    )


# Regression and binary rows without an id: lineitem.
LI = """li AS (
    SELECT (l_quantity - 25) / 15 AS q, (l_discount - 0.05) / 0.03 AS d,
           l_extendedprice / 1000 AS t, CAST(l_returnflag = 'R' AS INTEGER) AS r,
           1 + l_tax * 100 AS w
    FROM lineitem)"""


def lineitems(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        ((F.col("l_quantity") - 25) / 15).alias("q"),
        ((F.col("l_discount") - 0.05) / 0.03).alias("d"),
        (F.col("l_extendedprice") / 1000).alias("t"),
        (F.col("l_returnflag") == "R").cast("int").alias("r"),
        (1 + F.col("l_tax") * 100).alias("w"),
    )


# Imbalanced binary label with a size: labels joined with documents.
DOC = """doc AS (
    SELECT doc_id AS id, CAST(quality AS BIGINT) AS y, toxic, n_chars / 1000 AS w,
           ln(1 + n_chars) - 7 AS x1, CAST(lang = 'en' AS DOUBLE) AS x2
    FROM labels JOIN documents USING (doc_id))"""


def documents(spark: SparkSession, folder: str) -> DataFrame:
    joined = table(spark, folder, "labels").join(table(spark, folder, "documents"), "doc_id")
    return joined.select(
        F.col("doc_id").alias("id"),
        F.col("quality").cast("long").alias("y"),
        "toxic",
        (F.col("n_chars") / 1000).alias("w"),
        (F.log(1 + F.col("n_chars")) - 7).alias("x1"),
        (F.col("lang") == "en").cast("double").alias("x2"),
    )


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), "embedding", "label"
    )
