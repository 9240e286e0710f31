"""Splits, folds and batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkfold.operators import splits
from workloads.base import EV, OD, ORACLE, events, orders, query, table


def shuffled(seed, key="id"):
    return f"md5(concat('{seed}:', {key})), {key}"


SPLIT = """WITH {0}, r AS (SELECT id, row_number() OVER (ORDER BY {1}) - 1 AS r FROM {2})
SELECT id, r < {3} AS is_test FROM r"""


@query(
    "p01_train_test_split",
    SPLIT.format(OD, shuffled(7), "od", "(SELECT ceil(count(*) * 0.3) FROM od)"),
)
def p01(spark, d):
    return splits.train_test_split(orders(spark, d).select("id"), "id", test_size=0.3, seed=7)


@query(
    "p01_train_test_split_unshuffled",
    SPLIT.format(EV, "id", "ev", "(SELECT ceil(count(*) * 0.25) FROM ev)"),
)
def p01_plain(spark, d):
    return splits.train_test_split(events(spark, d).select("id"), "id", shuffle=False)


@query("p01_train_test_split_rows", SPLIT.format(EV, shuffled(11), "ev", "123"))
def p01_rows(spark, d):
    return splits.train_test_split(events(spark, d).select("id"), "id", test_size=123, seed=11)


# Quotas per class; the surplus is taken from the highest classes, a shortage is filled from the
# rest in a second shuffled order.
STRATIFIED = """WITH base AS ({rows}),
n AS (SELECT count(*) AS n, {n_test} AS n_test FROM base),
c AS (SELECT label, count(*) AS c FROM base GROUP BY label),
q AS (SELECT label, CAST(least(greatest(1, round_even(n_test * c / n, 0)), c - 1) AS BIGINT) AS q
      FROM c, n),
cum AS (SELECT label, q, sum(q) OVER (ORDER BY label) - q AS below FROM q),
cut AS (SELECT label, greatest(0, least(q, n_test - below)) AS q FROM cum, n),
r AS (SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY {first}) AS r FROM base),
marked AS (SELECT id, label, r <= q AS taken FROM r JOIN cut USING (label)),
rest AS (SELECT id, row_number() OVER (ORDER BY {second}) AS r FROM marked WHERE NOT taken),
fill AS (SELECT id FROM rest
         WHERE r <= (SELECT max(n_test) FROM n) - (SELECT sum(q) FROM cut))
SELECT id, label, taken OR id IN (SELECT id FROM fill) AS is_test FROM marked"""


def stratified_sql(rows, n_test, seed):
    return STRATIFIED.format(
        rows=rows, n_test=n_test, first=shuffled(seed), second=shuffled(f"{seed}:fill")
    )


def _stratified(df, test_size, seed):
    return splits.train_test_split(df, "id", test_size=test_size, stratify="label", seed=seed)


@query(
    "p02_stratified_split",
    stratified_sql(f"WITH {OD} SELECT id, y3 AS label FROM od", "ceil(count(*) * 0.25)", 42),
)
def p02(spark, d):
    rows = orders(spark, d).select("id", F.col("y3").alias("label"))
    return _stratified(rows, 0.25, 42)


@query(
    "p02_stratified_split_surplus",
    stratified_sql("SELECT p_partkey AS id, p_size AS label FROM part", "30", 5),
)
def p02_surplus(spark, d):
    rows = table(spark, d, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_size").alias("label")
    )
    return _stratified(rows, 30, 5)


@query(
    "p02_stratified_split_many_classes",
    stratified_sql(
        "SELECT c_custkey AS id, c_nationkey AS label FROM customer", "ceil(count(*) * 0.21)", 9
    ),
)
def p02_many(spark, d):
    rows = table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("label")
    )
    return _stratified(rows, 0.21, 9)


# as many classes as customers, and one that holds half of the rows
HOT_CUSTOMERS = f"WITH {OD} SELECT id, CASE WHEN id % 2 = 0 THEN -1 ELSE cust END AS label FROM od"


def _hot_customers(spark, d):
    label = F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("cust"))
    return orders(spark, d).select("id", label.alias("label"))


@query("p02_stratified_split_customers", stratified_sql(HOT_CUSTOMERS, "ceil(count(*) * 0.02)", 3))
def p02_customers(spark, d):
    # every class asks for a row, more than the split takes: the highest classes give them back
    return _stratified(_hot_customers(spark, d), 0.02, 3)


@query("p02_stratified_split_customers_fill", stratified_sql(HOT_CUSTOMERS, "ceil(count(*) * 0.9)", 4))
def p02_customers_fill(spark, d):
    # no class is taken whole, so the rest is filled in a second order
    return _stratified(_hot_customers(spark, d), 0.9, 4)


FOLD = """WITH {0}, r AS (SELECT id, row_number() OVER (ORDER BY {1}) - 1 AS r FROM {2}),
k AS (SELECT count(*) // {3} AS size, count(*) % {3} AS longer FROM {2})
SELECT id, CAST(CASE WHEN r < longer * (size + 1) THEN r // (size + 1)
  ELSE longer + (r - longer * (size + 1)) // size END AS INTEGER) AS fold FROM r, k"""


@query("p03_k_fold", FOLD.format(EV, "id", "ev", 7))
def p03(spark, d):
    return splits.k_fold(events(spark, d).select("id"), "id", n_splits=7)


@query("p03_k_fold_shuffled", FOLD.format(OD, shuffled(3), "od", 7))
def p03_shuffled(spark, d):
    return splits.k_fold(orders(spark, d).select("id"), "id", n_splits=7, shuffle=True, seed=3)


@query(
    "p04_stratified_k_fold",
    f"""WITH {OD} SELECT id, y3, CAST((row_number() OVER (PARTITION BY y3 ORDER BY id) - 1) % 4
        AS INTEGER) AS fold FROM od""",
)
def p04(spark, d):
    rows = orders(spark, d).select("id", "y3")
    return splits.stratified_k_fold(rows, "id", "y3", n_splits=4)


CLASS_FOLD = """r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {0}) - 1 AS r,
  count(*) OVER (PARTITION BY label) // {1} AS size,
  count(*) OVER (PARTITION BY label) % {1} AS longer FROM base),
folded AS (SELECT *, CAST(CASE WHEN r < longer * (size + 1) THEN r // (size + 1)
  ELSE longer + (r - longer * (size + 1)) // size END AS INTEGER) AS fold FROM r)"""


@query(
    "p04_stratified_k_fold_shuffled",
    f"WITH {OD}, base AS (SELECT id, y3 AS label FROM od), {CLASS_FOLD.format(shuffled(5), 4)} "
    "SELECT id, label, fold FROM folded",
)
def p04_shuffled(spark, d):
    rows = orders(spark, d).select("id", F.col("y3").alias("label"))
    return splits.stratified_k_fold(rows, "id", "label", n_splits=4, shuffle=True, seed=5)


@query(
    "p04_stratified_k_fold_many_classes",
    "WITH base AS (SELECT c_custkey AS id, c_nationkey AS label FROM customer), "
    f"{CLASS_FOLD.format(shuffled(2), 3)} SELECT id, label, fold FROM folded",
)
def p04_many(spark, d):
    rows = table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("label")
    )
    return splits.stratified_k_fold(rows, "id", "label", n_splits=3, shuffle=True, seed=2)


@query(
    "p04_stratified_k_fold_shuffled_customers",
    f"WITH base AS ({HOT_CUSTOMERS}), {CLASS_FOLD.format(shuffled(7), 5)} "
    "SELECT id, label, fold FROM folded",
)
def p04_shuffled_customers(spark, d):
    return splits.stratified_k_fold(
        _hot_customers(spark, d), "id", "label", n_splits=5, shuffle=True, seed=7
    )


@query(
    "p05_holdout",
    f"""WITH {EV}, r AS (SELECT id, row_number() OVER (ORDER BY {shuffled('13:holdout')}) AS r
          FROM ev)
        SELECT id, r <= (SELECT least(greatest(1, ceil(count(*) * 0.15)), count(*) - 1) FROM ev)
        AS is_validation FROM r""",
)
def p05(spark, d):
    return splits.holdout_split(events(spark, d).select("id"), "id", fraction=0.15, seed=13)


@query(
    "p06_mini_batches",
    f"""WITH {OD} SELECT id, (row_number() OVER (ORDER BY {shuffled('4:2')}) - 1) // 700 AS batch
        FROM od""",
)
def p06(spark, d):
    rows = orders(spark, d).select("id")
    return splits.mini_batches(rows, "id", epoch=2, batch_size=700, seed=4).df


@query(
    "p06_mini_batches_unshuffled",
    f"WITH {EV} SELECT id, (row_number() OVER (ORDER BY id) - 1) // 32 AS batch FROM ev",
)
def p06_plain(spark, d):
    return splits.mini_batches(events(spark, d).select("id"), "id", epoch=0, shuffle=False).df


@query("p04_stratified_k_fold_bucketed", ORACLE["p04_stratified_k_fold"])
def p04_bucketed(spark, d):
    rows = orders(spark, d).select("id", "y3")
    return splits.stratified_k_fold(rows, "id", "y3", n_splits=4, bucket_rows=500)


@query(
    "p04_stratified_k_fold_customers",
    f"""WITH {OD} SELECT id, cust, CAST((row_number() OVER (PARTITION BY cust ORDER BY id) - 1) % 3
        AS INTEGER) AS fold FROM od""",
)
def p04_customers(spark, d):
    # a label with as many values as there are customers
    rows = orders(spark, d).select("id", "cust")
    return splits.stratified_k_fold(rows, "id", "cust", n_splits=3, bucket_rows=2000)
