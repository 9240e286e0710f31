"""Exact ranks, order statistics and running sums without a single-partition sort.

Three tools, all pure functions of the rows (nothing depends on how Spark happened to partition
them, so lost executors and retried stages cannot change a result):

* ``order_statistics`` finds the rows standing at given ranks by histogram passes that narrow the
  key range. Only counts are shuffled. A split is then a comparison with a few literals.
* ``hash_buckets`` / ``value_buckets`` cut a table into ordered buckets of bounded size.
* ``running_sums`` adds the totals of the earlier buckets to a window inside each bucket; the table
  is shuffled once, by bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkfold.constants import (
    BROADCAST_ROWS,
    BUCKET_ROWS,
    HISTOGRAM_BITS,
    LEAF_ROWS,
    MAX_BUCKETS,
    SAMPLES_PER_BUCKET,
)
from sparkfold.functions.scalar import is_violation
from sparkfold.operators.checks import is_number

PREFIX = 3  # hex digits by which a search pass over md5 keys narrows the range
LONGEST_PREFIX = 30
LITERAL_PAIRS = 64  # intervals that are literals of the plan; more are a joined table
DRIVER_BINS = 65_536  # counts of groups by interval that reach the driver at most, and ...
DRIVER_GROUPS = 256  # ... groups; beyond, their ranks are searched by tables
HEAVY_PARTS = 1000  # a key with more than one part in so many of the rows is never shuffled
DRIVER_ROWS = 20_000  # rows of the last intervals that are sorted on the driver at most


def shuffle_key(seed: int | str, id_col: str) -> Column:
    """Shuffled position of a row: depends on the seed and the row's id only."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")).cast("binary"))


class HashBins:
    """Intervals of uniform md5 keys: their leading hex digits."""

    kind = "string"

    def column(self, key: Column, depth: int) -> Column:
        return F.substring(key, 1, PREFIX * (depth + 1))

    def coarser(self, bin_: str, depth: int) -> str:
        return bin_[: PREFIX * depth]

    def finest(self, depth: int) -> bool:
        return PREFIX * (depth + 1) >= LONGEST_PREFIX


@dataclass(frozen=True)
class NumberBins:
    """Intervals of numbers between ``low`` and ``low + 2**bits``: their leading bits."""

    low: int
    bits: int
    kind = "long"

    def _shift(self, depth: int) -> int:
        return max(self.bits - HISTOGRAM_BITS * (depth + 1), 0)

    def column(self, key: Column, depth: int) -> Column:
        offset = F.floor(key).cast("long") - F.lit(self.low)
        return F.shiftright(offset, self._shift(depth))

    def coarser(self, bin_: int, depth: int) -> int:
        return bin_ >> (self._shift(depth - 1) - self._shift(depth))

    def finest(self, depth: int) -> bool:
        return self._shift(depth) == 0


@dataclass(frozen=True)
class RowOrder:
    """A total order of rows, and ever finer ordered intervals of its first column."""

    columns: tuple[Column, ...]
    bins: HashBins | NumberBins


def shuffled_order(seed: int | str, id_col: str) -> RowOrder:
    return RowOrder((shuffle_key(seed, id_col), F.col(id_col)), HashBins())


def id_order(df: DataFrame, id_col: str) -> RowOrder:
    """Order by a numeric id."""
    if not is_number(df, id_col):
        raise ValueError(f"order by {id_col!r} needs a numeric id.")
    number = F.floor(F.col(id_col)).cast("long")
    low, high = df.agg(F.min(number), F.max(number)).first()
    if low is None:
        raise ValueError("at least one sample is needed.")
    return RowOrder((F.col(id_col),), NumberBins(low, max(int(high - low).bit_length(), 1)))


def row_order(df: DataFrame, id_col: str, shuffle: bool, seed: int | str) -> RowOrder:
    return shuffled_order(seed, id_col) if shuffle else id_order(df, id_col)


def precedes(columns: Sequence[Column], values: Sequence) -> Column:
    """True for rows that come strictly before the given key."""
    column, value = columns[0], F.lit(values[0])
    if len(columns) == 1:
        return column < value
    return (column < value) | ((column == value) & precedes(columns[1:], values[1:]))


Targets = Callable[[dict], Mapping[object, Sequence[int]]]


def order_statistics(
    df: DataFrame,
    order: RowOrder,
    targets: Targets,
    group: Column | None = None,
    *,
    leaf_rows: int = LEAF_ROWS,
) -> tuple[dict, dict]:
    """Keys of the rows at given 0-based ranks, per group.

    ``targets`` receives the row count of every group and answers with the wanted ranks. Returns
    the counts and ``{(group, rank): key}``. Each pass counts rows per key interval and keeps the
    intervals that hold a target; once those are small, they alone are sorted.
    """
    spark, bins = df.sparkSession, order.bins
    keys = [f"_k{i}" for i in range(len(order.columns))]
    rows = df.select(
        (F.lit(0) if group is None else group).alias("_g"),
        *[c.alias(name) for c, name in zip(order.columns, keys, strict=True)],
    )
    places = f"_g {rows.schema['_g'].dataType.simpleString()}, _b {bins.kind}"

    def narrowed(depth: int, kept) -> DataFrame:
        """Rows inside the kept (group, interval) pairs; there is one pair per target at most."""
        inside = rows.withColumn("_b", bins.column(F.col("_k0"), depth))
        if len(kept) <= LITERAL_PAIRS:
            by_group: dict = {}
            for g, b in kept:
                by_group.setdefault(g, []).append(b)
            tests = [F.col("_g").eqNullSafe(F.lit(g)) & F.col("_b").isin(b) for g, b in by_group.items()]
            return inside.filter(reduce(lambda a, b: a | b, tests))
        table = spark.createDataFrame(list(kept), places)
        return inside.join(F.broadcast(table), ["_g", "_b"], "left_semi")

    depth, scope, kept = 0, rows, {}
    counts: dict = {}
    wanted: list[tuple] = []  # (group, rank, rank left inside the interval, interval)
    while True:
        interval = bins.column(F.col("_k0"), depth).alias("_b")
        table: dict = {}
        counted = scope.groupBy("_g", interval).count()
        if group is not None and depth == 0:
            counted = counted.limit(DRIVER_BINS + 1)
        found = counted.collect()
        for g, b, n in found:
            table.setdefault(g, []).append((b, n))
        if group is not None and depth == 0 and max(len(found) - DRIVER_BINS, len(table) - DRIVER_GROUPS) > 0:
            raise ManyGroups
        if depth == 0:
            counts = {g: sum(n for _, n in found) for g, found in table.items()}
            ranks = targets(dict(sorted(counts.items())))
            wanted = [(g, r, r, None) for g, some in ranks.items() for r in some]
            if any(not 0 <= r < counts.get(g, 0) for g, r, _, _ in wanted):
                raise ValueError("a wanted rank lies outside its group.")
        located, kept = [], {}
        for g, rank, left, parent in wanted:
            for b, n in sorted(table[g]):
                if parent is not None and bins.coarser(b, depth) != parent:
                    continue
                if left < n:
                    break
                left -= n
            located.append((g, rank, left, b))
            kept[(g, b)] = n
        wanted = located
        if not wanted:
            return counts, {}
        if bins.finest(depth) or max(kept.values()) <= leaf_rows:
            break
        scope = narrowed(depth, kept)
        depth += 1
    if sum(kept.values()) <= DRIVER_ROWS:
        return counts, _sorted_keys(narrowed(depth, kept).select("_g", "_b", *keys).collect(), wanted)
    goal = spark.createDataFrame(
        [(g, b, left + 1, rank) for g, rank, left, b in wanted],
        f"{places}, _rn int, _rank long",
    )
    place = Window.partitionBy("_g", "_b").orderBy(*keys)
    numbered = narrowed(depth, kept).select(
        "*",
        F.row_number().over(place).alias("_rn"),
        # a cutoff between equal keys would take or leave them together
        F.struct(*keys).eqNullSafe(F.lag(F.struct(*keys)).over(place)).alias("_again"),
    )
    found = numbered.join(F.broadcast(goal), ["_g", "_b", "_rn"]).select(
        "_g", "_rank", "_again", *keys
    )
    rows = found.collect()
    if any(r["_again"] or None in tuple(r[3:]) for r in rows):
        raise ValueError("ids must be unique and not missing.")
    return counts, {(r[0], r[1]): tuple(r[3:]) for r in rows}


def _sorted_keys(rows: list, wanted: list[tuple]) -> dict:
    """Keys at the wanted ranks of a few rows (group, interval, key...)."""
    inside: dict = {}
    for g, b, *key in rows:
        inside.setdefault((g, b), []).append(tuple(key))
    found = {}
    for found_in in inside.values():
        if any(None in key for key in found_in):
            raise ValueError("ids must be unique and not missing.")
        found_in.sort()
    for g, rank, left, b in wanted:
        place = inside[(g, b)]
        key = place[left]
        # a cutoff between equal keys would take or leave them together
        if left and place[left - 1] == key:
            raise ValueError("ids must be unique and not missing.")
        found[(g, rank)] = key
    return found


class ManyGroups(Exception):
    """There are too many groups for the driver to hold their counts."""


def heavy_join(
    df: DataFrame, table: DataFrame, on: Sequence[str], weight: str, total: int, rows: int, how: str = "inner"
) -> DataFrame:
    """Join with a table that has each key once and ``weight``, the number of rows with that key.

    A table of up to BROADCAST_ROWS / 10 rows is broadcast. Else the keys with more than a
    HEAVY_PARTS-th of all rows, of which there are HEAVY_PARTS at most, are broadcast and their rows
    stay where they are; the rest is shuffled, and no key of it is large.
    """
    plain = table.drop(weight)
    if rows <= BROADCAST_ROWS // 10:
        return df.join(F.broadcast(plain), on, how)
    heavy = table.filter(F.col(weight) > total // HEAVY_PARTS).drop(weight)
    light = table.filter(F.col(weight) <= total // HEAVY_PARTS).drop(weight)
    here = df.join(F.broadcast(heavy), on, "left_semi" if how == "left_semi" else "inner")
    rest = df.join(F.broadcast(heavy.select(*on)), on, "left_anti").join(light.hint("merge"), on, how)
    return here.unionByName(rest)


def group_counts(df: DataFrame, group: Column) -> tuple[DataFrame, int, int]:
    """(_g, _n) per group, kept; the number of rows, and of groups."""
    counts = df.groupBy(group.alias("_g")).agg(F.count(F.lit(1)).alias("_n")).persist()
    total, groups = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.count(F.lit(1))).first()
    return counts, total, groups


def group_keys(
    df: DataFrame,
    order: RowOrder,
    group: Column,
    wanted: DataFrame,
    total: int,
    groups: int,
    *,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """Keys of the rows at wanted 0-based ranks (_g, _rank) of md5 orders, for any number of groups.

    A distributed radix search: ranks, histograms and found keys are tables throughout. Rows are
    counted by the leading digits of their key, as many as leave about 16 rows per count; every rank
    moves to the interval that holds it, and intervals above ``leaf_rows`` are counted by more
    digits. Only the rows of the last intervals are sorted. A large group is in many intervals by
    then, so none of its rows meet in one task unless they are few.

    The result (_g, _rank, _k0, _k1) is kept.
    """
    keys = [f"_k{i}" for i in range(len(order.columns))]
    rows = df.select(
        group.alias("_g"), *[c.alias(name) for c, name in zip(order.columns, keys, strict=True)]
    )
    digits = 0
    while digits < PREFIX and 16 ** (digits + 2) * groups <= total:
        digits += 1

    def cut(scope: DataFrame, length: int) -> DataFrame:
        return scope.withColumn("_b", F.substring("_k0", 1, length) if length else F.lit(""))

    scope, places, parent, held, found = rows, wanted.withColumn("_left", F.col("_rank")), 0, [], []
    places = places.withColumn("_p", F.lit(""))
    while True:
        counted = cut(scope, digits).groupBy("_g", "_b").agg(F.count(F.lit(1)).alias("_n"))
        counted = counted.withColumn("_p", F.substring("_b", 1, parent) if parent else F.lit(""))
        inside = Window.partitionBy("_g", "_p").orderBy("_b")
        counted = counted.withColumn("_before", F.sum("_n").over(inside) - F.col("_n"))
        here = (F.col("_before") <= F.col("_left")) & (F.col("_left") < F.col("_before") + F.col("_n"))
        located = counted.join(places, ["_g", "_p"]).filter(here).select(
            "_g", "_rank", (F.col("_left") - F.col("_before")).alias("_left"), "_b", "_n"
        ).persist()
        held.append(located)
        large = located.filter(F.col("_n") > leaf_rows) if digits < LONGEST_PREFIX else located.limit(0)
        # an interval is large only if it holds more than leaf_rows rows, so these are few
        open_ = large.select("_g", "_b", "_n").distinct()
        n_open, ends = open_.count(), located.filter(F.col("_n") <= leaf_rows)
        if digits >= LONGEST_PREFIX:
            ends = located
        scoped = cut(scope, digits)
        small = scoped
        if n_open:
            small = scoped.join(F.broadcast(open_.select("_g", "_b")), ["_g", "_b"], "left_anti")
        found.append(_leaf_keys(small, ends, keys, total))
        if not n_open:
            break
        scope = scoped.join(F.broadcast(open_.select("_g", "_b")), ["_g", "_b"], "left_semi").drop("_b")
        places = large.select("_g", "_rank", "_left", F.col("_b").alias("_p"))
        parent, digits = digits, min(digits + PREFIX, LONGEST_PREFIX)
    result = reduce(DataFrame.unionByName, found).persist()
    missing = wanted.count() - result.count()
    for table in held:
        table.unpersist()
    if missing:
        raise ValueError("a wanted rank lies outside its group.")
    return result


def _leaf_keys(rows: DataFrame, ends: DataFrame, keys: Sequence[str], total: int) -> DataFrame:
    """(_g, _rank, keys) of ranks whose intervals (_g, _rank, _left, _b, _n) are small."""
    intervals = ends.groupBy("_g", "_b").agg(F.max("_n").alias("_n"))
    chosen = heavy_join(rows, intervals, ["_g", "_b"], "_n", total, intervals.count(), "left_semi")
    place = Window.partitionBy("_g", "_b").orderBy(*keys)
    twice = F.raise_error(F.lit("ids must be unique and not missing.")).cast("int")
    same = F.struct(*keys).eqNullSafe(F.lag(F.struct(*keys)).over(place))
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    numbered = chosen.select("*", F.row_number().over(place).alias("_rn"), (same | missing).alias("_bad"))
    goal = ends.select("_g", "_rank", "_b", (F.col("_left") + 1).cast("int").alias("_rn"))
    return (
        numbered.withColumn("_rn", F.when(F.col("_bad"), twice).otherwise(F.col("_rn")))
        .join(goal, ["_g", "_b", "_rn"]).select("_g", "_rank", *keys)
    )


def bucket_count(n_rows: int, bucket_rows: int) -> int:
    return max(1, min(MAX_BUCKETS, -(-n_rows // bucket_rows)))


def hash_buckets(
    key: Column, n_rows: int, bucket_rows: int = BUCKET_ROWS
) -> tuple[Column, int]:
    """Ordered buckets of md5 keys and their number; uniform by construction, so nothing has to be
    sampled."""
    digits = 0
    while 16**digits < bucket_count(n_rows, bucket_rows):
        digits += 1
    return F.substring(key, 1, digits), 16**digits


def _sampled(df: DataFrame, values: list[Column], id_col: str, n_rows: int, want: int):
    """About ``want`` rows chosen by a hash of the id; they only place bucket bounds."""
    every = max(1, n_rows // want)
    chosen = df.filter(F.pmod(F.xxhash64(id_col), F.lit(every)) == 0)
    return chosen.select(*[v.alias(f"_s{i}") for i, v in enumerate(values)]).toPandas()


def _bounds(sample: np.ndarray, buckets: int) -> tuple[list[float], list[int]]:
    """Bucket bounds from sampled values, and the buckets that hold one heavy value only."""
    if sample.size == 0:
        return [], []
    cuts = np.sort(sample)[(np.arange(1, buckets) * sample.size) // buckets]
    values, repeats = np.unique(cuts, return_counts=True)
    heavy = values[repeats > 1]
    splits = np.unique(np.concatenate([values, np.nextafter(heavy, np.inf)]))
    alone = np.searchsorted(splits, heavy) + 1
    return splits.tolist(), alone.tolist()


def _cut(df: DataFrame, source: str, out: str, splits: list[float]) -> DataFrame:
    if not splits:
        return df.withColumn(out, F.lit(0.0))
    edges = [float("-inf"), *splits, float("inf")]
    return Bucketizer(splits=edges, inputCol=source, outputCol=out).transform(df)


def _part_of(cuts: dict[float, np.ndarray]):
    """The part of a bucket that a value falls in, 0 in a bucket without cuts.

    There are at most as many cuts as buckets, and a row takes a binary search among those of its own.
    """

    @F.pandas_udf("double")
    def part(bucket: pd.Series, value: pd.Series) -> pd.Series:
        buckets, values = bucket.to_numpy(), value.to_numpy()
        found = np.zeros(len(buckets))
        order = np.argsort(buckets, kind="stable")
        bounds = np.flatnonzero(np.diff(buckets[order])) + 1
        for rows in np.split(order, bounds):
            own = cuts.get(buckets[rows[0]]) if rows.size else None
            if own is not None:
                found[rows] = np.searchsorted(own, values[rows], side="right")
        return pd.Series(found)

    return part


def value_buckets(
    df: DataFrame,
    leading: Column | None,
    id_col: str,
    n_rows: int,
    bucket_rows: int = BUCKET_ROWS,
) -> tuple[DataFrame, int]:
    """Ordered buckets ``(_b1, _b2)`` for the order (leading, id); also a bound on their number.

    ``_b1`` cuts the leading value. A value that fills whole buckets by itself gets its own
    ``_b1`` and is cut further by id (``_b2``), in as many parts as its share of the sample asks
    for, so that there are O(rows / bucket_rows) buckets however many values are tied.
    """
    if not is_number(df, id_col):
        raise ValueError(f"order by {id_col!r} needs a numeric id.")
    # the same refusal whatever the number of buckets, before any row could fall between them
    missing = F.raise_error(F.lit("ids must be unique and not missing."))
    kind = df.schema[id_col].dataType
    df = df.withColumn(
        id_col,
        F.when(is_violation(F.col(id_col)), missing.cast(kind)).otherwise(F.col(id_col)),
    )
    buckets = bucket_count(n_rows, bucket_rows)
    if buckets == 1:
        return df.withColumn("_b1", F.lit(0.0)).withColumn("_b2", F.lit(0.0)), 1
    id_value = F.col(id_col).cast("double")
    # adding zero turns a negative zero into the plain one, which the cut treats as smaller
    value = id_value if leading is None else leading + F.lit(0.0)
    sample = _sampled(df, [value, id_value], id_col, n_rows, buckets * SAMPLES_PER_BUCKET)
    splits, alone = _bounds(sample["_s0"].to_numpy(dtype=float), buckets)
    cut = _cut(df.withColumn("_v", value), "_v", "_b1", splits).drop("_v")
    if leading is None or not alone:
        return cut.withColumn("_b2", F.lit(0.0)), buckets + 1
    places = np.searchsorted(splits, sample["_s0"].to_numpy(dtype=float), side="right")
    ids = sample["_s1"].to_numpy(dtype=float)
    cuts, more = {}, 0
    for b in alone:
        inside = ids[places == b]
        parts = -(-buckets * inside.size // ids.size) + 1
        cuts[float(b)] = np.array(_bounds(inside, int(parts))[0])
        more += len(cuts[float(b)])
    part = _part_of(cuts)
    cut = cut.withColumn("_b2", part(F.col("_b1"), id_value)).select(*df.columns, "_b1", "_b2")
    return cut, len(splits) + 1 + more


def running_sums(
    df: DataFrame,
    buckets: Sequence[str],
    n_buckets: int,
    order: Sequence[Column],
    sums: Mapping[str, Column],
    group: Sequence[str] = (),
    *,
    place: Sequence[str],
) -> DataFrame:
    """Inclusive running sums in the given order (per group), with the grand totals.

    ``place`` names the ordering columns: two rows that agree in all of them are an error.

    For every entry of ``sums`` the result has ``<name>`` and ``<name>_total``.
    """
    keys = [*group, *buckets]
    twice = F.raise_error(F.lit("ids must be unique and not missing.")).cast("long")

    def once(value: Column, window) -> Column:
        """The value, or an error if the row has the same place as the one before it."""
        row = F.struct(*place)
        return F.when(row.eqNullSafe(F.lag(row).over(window)), twice).otherwise(value)

    if n_buckets == 1 and not group:
        # at most one bucket's worth of rows: a plain window needs no totals of other buckets
        so_far = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        whole = Window.orderBy(*order).rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing
        )
        return df.select(
            "*",
            *[
                once(F.sum(v).over(so_far), Window.orderBy(*order)).alias(k)
                for k, v in sums.items()
            ],
            *[F.sum(v).over(whole).alias(f"{k}_total") for k, v in sums.items()],
        )
    totals = df.groupBy(*keys).agg(*[F.sum(v).alias(f"_t_{k}") for k, v in sums.items()])
    everything = Window.partitionBy(*group)
    earlier = everything.orderBy(*buckets).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        *[F.coalesce(F.sum(f"_t_{k}").over(earlier), F.lit(0)).alias(f"_o_{k}") for k in sums],
        *[F.sum(f"_t_{k}").over(everything).alias(f"{k}_total") for k in sums],
    )
    if not group and n_buckets <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    # null-safe: a missing group is a group like any other here, no row is lost
    renamed = offsets.withColumnsRenamed({k: f"_j_{k}" for k in keys})
    same = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_j_{k}")) for k in keys]
    )
    nearby = Window.partitionBy(*keys).orderBy(*order)
    return df.join(renamed, same).select(
        *df.columns,
        *[
            once(F.sum(v).over(inside) + F.col(f"_o_{k}"), nearby).alias(k)
            for k, v in sums.items()
        ],
        *[f"{k}_total" for k in sums],
    )


def add_rank(
    df: DataFrame,
    id_col: str,
    out: str,
    *,
    shuffle: bool,
    seed: int | str = 0,
    group: Sequence[str] = (),
    n_rows: int | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Exact 0-based rank of every row by shuffled position or by id, per group."""
    n = df.count() if n_rows is None else n_rows
    if shuffle:
        bucketed = df.withColumn("_shuffle_key", shuffle_key(seed, id_col))
        bucket, n_buckets = hash_buckets(F.col("_shuffle_key"), n, bucket_rows)
        bucketed = bucketed.withColumn("_b1", bucket)
        buckets, order = ["_b1"], [F.col("_shuffle_key"), F.col(id_col)]
    else:
        bucketed, n_buckets = value_buckets(df, None, id_col, n, bucket_rows)
        buckets, order = ["_b1"], [F.col(id_col)]
    ranked = running_sums(
        bucketed, buckets, n_buckets, order, {"_seen": F.lit(1).cast("long")}, group,
        place=["_shuffle_key", id_col] if shuffle else [id_col],
    )
    return ranked.withColumn(out, F.col("_seen") - 1).select(*df.columns, out)
