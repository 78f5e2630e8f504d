"""Value counts: one mergeable state per column, from which mean, standard
deviation, any exact quantile and the mode follow without reading the
input again.

A state is a table (column_name, whole, real, text, n): how many rows hold
each value, in the column's own kind (whole numbers, other numbers, text).
States of disjoint row sets merge by adding ``n``, so a state can be stored
next to its data and grown file by file.  Building one is a single scan and a
single shuffle with map-side combine; a value that a third of all rows share is
one row per task.  No step sorts all values: quantiles select the bucket
that holds the rank, and a bucket too large for one task is range-partitioned.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwx.operators.schema import quote
from tripwx.sources.sinks import cached

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
REAL = (T.FloatType, T.DoubleType, T.DecimalType)
KINDS = {"whole": "bigint", "real": "double", "text": "string"}
BUCKETS = 256
MAX_SORT_VALUES = 1_000_000


def kind_of(dtype: T.DataType) -> str:
    return "whole" if isinstance(dtype, WHOLE) else "real" if isinstance(dtype, REAL) else "text"


def long_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, whole, real, text): one row per row and column, from
    one scan; the value stands under its column's kind."""
    def row(c):
        own = kind_of(df.schema[c].dataType)
        casts = [f"CAST({quote(c)} AS {t})" if k == own else f"CAST(NULL AS {t})" for k, t in KINDS.items()]
        return ", ".join([_text(c), *casts])
    return df.selectExpr(f"stack({len(columns)}, {', '.join(map(row, columns))}) AS (column_name, whole, real, text)")


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def count_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """The state of ``columns``.  NULL is a value (all three are NULL); -0.0
    counts as 0.0, all NaN as one value.  Rows are counted by the column's
    number and the kinds that occur; names and empty kinds are put in after."""
    own = [kind_of(df.schema[c].dataType) for c in columns]
    kinds = [k for k in KINDS if k in own]

    def row(i, c):
        return ", ".join([str(i), *(f"CAST({quote(c)} AS {KINDS[k]})" if k == own[i] else f"CAST(NULL AS {KINDS[k]})" for k in kinds)])
    stacked = df.selectExpr(f"stack({len(columns)}, {', '.join(row(i, c) for i, c in enumerate(columns))}) AS (at, {', '.join(kinds)})")
    counted = stacked.groupBy("at", *kinds).agg(F.count(F.lit(1)).alias("n"))
    names = F.array(*[F.lit(c) for c in columns])
    return counted.select(F.element_at(names, F.col("at") + 1).alias("column_name"),
                          *[F.col(k) if k in kinds else F.lit(None).cast(t).alias(k) for k, t in KINDS.items()], "n")


def merge_counts(states: Iterable[DataFrame]) -> DataFrame:
    """One state of several, over disjoint rows."""
    rows = functools.reduce(DataFrame.unionByName, states)
    return rows.groupBy("column_name", *KINDS).agg(F.sum("n").alias("n"))


def _number() -> Column:
    return F.coalesce(F.col("whole").cast("double"), F.col("real"))


def _valued() -> Column:
    """A value that quantiles and modes look at: neither NULL nor NaN."""
    return (F.col("whole").isNotNull() | F.col("text").isNotNull()
            | (F.col("real").isNotNull() & ~F.isnan("real")))


def modes_of(state: DataFrame) -> DataFrame:
    """(column_name, whole, real, text, n): the most frequent value of each
    column, ties to the smallest; no row for a column without values."""
    value = F.struct(*KINDS)
    top = state.groupBy("column_name").agg(F.max(F.when(_valued(), F.col("n"))).alias("best"))
    found = state.filter(_valued()).join(F.broadcast(top), "column_name").filter(F.col("n") == F.col("best"))
    return found.groupBy("column_name").agg(F.min(value).alias("v"), F.max("n").alias("n")).select("column_name", "v.*", "n")


def moments_of(state: DataFrame) -> DataFrame:
    """(column_name, rows, values, mean, stddev): rows with NULL ones, how
    many hold a value, mean and sample standard deviation of the numbers.

    Two passes over the state, so that large means lose no digits."""
    x = _number()
    first = state.groupBy("column_name").agg(
        F.sum("n").alias("rows"), F.sum(F.when(x.isNotNull(), F.col("n"))).alias("values"),
        (F.sum(x * F.col("n")) / F.sum(F.when(x.isNotNull(), F.col("n")))).alias("mean"))
    off = x - F.col("mean")
    spread = state.join(F.broadcast(first.select("column_name", "mean")), "column_name").groupBy("column_name").agg(
        F.sum(F.col("n") * off * off).alias("squares"))
    stddev = F.when(F.col("values") > 1, F.sqrt(F.col("squares") / (F.col("values") - 1)))
    return first.join(F.broadcast(spread), "column_name").select(
        "column_name", "rows", F.coalesce("values", F.lit(0)).alias("values"), "mean", stddev.alias("stddev"))


def _ends(state: DataFrame) -> DataFrame:
    """(column_name, rows, values, total, lo, hi, best) in one aggregate: all
    rows, those with a number, their sum, the finite range and the largest
    count of a value."""
    x = _number()
    finite = F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)
    return state.groupBy("column_name").agg(
        F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(x.isNotNull(), F.col("n"))), F.lit(0)).alias("values"),
        F.sum(x * F.col("n")).alias("total"), F.min(finite).alias("lo"), F.max(finite).alias("hi"),
        F.max(F.when(_valued(), F.col("n"))).alias("best"))


def _buckets(state: DataFrame, ends: list) -> list:
    """One row per column and equal-width bucket: rows, values, range, the
    squares of the distances to the column's mean, and the smallest value that
    has the column's largest count.  Infinities have buckets of their own, NaN one apart."""
    known = state.sparkSession.createDataFrame(
        [(r.column_name, r.lo, r.hi, r.total / r["values"] if r["values"] else None, r.best) for r in ends],
        "column_name string, lo double, hi double, mean double, best bigint")
    rows = state.select("column_name", _number().alias("x"), "n", *KINDS).join(F.broadcast(known), "column_name")
    width = F.col("hi") / BUCKETS - F.col("lo") / BUCKETS
    place = F.floor((F.col("x") - F.col("lo")) / F.when(width > 0, width))
    bucket = (F.when(F.isnan("x"), BUCKETS + 1).when(F.col("x") == float("-inf"), -1).when(F.col("x") == float("inf"), BUCKETS)
              .otherwise(F.coalesce(F.least(place, F.lit(BUCKETS - 1)), F.lit(0))))
    off = F.col("x") - F.col("mean")
    mode = F.when((F.col("n") == F.col("best")) & _valued(), F.col("x"))
    return rows.filter(F.col("x").isNotNull()).groupBy("column_name", bucket.alias("bucket")).agg(
        F.sum("n").alias("n"), F.count("*").alias("values"), F.min("x").alias("lo"), F.max("x").alias("hi"),
        F.sum(off * off * F.col("n")).alias("squares"), F.min(mode).alias("mode")).collect()


def _quantiles(state: DataFrame, buckets: list, p: float, max_sort_values: int) -> dict[str, float]:
    """The bucket that holds rank ceil(p * n) of each column, and in it the value."""
    found, targets = {}, {}
    for name in {r.column_name for r in buckets}:
        own = sorted((r for r in buckets if r.column_name == name and r.bucket <= BUCKETS), key=lambda r: r.lo)
        need = max(1, -int(-round(p * sum(r.n for r in own), 9) // 1))
        for r in own:
            if need <= r.n:
                break
            need -= r.n
        if own and r["values"] == 1:
            found[name] = r.lo
        elif own:
            targets[name] = (r.lo, r.hi, need, r["values"])
    rows = state.select("column_name", _number().alias("x"), "n").filter(F.col("x").isNotNull() & ~F.isnan("x"))
    for large in (False, True):
        some = {c: t for c, t in targets.items() if (t[3] > max_sort_values) == large}
        if some:
            inside = functools.reduce(lambda a, b: a | b, [
                (F.col("column_name") == c) & F.col("x").between(lo, hi) for c, (lo, hi, *_) in some.items()])
            found |= _ranked(rows.filter(inside), {c: t[2] for c, t in some.items()}, large)
    return found


def quantiles_of(state: DataFrame, p: float, max_sort_values: int = MAX_SORT_VALUES) -> dict[str, float]:
    """Column -> the least number v with cume_dist(v) >= p; NULL and NaN are
    left out, as are columns without numbers.

    Equal-width buckets between the least and the largest finite number (one
    row per column and bucket to the driver) name the bucket that holds rank
    ceil(p * n).  Its values are summed up in order: in one task, or, if
    the bucket holds more than ``max_sort_values`` values, by ranges."""
    return _quantiles(state, _buckets(state, _ends(state).collect()), p, max_sort_values)


def summary_of(state: DataFrame, p: float = 0.5, max_sort_values: int = MAX_SORT_VALUES) -> dict[str, dict]:
    """Column -> rows, mean, stddev, quantile, mode (as a double) and
    mode_count, from three walks over the state: ends, buckets, target buckets."""
    ends = _ends(state).collect()
    buckets = _buckets(state, ends)
    quantiles = _quantiles(state, buckets, p, max_sort_values)
    out = {}
    for r in ends:
        own = [b for b in buckets if b.column_name == r.column_name]
        many = r["values"]
        out[r.column_name] = {
            "rows": r.rows, "mean": r.total / many if many else None,
            "stddev": (sum(b.squares for b in own) / (many - 1)) ** 0.5 if many > 1 else None,
            "quantile": quantiles.get(r.column_name), "mode_count": r.best,
            "mode": min((b["mode"] for b in own if b["mode"] is not None), default=None)}
    return out


def _ranked(rows: DataFrame, need: dict[str, int], by_range: bool) -> dict[str, float]:
    """Column -> the value that holds rank ``need`` among ``rows`` (column_name, x, n)."""
    spark = rows.sparkSession
    wanted = spark.createDataFrame(list(need.items()), "column_name string, need long")
    upto = Window.partitionBy("column_name").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    if not by_range:
        hit = rows.withColumn("upto", F.sum("n").over(upto)).join(F.broadcast(wanted), "column_name")
        return {r.column_name: r.x for r in hit.filter("upto >= need").groupBy("column_name").agg(F.min("x").alias("x")).collect()}
    # one row per range and column says which range holds the rank; only that range is summed up in order
    ranged = rows.repartitionByRange("column_name", "x").withColumn("part", F.spark_partition_id())
    with cached(ranged) as ranged:
        sums = sorted(ranged.groupBy("column_name", "part").agg(F.sum("n").alias("n")).collect(), key=lambda r: r.part)
        left, keep = dict(need), {}
        for r in sums:
            if r.column_name not in keep:
                if left[r.column_name] <= r.n:
                    keep[r.column_name] = r.part
                else:
                    left[r.column_name] -= r.n
        target = functools.reduce(lambda a, b: a | b, [
            (F.col("column_name") == c) & (F.col("part") == part) for c, part in keep.items()])
        return _ranked(ranged.filter(target).drop("part"), left, False)
