"""Stored, mergeable sketches: quantiles (KLL) and distinct counts (HLL).

A sketch table has one row per part of the data (a day, a file) and column.
Parts are merged without their rows, so a new day costs only its own scan.
What an approximate answer promises can be checked: ``rank_check`` counts
the rows below and up to it, ``error_check`` compares with an exact count.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwx.operators.schema import quote

QUANTILE_SIZE = 4096
DISTINCT_BITS = 14


def quantile_error(size: int = QUANTILE_SIZE) -> float:
    """Rank error, as a share of the rows, that a quantile sketch of
    ``size`` keeps in 99 of 100 cases."""
    return 2.296 / size ** 0.9723


def distinct_error(bits: int = DISTINCT_BITS) -> float:
    """Relative standard error of a distinct sketch of 2**bits registers."""
    return 1.04 / 2 ** (bits / 2)


def _number(c: str) -> Column:
    x = F.col(quote(c)).cast("double")
    return F.when(~F.isnan(x), x)


def _unpivot(wide: DataFrame, keys: list[str], columns: list[str], kind: str) -> DataFrame:
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("rows"), F.col(f"s{i}").alias("sketch"))
            for i, c in enumerate(columns)]
    return wide.select(*keys, F.inline(F.array(*rows))).filter(F.col("rows") > 0).withColumn("kind", F.lit(kind))


def quantile_sketches(df: DataFrame, columns: list[str], by: list[str] = (), size: int = QUANTILE_SIZE) -> DataFrame:
    """(by.., column_name, rows, sketch, kind): a quantile sketch of every
    column's numbers (NULL and NaN left out), all from one scan."""
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.count(_number(c)).alias(f"n{i}"), F.kll_sketch_agg_double(_number(c), size).alias(f"s{i}")]
    return _unpivot(df.groupBy(*by).agg(*aggs), list(by), columns, "quantile")


def distinct_sketches(df: DataFrame, columns: list[str], by: list[str] = (), bits: int = DISTINCT_BITS) -> DataFrame:
    """(by.., column_name, rows, sketch, kind): a distinct sketch of every
    column's values (NULL left out), all from one scan."""
    aggs = []
    for i, c in enumerate(columns):
        text = F.col(quote(c)).cast("string")
        aggs += [F.count(text).alias(f"n{i}"), F.hll_sketch_agg(text, bits).alias(f"s{i}")]
    return _unpivot(df.groupBy(*by).agg(*aggs), list(by), columns, "distinct")


def merged(sketches: DataFrame) -> DataFrame:
    """(column_name, rows, sketch) over all parts; one kind of sketch."""
    kinds = {r.kind for r in sketches.select("kind").distinct().collect()}
    if len(kinds) > 1:
        raise ValueError(f"sketches of several kinds: {sorted(kinds)}")
    union = F.hll_union_agg if kinds == {"distinct"} else F.kll_merge_agg_double
    return sketches.groupBy("column_name").agg(F.sum("rows").alias("rows"), union("sketch").alias("sketch"))


def sketched_quantiles(sketches: DataFrame, p: float) -> DataFrame:
    """(column_name, rows, quantile) of merged quantile sketches."""
    return merged(sketches).select("column_name", "rows", F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias("quantile"))


def sketched_distinct(sketches: DataFrame) -> DataFrame:
    """(column_name, rows, distinct_approx) of merged distinct sketches."""
    return merged(sketches).select("column_name", "rows", F.hll_sketch_estimate("sketch").alias("distinct_approx"))


def rank_check(df: DataFrame, answers: DataFrame, p: float, error: float) -> DataFrame:
    """(column_name, quantile, rows, below, upto, within): for each answer
    (column_name, quantile) how many numbers are smaller, how many not
    larger, and whether rank p lies between the two, give or take ``error`` of
    the rows.  One aggregate over ``df``; the answers are one row a column."""
    found = {r.column_name: r["quantile"] for r in answers.collect()}
    aggs = []
    for i, (c, v) in enumerate(found.items()):
        x = _number(c)
        aggs += [F.count(x).alias(f"n{i}"), F.count_if(x < F.lit(v)).alias(f"b{i}"), F.count_if(x <= F.lit(v)).alias(f"u{i}")]
    schema = "column_name string, quantile double, rows bigint, below bigint, upto bigint"
    rows = []
    if aggs:
        row = df.agg(*aggs).first()
        rows = [(c, v, row[f"n{i}"], row[f"b{i}"], row[f"u{i}"]) for i, (c, v) in enumerate(found.items())]
    rank, slack = F.ceil(F.lit(p) * F.col("rows")), F.ceil(F.lit(error) * F.col("rows"))
    within = (F.col("below") < rank + slack) & (F.col("upto") >= rank - slack)
    return df.sparkSession.createDataFrame(rows, schema).withColumn("within", F.coalesce(within, F.lit(False)))


def error_check(approx: DataFrame, exact: DataFrame, error: float) -> DataFrame:
    """(column_name, distinct, within): exact counts (column_name, distinct)
    and whether the approximate ones are off by at most ``error`` of them."""
    off = F.abs(F.col("distinct_approx") - F.col("distinct"))
    return exact.join(approx.select("column_name", "distinct_approx"), "column_name").select(
        "column_name", "distinct", (off <= F.ceil(F.lit(error) * F.col("distinct"))).alias("within"))


def distinct_by_column(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, distinct): exact, NULL left out.  Each column is a
    distinct aggregate of its own over a scan of that column alone, so no row
    is expanded once per column and each column is read once."""
    parts = [df.select(F.col(quote(c)).alias("v")).filter(F.col("v").isNotNull()).distinct()
             .agg(F.count(F.lit(1)).alias("distinct")).select(F.lit(c).alias("column_name"), "distinct") for c in columns]
    return functools.reduce(DataFrame.unionByName, parts)
