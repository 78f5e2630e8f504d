"""Profiling operators.  Each returns a DataFrame; none collects data.

Scale notes
* Counts, means, min/max, stddev, null and distinct counts for many
  columns are folded into ONE aggregate (one scan), not one job per column.
* Modes are hash aggregates: (column, value) -> count with map-side
  combine, the maximum count per column, and the smallest value reaching
  it.  A value holding a third of all rows costs nothing extra, and no
  task ever holds all values of a column.
* The exact median is a selection over value counts (see ``exact_quantile``);
  the approximate forms are Spark's GK sketches, as published.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwx.functions.columns import round_stable
from tripwx.operators import value_counts
from tripwx.operators.schema import quote, schema_report
from tripwx.sources import sinks

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _q(c: str) -> Column:
    return F.col(quote(c))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def row_count_by_file(df: DataFrame) -> DataFrame:
    """(file, rows) per input file; summing ``rows`` gives the total.
    ``df`` must be a file scan (the hidden ``_metadata`` column)."""
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"))


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """Group count ordered by the keys."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).orderBy(*keys)


def grouped_mean(df: DataFrame, key: str, value: str, digits: int = 2, alias: str | None = None,
                 order_by_mean: bool = True, with_count: bool = False) -> DataFrame:
    alias = alias or f"avg_{value}"
    aggs = [round_stable(F.avg(_q(value)), digits).alias(alias)]
    if with_count:
        aggs.append(F.count(F.lit(1)).alias("count"))
    out = df.groupBy(key).agg(*aggs)
    return out.orderBy(F.desc(alias), key) if order_by_mean else out.orderBy(key)


def min_max_avg(df: DataFrame, columns: list[str], digits: int = 2) -> DataFrame:
    """``<c>_min``, ``<c>_max``, ``<c>_avg`` for the listed columns that exist."""
    present = [c for c in columns if c in df.columns]
    aggs = []
    for c in present:
        aggs += [F.min(_q(c)).alias(f"{c}_min"), F.max(_q(c)).alias(f"{c}_max"),
                 round_stable(F.avg(_q(c)), digits).alias(f"{c}_avg")]
    return df.agg(*aggs)


def min_max(df: DataFrame, columns: list[str]) -> DataFrame:
    aggs = []
    for c in columns:
        aggs += [F.min(_q(c)).alias(f"min_{c}"), F.max(_q(c)).alias(f"max_{c}")]
    return df.agg(*aggs)


def global_means(df: DataFrame, columns: list[str], digits: int | dict[str, int] = 4,
                 stddev_of: list[str] = ()) -> DataFrame:
    """Rounded means (and sample stddevs) in one aggregate."""
    def d(c):
        return digits[c] if isinstance(digits, dict) else digits
    aggs = []
    for c in columns:
        aggs.append(round_stable(F.avg(_q(c)), d(c)).alias(f"mean_{c}"))
        if c in stddev_of:
            aggs.append(round_stable(F.stddev_samp(_q(c)), d(c)).alias(f"stddev_{c}"))
    return df.agg(*aggs)


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row, one count of NULLs per column (0, not NULL, on empty input)."""
    cols = columns or df.columns
    return df.agg(*[F.count_if(_q(c).isNull()).alias(c) for c in cols])


def null_counts_sql(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A24 in the reference's SQL form: the query text is generated from the
    column names (backtick-quoted, so spaces, dots and backticks are safe)
    and run against the frame as a view (``spark.sql`` with a DataFrame
    argument).  ``count_if`` gives 0 on empty input, unlike ``sum(case..)``."""
    cols = columns or df.columns
    select = ", ".join(f"count_if({quote(c)} IS NULL) AS {quote(c)}" for c in cols)
    return df.sparkSession.sql(f"SELECT {select} FROM {{t}}", t=df)


def approx_medians_table(df: DataFrame, columns: list[str], rel_err: float) -> DataFrame:
    """A13 as a one-row table: ``approxQuantile`` medians with the given
    relative error (the GK sketch; only the scalars reach the driver)."""
    med = approx_quantiles(df, columns, rel_err)
    fields = ", ".join(f"{quote('median_' + c)} double" for c in columns)
    return df.sparkSession.createDataFrame([tuple(med[c] for c in columns)], fields)


def distinct_counts(df: DataFrame, columns: list[str], approx: bool = False,
                    count_null: bool = True) -> DataFrame:
    """Distinct values per column in one pass.  With ``count_null`` a NULL
    counts as one value, as ``select(c).distinct().count()`` does."""
    aggs = []
    for c in columns:
        base = F.approx_count_distinct(_q(c)) if approx else F.count_distinct(_q(c))
        if count_null:
            base = base + F.max(F.when(_q(c).isNull(), 1).otherwise(0))
        aggs.append(base.cast("bigint").alias(f"distinct_{c}"))
    return df.agg(*aggs)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def smallest_distinct(df: DataFrame, column: str, n: int, passes: int = 2, rows_per_pass: int = 64) -> list:
    """The ``n`` smallest distinct non-NULL values of a column.

    High-cardinality columns (timestamps, amounts): each pass is a
    ``TakeOrdered`` - every task keeps only its ``n * rows_per_pass``
    smallest rows above the largest value found so far (a filter that
    reaches the Parquet scan) - so one pass usually suffices and nothing
    else moves.  When duplicates fill the lower tail instead, after
    ``passes`` passes the remainder is a distinct aggregation above the
    threshold; map-side partial aggregation collapses exactly those
    duplicates before the shuffle.
    """
    found: list = []
    base = df.select(_q(column).alias("v")).where(F.col("v").isNotNull())

    def above(frame):
        return frame if not found else frame.where(F.col("v") > F.lit(found[-1]))

    for _ in range(passes):
        if len(found) >= n:
            break
        got = [r["v"] for r in above(base).orderBy("v").limit(n * rows_per_pass).collect()]
        if not got:
            return found
        for v in got:
            if not found or v != found[-1]:
                found.append(v)
    if len(found) < n:
        rest = above(base).distinct().orderBy("v").limit(n - len(found)).collect()
        found += [r["v"] for r in rest]
    return found[:n]


def distinct_bounded(df: DataFrame, column: str, limit: int = 10, categorical: bool = False) -> DataFrame:
    """Sorted non-NULL distinct values.  A categorical column lists all
    of them (a distinct aggregation over few values); any other column
    shows the first ``limit`` and flags ``has_more`` when another exists."""
    d = df.select(column).where(_q(column).isNotNull())
    if categorical:
        return d.distinct().withColumn("has_more", F.lit(False)).orderBy(column)
    values = smallest_distinct(df, column, limit + 1)
    field = df.schema[column]
    schema = T.StructType([T.StructField(column, field.dataType, True),
                           T.StructField("has_more", T.BooleanType(), False)])
    more = len(values) > limit
    return df.sparkSession.createDataFrame([(v, more) for v in values[:limit]], schema)


def distinct_report(df: DataFrame, columns: dict[str, bool], limit: int = 10) -> DataFrame:
    """A21 over many columns (name -> categorical): (column_name, value as
    text, has_more)."""
    return functools.reduce(DataFrame.unionByName, [
        distinct_bounded(df, c, limit, categorical).select(
            F.lit(c).alias("column_name"), _q(c).cast("string").alias("value"), "has_more")
        for c, categorical in columns.items()])


def top_k(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    """The k most frequent keys, ties by key ascending."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(key)).limit(k))


def describe_typed(df: DataFrame, columns: list[str], digits: int | None = None) -> DataFrame:
    """count/mean/stddev/min/max per column as typed values (``describe()``
    returns strings).  One aggregate, then unpivoted to one row per column."""
    def r(c):
        return c if digits is None else round_stable(c, digits)
    aggs = []
    for c in columns:
        x = _q(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), r(F.avg(x)).alias(f"{c}__mean"),
                 r(F.stddev_samp(x)).alias(f"{c}__stddev"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    parts = ", ".join(
        f"'{c}', `{c}__count`, `{c}__mean`, `{c}__stddev`, `{c}__min`, `{c}__max`" for c in columns)
    return wide.selectExpr(f"stack({len(columns)}, {parts}) as (column_name, count, mean, stddev, min, max)")


def preview(df: DataFrame, n: int = 20, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows in a fixed order (TakeOrdered: each task keeps n)."""
    keys = order_by or df.columns
    return df.orderBy(*[F.asc_nulls_first(_q(c)) for c in keys]).limit(n)


def distinct_preview(df: DataFrame, columns: list[str], n: int = 3) -> DataFrame:
    """(column_name, value): the ``n`` smallest non-NULL distinct
    values of every column, as text.  One aggregate per rank, for all
    columns together: the least value above the one before."""
    text = {c: _q(c).cast("string") for c in columns}
    last: dict[str, str | None] = {}
    rows = []
    for _ in range(n):
        found = df.agg(*[F.min(F.when(text[c] > F.lit(last[c]), text[c]) if last.get(c) is not None else text[c]).alias(f"v{i}")
                         for i, c in enumerate(columns) if last.get(c, "") is not None]).first().asDict()
        for i, c in enumerate(columns):
            if last.get(c, "") is not None:
                last[c] = found[f"v{i}"]
                rows += [(c, last[c])] if last[c] is not None else []
        if all(last[c] is None for c in columns):
            break
    return df.sparkSession.createDataFrame(rows, "column_name string, value string")


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Spark's own string-valued summary (count, mean, stddev, min, max)."""
    return df.describe(*(columns or []))


# ------------------------------------------------------------------- modes
def _long_values(df: DataFrame, columns: list[str], dtype: str) -> DataFrame:
    parts = ", ".join(f"'{c}', CAST({quote(c)} AS {dtype})" for c in columns)
    return df.selectExpr(f"stack({len(columns)}, {parts}) as (column_name, value)")


def _best_per_column(counts: DataFrame) -> DataFrame:
    """(column_name, value, n) -> (column_name, mode, mode_count): highest
    count, ties to the smallest value.  Both steps are hash aggregates; the
    per-column maxima (one row per column) are broadcast back, and Spark
    reuses the counts' shuffle for both branches."""
    best = counts.groupBy("column_name").agg(F.max("n").alias("best"))
    return (counts.join(F.broadcast(best), "column_name").where(F.col("n") == F.col("best"))
            .groupBy("column_name").agg(F.min("value").alias("mode"), F.max("best").alias("mode_count")))


_WHOLE = ("tinyint", "smallint", "int", "bigint")


def _counted_as(dtype: str) -> str:
    if dtype in _WHOLE:
        return "bigint"
    return "double" if dtype in ("float", "double") else dtype


def modes(df: DataFrame, columns: list[str], dtype: str | None = None) -> DataFrame:
    """(column_name, mode, mode_count): most frequent value per column,
    NULL and NaN apart, ties to the smallest value.

    Values are counted in their own type (columns of one type share a
    scan), so that big integers a double cannot hold stay apart; the result
    is ``dtype``, by default bigint if all columns are whole, else double."""
    own = dict(df.dtypes)
    groups: dict[str, list[str]] = {}
    for c in columns:
        groups.setdefault("string" if dtype == "string" else _counted_as(own[c]), []).append(c)
    out = dtype or ("bigint" if set(groups) == {"bigint"} else "double")
    parts = []
    for kind, names in groups.items():
        values = _long_values(df, names, kind).where(F.col("value").isNotNull())
        if kind == "double":
            values = values.where(~F.isnan("value"))
        counts = values.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
        parts.append(_best_per_column(counts).withColumn("mode", F.col("mode").cast(out)))
    return functools.reduce(DataFrame.unionByName, parts)


#: a counter sketch of m tracked items is off by at most this many m-ths of the counted rows
SKETCH_ERROR = 3.5


def modes_heavy_hitters(df: DataFrame, columns: list[str], support: float = 1e-4, dtype: str = "double") -> DataFrame:
    """(column_name, mode, mode_count) by counter sketches, ties smallest.

    Scan 1 is one aggregate: per column a mergeable sketch of its most
    frequent values, in the column's own type, whose counts are off by less
    than ``support`` of the rows (``approx_top_k``; 3.5 / support items).  From it,
    per column, before anything is counted:

    * the sketch kept all values, so its counts are exact: done;
    * the best count is more than three times the error: the mode is among the
      values whose count may reach it, and only those are recounted;
    * no value stands out (near-unique columns): all values are counted.

    Scan 2 does the last two together, for all columns that need either."""
    tracked = min(100_000, math.ceil(SKETCH_ERROR / support))
    seen = {c: F.when(~F.isnan(_q(c)), _q(c)) if t in ("double", "float") else _q(c) for c, t in df.dtypes if c in columns}
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        aggs += [F.count(seen[c]).alias(f"n{i}"),
                 F.call_function("approx_top_k", seen[c], F.lit(tracked), F.lit(tracked)).alias(f"k{i}")]
    row = df.agg(*aggs).first()                     # at most ``tracked`` values a column
    found, candidates, full = [], [], []
    for i, c in enumerate(columns):
        n, items = row[f"n{i}"], [x for x in row[f"k{i}"] or [] if x["item"] is not None]
        error = SKETCH_ERROR * row["rows"] / tracked
        best = max((x["count"] for x in items), default=0)
        if sum(x["count"] for x in items) == n:     # each count is at least the true one: all are true
            top = min((x["item"] for x in items if x["count"] == best), default=None)
            found += [(c, top, best)] if items else []
        elif best > 3 * error:
            candidates += [(c, x["item"]) for x in items if x["count"] >= best - error]
        else:
            full.append(c)
    rest = [c for c in columns if c in full or c in {name for name, _ in candidates}]
    out = [(c, float(v) if dtype == "double" else str(v) if dtype == "string" else v, n) for c, v, n in found]
    sure = df.sparkSession.createDataFrame(out, f"column_name string, mode {dtype}, mode_count bigint")
    if not rest:
        return sure
    if candidates:
        values = value_counts.long_values(df, rest)
        kinds = {c: value_counts.kind_of(df.schema[c].dataType) for c in rest}
        cast = {"whole": int, "real": float, "text": str}
        picks = [(c, *[cast[k](v) if kinds[c] == k else None for k in value_counts.KINDS], True) for c, v in candidates]
        listed = df.sparkSession.createDataFrame(picks, "c string, w bigint, r double, t string, picked boolean")
        same = (F.col("c") == F.col("column_name")) & F.col("w").eqNullSafe(F.col("whole")) \
            & F.col("r").eqNullSafe(F.col("real")) & F.col("t").eqNullSafe(F.col("text"))
        values = values.join(F.broadcast(listed), same, "left").filter(F.col("picked") | F.col("column_name").isin(full))
        counts = values.groupBy("column_name", *value_counts.KINDS).agg(F.count(F.lit(1)).alias("n"))
    else:
        counts = value_counts.count_values(df, rest)
    mode = F.coalesce(F.col("whole").cast(dtype), F.col("real").cast(dtype), F.col("text").cast(dtype))
    with sinks.cached(counts) as counts:                # read twice below
        best = value_counts.modes_of(counts).select("column_name", mode.alias("mode"), F.col("n").alias("mode_count")).collect()
    return df.sparkSession.createDataFrame([tuple(r) for r in sure.collect()] + [tuple(r) for r in best], sure.schema)


# ----------------------------------------------------------------- medians
def medians_approx(df: DataFrame, columns: list[str], accuracy: int = 10000) -> DataFrame:
    """``percentile_approx(c, 0.5, accuracy)`` for several columns, one pass."""
    return df.agg(*[F.percentile_approx(_q(c), 0.5, accuracy).alias(f"median_{c}") for c in columns])


def approx_quantiles(df: DataFrame, columns: list[str], rel_err: float) -> dict[str, float | None]:
    """``DataFrameStatFunctions.approxQuantile`` medians (driver-side scalars)."""
    res = df.approxQuantile(columns, [0.5], rel_err)
    return {c: (v[0] if v else None) for c, v in zip(columns, res)}


def medians_exact(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact lower median (``percentile_disc(0.5)``) per column, one row.

    Built on ``exact_quantile``: value counts per (column, value), then a
    running count over the values, so the work is one shuffle of distinct
    values per column, never a sort of all rows in one task.
    """
    wide = _pivot_one(exact_quantile(df, columns, 0.5), "quantile", columns)
    return wide.select(*[_q(c).alias(f"median_{c}") for c in columns])


def exact_quantile(df: DataFrame, columns: list[str], p: float, buckets: int = 256,
                   max_sort_values: int = 2_000_000, max_rounds: int = 80,
                   bounds: dict[str, tuple[float | None, float | None]] | None = None) -> DataFrame:
    """(column_name, quantile): per column, the smallest value v whose
    cume_dist(v) >= p (``percentile_disc``), NULL and NaN ignored.

    A distributed selection, not a global sort:
    1. one aggregate sketches ``buckets - 1`` split points per column
       (equal widths between min and max in the first round,
       ``percentile_approx`` in later ones; columns x buckets numbers
       reach the driver);
    2. one pass bucketizes every value (``Bucketizer``: a binary search in
       the JVM) and takes rows, min and max per (column, bucket) - a
       columns x buckets table; its running sum names the bucket holding
       rank ceil(p * n) and the rank inside it;
    3. while that bucket still holds more than ``max_sort_values`` rows of
       more than one distinct value, steps 1-2 repeat on its rows only;
    4. one pass counts the target bucket's rows per value and takes a
       running sum over at most ``max_sort_values`` distinct values.
    A value holding a third of all rows fills a bucket on its own (one
    distinct value), so skew never enlarges the final sort.  ``bounds``
    (column -> finite (min, max)) lets a caller that already aggregated
    the columns skip the min/max pass.
    """
    from pyspark.ml.feature import Bucketizer
    from pyspark.sql.window import Window

    spark = df.sparkSession
    names = [f"c{i}" for i in range(len(columns))]
    # + 0.0 turns -0.0 into 0.0: Bucketizer's binary search orders -0.0 below
    # 0.0 while SQL comparisons treat them as equal
    doubles = df.select([(_q(c).cast("double") + F.lit(0.0)).alias(n) for n, c in zip(names, columns)])
    fractions = [i / buckets for i in range(1, buckets)]
    inf = float("inf")
    # state per column: (lo, hi, rank wanted inside [lo, hi), rows in range)
    state: dict[str, tuple[float, float, int | None, int | None]] = {n: (-inf, inf, None, None) for n in names}

    def in_range(n):
        lo, hi = state[n][:2]
        c = F.col(n).isNotNull() & ~F.isnan(n)
        if lo != -inf:
            c = c & (F.col(n) >= lo)
        if hi != inf:
            c = c & (F.col(n) < hi)
        return c

    def middle(n):
        """A cut that halves the range, so that every round narrows it and a
        bucket of several values always ends below ``max_sort_values``."""
        lo, hi = max(state[n][0], mm[f"{n}_lo"]), min(state[n][1], mm[f"{n}_hi"])
        return lo + (hi - lo) / 2

    open_cols = list(names)
    # round 1 cuts each column's finite range into equal widths (one min/max
    # aggregate); later rounds, needed only when values crowd into one
    # bucket (heavy tails), cut at sketched quantiles of that bucket
    if bounds is not None:
        mm = {f"{n}_{k}": bounds[c][i] for n, c in zip(names, columns) for i, k in enumerate(("lo", "hi"))}
    else:
        mm = doubles.agg(*[x for n in names for x in (F.min(finite_only(F.col(n))).alias(f"{n}_lo"),
                                                      F.max(finite_only(F.col(n))).alias(f"{n}_hi"))]).first()
    for round_no in range(max_rounds):
        if not open_cols:
            break
        if round_no == 0:
            cuts = {}
            for n in open_cols:
                lo, hi = mm[f"{n}_lo"], mm[f"{n}_hi"]
                if lo is None:      # no finite value: at most -inf / +inf remain
                    cuts[n] = [0.0]
                elif lo == hi:
                    cuts[n] = [lo]
                else:
                    cuts[n] = [lo + (hi - lo) * i / buckets for i in range(buckets)]
        else:
            sk = doubles.agg(*[F.percentile_approx(F.when(in_range(n), F.col(n)), fractions, 4 * buckets)
                               .alias(n) for n in open_cols]).first()
            cuts = {n: [*(sk[n] or []), middle(n)] for n in open_cols}
        splits = {}
        for n in open_cols:
            lo, hi = state[n][:2]
            inner = sorted({v for v in cuts[n] if v is not None and lo < v < hi})
            if inner:
                splits[n] = [lo] + inner + [hi]
            elif state[n][2] is None:
                state[n] = (0.0, 0.0, None, 0)   # no non-NULL value at all
            # else: the sketch cannot cut this range further; keep it as is
        open_cols = [n for n in open_cols if n in splits]
        if not open_cols:
            break
        bz = Bucketizer(splitsArray=[splits[n] for n in open_cols], inputCols=open_cols,
                        outputCols=[f"{n}_b" for n in open_cols], handleInvalid="keep")
        marked = bz.transform(doubles.select(*open_cols)).select(
            *[F.when(in_range(n), F.col(f"{n}_b")).alias(f"{n}_b") for n in open_cols], *open_cols)
        parts = ", ".join(f"'{n}', {n}_b, {n}" for n in open_cols)
        stats = (marked.selectExpr(f"stack({len(open_cols)}, {parts}) as (column_name, bucket, value)")
                 .where(F.col("bucket").isNotNull())
                 .groupBy("column_name", "bucket")
                 .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("vmin"), F.max("value").alias("vmax"))
                 .collect())
        still_open = []
        for n in open_cols:
            # a bucket needs another round only if it has more rows than may be
            # sorted AND more than one distinct value (min < max)
            rows = sorted((int(r["bucket"]), r["n"], r["n"] if r["vmin"] < r["vmax"] else 1)
                          for r in stats if r["column_name"] == n)
            total = sum(k for _, k, _ in rows)
            if total == 0:
                state[n] = (0.0, 0.0, None, 0)
                continue
            need = state[n][2] if state[n][2] is not None else max(1, math.ceil(round(p * total, 9)))
            before = 0
            for b, k, d in rows:
                if before + k >= need:
                    state[n] = (splits[n][b], splits[n][b + 1], need - before, k)
                    if d > max_sort_values and len(splits[n]) > 2:
                        still_open.append(n)
                    break
                before += k
        open_cols = still_open

    live = {n: st for n, st in state.items() if st[2] is not None}
    if not live:
        return spark.createDataFrame([], "column_name string, quantile double")
    cond = None
    for n in live:
        c = (F.col("column_name") == n) & F.col("value").isNotNull() & ~F.isnan("value")
        lo, hi = live[n][:2]
        if lo != -inf:
            c = c & (F.col("value") >= lo)
        if hi != inf:
            c = c & (F.col("value") < hi)
        cond = c if cond is None else cond | c
    parts = ", ".join(f"'{n}', {n}" for n in live)
    need = spark.createDataFrame([(n, st[2]) for n, st in live.items()], "column_name string, need long")
    vc = (doubles.selectExpr(f"stack({len(live)}, {parts}) as (column_name, value)").where(cond)
          .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")))
    upto = Window.partitionBy("column_name").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    hit = (vc.withColumn("cum", F.sum("n").over(upto)).join(F.broadcast(need), "column_name")
           .where(F.col("cum") >= F.col("need")))
    label = F.element_at(F.create_map(*[x for n, c in zip(names, columns) for x in (F.lit(n), F.lit(c))]),
                         F.col("column_name"))
    return hit.groupBy("column_name").agg(F.min("value").alias("quantile")).select(
        label.alias("column_name"), "quantile")


def finite_only(c: Column) -> Column:
    """The value when it is a finite number, else NULL."""
    return F.when(c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")), c)


def _pivot_one(long_df: DataFrame, value: str, columns: list[str]) -> DataFrame:
    """(column_name, value) rows -> one row with a column per name."""
    return long_df.groupBy().pivot("column_name", columns).agg(F.first(value))


def _shown(c: Column, digits: int | None) -> Column:
    return c if digits is None else round_stable(c, digits)


def dataset_summary(df: DataFrame, columns: list[str], stddev_of: str | None = None,
                    digits: int | None = None) -> DataFrame:
    """(column_name, record_count, <stddev_of>_stddev, mean, median,
    mode); NaN for what a column without values has none of.  ``digits``
    rounds the means and the stddev (not by default).

    The input is scanned once: its value counts (one state per column, see
    ``value_counts``) are kept for the call, and everything else reads them."""
    names = list(dict.fromkeys([*columns, *([stddev_of] if stddev_of else [])]))
    with sinks.cached(value_counts.count_values(df, names)) as state:
        found = value_counts.summary_of(state)                       # one entry a column
    rows = max((r["rows"] for r in found.values()), default=0)
    spread = [found.get(stddev_of, {}).get("stddev")] if stddev_of else []
    table = [(c, rows, *spread, *(found.get(c, {}).get(k) for k in ("mean", "quantile", "mode"))) for c in columns]
    fields = "column_name string, record_count bigint" + (f", {quote(stddev_of + '_stddev')} double" if stddev_of else "")
    out = df.sparkSession.createDataFrame(table, fields + ", mean double, median double, mode double")
    rounded = [f"{stddev_of}_stddev"] * bool(stddev_of) + ["mean"]
    out = out.withColumns({c: _shown(_q(c), digits) for c in rounded})
    gaps = [*rounded, "median", "mode"]
    return out.withColumns({c: F.coalesce(_q(c), F.lit(float("nan"))) for c in gaps})


def stats_table(df: DataFrame, columns: dict[str, str], digits: int | None = None, median: str = "exact",
                rel_err: float = 0.001) -> DataFrame:
    """Rows Mean / Median / Mode, one column per (renamed) input column.
    ``median="exact"`` is ``percentile_disc(0.5)``; ``"approx"`` is the
    published ``approxQuantile`` with relative error ``rel_err``."""
    names = list(columns)
    mean = df.agg(F.lit("Mean").alias("Stat_Type"),
                  *[_shown(F.avg(_q(c)), digits).alias(a) for c, a in columns.items()])
    if median == "approx":
        med = approx_medians_table(df, names, rel_err).toDF(*names)
    else:
        med = _pivot_one(exact_quantile(df, names, 0.5), "quantile", names)
    med = med.select(F.lit("Median").alias("Stat_Type"), *[_q(c).alias(a) for c, a in columns.items()])
    mod = _pivot_one(modes(df, names, "double"), "mode", names)
    mod = mod.select(F.lit("Mode").alias("Stat_Type"), *[_q(c).alias(a) for c, a in columns.items()])
    return mean.unionByName(med).unionByName(mod)


def table_profile(df: DataFrame) -> DataFrame:
    """A29 as one result, one aggregate: (column_name, position, dtype,
    rows, columns, nulls, distinct_approx) per column."""
    names = df.columns
    row = df.agg(F.count(F.lit(1)).alias("rows"), *[x for i, c in enumerate(names) for x in (
        F.count_if(_q(c).isNull()).alias(f"n{i}"), F.approx_count_distinct(_q(c)).alias(f"d{i}"))]).first()
    out = [(c, i + 1, t, row["rows"], len(names), row[f"n{i}"], row[f"d{i}"]) for i, (c, t) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(
        out, "column_name string, position int, dtype string, rows bigint, columns int, nulls bigint, distinct_approx bigint")


def schema_profile(df: DataFrame) -> DataFrame:
    """A30 with what the rows show: the schema report and, per column, how
    many rows hold no value (one aggregate over the table)."""
    report = schema_report(df.sparkSession, df)
    found = table_profile(df).select("column_name", "rows", "nulls")
    return report.join(F.broadcast(found), "column_name")


def sample_rows(df: DataFrame, n: int) -> DataFrame:
    """Any ``n`` rows, reading no more than it must; none if ``n`` is
    not positive."""
    return df.limit(max(0, n))


def profile(df: DataFrame, numeric: list[str] | None = None,
            aggregate_columns: list[str] = ("trip_duration", "distance", "temp_f")) -> dict[str, DataFrame]:
    """The table profile as named DataFrames; a section is present only
    when its columns exist (``numeric`` defaults to every numeric column)."""
    numeric = numeric_columns(df) if numeric is None else numeric
    out = {
        "rows": row_count(df),
        "columns": df.sparkSession.createDataFrame([(len(df.columns),)], "columns int"),
        "nulls": null_counts(df),
        "sample": df.limit(10),
    }
    present_numeric = [c for c in numeric if c in df.columns]
    if present_numeric:
        out["describe"] = describe_typed(df, present_numeric)
    if "is_taxi" in df.columns:
        out["by_is_taxi"] = count_by(df, "is_taxi")
    if "time_hours" in df.columns:
        out["by_hour"] = count_by(df, "time_hours")
    if "date" in df.columns:
        out["top_dates"] = top_k(df, "date", 10)
    present_agg = [c for c in aggregate_columns if c in df.columns]
    if present_agg:
        out["min_max_avg"] = min_max_avg(df, present_agg)
    return out
