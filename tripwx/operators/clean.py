"""Row validation: named rules, NULL drops, stage counts, imputation, dedup.

A rule is a (name, Column) pair; a row passes when the Column is TRUE
(FALSE and NULL both fail, as in ``filter``).  ``funnel`` reports the row
count after every stage of a rule chain in ONE aggregate pass, instead of
one ``count()`` job per stage.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwx.operators.schema import quote
from tripwx.session import scratch_path


@dataclass(frozen=True)
class Rule:
    name: str
    condition: Column


def _nan_safe_not_null(df: DataFrame, names: list[str]) -> Column:
    """All named columns non-NULL; NaN counts as NULL for doubles/floats,
    as in ``na.drop``."""
    cond = F.lit(True)
    types = dict(df.dtypes)
    for n in names:
        c = F.col(quote(n))
        if types.get(n) in ("double", "float"):
            cond = cond & c.isNotNull() & ~F.isnan(c)
        else:
            cond = cond & c.isNotNull()
    return cond


def drop_nulls(df: DataFrame, subset: list[str] | None = None, existing_only: bool = False) -> DataFrame:
    """``na.drop('any')`` over ``subset`` (all columns when None).

    ``existing_only`` keeps only the subset names present in ``df``
    (case-sensitive, like the reference's check)."""
    if subset is None:
        return df.dropna(how="any")
    names = [n for n in subset if n in df.columns] if existing_only else list(subset)
    if not names:
        return df
    return df.dropna(how="any", subset=names)


def apply_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Keep rows passing every rule: one Filter (its column-only conjuncts
    reach the Parquet scan as pushed filters)."""
    if not rules:
        return df
    return df.filter(functools.reduce(lambda a, b: a & b, [r.condition for r in rules]))


def null_rule(df: DataFrame, names: list[str], label: str = "not_null") -> Rule:
    return Rule(label, _nan_safe_not_null(df, [n for n in names if n in df.columns]))


def funnel(df: DataFrame, rules: list[Rule], input_label: str = "input") -> DataFrame:
    """(stage_no, stage, rows): input rows, then rows left after each rule,
    all from a single aggregation."""
    aggs = [F.count(F.lit(1)).alias("c0")]
    cumulative = F.lit(True)
    for i, r in enumerate(rules, start=1):
        cumulative = cumulative & r.condition
        aggs.append(F.count_if(F.coalesce(cumulative, F.lit(False))).alias(f"c{i}"))
    one_row = df.agg(*aggs)
    labels = [input_label] + [r.name for r in rules]
    stack_args = ", ".join(f"{i}, '{lab}', c{i}" for i, lab in enumerate(labels))
    return one_row.selectExpr(f"stack({len(labels)}, {stack_args}) as (stage_no, stage, rows)")


def _mean(c: Column, exact_scale: int | None) -> Column:
    if exact_scale is None:
        return F.avg(c)
    exact_sum = F.sum(c.cast(f"decimal(38,{exact_scale})")).cast("double")
    return exact_sum / F.count(c)


def impute_mean(df: DataFrame, columns: list[str], exact_scale: int | None = None) -> DataFrame:
    """Replace NULL with the column mean.

    All means come from one aggregate (one scan for any number of
    columns); a column whose mean is NULL (all NULL / empty) is left as is.
    With ``exact_scale`` the values are known to carry at most that many
    decimals and the sum is taken as an exact decimal, so the mean does not
    depend on the order in which partitions are added up.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    row = df.agg(*[_mean(F.col(quote(c)), exact_scale).alias(c) for c in present]).first()
    return _filled(df, {c: row[c] for c in present})


def _filled(df: DataFrame, means: dict[str, float | None]) -> DataFrame:
    known = {c: F.coalesce(F.col(quote(c)), F.lit(float(v))) for c, v in means.items() if v is not None}
    return df.withColumns(known) if known else df


def impute_with_funnel(df: DataFrame, rules: list[Rule], columns: list[str], exact_scale: int | None = None,
                       input_label: str = "input") -> tuple[DataFrame, DataFrame]:
    """(rows that pass all rules, NULLs replaced by the means of those rows;
    the stage funnel).  Means and stage counts come from one aggregate, so a
    job that writes the rows scans its input twice in all, not three times."""
    present = [c for c in columns if c in df.columns]
    passed = F.lit(True)
    aggs = [F.count(F.lit(1)).alias("c0")]
    for i, r in enumerate(rules, start=1):
        passed = passed & r.condition
        aggs.append(F.count_if(F.coalesce(passed, F.lit(False))).alias(f"c{i}"))
    aggs += [_mean(F.when(passed, F.col(quote(c))), exact_scale).alias(f"m{i}") for i, c in enumerate(present)]
    row = df.agg(*aggs).first()
    stages = [(i, name, row[f"c{i}"]) for i, name in enumerate([input_label, *[r.name for r in rules]])]
    report = df.sparkSession.createDataFrame(stages, "stage_no int, stage string, rows bigint")
    return _filled(apply_rules(df, rules), {c: row[f"m{i}"] for i, c in enumerate(present)}), report


def dedup(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Whole-row (or subset) deduplication.  It is a hash aggregate, so
    copies of a hot row collapse map-side before the shuffle."""
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


def dedup_stored(df: DataFrame, max_repeated: int = 1 << 22) -> DataFrame:
    """Whole-row deduplication of a stored table by its rows' hashes.

    Only 8-byte hashes are shuffled for all rows.  Rows whose hash stands once
    are kept where they are; full rows meet only where hashes do.  The repeated
    hashes are written once and broadcast, up to ``max_repeated`` of them; with
    more, repetition is the rule and ``dedup`` is the better plan.  ``df``
    is read three times, so it should be a scan, not a costly query."""
    spark = df.sparkSession
    row = F.xxhash64(*[F.col(quote(c)) for c in df.columns])
    path = scratch_path(spark, "repeated-rows")
    df.groupBy(row.alias("_row")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("_row").write.parquet(path)
    repeated = spark.read.schema("_row bigint").parquet(path)
    if repeated.count() > max_repeated:
        return dedup(df)
    met = F.broadcast(repeated)
    alone = df.join(met, row == F.col("_row"), "left_anti")
    return alone.unionByName(df.join(met, row == F.col("_row"), "left_semi").dropDuplicates())
