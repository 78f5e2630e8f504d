"""Schema operators: align to a declared spec, resolve alternative names,
bulk rename / cast / drop, and a schema report as a table.

All of these are plan-build-time decisions on ``df.columns`` and compile to
a single projection; none of them touches data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    dtype: str  # Spark SQL type name, e.g. "double", "bigint", "timestamp"


def quote(name: str) -> str:
    """Backtick-quote an identifier for generated SQL."""
    return "`" + name.replace("`", "``") + "`"


def find_column(df: DataFrame, name: str) -> str | None:
    """Actual column name matching ``name`` case-insensitively, or None."""
    lowered = name.lower()
    for c in df.columns:
        if c.lower() == lowered:
            return c
    return None


def cast_or_null(df: DataFrame, name: str, dtype: str, safe: bool = True) -> Column:
    """The column cast to ``dtype`` if present, else a typed NULL.

    ``safe`` uses ``try_cast`` so a malformed value becomes NULL instead of
    failing the job under ANSI mode.
    """
    actual = find_column(df, name)
    if actual is None:
        return F.lit(None).cast(dtype)
    c = F.col(quote(actual))
    return c.try_cast(dtype) if safe else c.cast(dtype)


def align(df: DataFrame, specs: list[ColumnSpec], safe: bool = True) -> DataFrame:
    """Project ``df`` onto ``specs``: cast if present, typed NULL if absent."""
    return df.select([cast_or_null(df, s.name, s.dtype, safe).alias(s.name) for s in specs])


def first_present(df: DataFrame, *names: str, dtype: str = "string") -> Column:
    """``coalesce`` over those of ``names`` that exist (typed NULL if none)."""
    present = [F.col(quote(n)) for n in (find_column(df, x) for x in names) if n is not None]
    if not present:
        return F.lit(None).cast(dtype)
    return F.coalesce(*present)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Bulk rename; names may contain spaces, %, degree signs or parentheses.
    Names that do not exist are ignored."""
    present = {old: new for old, new in mapping.items() if old in df.columns}
    return df.withColumnsRenamed(present)


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Bulk ``try_cast`` of existing columns."""
    return df.withColumns({n: F.col(quote(n)).try_cast(t) for n, t in types.items() if n in df.columns})


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop by exact name; dotted names are not parsed as struct paths and
    missing names are ignored."""
    keep = [c for c in df.columns if c not in set(names)]
    return df.select([F.col(quote(c)) for c in keep])


def schema_report(spark: SparkSession, df: DataFrame) -> DataFrame:
    """(position, column, type, nullable) as a DataFrame."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    schema = T.StructType([
        T.StructField("position", T.IntegerType(), False),
        T.StructField("column_name", T.StringType(), False),
        T.StructField("data_type", T.StringType(), False),
        T.StructField("nullable", T.BooleanType(), False),
    ])
    return spark.createDataFrame(rows, schema)
