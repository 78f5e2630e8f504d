"""CSV sources: header + inferred schema, globs, all-string lookups and a
strict quoted reader that drops rows of the wrong width."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_csv(spark: SparkSession, path: str, infer: bool = True, schema: str | None = None,
             **options) -> DataFrame:
    """Header CSV (a file, folder or glob).  Prefer an explicit ``schema``
    at scale: inference is an extra full pass over the input."""
    reader = spark.read.option("header", "true")
    if schema:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", "true" if infer else "false")
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path)


def scan_lookup_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Small lookup CSV, every column a string, named by the file's header
    (``columns``: those to keep, in any order).

    ``""`` inside quotes is an escaped quote, and a row whose field count
    differs from the header is dropped (DROPMALFORMED).  Column pruning
    would let a short row survive a narrow select, so this read does
    without it.
    """
    df = (spark.read.option("header", "true").option("quote", '"').option("escape", '"')
          .option("mode", "DROPMALFORMED").option("columnPruning", "false").csv(path))
    return df.select(*[f"`{c}`" for c in columns]) if columns else df


#: a comma outside quotes (an even number of quotes follows)
_BETWEEN_FIELDS = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def scan_lookup_csv_checked(spark: SparkSession, path: str, columns: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``scan_lookup_csv`` with its rejects: (rows, rejects).

    rejects: line (as it stands in the file), fields (how many it has),
    expected (how many the header has) and reason.  Rows and rejects are two views
    of one lenient read; every data line of the file is in just one of them."""
    reader = spark.read.option("header", "true").option("quote", '"').option("escape", '"').option("columnPruning", "false")
    names = reader.csv(path).columns                              # reads the header line
    reject = "_reject"
    while reject in names:
        reject = "_" + reject
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, reject]])
    # the condition is always true: Spark refuses to read the reject column alone
    more = F.coalesce(F.length(f"`{names[0]}`"), F.lit(0)) >= 0
    df = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", reject).schema(schema).csv(path).filter(more)
    rows = df.filter(F.col(reject).isNull()).select(*[f"`{c}`" for c in columns or names])
    fields = (F.regexp_count(reject, F.lit(_BETWEEN_FIELDS)) + 1).cast("int")
    rejects = df.filter(F.col(reject).isNotNull()).select(
        F.col(reject).alias("line"), fields.alias("fields"), F.lit(len(names)).alias("expected"))
    reason = (F.when(F.col("fields") < F.col("expected"), "too few fields")
              .when(F.col("fields") > F.col("expected"), "too many fields").otherwise("not parsed"))
    return rows, rejects.withColumn("reason", reason)
