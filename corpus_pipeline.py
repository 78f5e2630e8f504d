"""From raw documents to a training mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes it as Parquet and hands the reread table to the next one.  All
stages but the last return the columns of ``documents``.

Rows are told apart by id and text hash, so rows that share an id are judged
one by one; a row repeated with the same id and text is one document, of
which the near-duplicate stage keeps one.  Null ids, texts and sources
stay in the table, an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripwx.llm import decontam, jaccard_join, mixing, pii, quality
from tripwx.llm.store import cut

ORACLE_SQL = None       # the classifier and the tilings have no SQL form


def _key():
    """Orders rows by id, null ids last, and tells texts of one id apart."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"))


def _keyed(docs: DataFrame, *columns: str) -> DataFrame:
    return docs.select(_key().alias("doc_id"), *columns)


def _free(docs: DataFrame, name: str) -> str:
    """``name``, prefixed until no column of ``docs`` has it."""
    while name.lower() in (c.lower() for c in docs.columns):
        name = "_" + name
    return name


def _join(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """``docs`` joined to ``keys`` (_k: their key, and other columns)."""
    id_, h = _free(docs, "_kid"), _free(docs, "_kh")
    right = keys.select(F.col("_k.id").alias(id_), F.col("_k.h").alias(h), *[c for c in keys.columns if c != "_k"])
    return docs.join(right, docs["doc_id"].eqNullSafe(right[id_]) & (F.xxhash64(docs["text"]) == right[h]), how)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality.accept(docs, labels)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: of documents linked by a Jaccard
    similarity of 0.8 on five-word shingles, the one with the least id."""
    found = jaccard_join.join_components(_keyed(docs, "text"), size=5, num=80, den=100)
    rows = _free(docs, "_rows")
    stay = found.filter(F.col("doc_id") == F.col("component_id")).groupBy(F.col("doc_id").alias("_k")).agg(F.count("*").alias(rows))
    kept = _join(docs, stay, "inner").select(*docs.columns, rows)
    # of rows with one id and text the least stays; summed up inside each task first
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    once = kept.filter(F.col(rows) > 1).groupBy("doc_id", F.xxhash64("text")).agg(F.min(row).alias(rows)).select(f"{rows}.*")
    return kept.filter(F.col(rows) == 1).drop(rows).unionByName(once)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    gone = decontam.leaked(_keyed(docs, "text"), benchmark).select(F.col("doc_id").alias("_k"))
    return _join(docs, gone, "left_anti").select(*docs.columns)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the text gives way to its kind; n_chars follows."""
    out = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return out
    kind = docs.schema["n_chars"].dataType
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars"))).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with their share of it: size,
    source_size, target, epochs (whole passes) and taken (tokens).

    Rows equal in id, text and source stand side by side in the mix, so all
    of them have the same share, unless the source's budget ends among them: then
    the first of them, in any order, are taken, and one in part."""
    mixed = mixing.mix(_keyed(docs, "text", "source"))
    named = {c: _free(docs, f"_{c}") for c in (*MIX, "more", "copies", "source")}
    more = F.sum(F.col("taken") - F.col("epochs") * F.col("size"))
    shares = mixed.groupBy(F.col("doc_id").alias("_k"), F.col("source").alias(named["source"])).agg(
        *[F.min(c).alias(named[c]) for c in MIX if c != "taken"], more.alias(named["more"]), F.count("*").alias(named["copies"]))
    shares = cut(shares, "shares")
    size, extra, copies = (F.col(named[c]) for c in ("size", "more", "copies"))
    whole = F.col(named["epochs"]) * size
    alike = (extra == 0) | (extra == copies * size)
    same = F.col("source").eqNullSafe(F.col(named["source"]))
    even = _join(docs, shares.filter(alike & ((extra > 0) | (whole > 0))), "inner").filter(same)
    even = even.withColumn(named["taken"], whole + F.when(extra > 0, size).otherwise(0))
    # at most one key per source, looked up without a shuffle of the texts: its rows are numbered
    row, number = _free(docs, "_row"), _free(docs, "_number")
    odd = shares.filter(~alike)
    split = _join(docs, F.broadcast(odd) if odd.count() <= BROADCAST_KEYS else odd, "inner").filter(same)
    split = cut(split.withColumn(row, F.monotonically_increasing_id()), "split")
    one = split.select(F.col(named["source"]).alias("source"), F.col(row).alias("_row"), F.lit(1).cast("long").alias("_one"))
    upto = mixing.prefix_sums(one, "source", ["_row"], "_one", "numbers")
    split = split.join(upto.select(F.col("_row").alias(row), F.col(mixing.TOTAL).alias(number)), row)
    left = F.greatest(F.lit(0).cast("long"), F.least(size, extra - (F.col(number) - 1) * size))
    split = split.withColumn(named["taken"], whole + left).filter(F.col(named["taken"]) > 0)

    def shown(df):
        return df.select(*docs.columns, *[F.col(named[c]).alias(c) for c in MIX if c not in docs.columns])
    return shown(even).unionByName(shown(split))


BROADCAST_KEYS = 1 << 16
MIX = ("size", "source_size", "target", "epochs", "taken")
STAGES = [
    ("quality", quality_filter),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("pii", redact_pii),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
