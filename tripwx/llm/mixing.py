"""Mixing sources to target weights.

Every source gets a token budget; inside a source the documents stand in a
hash-random order and the budget cuts that order at an exact token.  The
order is a range sort and the running totals are distributed prefix sums,
so a source of any size is spread over many tasks.

Defined results: a null or blank text has size 0 and is taken 0 times; a
null source is a source of its own, last in order; documents whose order
key ties are ordered by id, then size (rows equal in all of these are
interchangeable); an empty table gives no rows; a null id is an id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwx.llm.store import cut

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
PART, WITHIN, TOTAL = "_part", "_within", "_running"


def _run_within(group: int, value: int):
    """Running total of ``value`` inside each run of equal ``group`` values
    of a sorted partition, carried over its batches."""
    def run(batches):
        last, carried = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            groups, values = batch.column(group), batch.column(value).to_numpy()
            code = pc.fill_null(groups.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
            total = np.cumsum(values)
            begin = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
            before = (total - values)[begin]
            if last is not None and groups[0].as_py() == last[0]:
                before[0] -= carried
            total = total - np.repeat(before, np.diff(np.r_[begin, len(code)]))
            last, carried = (groups[-1].as_py(),), int(total[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(total, pa.int64())], [*batch.schema.names, WITHIN])
    return run


def prefix_sums(df: DataFrame, group: str, order: list[str], value: str, label: str) -> DataFrame:
    """``df`` with ``_running``: the inclusive sum of ``value`` (a long, not
    null) over the rows of ``group`` up to this one in ``order``.

    One range exchange sorts the rows by group and order, a hot group being
    split over many partitions; each partition sums its own rows; one row
    per partition and group then carries the totals of earlier partitions
    over.  The sorted rows are written once: sampled range bounds differ
    between evaluations."""
    keys = [F.col(group).asc_nulls_last(), *[F.col(c).asc_nulls_first() for c in order]]
    ranged = (df.repartitionByRange(*keys).sortWithinPartitions(*keys)
              .withColumn(PART, F.spark_partition_id()))
    at = ranged.columns
    schema = T.StructType([*ranged.schema.fields, T.StructField(WITHIN, T.LongType())])
    rows = cut(ranged.mapInArrow(_run_within(at.index(group), at.index(value)), schema), label)
    parts = rows.groupBy(group, PART).agg(F.sum(value).alias("_sum"))
    later = parts.select(F.col(group).alias("_g"), F.col(PART).alias("_p"), "_sum")
    # few rows: one per partition and group it holds
    before = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = later.select("_g", "_p", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    return (rows.join(offsets, F.col(group).eqNullSafe(F.col("_g")) & (F.col(PART) == F.col("_p")))
            .withColumn(TOTAL, F.col("_before") + F.col(WITHIN))
            .drop("_g", "_p", "_before", PART, WITHIN))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source (``source``, ``source_size``): ``weight`` (the given ones
    in turn, sources by code point, null last) and ``target``.

    All targets together are ``share`` of all tokens.  A target never
    exceeds ``max_epochs`` times its source; what is above is reshared by
    weight.  That process ends at min(cap, level * weight) for one level:
    with the sources sorted by cap / weight, the level is the least of
    (budget - caps before) / (weights from here on) that its own source
    does not reach."""
    named = sizes.groupBy(F.col("source").alias("source")).agg(F.sum("size").alias("source_size"))
    named = named.withColumn("_one", F.lit(1).cast("long")).withColumn("_all", F.lit(0))
    ranked = prefix_sums(named.withColumn("_null", F.col("source").isNull()), "_all",
                         ["_null", "source"], "_one", "sources")
    picks = F.array(*[F.lit(w).cast("long") for w in weights])
    ranked = ranked.select(
        "source", "source_size", F.element_at(picks, ((F.col(TOTAL) - 1) % len(weights) + 1).cast("int")).alias("weight"))
    ranked = ranked.withColumn("_cap", F.col("source_size") * max_epochs)
    ranked = ranked.withColumn("_ratio", F.col("_cap") / F.col("weight")).withColumn("_all", F.lit(0))
    caps = prefix_sums(ranked, "_all", ["_ratio", "source"], "_cap", "caps").withColumnRenamed(TOTAL, "_caps")
    both = prefix_sums(caps, "_all", ["_ratio", "source"], "weight", "weights").withColumnRenamed(TOTAL, "_weights")
    both = cut(both, "targets")
    total, weight = both.agg(F.sum("source_size"), F.sum("weight")).first()
    budget = (total or 0) * share
    rest = F.lit(weight or 0) - F.col("_weights") + F.col("weight")
    level = (F.lit(float(budget)) - (F.col("_caps") - F.col("_cap"))) / rest
    # the first source in ratio order whose cap is not reached fixes the level for all after it
    found = both.select(level.alias("l"), "_ratio", "_weights").filter(F.col("_ratio") >= F.col("l")).agg(
        F.min_by("l", F.struct("_ratio", "_weights"))).first()[0]
    found = math.inf if found is None else float(found)
    target = F.least(F.col("_cap").cast("double"), F.col("weight") * F.lit(found))
    return both.select("source", "source_size", "weight", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0,
        max_epochs: int = MAX_EPOCHS, seed: int = 17) -> DataFrame:
    """doc_id, size, source, source_size, target, epochs (whole passes over
    the document) and taken (tokens the mix takes of it, repeats counted).

    A source whose budget is q whole passes and r tokens takes every
    document q times and, once more, the first r tokens of its hash order."""
    sized = docs.select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    # narrow rows, written once: the texts are counted once, and a number of its own lets equal rows part
    keyed = cut(sized.withColumns({"_key": F.xxhash64(F.lit(seed), "doc_id"), "_row": F.monotonically_increasing_id()}), "sizes")
    placed = prefix_sums(keyed, "source", ["_key", "doc_id", "size", "_row"], "size", "mix-order")
    targets = source_targets(placed, weights, share, max_epochs)
    rows = placed.join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
    budget = F.least(F.round("target").cast("long"), F.col("source_size") * max_epochs)
    rows = rows.withColumn("_budget", budget)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("_budget") / F.col("source_size"))).otherwise(0).cast("long")
    rows = rows.withColumn("epochs", passes)
    left = F.col("_budget") - F.col("epochs") * F.col("source_size")
    more = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), left - (F.col(TOTAL) - F.col("size"))))
    return rows.select("doc_id", "size", "source", "source_size", "target", "epochs",
                       (F.col("epochs") * F.col("size") + more).alias("taken"))
