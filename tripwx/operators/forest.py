"""A fitted forest as plain tables.

``flatten`` turns a trained pipeline into two tables: one row per tree node,
and one row per label of each indexed column.  They are Parquet like any other
data: another job, or another engine, can score with them without the library
that trained the model.  ``score`` packs the nodes into arrays (their number is
bounded by trees x 2^(depth + 1), whatever the training data) and lets
every task walk all trees for a whole Arrow batch at once.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwx.operators import ml
from tripwx.session import scratch_path

NODES = ("tree int, node int, feature int, threshold double, categories array<int>, left int, right int, "
         "class_shares array<double>")


def flatten(model: PipelineModel) -> dict[str, DataFrame]:
    """``nodes``: tree, node, feature, threshold (numbers: left if not
    above), categories (codes that go left; NULL for numbers), left and right child (-1
    in a leaf), class_shares of the training rows.  ``labels``: column, label, code."""
    spark = SparkSession.active()
    path = scratch_path(spark, "forest")
    model.stages[-1].write().save(path)
    rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    leaf = F.col("leftChild") < 0
    numbers = F.col("split.numCategories") < 0
    nodes = rows.select(
        F.col("treeID").cast("int").alias("tree"), F.col("id").cast("int").alias("node"),
        F.when(~leaf, F.col("split.featureIndex")).cast("int").alias("feature"),
        F.when(~leaf & numbers, F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        F.when(~leaf & ~numbers, F.transform("split.leftCategoriesOrThreshold", lambda c: c.cast("int"))).alias("categories"),
        F.col("leftChild").cast("int").alias("left"), F.col("rightChild").cast("int").alias("right"),
        F.transform("impurityStats", lambda s: s / F.aggregate("impurityStats", F.lit(0.0), lambda a, b: a + b)).alias("class_shares"))
    labels = [(s.getOutputCol(), s.getInputCol(), label, code) for s in model.stages if isinstance(s, StringIndexerModel)
              for code, label in enumerate(s.labelsArray[0])]
    return {"nodes": nodes, "labels": spark.createDataFrame(labels, "output string, input string, label string, code int")}


def save(tables: dict[str, DataFrame], path: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def load(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}") for name in ("nodes", "labels")}


class Walker:
    """All trees in one set of arrays, indexed by node place; children are
    places too."""

    def __init__(self, rows: list):
        place = {(r.tree, r.node): i for i, r in enumerate(rows)}
        self.roots = np.array([place[t, 0] for t in sorted({r.tree for r in rows})], np.int64)
        self.leaf = np.array([r.left < 0 for r in rows], bool)
        self.feature = np.array([r.feature or 0 for r in rows], np.int64)
        self.threshold = np.array([np.nan if r.threshold is None else r.threshold for r in rows])
        self.child = np.array([[place.get((r.tree, r.left), 0), place.get((r.tree, r.right), 0)] for r in rows], np.int64)
        self.shares = np.array([r.class_shares for r in rows])
        codes = 1 + max((c for r in rows for c in r.categories or []), default=0)
        self.nominal = np.array([r.categories is not None for r in rows], bool)
        self.goes_left = np.zeros((len(rows), codes + 1), bool)
        for i, r in enumerate(rows):
            self.goes_left[i, list(r.categories or [])] = True

    def shares_of(self, x: np.ndarray) -> np.ndarray:
        """Sum over the trees of the class shares of each row's leaf."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        row = np.arange(len(x))[:, None]
        while not self.leaf[at].all():
            value = x[row, self.feature[at]]
            code = np.clip(value, 0, self.goes_left.shape[1] - 1).astype(np.int64)     # the last column is never left
            left = np.where(self.nominal[at], self.goes_left[at, code], value <= self.threshold[at])
            at = np.where(self.leaf[at], at, self.child[at, np.where(left, 0, 1)])
        return self.shares[at].sum(1)


def score(tables: dict[str, DataFrame], rows: DataFrame, features: list[str] | None = None,
          prediction: str = "prediction") -> DataFrame:
    """``rows`` with ``<prediction>`` and ``<prediction>_share`` (mean class
    share of the winning class).  A row with a NULL, NaN or unknown feature keeps NULLs."""
    features = features or ml.FEATURES
    codes: dict[str, tuple[str, dict]] = {}
    for r in tables["labels"].collect():                      # at most one row per bin of an indexed column
        codes.setdefault(r.output, (r.input, {}))[1][r.label] = float(r.code)
    walker = Walker(sorted(tables["nodes"].collect(), key=lambda r: (r.tree, r.node)))
    vector = []
    for name in features:
        if name in codes:
            source, known = codes[name]
            pairs = [x for label, code in known.items() for x in (F.lit(label), F.lit(code))]
            vector.append(F.try_element_at(F.create_map(*pairs), F.col(source).cast("string")))
        else:
            value = F.col(name).cast("double")
            vector.append(F.when(~F.isnan(value), value))
    packed = rows.withColumn("_vector", F.array(*vector))
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(len(names)).flatten()
            x = flat.to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, len(features))
            whole = ~np.isnan(x).any(1)
            shares = walker.shares_of(x[whole])
            best = np.full(batch.num_rows, np.nan)
            top = best.copy()
            best[whole], top[whole] = shares.argmax(1), shares.max(1, initial=0) / len(walker.roots)
            columns = [pa.array(v, pa.float64(), from_pandas=True) for v in (best, top)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], *columns],
                                             [*names, prediction, f"{prediction}_share"])
    added = [T.StructField(c, T.DoubleType()) for c in (prediction, f"{prediction}_share")]
    return packed.mapInArrow(run, T.StructType([*rows.schema.fields, *added]))


# the walker travels to the executors by value: a cluster needs no installed copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
