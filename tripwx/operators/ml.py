"""Transport-mode classifier: class balancing, split, indexing, random
forest, evaluation and batch scoring, on Spark ML.

Sampling and splitting have two forms: Spark's Bernoulli ``sample`` /
``randomSplit`` (as published), and a hash form that keeps a row when a
uniform number derived from the row's own key falls under the fraction.
The hash form gives the same rows on any cluster size and partitioning,
and after an executor loss, and can be reproduced in plain SQL.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# --- fixed values: published model configuration -----------------------------
FEATURES = ["start_longitude", "start_latitude", "distance", "time_hours", "temp_f",
            "precipitation_mm", "season_indexed", "beaufort_indexed"]
CATEGORICAL = {"season": "season_indexed", "beaufort_scale": "beaufort_indexed"}
LABEL = "is_taxi"
NUM_TREES, MAX_DEPTH, MAX_BINS = 40, 10, 64
SPLIT = (0.8, 0.2)
SEED = 12345
MODE_LABELS = {1.0: "YELLOW TAXI", 0.0: "CITIBIKE"}
# -----------------------------------------------------------------------------

_TWO_32 = 4294967296.0


def uniform(key_cols: list[str], seed: int = SEED, purpose: str = "") -> Column:
    """Deterministic number in [0, 1) from the row's key columns: the first
    32 bits of md5(purpose|seed|k1|k2|...).  Each decision (balancing,
    splitting) uses its own ``purpose`` so the draws are independent."""
    key = F.concat_ws("|", F.lit(purpose), F.lit(str(seed)), *[F.col(c).cast("string") for c in key_cols])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / _TWO_32


def class_counts(df: DataFrame, label: str = LABEL) -> dict:
    """Rows per class: one small aggregate, one row per class to the driver."""
    return {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}


def balance_classes(df: DataFrame, label: str = LABEL, key_cols: list[str] | None = None,
                    seed: int = SEED, method: str = "hash") -> DataFrame:
    """M1: downsample the majority class to about the minority's size.

    The majority is detected (not assumed); fraction = minority/majority,
    at most 1.  ``method="sample"`` is Spark's Bernoulli sample with the
    seed; ``method="hash"`` keeps majority rows with uniform(key) < fraction.
    """
    counts = class_counts(df, label)
    if len(counts) < 2:
        return df
    majority = max(counts, key=lambda k: (counts[k], str(k)))
    minority_n = min(counts.values())
    fraction = min(1.0, minority_n / counts[majority])
    major = df.filter(F.col(label) == majority)
    rest = df.filter(F.col(label) != majority)
    if method == "sample":
        kept = major.sample(withReplacement=False, fraction=fraction, seed=seed)
    else:
        kept = major.filter(uniform(key_cols or df.columns, seed, "balance") < fraction)
    return rest.union(kept)


def split_hash(df: DataFrame, key_cols: list[str], train_fraction: float = SPLIT[0],
               seed: int = SEED) -> DataFrame:
    """M2 (reproducible form): adds ``split`` = 'train' / 'test'."""
    return df.withColumn("split", F.when(uniform(key_cols, seed, "split") < train_fraction, "train").otherwise("test"))


def split_random(df: DataFrame, weights=SPLIT, seed: int = SEED) -> list[DataFrame]:
    """M2 as published: ``randomSplit``."""
    return df.randomSplit(list(weights), seed)


def string_indexer(input_col: str, output_col: str) -> StringIndexer:
    """M3: frequency-descending codes (ties alphabetical), unseen/NULL skipped."""
    return StringIndexer(inputCol=input_col, outputCol=output_col, handleInvalid="skip",
                         stringOrderType="frequencyDesc")


def pipeline(num_trees: int = NUM_TREES, max_depth: int = MAX_DEPTH, max_bins: int = MAX_BINS,
             seed: int = SEED) -> Pipeline:
    """M3-M6: two indexers, assembler (rows with NULL/NaN skipped), forest."""
    stages = [string_indexer(i, o) for i, o in CATEGORICAL.items()]
    stages.append(VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="skip"))
    stages.append(RandomForestClassifier(labelCol=LABEL, featuresCol="features", numTrees=num_trees,
                                         maxDepth=max_depth, maxBins=max_bins, seed=seed))
    return Pipeline(stages=stages)


def confusion_matrix(pred: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """(label, prediction, count)."""
    return (pred.groupBy(F.col(label).cast("double").alias("label"),
                         F.col(prediction).cast("double").alias("prediction"))
            .agg(F.count(F.lit(1)).alias("count")))


def metrics(pred: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """M7 as a DataFrame: rows, accuracy and weighted F1 (weights = true
    class shares), computed from the confusion counts."""
    cm = confusion_matrix(pred, label, prediction)
    tp = cm.filter(F.col("label") == F.col("prediction")).select(F.col("label").alias("cls"), F.col("count").alias("tp"))
    actual = cm.groupBy(F.col("label").alias("cls")).agg(F.sum("count").alias("act"))
    predicted = cm.groupBy(F.col("prediction").alias("cls")).agg(F.sum("count").alias("prd"))
    per = (actual.join(predicted, "cls", "left").join(tp, "cls", "left")
           .fillna(0, subset=["prd", "tp"])
           .withColumn("precision", F.when(F.col("prd") > 0, F.col("tp") / F.col("prd")).otherwise(0.0))
           .withColumn("recall", F.col("tp") / F.col("act"))
           .withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                    2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                       .otherwise(0.0)))
    total = F.sum("act")
    return per.agg(
        total.alias("rows"),
        (F.sum("tp") / total).alias("accuracy"),
        (F.sum(F.col("f1") * F.col("act")) / total).alias("weighted_f1"))


def evaluate(pred: DataFrame, label: str = LABEL) -> dict[str, float]:
    """M7 as published: Spark's evaluator, accuracy and weighted F1."""
    out = {}
    for m in ("accuracy", "f1"):
        ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName=m)
        out[m] = ev.evaluate(pred)
    return out


def train(data: DataFrame, key_cols: list[str], seed: int = SEED, **forest) -> tuple[PipelineModel, DataFrame]:
    """NULL drop, balance, hash split, fit on train; returns the model
    and the test-set predictions."""
    clean = data.dropna(how="any")
    balanced = balance_classes(clean, LABEL, key_cols, seed)
    split = split_hash(balanced, key_cols, SPLIT[0], seed)
    train_df = split.filter(F.col("split") == "train").drop("split")
    test_df = split.filter(F.col("split") == "test").drop("split")
    # the forest reads its input once per tree level: keep it (memory, then
    # disk) for the fit instead of recomputing the merge for every pass
    train_df = train_df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = pipeline(seed=seed, **forest).fit(train_df)
    finally:
        train_df.unpersist()
    return model, model.transform(test_df)


def score(model: PipelineModel, trips: DataFrame, keep_unscored: bool = False) -> DataFrame:
    """M8: batch scoring of a trips table.

    The pipeline skips rows it cannot score (a category the indexers never
    saw, a NULL/NaN feature).  With ``keep_unscored`` those rows are kept
    with a NULL prediction and ``predicted_mode = 'UNSCORED'``: the test
    uses each indexer's label list (a few values) and the raw features, so
    no key and no join is needed."""
    label = F.when(F.col("prediction") == 1.0, MODE_LABELS[1.0]).otherwise(MODE_LABELS[0.0])
    keep = list(trips.columns) + ["prediction"]
    if not keep_unscored:
        return model.transform(trips).select(*keep).withColumn("predicted_mode", label)
    ok = F.lit(True)
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            ok = ok & F.col(stage.getInputCol()).isin(*stage.labelsArray[0])
    for c in FEATURES:
        if c in trips.columns:
            ok = ok & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    ok = F.coalesce(ok, F.lit(False))
    scored = model.transform(trips.filter(ok)).select(*keep).withColumn("predicted_mode", label)
    unscored = (trips.filter(~ok).withColumn("prediction", F.lit(None).cast("double"))
                .withColumn("predicted_mode", F.lit("UNSCORED")))
    return scored.unionByName(unscored)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
