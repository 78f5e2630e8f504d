"""Registered queries: model operators (M1-M8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripwx.operators import clean, forest, ml
from tripwx.plans import inputs
from tripwx.plans.oracle import sql
from tripwx.plans.q_ingest import MERGED_COLS, _all_not_null
from tripwx.plans.register import register
from tripwx.session import scratch_path

KEY = ["date", "time_hours", "start_longitude", "start_latitude", "trip_duration", "distance"]


def _u(purpose):
    return ("CAST(('0x' || substr(md5(concat_ws('|', '" + purpose + "', '12345', CAST(date AS VARCHAR), "
            "CAST(time_hours AS VARCHAR), CAST(start_longitude AS VARCHAR), CAST(start_latitude AS VARCHAR), "
            "CAST(trip_duration AS VARCHAR), CAST(distance AS VARCHAR))), 1, 8))::BIGINT AS DOUBLE) / 4294967296.0")


_CLEAN = f"SELECT * FROM merged_left WHERE {_all_not_null(MERGED_COLS)}"
_BALANCED = f"""
WITH c AS ({_CLEAN}),
     n AS (SELECT is_taxi, count(*) AS k FROM c GROUP BY 1),
     mj AS (SELECT is_taxi AS major, k AS major_n FROM n ORDER BY k DESC, CAST(is_taxi AS VARCHAR) DESC LIMIT 1),
     mn AS (SELECT min(k) AS minor_n FROM n)
SELECT c.* FROM c, mj, mn
WHERE c.is_taxi <> mj.major OR {_u('balance')} < least(1.0, CAST(mn.minor_n AS DOUBLE) / mj.major_n)"""
_RULE = "CAST(CASE WHEN distance >= 100 THEN 1.0 ELSE 0.0 END AS DOUBLE)"


def _clean(spark, sf):
    return clean.drop_nulls(inputs.merged_left(spark, sf))


def _rule(df):
    return df.withColumn("prediction", F.when(F.col("distance") >= 100, 1.0).otherwise(0.0))


@register("balance_classes", sql(f"SELECT * FROM ({_BALANCED}) b", "merged_left"))
def q_balance_classes(spark, sf):
    return ml.balance_classes(_clean(spark, sf), "is_taxi", KEY)


@register("split_hash", sql(f"""
SELECT *, CASE WHEN {_u('split')} < 0.8 THEN 'train' ELSE 'test' END AS split FROM ({_BALANCED}) b""", "merged_left"))
def q_split_hash(spark, sf):
    return ml.split_hash(ml.balance_classes(_clean(spark, sf), "is_taxi", KEY), KEY)


@register("string_index", sql(f"""
SELECT beaufort_scale, CAST(row_number() OVER (ORDER BY count(*) DESC, beaufort_scale) - 1 AS DOUBLE) AS beaufort_indexed
FROM ({_CLEAN}) c GROUP BY 1""", "merged_left"))
def q_string_index(spark, sf):
    df = _clean(spark, sf)
    model = ml.string_indexer("beaufort_scale", "beaufort_indexed").fit(df)
    return model.transform(df.select("beaufort_scale").distinct())


@register("confusion_matrix", sql(f"""
SELECT CAST(is_taxi AS DOUBLE) AS label, {_RULE} AS prediction, count(*) AS count
FROM ({_CLEAN}) c GROUP BY 1, 2""", "merged_left"))
def q_confusion_matrix(spark, sf):
    return ml.confusion_matrix(_rule(_clean(spark, sf)))


@register("classification_metrics", sql(f"""
SELECT * FROM (WITH p AS (SELECT CAST(is_taxi AS DOUBLE) AS label, {_RULE} AS prediction FROM ({_CLEAN}) c),
     cls AS (SELECT label AS cls, count(*) AS act, count_if(prediction = label) AS tp FROM p GROUP BY 1),
     prd AS (SELECT prediction AS cls, count(*) AS prd FROM p GROUP BY 1),
     per AS (SELECT cls.cls, act, tp, coalesce(prd, 0) AS prd,
                    CASE WHEN coalesce(prd, 0) > 0 THEN tp / prd ELSE 0.0 END AS precision,
                    tp / act AS recall
             FROM cls LEFT JOIN prd ON cls.cls = prd.cls),
     f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                          ELSE 0.0 END AS f1 FROM per)
SELECT CAST(sum(act) AS BIGINT) AS rows,
       sum(tp) / sum(act) AS accuracy, sum(f1 * act) / sum(act) AS weighted_f1
FROM f) m""", "merged_left"))
def q_classification_metrics(spark, sf):
    return ml.metrics(_rule(_clean(spark, sf)))


@register("ml_train", None)
def q_ml_train(spark, sf):
    _, pred = ml.train(inputs.merged_left(spark, sf), KEY, num_trees=ml.NUM_TREES)
    return ml.confusion_matrix(pred)


_SCORABLE = " AND ".join(f"{c} IS NOT NULL" for c in [
    "start_longitude", "start_latitude", "distance", "time_hours", "temp_f", "precipitation_mm", "season", "beaufort_scale"])


@register("ml_score", sql(f"""
SELECT CAST(count_if({_SCORABLE}) AS BIGINT) AS scored, CAST(count_if(NOT ({_SCORABLE})) AS BIGINT) AS unscored,
       CAST(count(*) AS BIGINT) AS agreeing
FROM merged_left""", "merged_left"))
def q_ml_score(spark, sf):
    """All trips scored twice: by the saved and reloaded pipeline, and by the
    forest's own node table, saved and reloaded as Parquet.  Each row must
    get the same prediction, or none, from both."""
    merged = inputs.merged_left(spark, sf)
    model, _ = ml.train(merged, KEY)
    path = scratch_path(spark, "model")
    ml.save(model, f"{path}/pipeline")
    loaded = ml.load(f"{path}/pipeline")
    forest.save(forest.flatten(loaded), f"{path}/forest")
    rows = ml.score(loaded, merged, keep_unscored=True)
    both = forest.score(forest.load(spark, f"{path}/forest"), rows, prediction="by_nodes")
    scored = F.col("prediction").isNotNull()
    return both.agg(F.count_if(scored).alias("scored"), F.count_if(~scored).alias("unscored"),
                    F.count_if(F.col("prediction").eqNullSafe(F.col("by_nodes"))).alias("agreeing"))


@register("ml_test_rows", sql(f"""
SELECT CAST(count_if({_u('split')} >= 0.8) AS BIGINT) AS test_rows, CAST(count(*) AS BIGINT) AS balanced_rows, true AS fitted
FROM ({_BALANCED}) b""", "merged_left"))
def q_ml_test_rows(spark, sf):
    """The test rows all get a prediction.  The test table's labels do not
    follow from its features, so no model can beat chance on its test rows; the
    fit itself must show on the rows that it came from: over all balanced rows, more
    are right than half by five standard errors."""
    model, pred = ml.train(inputs.merged_left(spark, sf), KEY, num_trees=ml.NUM_TREES)
    balanced = ml.balance_classes(_clean(spark, sf), "is_taxi", KEY)
    known = ml.metrics(model.transform(balanced)).first()
    tested = ml.metrics(pred).first()
    fitted = known.accuracy > 0.5 + 2.5 / known.rows ** 0.5
    return spark.createDataFrame([(tested.rows, known.rows, fitted)], "test_rows bigint, balanced_rows bigint, fitted boolean")
