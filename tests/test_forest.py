"""The forest's node table against the model that it was made from."""

import random

import pytest
from pyspark.sql import functions as F

from tripwx.operators import forest, ml


@pytest.fixture(scope="module")
def trips(spark):
    rng = random.Random(2)
    seasons, winds = ["WINTER", "SPRING", "SUMMER", "FALL"], [f"{k} - wind" for k in range(9)]
    rows = []
    for i in range(1500):
        season, wind, hour = rng.choice(seasons), rng.choice(winds), rng.randrange(24)
        distance = rng.expovariate(0.3)
        taxi = int((distance > 3) ^ (season in ("WINTER", "FALL")) ^ (wind in winds[2:5]) if rng.random() < 0.9 else rng.random() < 0.5)
        rows.append((i, -74 + rng.random(), 40 + rng.random(), distance, hour, rng.gauss(60, 20), rng.random() * 5, season, wind, taxi))
    schema = ("id int, start_longitude double, start_latitude double, distance double, time_hours int, temp_f double, "
              "precipitation_mm double, season string, beaufort_scale string, is_taxi int")
    return spark.createDataFrame(rows, schema).cache()


def test_node_table_agrees_with_the_model(spark, trips, tmp_dir):
    model = ml.pipeline(num_trees=7, max_depth=6).fit(trips)
    forest.save(forest.flatten(model), tmp_dir)
    tables = forest.load(spark, tmp_dir)
    nodes = tables["nodes"]
    assert nodes.select("tree").distinct().count() == 7
    assert nodes.filter("categories IS NOT NULL").count() > 0 and nodes.filter("threshold IS NOT NULL").count() > 0
    assert nodes.filter("left >= 0 AND (threshold IS NULL) = (categories IS NULL)").count() == 0
    odd = trips.limit(1)
    more = trips.unionByName(odd.withColumn("season", F.lit("MONSOON"))).unionByName(odd.withColumn("distance", F.lit(float("nan")))) \
        .unionByName(odd.withColumn("temp_f", F.lit(None).cast("double"))).unionByName(odd.withColumn("season", F.lit(None).cast("string")))
    scored = ml.score(model, more, keep_unscored=True)
    both = forest.score(tables, scored, prediction="nodes")
    assert both.columns == [*scored.columns, "nodes", "nodes_share"]
    rows = both.collect()
    assert len(rows) == trips.count() + 4 and sum(r.nodes is None for r in rows) == 4
    assert all(r.prediction == r.nodes for r in rows) and {r.nodes for r in rows} == {0.0, 1.0, None}
    # the winning class's mean share is the model's probability
    shown = model.transform(trips).select("id", "probability").collect()
    share = {r.id: r.nodes_share for r in rows if r.nodes is not None}
    assert all(abs(max(r.probability) - share[r.id]) < 1e-9 for r in shown if r.id in share)


def test_a_single_leaf_and_no_rows(spark, trips, tmp_dir):
    """A forest that never splits; empty input."""
    model = ml.pipeline(num_trees=2, max_depth=0).fit(trips)
    forest.save(forest.flatten(model), tmp_dir)
    tables = forest.load(spark, tmp_dir)
    assert {r.prediction for r in ml.score(model, trips).select("prediction").distinct().collect()} == {
        r.p for r in forest.score(tables, trips, prediction="p").select("p").distinct().collect()}
    assert forest.score(tables, trips.limit(0)).count() == 0
