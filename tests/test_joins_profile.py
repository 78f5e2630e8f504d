import random

import numpy as np
import pytest

from tripwx.operators import joins
from tripwx.operators import profile as P


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_small_broadcast_and_fallbacks_agree(spark):
    fact = spark.createDataFrame([(i % 7, i) for i in range(500)] + [(3, -1)] * 400, "k int, v int")
    dim = spark.range(5).selectExpr("CAST(id AS int) AS k", "concat('d', id) AS name")
    b = joins.join_small(fact, dim, ["k"], "left")
    assert "BroadcastHashJoin" in b._jdf.queryExecution().sparkPlan().toString()
    shuffle = joins.join_small(fact, dim, ["k"], "left", max_bytes=0)
    salted = joins.join_small(fact, dim, ["k"], "left", max_bytes=0, salt_buckets=4)
    expected = sorted(map(tuple, b.collect()), key=str)
    assert sorted(map(tuple, shuffle.collect()), key=str) == expected
    assert sorted(map(tuple, salted.collect()), key=str) == expected
    assert b.count() == fact.count()          # unique dim keys: LEFT keeps every fact row
    assert b.columns[0] == "k"                 # USING semantics: key first, once
    with pytest.raises(ValueError):
        joins.join_small(fact, dim, ["k"], "right", max_bytes=0, salt_buckets=4)


def test_join_small_runs_and_keeps_nothing(spark):
    fact = spark.range(100).selectExpr("id % 7 AS k", "id AS v")
    dim = spark.range(7).selectExpr("id AS k", "id * 2 AS w").repartition(4)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "join_small")
    joins.join_small(fact, dim, ["k"], "left")
    assert len(tracker.getJobIdsForGroup("planning")) == 0
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_modes_exact_types(spark):
    big = 9007199254740992
    df = spark.createDataFrame([(big + 1, float("nan")), (big + 1, float("nan")), (big, float("nan")), (None, 1.0), (None, 1.0)],
                               "b bigint, d double")
    assert [tuple(r) for r in P.modes(df, ["b"]).collect()] == [("b", big + 1, 2)]
    assert [tuple(r) for r in P.modes(df, ["d"]).collect()] == [("d", 1.0, 2)]


def test_table_profile_and_sample(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, s string")
    assert [tuple(r)[:6] for r in P.table_profile(df).collect()] == [("a", 1, "int", 2, 2, 0), ("s", 2, "string", 2, 2, 1)]
    assert P.sample_rows(df, -3).count() == 0 and P.sample_rows(df, 1).count() == 1


def test_summary_of_an_empty_table(spark):
    out = P.dataset_summary(spark.createDataFrame([], "a double"), ["a"], stddev_of="a").first()
    assert out["record_count"] == 0 and all(np.isnan(out[c]) for c in ("mean", "median", "mode", "a_stddev"))


def test_unions(spark):
    a = spark.createDataFrame([(1, 2.0)], "x int, y double")
    b = spark.createDataFrame([(3.5, 4)], "y double, x int")
    assert joins.union_by_name(a, b).collect()[1]["x"] == 4
    assert joins.union_positional(a, a, a).count() == 3


def test_exact_quantile_matches_numpy_with_hot_value(spark):
    rnd = random.Random(7)
    vals = [rnd.randint(0, 5000) / 7 for _ in range(3000)] + [42.0] * 1500 + [None] * 50
    df = spark.createDataFrame([(v, None if v is None else int(v) % 13) for v in vals], "a double, b int")
    got = {r["column_name"]: r["quantile"] for r in P.exact_quantile(df, ["a", "b"], 0.5, buckets=16).collect()}
    for col, idx in (("a", 0), ("b", 1)):
        xs = np.sort(np.array([v if idx == 0 else int(v) % 13 for v in vals if v is not None], dtype=float))
        k = int(np.ceil(0.5 * len(xs))) - 1
        assert got[col] == xs[k]
    q90 = P.exact_quantile(df, ["a"], 0.9, buckets=8).first()["quantile"]
    xs = np.sort([v for v in vals if v is not None])
    assert q90 == xs[int(np.ceil(0.9 * len(xs))) - 1]


def test_modes_tie_smallest_and_null_ignored(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (2.0, "b"), (1.0, "a"), (None, None), (None, None),
                                (None, None)], "x double, s string")
    m = {r["column_name"]: (r["mode"], r["mode_count"]) for r in P.modes(df, ["x"]).collect()}
    assert m["x"] == (1.0, 2)
    t = {r["column_name"]: r["mode"] for r in P.modes(df, ["s"], dtype="string").collect()}
    assert t["s"] == "a"
    hh = {r["column_name"]: r["mode"] for r in P.modes_heavy_hitters(df, ["x"], 0.01).collect()}
    assert hh["x"] == 1.0


def test_counts_on_empty_input_are_zero(spark):
    df = spark.createDataFrame([], "a double, b string")
    r = P.null_counts(df).first()
    assert (r["a"], r["b"]) == (0, 0)
    assert P.row_count(df).first()["rows"] == 0


def test_distinct_counts_count_null_as_value(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "a int")
    assert P.distinct_counts(df, ["a"]).first()[0] == 3
    assert P.distinct_counts(df, ["a"], count_null=False).first()[0] == 2


def test_distinct_bounded_flag(spark):
    df = spark.createDataFrame([(i,) for i in range(30)] + [(None,)], "a int")
    out = P.distinct_bounded(df, "a", 10).collect()
    assert [r["a"] for r in out] == list(range(10)) and all(r["has_more"] for r in out)
    few = P.distinct_bounded(df.filter("a < 5"), "a", 10).collect()
    assert len(few) == 5 and not any(r["has_more"] for r in few)


def test_top_k_ties_by_key(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "d string")
    assert [tuple(r) for r in P.top_k(df, "d", 2).collect()] == [("c", 2), ("a", 1)]


def test_describe_typed_matches_describe(spark):
    df = spark.createDataFrame([(1.0, 10), (2.0, 20), (4.0, None)], "x double, y int")
    t = {r["column_name"]: r for r in P.describe_typed(df, ["x", "y"]).collect()}
    d = {r["summary"]: r for r in P.describe(df, ["x", "y"]).collect()}
    assert t["x"]["count"] == int(d["count"]["x"]) == 3
    assert abs(t["x"]["mean"] - float(d["mean"]["x"])) < 1e-12
    assert t["y"]["max"] == 20.0


def test_stats_table_shape(spark):
    df = spark.createDataFrame([(40.1, -74.0), (40.2, -73.9), (40.2, -73.9)], "`lat x` double, `lng y` double")
    out = P.stats_table(df, {"lat x": "Lat", "lng y": "Lng"}).collect()
    by = {r["Stat_Type"]: r for r in out}
    assert set(by) == {"Mean", "Median", "Mode"}
    assert by["Mode"]["Lat"] == 40.2 and by["Median"]["Lng"] == -73.9


def test_exact_quantile_refines_until_small(spark):
    rnd = random.Random(11)
    vals = [rnd.random() * 1000 for _ in range(5000)] + [500.0] * 2500
    df = spark.createDataFrame([(v,) for v in vals], "a double")
    xs = np.sort(vals)
    for p in (0.1, 0.5, 0.77):
        got = P.exact_quantile(df, ["a"], p, buckets=4, max_sort_values=50).first()["quantile"]
        assert got == xs[int(np.ceil(p * len(xs))) - 1]


def test_exact_quantile_heavy_tail_and_infinities(spark):
    rnd = random.Random(3)
    vals = [rnd.random() for _ in range(3000)] + [1e300, -1e250, float("inf"), float("-inf"), float("nan")]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "a double")
    xs = np.sort([v for v in vals if not np.isnan(v)])
    for p in (0.0001, 0.5, 0.9999, 1.0):
        got = P.exact_quantile(df, ["a"], p, buckets=8, max_sort_values=40).first()["quantile"]
        assert got == xs[max(0, int(np.ceil(p * len(xs))) - 1)]
    only_inf = spark.createDataFrame([(float("inf"),), (float("-inf"),), (None,)], "a double")
    assert P.exact_quantile(only_inf, ["a"], 0.5).first()["quantile"] == float("-inf")
    empty = spark.createDataFrame([(None,)], "a double")
    assert P.exact_quantile(empty, ["a"], 0.5).count() == 0


def test_stats_table_approx_median(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "`lat x` double")
    by = {r["Stat_Type"]: r for r in P.stats_table(df, {"lat x": "Lat"}, median="approx").collect()}
    assert abs(by["Median"]["Lat"] - 50.0) <= 1.0 and by["Mean"]["Lat"] == 50.0


def test_fallback_join_splits_hot_key(spark):
    """Dimension above the broadcast bound: shuffle join; a key holding a
    third of the fact rows is split by AQE's skew-join handling."""
    keys = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        n = 30000
        fact = spark.range(n).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "id AS v")
        dim = spark.range(n).selectExpr("id AS k", "concat('d', id) AS name")
        out = joins.join_small(fact, dim, ["k"], "left", max_bytes=0)
        assert len(out.collect()) == n                # runs this plan, so AQE finalizes it
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_modes_reuse_the_counts_shuffle(spark):
    df = spark.range(5000).selectExpr("CAST(id % 37 AS DOUBLE) AS a", "CAST(id % 11 AS DOUBLE) AS b")
    out = P.modes(df, ["a", "b"])
    assert len(out.collect()) == 2                     # runs this plan, so AQE finalizes it
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan and "SortAggregate" not in plan
