"""Value counts, counter-sketch modes and stored sketches against plain Python."""

import math
import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tripwx.operators import profile as P
from tripwx.operators import sketches, value_counts

INF, NAN = float("inf"), float("nan")
SCHEMA = "a bigint, b double, c string, d int"


def made(rng, n):
    big = 2 ** 53
    return [(rng.choice([None, 1, 2, 3, big, big + 1]), rng.choice([None, NAN, INF, -INF, -0.0, 0.0, 1.5, rng.gauss(0, 1e6)]),
             rng.choice([None, "x", "y", "it's"]), rng.randrange(1000)) for _ in range(n)]


def disc(values, p):
    values = sorted(v for v in values if v is not None and not math.isnan(v))
    return float(values[max(1, math.ceil(round(p * len(values), 9))) - 1]) if values else None


def best(values):
    counts = Counter(v + 0 if isinstance(v, float) else v for v in values if v is not None and v == v)
    return min((-n, v) for v, n in counts.items())[::-1] if counts else None


@pytest.mark.parametrize("limit", [1, 5, 10_000])
def test_state_against_python(spark, limit):
    """``limit`` 1 sends every quantile through the range-partitioned path."""
    rows = made(random.Random(limit), 700)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    state = value_counts.merge_counts([value_counts.count_values(df.filter(f"d % 3 = {k}"), list("abcd")) for k in range(3)]).persist()
    columns = dict(zip("abcd", zip(*rows)))
    for p in (0.0, 0.1, 0.5, 0.99, 1.0):
        got = value_counts.quantiles_of(state, p, limit)
        assert got == {c: disc(columns[c], p) for c in "abd"}, p
    modes = {r.column_name: (next(v for v in (r.whole, r.real, r.text) if v is not None), -r.n) for r in value_counts.modes_of(state).collect()}
    assert modes == {c: best(v) for c, v in columns.items()}
    moments = {r.column_name: r for r in value_counts.moments_of(state).collect()}
    for c in "ad":
        values = [v for v in columns[c] if v is not None]
        assert (moments[c].rows, moments[c].values) == (700, len(values))
        assert moments[c].mean == pytest.approx(sum(values) / len(values))
        assert moments[c].stddev == pytest.approx(statistics.stdev(values))
    state.unpersist()


def test_heavy_tail_and_hot_value(spark):
    """An outlier that leaves all other values in one bucket, and a value that a third of the rows share."""
    rows = [(float(i % 997),) for i in range(4000)] + [(1e300,)] + [(5.0,)] * 2000
    state = value_counts.count_values(spark.createDataFrame(rows, "x double"), ["x"])
    for p in (0.25, 0.5, 0.75):
        assert value_counts.quantiles_of(state, p, 50) == {"x": disc([r[0] for r in rows], p)}


def test_empty_and_null_columns(spark):
    df = spark.createDataFrame([], SCHEMA)
    state = value_counts.count_values(df, list("abcd"))
    assert value_counts.quantiles_of(state, 0.5) == {} and value_counts.modes_of(state).count() == 0
    row = P.dataset_summary(df, ["a", "b"], stddev_of="d").collect()
    assert [(r.record_count, math.isnan(r.mean), math.isnan(r.median), math.isnan(r["mode"])) for r in row] == [(0, True, True, True)] * 2
    nulls = spark.createDataFrame([(None, NAN, None, 1)] * 3, SCHEMA)
    assert [tuple(map(str, r)) for r in P.dataset_summary(nulls, ["a", "d"], stddev_of="d").orderBy("column_name").collect()] == [
        ("a", "3", "0.0", "nan", "nan", "nan"), ("d", "3", "0.0", "1.0", "1.0", "1.0")]


def test_summary_scans_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch
    df = spark.range(1000).selectExpr("id", "id % 7 AS k").mapInArrow(counted, "id bigint, k bigint")
    rows = P.dataset_summary(df, ["id", "k"], stddev_of="id").collect()
    assert [r.median for r in sorted(rows, key=lambda r: r.column_name)] == [499.0, 3.0]
    assert seen.value == 1000


def test_counter_modes_scan_at_most_twice(spark):
    """Few values (exact in the sketch), a heavy one among many, near-unique
    ones, big whole numbers that a double cannot hold, text and NULL columns."""
    rng = random.Random(6)
    big = 2 ** 60
    rows = [(i % 3, 7 if i % 4 == 0 else 1000 + i, i if i != 500 else 501, big + (1 if i % 50 else 0), None, rng.choice(["p", "q"]))
            for i in range(8000)]
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch
    schema = "few int, heavy bigint, near bigint, wide bigint, none double, text string"
    df = spark.createDataFrame(rows, schema).repartition(4).mapInArrow(counted, schema)
    got = {r.column_name: (r["mode"], r.mode_count) for r in P.modes_heavy_hitters(df, ["few", "heavy", "near", "wide", "none"], 0.02, "bigint").collect()}
    assert got == {"few": (0, 2667), "heavy": (7, 2000), "near": (501, 2), "wide": (big + 1, 7840)}
    assert seen.value <= 16_000
    text = P.modes_heavy_hitters(df, ["text"], 0.02, "string").first()
    counts = Counter(r[5] for r in rows)
    assert (text["mode"], text.mode_count) == min(((v, n) for v, n in counts.items()), key=lambda x: (-x[1], x[0]))


def test_sketches_merge_and_keep_their_error(spark):
    rng = random.Random(8)
    rows = [(i % 5, rng.gauss(0, 1), rng.randrange(3000), None) for i in range(20_000)] + [(0, NAN, None, None)]
    df = spark.createDataFrame(rows, "part int, x double, k int, none double").repartition(6)
    quantiles = sketches.quantile_sketches(df, ["x", "k", "none"], by=["part"])
    assert {r.column_name for r in quantiles.collect()} == {"x", "k"}
    for p in (0.1, 0.5, 0.9):
        check = sketches.rank_check(df, sketches.sketched_quantiles(quantiles, p), p, 3 * sketches.quantile_error()).collect()
        assert {(r.column_name, r.rows, r.within) for r in check} == {("x", 20_000, True), ("k", 20_000, True)}
    wrong = spark.createDataFrame([("x", 0.5)], "column_name string, quantile double")
    assert not sketches.rank_check(df, wrong, 0.5, 0.001).first().within
    distinct = sketches.distinct_sketches(df, ["k", "none"], by=["part"])
    exact = sketches.distinct_by_column(df, ["k", "none"])
    assert {r.column_name: r.distinct for r in exact.collect()} == {"k": len({r[2] for r in rows} - {None}), "none": 0}
    assert all(r.within for r in sketches.error_check(sketches.sketched_distinct(distinct), exact, 4 * sketches.distinct_error()).collect())
    assert "Expand" not in exact._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="several kinds"):
        sketches.merged(distinct.unionByName(quantiles))


def test_impute_with_funnel_is_one_aggregate(spark):
    from tripwx.operators import clean
    df = spark.createDataFrame([(1, 2.0), (2, None), (3, 4.0), (None, 8.0), (9, 100.0)], "k int, v double")
    rules = [clean.Rule("known", F.col("k").isNotNull()), clean.Rule("small", F.col("k") < 5)]
    filled, funnel = clean.impute_with_funnel(df, rules, ["v", "absent"], exact_scale=3)
    assert [tuple(r) for r in funnel.orderBy("stage_no").collect()] == [(0, "input", 5), (1, "known", 4), (2, "small", 3)]
    assert sorted(tuple(r) for r in filled.collect()) == [(1, 2.0), (2, 3.0), (3, 4.0)]
    assert sorted(tuple(r) for r in clean.impute_mean(clean.apply_rules(df, rules), ["v"], 3).collect()) == [(1, 2.0), (2, 3.0), (3, 4.0)]


def test_stored_dedup_moves_hashes_only(spark, tmp_dir):
    from tripwx.operators import clean
    rows = [(i % 400, f"row {i % 400} " + "x" * 50, None if i % 3 else -0.0) for i in range(500)] + [(7, "hot", 0.0)] * 300
    spark.createDataFrame(rows, "a int, b string, c double").repartition(4).write.parquet(tmp_dir)
    df = spark.read.parquet(tmp_dir)
    got = clean.dedup_stored(df)
    def plain(frame):
        return sorted(str((a, b, c if c is None else c + 0.0)) for a, b, c in frame.collect())        # -0.0 and 0.0 are one value
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1            # of the repeated rows alone
    assert plain(got) == plain(clean.dedup(df))
    assert plain(clean.dedup_stored(df, max_repeated=3)) == plain(got)


def test_lookup_rejects(spark, tmp_dir):
    from tripwx.sources import csv as csv_src
    lines = ["id,name,_reject", '1,"a, ""b""",x', "2,short", "3,one,two,three", '4,"one, two"', '5,"ok",', ""]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(tmp_dir)
    rows, rejects = csv_src.scan_lookup_csv_checked(spark, tmp_dir, ["name", "id"])
    assert sorted(map(tuple, rows.collect())) == [('a, "b"', "1"), ("ok", "5")]
    assert sorted((r.line, r.fields, r.expected, r.reason) for r in rejects.collect()) == [
        ("2,short", 2, 3, "too few fields"), ("3,one,two,three", 4, 3, "too many fields"), ('4,"one, two"', 2, 3, "too few fields")]
    assert rows.count() == csv_src.scan_lookup_csv(spark, tmp_dir).count()


def test_stored_merge_shuffles_nothing(spark, tmp_dir):
    from tripwx.plans import merge
    trips = spark.range(200).selectExpr("date_add(DATE'2024-01-01', CAST(id % 7 AS int)) AS date", "CAST(id % 24 AS int) AS time_hours", "id")
    weather = spark.range(100).selectExpr("date_add(DATE'2024-01-01', CAST(id % 5 AS int)) AS date", "CAST(id % 24 AS int) AS time_hours",
                                          "id AS temp").dropDuplicates(["date", "time_hours"])
    merge.store_for_merges(trips, weather, tmp_dir, "stored_trips", "stored_weather", 4)
    got = merge.merge_stored(spark, "stored_trips", "stored_weather")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan.replace("BroadcastExchange", "Exchange")
    assert sorted(map(str, got.collect())) == sorted(map(str, trips.join(weather, ["date", "time_hours"], "left").collect()))
    for name in ("stored_trips", "stored_weather"):
        spark.sql(f"DROP TABLE {name}")
