"""The path-to-path jobs (E1-E18) chained on the smallest tables, with the
invariants of the reference's printed checks."""

import os

import pytest
from pyspark.sql import functions as F

from tripwx.plans import fixtures, inputs, jobs
from tripwx.plans.oracle import DATA_YEAR
from tripwx.plans.q_io import write_zone_csv
from tripwx.sources import sinks

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_job_chain(spark, tmp_dir):
    b = tmp_dir
    # E1-E3 weather
    sinks.write_csv(fixtures.weather_raw(spark, SF), f"{b}/w_raw")
    n_clean = jobs.weather_clean_job(spark, f"{b}/w_raw", f"{b}/w_clean", table="default.w_clean_t")
    assert n_clean == spark.table("default.w_clean_t").count() > 0
    prof = jobs.weather_enrich_job(spark, f"{b}/w_clean", f"{b}/w_enr", DATA_YEAR)
    assert sum(r["count"] for r in prof["by_beaufort"].collect()) == n_clean
    assert jobs.weather_publish_job(spark, f"{b}/w_enr", [f"{b}/w_a", f"{b}/w_b"]) == n_clean
    # E4 / E5 / E6 taxi
    sinks.write_parquet(fixtures.taxi_raw(spark, SF).repartition(2), f"{b}/taxi_raw")
    write_zone_csv(spark, SF, f"{b}/zones.csv", header="LocationID,Borough,Zone,service_zone,longitude,latitude")
    n_taxi_raw = fixtures.taxi_raw(spark, SF).count()
    assert jobs.taxi_ingest_job(spark, f"{b}/taxi_raw", f"{b}/zones.csv", f"{b}/taxi_trips") == n_taxi_raw
    assert jobs.taxi_clean_job(spark, f"{b}/taxi_raw", f"{b}/taxi_clean") == n_taxi_raw
    summary = jobs.taxi_summary_job(spark, f"{b}/taxi_raw", f"{b}/taxi_len").collect()
    assert {r["record_count"] for r in summary} == {n_taxi_raw} and len(summary) == 5
    # E7 / E8 / E9 bike
    sinks.write_csv(fixtures.bike_raw(spark, SF).repartition(2), f"{b}/bike_raw")
    n_bike = jobs.bike_ingest_job(spark, f"{b}/bike_raw/*.csv", f"{b}/bike_trips")
    assert 0 < n_bike <= fixtures.bike_raw(spark, SF).count()
    bstats = jobs.bike_stats_job(spark, f"{b}/bike_raw/*.csv", f"{b}/bike_clean")
    assert len(bstats["stats"].collect()) == 3 and bstats["stddev"].first()[0] > 0
    sinks.write_csv(fixtures.bike_new(spark, SF), f"{b}/bike_new")
    assert jobs.bike_new_format_job(spark, f"{b}/bike_new", f"{b}/bike_new_out", 2024) > 0
    # E10 / E11 merges on the event-shaped trips (which overlap the weather hours)
    taxi, bike = inputs.taxi_and_bike(spark, SF)
    sinks.write_parquet(taxi, f"{b}/taxi")
    sinks.write_parquet(bike, f"{b}/bike")
    n_trips = taxi.count() + bike.count()
    n_left = jobs.merge_left_job(spark, f"{b}/taxi", f"{b}/bike", f"{b}/w_a", f"{b}/merged")
    assert n_left == n_trips                      # weather keys are unique per hour
    n_inner = jobs.merge_inner_job(spark, f"{b}/bike", f"{b}/taxi", f"{b}/w_a", f"{b}/merged_inner")
    assert n_inner <= n_left
    # E12 in place, twice: cleaning is idempotent
    sinks.write_parquet(spark.read.parquet(f"{b}/merged"), f"{b}/strict")
    first = jobs.clean_strict_job(spark, f"{b}/strict").first()
    second = jobs.clean_strict_job(spark, f"{b}/strict").first()
    assert first["rows_after"] == second["rows_before"] == second["rows_after"] <= first["rows_before"]
    # E13 imputation leaves no NULL weather measure
    rep = jobs.clean_impute_job(spark, f"{b}/merged", f"{b}/imputed", DATA_YEAR)
    assert all(v == 0 for v in rep["nulls"].first().asDict().values() if v is not None)
    funnel = [r["rows"] for r in rep["funnel"].orderBy("stage_no").collect()]
    assert funnel == sorted(funnel, reverse=True) and funnel[-1] == spark.read.parquet(f"{b}/imputed").count()
    # E14 profile
    prof = jobs.profile_job(spark, f"{b}/merged")
    assert prof["rows"].first()["rows"] == n_left and "top_dates" in prof
    # E15 analytics: bucket counts add up to the merged rows
    out = jobs.analytics_job(spark, f"{b}/merged", f"{b}/analytics")
    counts = spark.read.option("header", "true").option("inferSchema", "true").csv(out["taxi_bike_temp"])
    assert counts.agg(F.sum("count")).first()[0] == n_left
    # E16 / E17 model
    res = jobs.train_job(spark, f"{b}/merged", f"{b}/model")
    cm_total = res["confusion"].agg(F.sum("count")).first()[0]
    assert res["metrics"].first()["rows"] == cm_total > 0
    assert jobs.score_job(spark, f"{b}/model", f"{b}/merged", f"{b}/scored") > 0
    # E18 sensor
    sinks.write_csv(fixtures.sensor_raw(spark, SF), f"{b}/sensor_raw")
    srep = jobs.sensor_job(spark, f"{b}/sensor_raw", f"{b}/sensor_clean", f"{b}/sensor_enr", 2019)
    assert srep["by_borough"].count() > 0 and srep["means"].count() == 1
