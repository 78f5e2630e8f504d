"""Shared inputs of the registered queries, built from the test views."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripwx.plans import fixtures, merge, trips, weather
from tripwx.plans.oracle import DATA_YEAR


def published_weather(spark, sf):
    return weather.published(fixtures.weather_raw(spark, sf), DATA_YEAR)


def enriched_weather(spark, sf):
    return weather.enriched(weather.cleaned(fixtures.weather_raw(spark, sf)), DATA_YEAR)


def taxi_and_bike(spark, sf):
    t = fixtures.trips(spark, sf)
    return t.filter(F.col("is_taxi") == 1), t.filter(F.col("is_taxi") == 0)


def merged_left(spark, sf):
    taxi, bike = taxi_and_bike(spark, sf)
    return merge.merge_left(taxi, bike, published_weather(spark, sf))


def taxi_trips(spark, sf):
    return trips.taxi_trips(fixtures.taxi_raw(spark, sf), fixtures.zones(spark, sf))


def bike_trips(spark, sf, **kw):
    return trips.bike_trips(fixtures.bike_raw(spark, sf), **kw)
