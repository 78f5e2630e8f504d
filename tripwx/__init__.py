"""tripwx: trip and hourly-weather analytics as Spark DataFrame functions.

Layout
    functions.columns   Column builders (season, Beaufort, flags, buckets, haversine, durations)
    operators           schema alignment, validation rules, joins, profiling, model operators
    sources             Parquet / CSV sources, sinks, tables, safe in-place overwrite
    plans               the published pipelines and path-to-path jobs (plans.jobs)
    session             session builder, cluster settings, shared scratch folders
"""
