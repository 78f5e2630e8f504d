"""Property tests: the distributed selections agree with brute force on
random small inputs (including heavy duplicates, NULLs and negatives)."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tripwx.operators import profile as P

values = st.lists(st.one_of(st.none(), st.integers(-50, 50).map(lambda x: x / 4),
                            st.sampled_from([7.25, 7.25, 7.25, -0.0])), min_size=1, max_size=120)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(vals=values, p=st.sampled_from([0.01, 0.25, 0.5, 0.9, 1.0]))
def test_exact_quantile_matches_sorting(spark, vals, p):
    df = spark.createDataFrame([(v,) for v in vals], "a double")
    got = P.exact_quantile(df, ["a"], p, buckets=4, max_sort_values=8).collect()
    xs = np.sort([v for v in vals if v is not None])
    if len(xs) == 0:
        assert got == []
    else:
        assert got[0]["quantile"] == xs[max(0, int(np.ceil(round(p * len(xs), 9))) - 1)]


@SETTINGS
@given(vals=values)
def test_modes_match_counting(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "a double")
    got = P.modes(df, ["a"]).collect()
    present = [v for v in vals if v is not None]
    if not present:
        assert got == []
        return
    counts = {}
    for v in present:
        counts[v + 0.0] = counts.get(v + 0.0, 0) + 1
    best = max(counts.values())
    assert got[0]["mode_count"] == best
    assert got[0]["mode"] == min(v for v, c in counts.items() if c == best)


rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 20)), st.one_of(st.none(), st.integers(0, 3))),
                min_size=0, max_size=60)


@SETTINGS
@given(data=rows)
def test_funnel_matches_sequential_filters(spark, data):
    from pyspark.sql import functions as F

    from tripwx.operators import clean
    df = spark.createDataFrame(data, "a int, b int")
    rules = [clean.Rule("a_pos", F.col("a") > 0), clean.Rule("b_not_null", F.col("b").isNotNull()),
             clean.Rule("a_small", F.col("a") < 15)]
    got = [r["rows"] for r in clean.funnel(df, rules).orderBy("stage_no").collect()]
    expected, keep = [len(data)], data
    for f in (lambda r: r[0] is not None and r[0] > 0, lambda r: r[1] is not None,
              lambda r: r[0] is not None and r[0] < 15):
        keep = [r for r in keep if f(r)]
        expected.append(len(keep))
    assert got == expected


@SETTINGS
@given(vals=st.lists(st.one_of(st.none(), st.integers(-30, 30)), max_size=80), n=st.integers(1, 6))
def test_smallest_distinct_matches_sorted_set(spark, vals, n):
    df = spark.createDataFrame([(v,) for v in vals], "a int")
    assert P.smallest_distinct(df, "a", n, passes=1, rows_per_pass=1) == sorted({v for v in vals if v is not None})[:n]


@SETTINGS
@given(vals=st.lists(st.one_of(st.none(), st.integers(-400, 400).map(lambda x: x / 100)), min_size=1, max_size=50))
def test_exact_scale_mean_imputation(spark, vals):
    from tripwx.operators import clean
    df = spark.createDataFrame([(v,) for v in vals], "a double")
    out = [r["a"] for r in clean.impute_mean(df, ["a"], exact_scale=2).collect()]
    present = [v for v in vals if v is not None]
    if not present:
        assert out == vals
    else:
        cents = sum(round(v * 100) for v in present)
        mean = (cents / 100) / len(present)
        assert out == [v if v is not None else mean for v in vals]
