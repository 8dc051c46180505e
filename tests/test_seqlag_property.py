"""Random sequences: bucketed lags always equal plain window lags."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fraudlake.operators.seqlag import Lag, sequence_lags

LAGS = [Lag("l1", "v", 1, -1), Lag("l2", "v", 2, -1), Lag("l3", "v", 3), Lag("l4", "v", 4, -1)]
rows_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 200), st.integers(0, 999)),
    min_size=1, max_size=60)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, bucket=st.sampled_from([60, 600, 3600]))
def test_bucketed_equals_window(spark, rows, bucket):
    base = dt.datetime(2024, 1, 1)
    data = [(k, base + dt.timedelta(minutes=m), f"{i:05d}", v) for i, (k, m, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, id string, v int")
    order = ["t", "id"]
    plain = sequence_lags(df, ["k"], order, LAGS, skew_safe=False)
    safe = sequence_lags(df, ["k"], order, LAGS, "t", bucket_seconds=bucket, hot_fraction=1e-9)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, safe.collect()), key=key) == sorted(map(tuple, plain.collect()), key=key)
