"""Batch window counts: the two-level (bucket, then expand) plan against window()."""

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigil.operators.windows import _direct, transaction_counts


@pytest.mark.parametrize("window, slide", [("5 minutes", "1 minute"), ("10 minutes", "2 minutes"),
                                           ("1 hour", "15 minutes"), ("7 minutes", "3 minutes")])
def test_sliding_counts_equal_window_function(spark, window, slide):
    rnd = random.Random(3)
    t0 = datetime(2024, 3, 1, 8, 0, 0)
    rows = [(t0 + timedelta(seconds=rnd.randint(0, 6 * 3600), microseconds=rnd.randint(0, 999999)),)
            for _ in range(2000)] + [(None,)]
    df = spark.createDataFrame(rows, "transaction_timestamp timestamp")
    got = sorted(tuple(r) for r in transaction_counts(df, window, slide).collect())
    want = sorted(tuple(r) for r in _direct(df, "transaction_timestamp", window, slide).collect())
    assert got == want


def test_sliding_counts_keep_ntz_type(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0, 0, 30),)], "transaction_timestamp timestamp_ntz")
    out = transaction_counts(df, "5 minutes", "1 minute")
    assert dict(out.dtypes)["window_start"] == "timestamp_ntz"
    assert out.agg(F.sum("transaction_count")).first()[0] == 5


@settings(max_examples=6, deadline=None)
@given(seed=st.integers(0, 1000), slide_min=st.sampled_from([1, 2, 3, 5, 10, 15]), k=st.integers(2, 6))
def test_sliding_counts_property(spark, seed, slide_min, k):
    rnd = random.Random(seed)
    t0 = datetime(2024, 5, 1)
    rows = [(t0 + timedelta(seconds=rnd.randint(0, 20_000)),) for _ in range(300)]
    df = spark.createDataFrame(rows, "transaction_timestamp timestamp")
    window, slide = f"{k * slide_min} minutes", f"{slide_min} minutes"
    got = sorted(tuple(r) for r in transaction_counts(df, window, slide).collect())
    want = sorted(tuple(r) for r in _direct(df, "transaction_timestamp", window, slide).collect())
    assert got == want
