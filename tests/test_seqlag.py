"""Skew-safe lags equal plain window lags, with every key forced hot."""

from pyspark.sql import functions as F

from fraudlake.operators.seqlag import Lag, sequence_lags
from fraudlake.sources import fixture

SF = "/root/testdata/sf0.01"
LAGS = [Lag("p1", "amount", 1, 0), Lag("p4", "oper_result", 4, "0"), Lag("t2", "transaction_date", 2)]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_bucketed_lags_equal_window(spark):
    tr = fixture.transactions(spark, SF)
    order = ["transaction_date", "transaction_id"]
    plain = sequence_lags(tr, ["card_num"], order, LAGS, skew_safe=False)
    # one-minute buckets: almost every row sits at a bucket edge
    for secs in (60, 3600, 86400):
        safe = sequence_lags(tr, ["card_num"], order, LAGS, bucket_seconds=secs, hot_fraction=1e-9)
        assert rows(safe) == rows(plain)


def test_one_hot_key_among_cold(spark):
    tr = fixture.transactions(spark, SF)
    # one card takes a third of all rows
    hot = tr.withColumn("card_num", F.when(F.col("transaction_id").cast("int") % 3 == 0, "HOT")
                        .otherwise(F.col("card_num")))
    order = ["transaction_date", "transaction_id"]
    plain = sequence_lags(hot, ["card_num"], order, LAGS, skew_safe=False)
    safe = sequence_lags(hot, ["card_num"], order, LAGS, bucket_seconds=3600, hot_fraction=0.2)
    assert rows(safe) == rows(plain)


def test_default_parameters_with_a_hot_key_and_null_keys(spark):
    tr = fixture.transactions(spark, SF)
    n = F.col("transaction_id").cast("int")
    hot = tr.withColumn("card_num", F.when(n % 3 == 0, "HOT").when(n % 7 == 1, F.lit(None).cast("string"))
                        .otherwise(F.col("card_num")))
    order = ["transaction_date", "transaction_id"]
    safe = sequence_lags(hot, ["card_num"], order, LAGS)
    assert rows_of(safe) == rows_of(sequence_lags(hot, ["card_num"], order, LAGS, skew_safe=False))
    # rows without a card are not paired with each other
    alone = safe.filter("card_num is null").agg(F.count("t2"), F.max("p1"), F.max("p4")).first()
    assert tuple(alone) == (0, 0, "0")


def test_buckets_ignore_session_time_zone(spark):
    import datetime as dt
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # minutes around the spring-forward gap (02:00-03:00 local does not exist)
        base = dt.datetime(2024, 3, 10, 1, 0)
        rows = [("k", base + dt.timedelta(minutes=7 * i), f"{i:04d}", i) for i in range(60)]
        df = spark.createDataFrame(rows, "k string, t timestamp_ntz, id string, v int")
        lags = [Lag("p1", "v", 1), Lag("p3", "v", 3)]
        plain = sequence_lags(df, ["k"], ["t", "id"], lags, skew_safe=False)
        safe = sequence_lags(df, ["k"], ["t", "id"], lags, "t", bucket_seconds=3600, hot_fraction=1e-9)
        assert rows_of(safe) == rows_of(plain)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def rows_of(df):
    return sorted((tuple((x is not None, x) for x in r) for r in df.collect()))
