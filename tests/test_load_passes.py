"""Loads and reports compute what they use several times once."""

import datetime as dt
from decimal import Decimal

from helpers import dims, ts, tx
from pyspark.sql import functions as F

from fraudlake.plans import daily
from fraudlake.plans import warehouse as W
from fraudlake.schemas import ACCOUNTS, CARDS, CLIENTS, TERMINALS, TRANSACTIONS, TRANSACTIONS_RAW
from fraudlake.sources import intake


def raw_feed(spark, path):
    rows = [(str(i % 40), f"2024-01-{10 + i % 3} 10:00:0{i % 7}", "x" if i % 9 == 0 else "5,00", f"C{i % 4}", "payment", "SUCCESS", "T1")
            for i in range(50)]
    spark.createDataFrame(rows, TRANSACTIONS_RAW).withColumn("file_name", F.lit("transactions_10012024.txt")).write.parquet(path)
    return spark.read.parquet(path)


def test_feed_is_typed_once_per_load(spark, scratch, monkeypatch):
    raw = raw_feed(spark, f"{scratch}/raw")
    read = []
    for name, at in (("duplicates", 2), ("append_transactions", 2), ("write_rejects", 2), ("write_rejects", 3)):
        def spy(*a, _f=getattr(W, name), _at=at, **kw):
            read.extend(a[_at].inputFiles())
            return _f(*a, **kw)
        monkeypatch.setattr(W, name, spy)
    wh = W.Warehouse(f"{scratch}/wh")
    for _ in range(2):
        daily.load_transactions(spark, wh, raw)
    assert read and not [f for f in read if "/raw/" in f]
    refused = sorted((r["reason"], r["raw"]) for r in W.read_rejects(spark, wh).collect())
    assert len([r for r in refused if r[0] == "bad amount"]) == 6
    assert len([r for r in refused if r[0] == intake.REPEATED]) == 7 and len(refused) == 13
    assert W.read_fact(spark, wh).count() == 37


def op(tid, t, amount):
    return (tid, ts(t), Decimal(amount), "C1", "op", "SUCCESS", "T1")


def test_ids_that_occur_once_are_not_grouped(spark):
    """The same rows with the repeated ids known as without, null ids and equal rows included."""
    t = "2024-01-16 10:00:00"
    batch = spark.createDataFrame([op("1", t, 1), op("2", t, 2), op("2", t, 3), op("2", t, 3), op("3", t, 4), op("3", t, 4),
                                   op(None, t, 5), op(None, t, 6), op("4", t, 7), op("5", t, 8), op("6", t, 9), op("6", t, 8)],
                                  TRANSACTIONS)
    stored = spark.createDataFrame([op("1", t, 1), op("4", t, 70), op("6", t, 9), op("9", t, 9)], TRANSACTIONS)
    again = intake.repeated_ids(batch)
    assert {r[0] for r in again.collect()} == {"2", "3", "6", None}
    for f in (intake.new_transactions, intake.duplicate_transactions):
        want, got = (sorted(map(str, f(batch, stored, *a).collect())) for a in ((), (again,)))
        assert got == want and got
    assert [r["transaction_id"] for r in intake.new_transactions(batch, stored, again).collect()].count(None) == 1


def test_full_slice_is_computed_once(spark, scratch, monkeypatch):
    rows = [("T1", "ATM", "C1", "a", ts("2023-12-01 00:00:00")), ("T2", "POS", "C2", "b", ts("2023-12-01 00:00:00"))]
    spark.createDataFrame(rows, "terminal_id string, terminal_type string, terminal_city string, terminal_address string, "
                                "update_dt timestamp_ntz").write.parquet(f"{scratch}/src")
    read = []

    def spy(opened, staged, keys, *a, _f=W.scd2_step):
        read.extend(staged.inputFiles() + keys.inputFiles())
        return _f(opened, staged, keys, *a)
    monkeypatch.setattr(W, "scd2_step", spy)
    wh = W.Warehouse(f"{scratch}/wh")
    W.load_dim(spark, wh, TERMINALS, spark.read.parquet(f"{scratch}/src"), dt.datetime(2024, 1, 2))
    assert read and not [f for f in read if "/src/" in f]
    assert W.read_dim(spark, wh, TERMINALS).count() == 2


def test_report_reads_stored_state(spark, scratch, monkeypatch):
    """The cards' state before the first report day is computed once, then read."""
    wh = W.Warehouse(f"{scratch}/wh")
    W.append_transactions(spark, wh, tx(spark, [(f"{d}{k}", f"2024-01-{d} 10:0{k}:00", 9 - k, "C1", "REJECT" if k < 3 else "SUCCESS")
                                                for d in (14, 16) for k in range(4)]))
    cards, accounts, clients, _ = dims(spark, [("C1", "P1", None)])
    for spec, df in ((CARDS, cards), (ACCOUNTS, accounts), (CLIENTS, clients)):
        src = df.drop("effective_from", "effective_to", "deleted_flg").withColumn("update_dt", F.lit(None).cast("timestamp_ntz"))
        W.load_dim(spark, wh, spec, src.withColumn("create_dt", F.lit("2023-12-01").cast("timestamp_ntz")), dt.datetime(2024, 1, 2))
    used = []

    def spy(*a, _f=daily.fraud_report, **kw):
        used.append(kw["before"].inputFiles())
        return _f(*a, **kw)
    monkeypatch.setattr(daily, "fraud_report", spy)
    day = dt.date(2024, 1, 16)
    daily.write_day(spark, wh, day)
    daily.backfill(spark, wh, day, dt.date(2024, 1, 17))
    assert len(used) == 2
    for before in used:
        assert before and not [f for f in before if "/fact_transactions/" in f]
    assert [(r["event_type"], r["tr_id"]) for r in W.read_report(spark, wh).collect()] == [(4, "163")]
