"""The id index, the cards' state between days, and refused workbooks."""

import datetime as dt
import os
import random

import pytest
from helpers import tx, ts
from pyspark.sql import functions as F
from xlsx import write_xlsx

from fraudlake.operators import rules
from fraudlake.plans import cardstate, daily, idindex
from fraudlake.plans import warehouse as W
from fraudlake.schemas import BLACKLIST, TERMINALS

DAY = dt.date(2024, 1, 16)


def stored(spark, wh):
    return sorted((r["transaction_id"], str(r["amount"])) for r in W.read_fact(spark, wh).collect())


# --- id index ---------------------------------------------------------------------

def test_index_follows_appends_and_merges(spark, scratch, monkeypatch):
    monkeypatch.setattr(idindex, "FAN", 2)
    wh = W.Warehouse(f"{scratch}/wh")
    for i in range(5):
        W.append_transactions(spark, wh, tx(spark, [(str(10 + i + k), f"2024-01-{10 + i} 10:00:00", i, "C1", "SUCCESS")
                                                    for k in (0, 1)]))
    assert stored(spark, wh) == [("10", "0.00"), ("11", "0.00"), ("12", "1.00"), ("13", "2.00"), ("14", "3.00"), ("15", "4.00")]
    ids = sorted((r["transaction_id"], r["event_date"].day) for r in idindex.ids(spark, wh).collect())
    assert ids == [("10", 10), ("11", 10), ("12", 11), ("13", 12), ("14", 13), ("15", 14)]
    live, every = idindex._folders(spark, wh)
    assert len(live) == 2 and sorted(f[:2] for f in live) == ["L0", "L2"] and len(every) == 8


def test_append_that_died_before_its_index(spark, scratch, monkeypatch):
    wh = W.Warehouse(f"{scratch}/wh")
    one = tx(spark, [("1", "2024-01-16 10:00:00", 5, "C1", "SUCCESS")])
    two = tx(spark, [("2", "2024-01-17 10:00:00", 6, "C1", "SUCCESS")])
    W.append_transactions(spark, wh, one)

    def die(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(idindex, "_write", die)
        with pytest.raises(RuntimeError):
            W.append_transactions(spark, wh, two)
    assert idindex.ids(spark, wh).count() == 1
    bad = tx(spark, [("2", "2024-01-18 10:00:00", 7, "C1", "SUCCESS"), ("3", "2024-01-18 10:00:00", 8, "C1", "SUCCESS")])
    assert [r["reason"] for r in W.duplicates(spark, wh, bad).collect()] == ["transaction_id stored with other values"]
    W.append_transactions(spark, wh, bad)
    W.append_transactions(spark, wh, two)
    assert stored(spark, wh) == [("1", "5.00"), ("2", "6.00"), ("3", "8.00")]


def test_fact_without_an_index_is_indexed_once(spark, scratch):
    wh = W.Warehouse(f"{scratch}/wh")
    old = tx(spark, [("7", "2024-01-16 10:00:00", 5, "C1", "SUCCESS")]).withColumn("event_date", F.to_date("transaction_date"))
    old.write.partitionBy("event_date").parquet(wh.fact)
    W.append_transactions(spark, wh, tx(spark, [("7", "2024-01-19 10:00:00", 1, "C1", "SUCCESS"),
                                                ("8", "2024-01-19 10:00:00", 1, "C1", "SUCCESS")]))
    assert stored(spark, wh) == [("7", "5.00"), ("8", "1.00")]


# --- cards' last operations -----------------------------------------------------------

def guess_days(spark, wh, first, last, **kw):
    fact, out = W.read_fact(spark, wh), {}
    day = first
    while day <= last:
        got = rules.guessing_on_day(fact, day, before=cardstate.before(spark, wh, day), **kw)
        out[day] = sorted(r["transaction_id"] for r in got.collect())
        cardstate.store(spark, wh, day)
        day += dt.timedelta(days=1)
    return out


@pytest.mark.parametrize("strict", [False, True])
def test_state_gives_the_same_hits_as_all_history(spark, scratch, strict):
    rng = random.Random(8)
    wh = W.Warehouse(f"{scratch}/wh")
    rows, t = [], ts("2024-01-14 00:00:00")
    for i in range(900):
        t += dt.timedelta(minutes=rng.choice([0, 1, 5, 9]))
        rows.append((f"{i:04}", str(t), 900 - i % 40 * 20, rng.choice(["C1", "C1", "C2", "C3"]),
                     rng.choice(["REJECT", "REJECT", "REJECT", "SUCCESS"])))
    rows.append(("9999", "2024-01-01 00:00:00", 5000, "C9", "REJECT"))
    ops = tx(spark, rows)
    W.append_transactions(spark, wh, ops)
    every = rules.with_guessing(ops, "20 minutes", strict).filter("is_guess").select("transaction_id", F.to_date("transaction_date").alias("d"))
    want = {}
    for r in every.collect():
        want.setdefault(r["d"], []).append(r["transaction_id"])
    last = t.date()
    got = guess_days(spark, wh, dt.date(2024, 1, 14), last, strict=strict)
    assert {d: x for d, x in got.items() if x} == {d: sorted(x) for d, x in want.items()} and len(want) >= 2
    state = cardstate.before(spark, wh, last + dt.timedelta(days=1)).groupBy("card_num").count().collect()
    assert {r["card_num"]: r["count"] for r in state} == {"C1": 4, "C2": 4, "C3": 4, "C9": 1}


def test_daily_state_reads_the_day_only(spark, scratch):
    wh = W.Warehouse(f"{scratch}/wh")
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(6)]
    W.append_transactions(spark, wh, tx(spark, [(f"{i}{k}", f"{d} 10:0{k}:00", 9 - k, "C1", "REJECT" if k < 3 else "SUCCESS")
                                                for i, d in enumerate(days) for k in range(4)]))
    cardstate.store(spark, wh, days[4])
    got = rules.guessing_on_day(W.read_fact(spark, wh), days[5], before=cardstate.before(spark, wh, days[5]))
    plan = got._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.split("\n") if "fact_transactions" in x]
    assert scans and all("event_date" in x and "= 2024-01-06" in x for x in scans)
    assert [r["transaction_id"] for r in got.collect()] == ["53"]


def test_late_operations_outdate_the_state(spark, scratch):
    wh = W.Warehouse(f"{scratch}/wh")
    W.append_transactions(spark, wh, tx(spark, [("1", "2024-01-14 10:00:00", 9, "C1", "SUCCESS")]))
    for d in (14, 15):
        cardstate.store(spark, wh, dt.date(2024, 1, d))
    W.append_transactions(spark, wh, tx(spark, [("2", "2024-01-15 10:00:00", 8, "C1", "REJECT")]))
    assert cardstate._newest(spark, wh, DAY)[1] == dt.date(2024, 1, 14)
    got = cardstate.before(spark, wh, DAY)
    assert sorted(r["transaction_id"] for r in got.collect()) == ["1", "2"]
    cardstate.store(spark, wh, dt.date(2024, 1, 15))
    assert cardstate._newest(spark, wh, DAY)[1] == dt.date(2024, 1, 15)


# --- refused workbooks -------------------------------------------------------------------

def listing(spark, wh):
    return sorted(r["passport"] for r in W.read_blacklist(spark, wh).collect())


@pytest.mark.parametrize("kind, reason", [("corrupt", "unreadable file"), ("empty", daily.EMPTY), ("bad dates", daily.EMPTY),
                                          ("shrunk", daily.SHRUNK)])
@pytest.mark.parametrize("command", ["run-day", "run-landing"])
def test_bad_blacklist_keeps_the_listing(spark, scratch, kind, reason, command):
    land, wh = f"{scratch}/landing", W.Warehouse(f"{scratch}/wh")
    os.makedirs(land)
    was = [(ts(f"2024-01-0{i} 00:00:00"), f"PP{i}") for i in range(1, 6)]
    W.replace_blacklist(spark, wh, spark.createDataFrame(was, BLACKLIST), dt.datetime(2024, 1, 15))
    path = f"{land}/passport_blacklist_16012024.xlsx"
    if kind == "corrupt":
        with open(path, "wb") as f:
            f.write(b"not a workbook")
    else:
        rows = {"empty": [], "bad dates": [["soon", "PP1"], ["later", "PP2"]], "shrunk": [["2024-01-01", "PP1"], ["2024-01-09", "PP9"]]}
        write_xlsx(path, [["date", "passport"], *rows[kind]])
    write_xlsx(f"{land}/terminals_16012024.xlsx", [["terminal_id", "terminal_type", "terminal_city", "terminal_address"],
                                                   ["T1", "ATM", "M", "a"], [None, "POS", "K", "b"]])
    if command == "run-day":
        daily.load_feeds(spark, wh, daily.feeds_from_folder(spark, land, DAY), dt.datetime(2024, 1, 16))
    else:
        assert "passport_blacklist" not in daily.run_landing(spark, wh, land, dt.datetime(2024, 1, 16))
    assert listing(spark, wh) == [f"PP{i}" for i in range(1, 6)]
    reasons = [r["reason"] for r in W.read_rejects(spark, wh).collect()]
    assert any(r.startswith(reason) for r in reasons) and "missing terminal_id" in reasons
    assert W.read_dim(spark, wh, TERMINALS).count() == 1


def test_listing_of_a_new_month_may_be_short(spark, scratch):
    land, wh = f"{scratch}/landing", W.Warehouse(f"{scratch}/wh")
    os.makedirs(land)
    was = [(ts(f"2024-01-0{i} 00:00:00"), f"PP{i}") for i in range(1, 6)]
    W.replace_blacklist(spark, wh, spark.createDataFrame(was, BLACKLIST), dt.datetime(2024, 1, 31))
    write_xlsx(f"{land}/passport_blacklist_01022024.xlsx", [["date", "passport"], ["2024-02-01", "PP9"]])
    daily.load_feeds(spark, wh, daily.feeds_from_folder(spark, land, dt.date(2024, 2, 1)), dt.datetime(2024, 2, 1))
    assert listing(spark, wh) == ["PP9"]
