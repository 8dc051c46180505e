"""Storage faults: only committed loads are read, and a load replaces what it must."""

import datetime as dt

import pytest
from helpers import D0, OPEN, tx, ts

from fraudlake.plans import daily
from fraudlake.plans import warehouse as W
from fraudlake.schemas import ACCOUNTS, BLACKLIST, CARDS, CLIENTS, REJECTS, REPORT
from fraudlake.sources.intake import REPEATED, STORED, duplicate_transactions, new_transactions

DAY = dt.date(2024, 1, 16)


def clients(spark, rows):
    """rows: (client_id, phone, update 'YYYY-MM-DD HH:MM:SS' or None[, passport])."""
    out = [(r[0], "L", "F", None, D0, r[3] if len(r) > 3 else "PP" + r[0], None, r[1], D0,
            ts(r[2]) if r[2] else None) for r in rows]
    return spark.createDataFrame(out, CLIENTS.source)


def hist(df):
    return sorted((r["client_id"], r["phone"], str(r["effective_from"]), str(r["effective_to"]), r["deleted_flg"])
                  for r in df.collect())


def test_versions_closed_on_the_report_day_are_read(spark, scratch):
    wh = W.Warehouse(f"{scratch}/wh")
    mid = dt.datetime(2024, 1, 16)          # the command line's default run time: midnight of the day
    W.load_dim(spark, wh, CARDS, spark.createDataFrame([("C1", "A1", D0, None)], CARDS.source), mid)
    W.load_dim(spark, wh, ACCOUNTS, spark.createDataFrame(
        [("A1", dt.datetime(2030, 1, 1), "1", D0, None)], ACCOUNTS.source), mid)
    W.load_dim(spark, wh, CLIENTS, clients(spark, [("1", "+70", None)]), dt.datetime(2024, 1, 15))
    W.load_dim(spark, wh, CLIENTS, clients(spark, [("1", "+79", "2024-01-16 12:00:00")]), mid)
    W.replace_blacklist(spark, wh, spark.createDataFrame([(dt.datetime(2024, 1, 1), "PP1")], BLACKLIST), mid)
    W.append_transactions(spark, wh, tx(spark, [("1", "2024-01-16 10:00:00", 5, "C1", "SUCCESS"),
                                                ("2", "2024-01-16 13:00:00", 5, "C1", "SUCCESS")]))
    rep = sorted((r["tr_id"], r["phone"]) for r in daily.build_report(spark, wh, DAY).collect())
    assert rep == [("1", "+70"), ("2", "+79")]


def test_failed_blacklist_refresh_keeps_the_listing(spark, scratch):
    wh = W.Warehouse(f"{scratch}/wh")
    assert W.read_blacklist(spark, wh).count() == 0
    W.replace_blacklist(spark, wh, spark.createDataFrame([(D0, "PP1")], BLACKLIST), dt.datetime(2024, 1, 1))
    bad = spark.range(3).selectExpr("timestamp_ntz'2024-01-01 00:00:00' as entry_dt",
                                    "raise_error('broken workbook') as passport")
    with pytest.raises(Exception, match="broken workbook"):
        W.replace_blacklist(spark, wh, bad.selectExpr("entry_dt", "cast(passport as string) passport"),
                            dt.datetime(2024, 1, 2))
    assert [r["passport"] for r in W.read_blacklist(spark, wh).collect()] == ["PP1"]
    W.replace_blacklist(spark, wh, spark.createDataFrame([], BLACKLIST), dt.datetime(2024, 1, 3))
    assert W.read_blacklist(spark, wh).count() == 0


def test_uncommitted_run_is_not_history(spark, scratch, monkeypatch):
    wh = W.Warehouse(f"{scratch}/wh")
    W.load_dim(spark, wh, CLIENTS, clients(spark, [("1", "+70", None), ("2", "+70", None)]), dt.datetime(2024, 1, 1))

    def dies(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(W, "commit", dies)
        with pytest.raises(RuntimeError):
            W.load_dim(spark, wh, CLIENTS, clients(spark, [("1", "+71", "2024-01-02 08:00:00")]), dt.datetime(2024, 1, 2))
    before = hist(W.read_dim(spark, wh, CLIENTS))
    assert len(before) == 2 and {x[1] for x in before} == {"+70"}
    W.load_dim(spark, wh, CLIENTS, clients(spark, [("1", "+71", "2024-01-02 08:00:00"), ("2", "+70", None)]),
               dt.datetime(2024, 1, 3))
    assert hist(W.read_dim(spark, wh, CLIENTS)) == [
        ("1", "+70", "2023-12-01 00:00:00", "2024-01-02 07:59:59", "N"),
        ("1", "+71", "2024-01-02 08:00:00", str(OPEN), "N"),
        ("2", "+70", "2023-12-01 00:00:00", str(OPEN), "N")]


def test_rerun_replaces_the_run_as_a_whole(spark, scratch):
    wh = W.Warehouse(f"{scratch}/wh")
    both = clients(spark, [("1", "+70", None), ("2", "+70", None)])
    W.load_dim(spark, wh, CLIENTS, both, dt.datetime(2024, 1, 1))
    W.load_dim(spark, wh, CLIENTS, clients(spark, [("1", "+70", None)]), dt.datetime(2024, 1, 2))   # 2 is missing
    assert len(hist(W.read_dim(spark, wh, CLIENTS))) == 3
    W.load_dim(spark, wh, CLIENTS, both, dt.datetime(2024, 1, 2))                                    # the right snapshot
    assert hist(W.read_dim(spark, wh, CLIENTS)) == [
        (k, "+70", "2023-12-01 00:00:00", str(OPEN), "N") for k in ("1", "2")]


def report_row(spark, ids, day=DAY):
    at = dt.datetime(day.year, day.month, day.day)
    return spark.createDataFrame([(at, "PP", "fio", "+7", 1, at, i) for i in ids], REPORT)


def ids(df):
    return sorted(r["tr_id"] for r in df.collect())


def test_report_days_without_hits_are_emptied(spark, scratch):
    wh = W.Warehouse(f"{scratch}/wh")
    assert ids(W.read_report(spark, wh)) == []
    next_day = DAY + dt.timedelta(days=1)
    W.write_report(spark, report_row(spark, ["a"]).unionAll(report_row(spark, ["b"], next_day)), wh, DAY, next_day)
    assert ids(W.read_report(spark, wh)) == ["a", "b"]
    W.write_report(spark, report_row(spark, []), wh, DAY)
    assert ids(W.read_report(spark, wh)) == ["b"]
    W.write_report(spark, report_row(spark, ["c"]), wh, DAY)
    assert ids(W.read_report(spark, wh)) == ["b", "c"]


def test_rejects_of_a_file_are_replaced(spark, scratch):
    wh = W.Warehouse(f"{scratch}/wh")
    bad = spark.createDataFrame([("f1", "bad amount", "x"), ("f2", "bad amount", "y")], REJECTS)
    files = spark.createDataFrame([("f1",), ("f2",)], "file_name string")
    W.write_rejects(spark, wh, bad, files)
    W.write_rejects(spark, wh, bad.limit(0), files.filter("file_name = 'f1'"))
    assert [r["file_name"] for r in W.read_rejects(spark, wh).collect()] == ["f2"]


def test_ids_are_unique_over_all_days(spark, scratch):
    wh = W.Warehouse(f"{scratch}/wh")
    raw = "transaction_id string, transaction_date string, amount string, card_num string, oper_type string, " \
          "oper_result string, terminal string, file_name string"
    line = lambda i, day, f: (i, f"2024-01-{day} 10:00:00", "1,00", "C1", "pay", "SUCCESS", "T1", f)
    first = spark.createDataFrame([line("1", 15, "f15"), line("2", 15, "f15")], raw)
    later = spark.createDataFrame([line("1", 16, "f16"), line("3", 16, "f16"), line("3", 16, "f16")], raw)
    for _ in range(2):                       # a rerun stores and logs the same
        daily.load_transactions(spark, wh, first)
        daily.load_transactions(spark, wh, later)
        rows = sorted((r["transaction_id"], r["event_date"].day) for r in W.read_fact(spark, wh).collect())
        assert rows == [("1", 15), ("2", 15), ("3", 16)]
        got = sorted((r["file_name"], r["reason"]) for r in W.read_rejects(spark, wh).collect())
        assert got == [("f16", REPEATED), ("f16", STORED)]


def test_duplicate_reasons(spark):
    batch = tx(spark, [("1", "2024-01-16 10:00:00", 5, "C1", "SUCCESS"), ("1", "2024-01-16 10:00:00", 5, "C1", "SUCCESS"),
                       ("2", "2024-01-16 10:00:00", 5, "C1", "SUCCESS"), ("2", "2024-01-16 11:00:00", 4, "C1", "REJECT"),
                       ("3", "2024-01-16 10:00:00", 5, "C1", "SUCCESS"), ("4", "2024-01-16 10:00:00", 5, "C1", "SUCCESS")])
    stored = tx(spark, [("3", "2024-01-16 10:00:00", 5, "C1", "SUCCESS"), ("4", "2024-01-15 10:00:00", 5, "C1", "SUCCESS")])
    got = sorted((r["raw"].split(";")[0], r["reason"]) for r in duplicate_transactions(batch, stored).collect())
    assert got == [("1", REPEATED), ("2", REPEATED), ("4", STORED)]
    new = sorted((r["transaction_id"], r["transaction_date"].hour) for r in new_transactions(batch, stored).collect())
    assert new == [("1", 10), ("2", 10)]
