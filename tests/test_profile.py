"""The stored card profile: equal to the computed one after any loads, from changed cards only."""

import datetime as dt

import pytest
from helpers import D0, tx, ts
from pyspark.sql import functions as F

from fraudlake.operators.asof import card_profile
from fraudlake.operators.scd2 import extract_since
from fraudlake.plans import commitlog, daily, profile, sweep
from fraudlake.plans import warehouse as W
from fraudlake.schemas import ACCOUNTS, BLACKLIST, CARDS, CLIENTS, TERMINALS

NONE = dt.timedelta(0)


def run(i):
    return dt.datetime(2024, 1, i)


class Bank:
    """Cards C<i> of accounts A<i> of clients <i // 2>, changed by the tests."""

    def __init__(self, n=6):
        self.cards = {f"C{i}": (f"A{i}", D0, None) for i in range(n)}
        self.accounts = {f"A{i}": (ts("2030-01-01"), f"{i // 2}", D0, None) for i in range(n)}
        self.clients = {f"{i}": ("L", "F", None, D0, f"PP{i}", None, "+7", D0, None) for i in range((n + 1) // 2)}

    def load(self, spark, wh, i, only=(CARDS, ACCOUNTS, CLIENTS)):
        for spec in only:
            rows = {"CARDS": self.cards, "ACCOUNTS": self.accounts, "CLIENTS": self.clients}[spec.name]
            src = spark.createDataFrame([(k, *v) for k, v in rows.items()], spec.source)
            W.load_dim(spark, wh, spec, src, run(i), extract=extract_since)


def computed(spark, wh):
    return card_profile(*(W.read_dim(spark, wh, s) for s in (CARDS, ACCOUNTS, CLIENTS)), W.read_blacklist(spark, wh))


def same(spark, wh, **kw):
    got, want = profile.read(spark, wh, W.read_blacklist(spark, wh), **kw), computed(spark, wh)
    got = got.select(*want.columns)
    return got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def cards_of(spark, wh, folder):
    return {r["card_num"] for r in spark.read.parquet(f"{wh.profile}/run={folder}").select("card_num").collect()}


def test_only_touched_cards_are_computed_again(spark, scratch):
    wh, bank = W.Warehouse(f"{scratch}/wh"), Bank()
    W.replace_blacklist(spark, wh, spark.createDataFrame([(ts("2024-01-05"), "PP1")], BLACKLIST), run(1))
    bank.load(spark, wh, 1)
    assert profile.read(spark, wh, W.read_blacklist(spark, wh)) is None
    profile.refresh(spark, wh)
    assert same(spark, wh) and profile.state(spark, wh)[0] == 1
    # A client of two cards, an account, a card that goes, a card that comes.
    bank.clients["0"] = (*bank.clients["0"][:6], "+8", D0, ts("2024-01-01 12:00:00"))
    bank.accounts["A2"] = (ts("2025-01-01"), "1", D0, ts("2024-01-01 13:00:00"))
    del bank.cards["C5"]
    bank.cards["C9"] = ("A2", ts("2024-01-01 10:00:00"), None)
    bank.load(spark, wh, 2)
    assert profile.read(spark, wh, W.read_blacklist(spark, wh)) is None      # a load since the refresh
    profile.refresh(spark, wh)
    number, folders, _ = profile.state(spark, wh)
    assert number == 2 and [f[0] for f in folders] == ["B", "D"]
    assert cards_of(spark, wh, folders[1]) == {"C0", "C1", "C2", "C5", "C9"}
    assert same(spark, wh)
    # A load without changes and a new listing change no stored row.
    W.replace_blacklist(spark, wh, spark.createDataFrame([(ts("2024-01-04"), "PP1"), (ts("2024-01-06"), "PP0")], BLACKLIST), run(3))
    bank.load(spark, wh, 3, (CLIENTS,))
    profile.refresh(spark, wh)
    assert cards_of(spark, wh, profile.state(spark, wh)[1][-1]) == set() and same(spark, wh)
    profile.refresh(spark, wh)
    assert profile.state(spark, wh)[0] == 3
    some = profile.read(spark, wh, W.read_blacklist(spark, wh), spark.createDataFrame([("C2",)], "card_num string"), run(2))
    got = sorted((r["card_num"], r["seg_to"] >= run(2), r["bl_entry_dt"]) for r in some.collect())
    assert got == [("C2", True, ts("2024-01-04"))]


def test_a_card_without_segments_hides_its_older_rows(spark, scratch):
    wh, bank = W.Warehouse(f"{scratch}/wh"), Bank(2)
    bank.cards["C1"] = ("A1", ts("2024-01-03 00:00:00"), None)     # opened after the run that deletes it
    bank.load(spark, wh, 1)
    profile.refresh(spark, wh)
    del bank.cards["C1"]
    bank.load(spark, wh, 2, (CARDS,))
    profile.refresh(spark, wh)
    assert same(spark, wh)
    assert {r["card_num"] for r in profile.read(spark, wh, W.read_blacklist(spark, wh)).collect()} == {"C0"}


def test_late_and_repeated_runs_are_computed_as_a_whole(spark, scratch):
    wh, bank = W.Warehouse(f"{scratch}/wh"), Bank(2)
    for i in (1, 2):
        bank.load(spark, wh, i, (CARDS, ACCOUNTS, CLIENTS) if i == 1 else (CLIENTS,))
        profile.refresh(spark, wh)
    bank.clients["0"] = (*bank.clients["0"][:6], "+9", D0, ts("2024-01-02 12:00:00"))
    bank.load(spark, wh, 2, (CLIENTS,))            # the same run again, with other rows
    profile.refresh(spark, wh)
    assert [f[0] for f in profile.state(spark, wh)[1]] == ["B"] and same(spark, wh)


def test_folders_are_merged_and_swept(spark, scratch, monkeypatch):
    monkeypatch.setattr(profile, "FAN", 2)
    wh, bank = W.Warehouse(f"{scratch}/wh"), Bank(2)
    kinds = []
    for i in range(1, 6):
        bank.clients["0"] = (*bank.clients["0"][:6], f"+{i}", D0, run(i) - dt.timedelta(hours=1))
        bank.load(spark, wh, i, (CARDS, ACCOUNTS, CLIENTS) if i == 1 else (CLIENTS,))
        profile.refresh(spark, wh)
        kinds.append("".join(f[0] for f in profile.state(spark, wh)[1]))
    assert kinds == ["B", "BD", "BM", "BMD", "B"] and same(spark, wh)
    sweep.sweep(spark, wh, NONE)
    sweep.sweep(spark, wh, NONE)
    assert {n.removeprefix("run=") for n in commitlog.listing(spark, wh.profile)} == set(profile.state(spark, wh)[1])
    assert same(spark, wh)


def test_refresh_that_loses_reads_again(spark, scratch, monkeypatch):
    wh, bank = W.Warehouse(f"{scratch}/wh"), Bank(2)
    bank.load(spark, wh, 1)
    put, lost = commitlog.put_once, []

    def first_one_loses(spark, path, content):
        if "profile_log" in path and not lost:
            lost.append(path)
            profile.refresh(spark, wh)
            assert not put(spark, path, content)
            return False
        return put(spark, path, content)
    monkeypatch.setattr(commitlog, "put_once", first_one_loses)
    profile.refresh(spark, wh)
    assert lost and profile.state(spark, wh)[0] == 1 and same(spark, wh)


@pytest.mark.parametrize("stored", [True, False])
def test_report_reads_the_stored_profile(spark, scratch, monkeypatch, stored):
    wh, bank = W.Warehouse(f"{scratch}/wh"), Bank(4)
    W.replace_blacklist(spark, wh, spark.createDataFrame([(ts("2024-01-02"), "PP1")], BLACKLIST), run(1))
    bank.load(spark, wh, 1)
    W.load_dim(spark, wh, TERMINALS, spark.createDataFrame([("T1", "ATM", "M", "a", D0)], TERMINALS.source), run(1))
    W.append_transactions(spark, wh, tx(spark, [(str(i), f"2024-01-0{d} 10:00:00", 5, f"C{i % 4}", "SUCCESS")
                                                for i, d in enumerate([2, 2, 2, 2, 3, 3, 3, 3])]))
    day = dt.date(2024, 1, 3)
    if stored:
        profile.refresh(spark, wh)
        monkeypatch.setattr("fraudlake.operators.rules.card_profile", None)     # must not be needed
    got = daily.build_report(spark, wh, day)
    assert sorted((r["tr_id"], r["event_type"]) for r in got.collect()) == [("6", 1), ("7", 1)]
    if stored:
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "card_profile" in plan and not any(f"dim_{n}" in plan for n in ("cards", "accounts", "clients"))
        daily.write_day(spark, wh, day)
        assert W.read_report(spark, wh).count() == 2
