"""Numbered commits, merged closed versions and the sweep of what no commit needs."""

import datetime as dt

import pytest
from helpers import D0
from test_storage import clients, hist, report_row

from fraudlake.plans import cardstate, commitlog, sweep
from fraudlake.plans import warehouse as W
from fraudlake.schemas import BLACKLIST, CLIENTS

FIRST = dt.datetime(2024, 1, 1)


def day(n):
    return FIRST + dt.timedelta(days=n)


def load(spark, wh, n, ids=("1", "2")):
    """Load n: every client has a new phone since the day before."""
    when = str(day(n) - dt.timedelta(hours=1))
    return W.load_dim(spark, wh, CLIENTS, clients(spark, [(i, f"+7{n:03d}", when) for i in ids]), day(n))


def test_a_number_is_taken_once(spark, scratch):
    path = f"{scratch}/log"
    assert commitlog.head(spark, path) == 0
    assert commitlog.put_once(spark, commitlog.numbered(path, 1), "a")
    assert not commitlog.put_once(spark, commitlog.numbered(path, 1), "b")
    assert open(commitlog.numbered(path, 1)).read() == "a"
    assert [commitlog.take_number(spark, path) for _ in range(2)] == [2, 3]
    assert sorted(commitlog.listing(spark, path)) == [f"{n:012d}.json" for n in (1, 2, 3)]     # no drafts left


def test_of_two_loaders_one_wins_and_the_other_reads_again(spark, scratch, monkeypatch):
    wh, alone = W.Warehouse(f"{scratch}/wh"), W.Warehouse(f"{scratch}/alone")
    for w in (wh, alone):
        load(spark, w, 0)
    step, other = W.scd2_step, []

    def meanwhile(*args):
        if not other:                       # the second loader commits while the first one computes
            other.append(1)
            load(spark, wh, 1, ids=("1", "3"))
        return step(*args)

    with monkeypatch.context() as m:
        m.setattr(W, "scd2_step", meanwhile)
        load(spark, wh, 2)
    load(spark, alone, 1, ids=("1", "3"))
    load(spark, alone, 2)
    assert hist(W.read_dim(spark, wh, CLIENTS)) == hist(W.read_dim(spark, alone, CLIENTS))
    assert [r["committed_at"] for r in W.history_log(spark, wh, "CLIENTS")] == [1, 2, 3]

    def always(*args):
        commitlog.take_number(spark, f"{wh.meta}/table_name=CLIENTS")
        return step(*args)

    monkeypatch.setattr(W, "scd2_step", always)
    with pytest.raises(W.ConcurrentLoad):
        W.load_dim(spark, wh, CLIENTS, clients(spark, [("1", "+7", None)]), day(3), attempts=2)


def test_long_history_reads_few_folders(spark, scratch, monkeypatch):
    monkeypatch.setattr(W, "FAN", 2)
    monkeypatch.setattr(W, "RECENT", 2)
    wh, runs, merges = W.Warehouse(f"{scratch}/wh"), 14, []
    put = commitlog.put_once
    monkeypatch.setattr(W.commitlog, "put_once", lambda s, p, c: (merges.append(p) if '"M' in c else None) or put(s, p, c))
    for n in range(runs):
        load(spark, wh, n)
    log = W.history_log(spark, wh, "CLIENTS")
    loads, closed, merged = W.live_folders(log)
    assert len(loads) == runs and len(closed) <= 6 and len(merges) >= 6
    files = W.read_dim(spark, wh, CLIENTS).inputFiles()
    assert {f.split("run=")[1].split("/")[0] for f in files} <= {*closed, loads[max(loads)]}
    got = hist(W.read_dim(spark, wh, CLIENTS))
    assert len(got) == 2 * runs == len(set(got))
    # As of any run, merged or not, and as a reader in the middle of a merge sees it.
    for upto in sorted(loads)[::4]:
        assert len(hist(W.read_dim(spark, wh, CLIENTS, upto))) == 2 * (sorted(loads).index(upto) + 1)
    at = max(i for i, r in enumerate(log) if r["replaces"] is not None)
    before, after = (sorted(hist(W._history(spark, wh, CLIENTS, log[:i]))) for i in (at, at + 1))
    assert before == after
    # A merged run cannot be repeated, a recent one can.
    with pytest.raises(ValueError, match="merged"):
        load(spark, wh, 1)
    load(spark, wh, runs - 1)
    assert hist(W.read_dim(spark, wh, CLIENTS)) == got


def test_sweep_leaves_live_folders_only(spark, scratch, monkeypatch):
    monkeypatch.setattr(W, "FAN", 2)
    monkeypatch.setattr(W, "RECENT", 1)
    wh = W.Warehouse(f"{scratch}/wh")
    for n in (0, 1, 2, 3, 3):
        load(spark, wh, n)
    for n in (0, 1):
        W.replace_blacklist(spark, wh, spark.createDataFrame([(D0, f"PP{n}")], BLACKLIST), day(n))
        W.write_report(spark, report_row(spark, [f"r{n}"]), wh, dt.date(2024, 1, 16))
    with monkeypatch.context() as m:                 # a load that dies before its commit
        m.setattr(W, "commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load(spark, wh, 4)
    state = (hist(W.read_dim(spark, wh, CLIENTS)), W.read_blacklist(spark, wh).collect(), W.read_report(spark, wh).collect())
    now = dt.timedelta(0)
    assert sweep.sweep(spark, wh, now) == []                             # marked only
    assert sweep.sweep(spark, wh, dt.timedelta(hours=1)) == []           # too young
    gone = sweep.sweep(spark, wh, now)
    assert len([p for p in gone if "/dim_clients/" in p]) >= 4 and len([p for p in gone if "blacklist" in p]) == 1
    assert len([p for p in gone if "rep_fraud" in p]) == 1
    keep = sweep.live(spark, wh)
    for path, names in keep.items():
        assert {n for n in commitlog.listing(spark, path) if n[0] not in "._"} == names
    assert state == (hist(W.read_dim(spark, wh, CLIENTS)), W.read_blacklist(spark, wh).collect(),
                     W.read_report(spark, wh).collect())
    assert sweep.sweep(spark, wh, now) == []
    load(spark, wh, 4)
    assert len(hist(W.read_dim(spark, wh, CLIENTS))) == 10
    assert cardstate._newest(spark, wh, dt.date(2024, 1, 16)) is None
