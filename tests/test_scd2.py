import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fraudlake.functions.expr import open_end
from fraudlake.operators.scd2 import (
    empty_history, extract_since, normalize_source, open_counts, scd2_apply,
)
from fraudlake.schemas import ACCOUNTS, ACCOUNTS_SRC

OPEN = dt.datetime(9999, 12, 31)
R1, R2, R3 = dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 16), dt.datetime(2024, 1, 23)
C0 = dt.datetime(2023, 12, 1)


def src(spark, rows):
    """rows: (account, valid_to, client, create_dt, update_dt)."""
    return normalize_source(spark.createDataFrame(rows, ACCOUNTS_SRC), ACCOUNTS)


def run(spark, hist, rows, run_ts, wm):
    s = src(spark, rows)
    return scd2_apply(hist, extract_since(s, wm), s.select(F.col("account").alias("id")), run_ts, ACCOUNTS)


def versions(hist):
    rows = [(r["account"], r["client"], r["effective_from"], r["effective_to"], r["deleted_flg"])
            for r in hist.collect()]
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


V = dt.datetime(2030, 1, 1)


def test_first_load_and_unchanged_restage(spark):
    h1 = run(spark, empty_history(spark, ACCOUNTS), [("A1", V, "1", C0, None)], R1, dt.datetime(1900, 1, 1))
    assert versions(h1) == [("A1", "1", C0, OPEN, "N")]
    # touched but unchanged: no second open version
    touch = dt.datetime(2024, 1, 14)
    h2 = run(spark, h1, [("A1", V, "1", C0, touch)], R2, R1)
    assert versions(h2) == [("A1", "1", C0, OPEN, "N")]


def test_change_null_to_value_and_padding(spark):
    h1 = run(spark, empty_history(spark, ACCOUNTS), [("A1  ", V, "", C0, None)], R1, dt.datetime(1900, 1, 1))
    assert versions(h1) == [("A1", None, C0, OPEN, "N")]   # CHAR padding and '' = NULL
    up = dt.datetime(2024, 1, 14, 12)
    h2 = run(spark, h1, [("A1", V, "7", C0, up)], R2, R1)
    assert versions(h2) == sorted([("A1", None, C0, up - dt.timedelta(seconds=1), "N"),
                                   ("A1", "7", up, OPEN, "N")], key=lambda r: tuple((x is not None, x) for x in r))


def test_changed_row_without_update_dt_closes_before_create(spark):
    # ``coalesce(update_dt, create_dt) - 1s``: a change with no update_dt ends
    # the old version before it started; such a row never matches an event.
    h1 = run(spark, empty_history(spark, ACCOUNTS), [("A1", V, "1", C0, None)], R1, dt.datetime(1900, 1, 1))
    h2 = run(spark, h1, [("A1", V, "2", C0, None)], R2, dt.datetime(1900, 1, 1))
    assert versions(h2) == [("A1", "1", C0, C0 - dt.timedelta(seconds=1), "N"), ("A1", "2", C0, OPEN, "N")]


def test_delete_return_and_rerun(spark):
    h1 = run(spark, empty_history(spark, ACCOUNTS),
             [("A1", V, "1", C0, None), ("A2", V, "2", C0, None)], R1, dt.datetime(1900, 1, 1))
    h2 = run(spark, h1, [("A2", V, "2", C0, None)], R2, R1)            # A1 deleted
    assert versions(h2) == [("A1", "1", C0, R2 - dt.timedelta(seconds=1), "N"),
                            ("A1", "1", R2, OPEN, "Y"), ("A2", "2", C0, OPEN, "N")]
    back = dt.datetime(2024, 1, 20)
    h3 = run(spark, h2, [("A1", V, "1", C0, back), ("A2", V, "2", C0, None)], R3, R2)
    assert versions(h3) == [("A1", "1", C0, R2 - dt.timedelta(seconds=1), "N"),
                            ("A1", "1", R2, back - dt.timedelta(seconds=1), "Y"),
                            ("A1", "1", back, OPEN, "N"), ("A2", "2", C0, OPEN, "N")]
    # the same run again changes nothing
    h3b = run(spark, h3, [("A1", V, "1", C0, back), ("A2", V, "2", C0, None)], R3, R2)
    assert versions(h3b) == versions(h3)


def test_same_day_create_and_delete(spark):
    made = dt.datetime(2024, 1, 16, 9)
    h1 = run(spark, empty_history(spark, ACCOUNTS), [("A9", V, "9", made, None)], R2, dt.datetime(1900, 1, 1))
    h2 = run(spark, h1, [("A8", V, "8", C0, None)], dt.datetime(2024, 1, 16), R2)
    closed = [r for r in versions(h2) if r[0] == "A9" and r[4] == "N"]
    assert closed[0][3] < closed[0][2]   # kept as is: closes before it began


def test_empty_snapshot_is_refused(spark, scratch):
    from fraudlake.plans import warehouse as W
    wh = W.Warehouse(scratch)
    with pytest.raises(ValueError):
        W.load_dim(spark, wh, ACCOUNTS, src(spark, []), R1, extract=extract_since)


def test_invariants_on_random_snapshots(spark):
    rnd = random.Random(7)
    hist = empty_history(spark, ACCOUNTS)
    wm = dt.datetime(1900, 1, 1)
    state, present = {}, set()
    for n, run_ts in enumerate([R1, R2, R3, dt.datetime(2024, 1, 30)]):
        rows, now = [], set()
        for k in range(40):
            if rnd.random() < 0.2:
                continue   # absent today
            old = state.get(k)
            client = str(rnd.randint(0, 3)) if (old is None or rnd.random() < 0.3) else old
            # every change, including a comeback, sets update_dt
            changed = client != old or (n > 0 and k not in present)
            upd = run_ts - dt.timedelta(hours=rnd.randint(1, 20)) if changed else None
            state[k] = client
            now.add(k)
            rows.append((f"A{k}", V, client, C0, upd))
        present = now
        hist = run(spark, hist, rows, run_ts, wm)
        hist = spark.createDataFrame(hist.collect(), ACCOUNTS.hist_schema)
        wm = run_ts
        assert open_counts(hist, ACCOUNTS).filter("n_open > 1").count() == 0
        live = {r[0]: r[2] for r in rows}
        cur = {r["account"]: r["client"] for r in hist.filter(
            (F.col("effective_to") == open_end()) & (F.col("deleted_flg") == "N")).collect()}
        assert cur == live
    # re-applying the last snapshot changes nothing
    again = run(spark, hist, rows, dt.datetime(2024, 1, 30), dt.datetime(2024, 1, 23))
    assert versions(again) == versions(hist)


def test_meta_seed_and_advance(spark):
    from fraudlake.plans import warehouse as W
    seed = W.seed_meta(spark, ["ACCOUNTS", "CARDS", "CLIENTS", "TERMINALS"])
    cur = W.meta_current(seed)
    assert {r["table_name"]: r["last_update_dt"] for r in cur.collect()} == {
        t: dt.datetime(1900, 1, 1) for t in ("ACCOUNTS", "CARDS", "CLIENTS", "TERMINALS")}
    moved = W.meta_advance(cur, "CLIENTS", R2)
    got = {r["table_name"]: r["last_update_dt"] for r in moved.collect()}
    assert got["CLIENTS"] == R2 and got["CARDS"] == dt.datetime(1900, 1, 1)


def test_key_back_without_a_change_is_reopened(spark):
    h = run(spark, empty_history(spark, ACCOUNTS), [("A1", V, "1", C0, None), ("A2", V, "2", C0, None)], R1,
            dt.datetime(1900, 1, 1))
    h = run(spark, h, [("A1", V, "1", C0, None)], R2, R1)
    h = run(spark, h, [("A1", V, "1", C0, None), ("A2", V, "2", C0, None)], R3, R2)   # update_dt did not move
    one = dt.timedelta(seconds=1)
    assert versions(h) == [("A1", "1", C0, OPEN, "N"), ("A2", "2", C0, R2 - one, "N"),
                           ("A2", "2", R2, R3 - one, "Y"), ("A2", "2", R3, OPEN, "N")]
