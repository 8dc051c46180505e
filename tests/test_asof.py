"""Profile enrichment (one join) equals chained as-of joins, gaps included."""

import datetime as dt
from decimal import Decimal

from fraudlake.operators.asof import card_profile, enrich
from fraudlake.schemas import ACCOUNTS, CARDS, CLIENTS, TRANSACTIONS

OPEN = dt.datetime(9999, 12, 31)


def d(day, h=0, s=0):
    return dt.datetime(2024, 1, day, h, 0, s)


def test_profile_matches_chain_with_gaps(spark):
    cards = spark.createDataFrame([
        ("C1", "A1", d(1), d(20) - dt.timedelta(seconds=1), "N"),
        ("C1", "A2", d(20), OPEN, "N"),               # card moves to another account
        ("C2", "A3", d(5), OPEN, "N"),
        ("C3", "A9", d(5), OPEN, "N"),               # account never exists
    ], "card_num string, account string, effective_from timestamp_ntz, effective_to timestamp_ntz, deleted_flg string")
    cards = cards.selectExpr("card_num", "account", "cast(null as timestamp_ntz) as create_dt",
                             "effective_from", "effective_to", "deleted_flg").select(*CARDS.hist_columns)
    acc = [("A1", d(25), "K1", None, d(3), d(10), "N"),         # starts after the card: gap first
           ("A1", d(25), "K2", None, d(12), OPEN, "N"),          # gap 10..12 in the middle
           ("A2", d(25), "K1", None, d(1), d(22), "N"),          # ends before the card: gap last
           ("A3", d(25), "K3", None, d(5), OPEN, "N"),
           ("A3", d(25), "K3", None, d(9), d(8), "N")]           # closes before it starts
    accounts = spark.createDataFrame(acc, ACCOUNTS.hist_schema)
    cl = [("K1", "L", "F", None, d(1), "PP1", None, "+1", d(1), d(1), d(6), "N"),
          ("K1", "L", "F", None, d(1), "PP1", None, "+1", d(1), d(7), OPEN, "N"),
          ("K2", "L2", "F2", "P", d(1), "PP2", None, "+2", d(1), d(1), d(14, 12), "N"),
          ("K2", "L2", "F2", "P", d(1), "PP2", None, "+2", d(1), d(14, 12, 1), OPEN, "Y"),
          ("K3", "L3", "F3", "P", d(1), "PP3", None, "+3", d(1), d(1), OPEN, "N")]
    clients = spark.createDataFrame(cl, CLIENTS.hist_schema)
    times = [d(1), d(2, 23), d(3), d(6, 12), d(9), d(10), d(11), d(12), d(14, 12), d(14, 13), d(19, 23),
             d(20), d(22), d(22, 0, 1), d(28), d(4), d(8, 12)]
    rows = []
    for i, t in enumerate(times):
        for c in ("C1", "C2", "C3", "CX"):
            rows.append((f"{c}-{i}", t, Decimal("1.00"), c, "op", "SUCCESS", "T1"))
    tr = spark.createDataFrame(rows, TRANSACTIONS)
    cols = ["transaction_id", "account", "valid_to", "client", "passport", "passport_valid_to", "phone", "fio"]
    fast = enrich(tr, cards, accounts, clients, prejoin=True).select(*cols)
    slow = enrich(tr, cards, accounts, clients, prejoin=False).select(*cols)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, fast.collect()), key=key) == sorted(map(tuple, slow.collect()), key=key)
    # segments of one card never overlap
    prof = card_profile(cards, accounts, clients).collect()
    for c in ("C1", "C2", "C3"):
        segs = sorted((r["seg_from"], r["seg_to"]) for r in prof if r["card_num"] == c)
        assert all(a[1] < b[0] for a, b in zip(segs, segs[1:]))
