"""Hand-made rows for rule and SCD2 tests."""

import datetime as dt
from decimal import Decimal

from fraudlake.schemas import ACCOUNTS, CARDS, CLIENTS, TERMINALS, TRANSACTIONS, BLACKLIST

OPEN = dt.datetime(9999, 12, 31)
D0 = dt.datetime(2023, 12, 1)


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def tx(spark, rows):
    """rows: (id, 'YYYY-MM-DD HH:MM:SS', amount, card, result[, terminal])."""
    out = []
    for r in rows:
        tid, t, amount, card, result = r[:5]
        term = r[5] if len(r) > 5 else "T1"
        out.append((tid, ts(t), Decimal(str(amount)), card, "op", result, term))
    return spark.createDataFrame(out, TRANSACTIONS)


def dims(spark, people, terminals=(("T1", "CITY1"),), valid_to=dt.datetime(2030, 1, 1)):
    """people: (card, passport, passport_valid_to, valid_to or None)."""
    cards, accs, clients = [], [], []
    for i, p in enumerate(people):
        card, passport, pvt = p[:3]
        vt = p[3] if len(p) > 3 and p[3] is not None else valid_to
        acc, cid = f"A{i}", f"{i}"
        cards.append((card, acc, D0, D0, OPEN, "N"))
        accs.append((acc, vt, cid, D0, D0, OPEN, "N"))
        clients.append((cid, f"L{i}", f"F{i}", None, D0, passport, pvt, f"+7{i}", D0, D0, OPEN, "N"))
    terms = [(tid, "ATM", city, "addr", D0, OPEN, "N") for tid, city in terminals]
    return (spark.createDataFrame(cards, CARDS.hist_schema),
            spark.createDataFrame(accs, ACCOUNTS.hist_schema),
            spark.createDataFrame(clients, CLIENTS.hist_schema),
            spark.createDataFrame(terms, TERMINALS.hist_schema))


def blacklist(spark, rows):
    return spark.createDataFrame([(ts(t), p) for t, p in rows], BLACKLIST)
