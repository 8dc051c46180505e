"""Table schemas, sentinels and dimension specs of the card-fraud warehouse.

Every Oracle ``date`` of the source system carries a time of day, so all
moments are ``TIMESTAMP_NTZ`` truncated to whole seconds, never ``DATE``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import types as T

# Fixed values that must equal the source system's for right results.
OPEN_END = dt.datetime(9999, 12, 31, 0, 0, 0)     # effective_to of an open version
NEVER = dt.datetime(9999, 1, 1, 0, 0, 0)          # "no date" default in the rules
FIRST_WATERMARK = dt.datetime(1900, 1, 1, 0, 0, 0)  # watermark before any load
FLAG_LIVE = "N"
FLAG_DELETED = "Y"
RESULT_SUCCESS = "SUCCESS"
RESULT_REJECT = "REJECT"
TABLE_DB = "DWH"             # table_db value of the meta rows
EVENT_PASSPORT, EVENT_CONTRACT, EVENT_CITIES, EVENT_GUESSING = 1, 2, 3, 4

S = T.StringType()
TS = T.TimestampNTZType()
AMOUNT = T.DecimalType(10, 2)


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# Raw text feed: everything is a string until typed by ``try_cast``.
TRANSACTIONS_RAW = _struct(
    ("transaction_id", S), ("transaction_date", S), ("amount", S),
    ("card_num", S), ("oper_type", S), ("oper_result", S), ("terminal", S),
)
TRANSACTIONS = _struct(
    ("transaction_id", S), ("transaction_date", TS), ("amount", AMOUNT),
    ("card_num", S), ("oper_type", S), ("oper_result", S), ("terminal", S),
)
BLACKLIST = _struct(("entry_dt", TS), ("passport", S))
TERMINALS_STAGE = _struct(
    ("terminal_id", S), ("terminal_type", S), ("terminal_city", S),
    ("terminal_address", S), ("update_dt", TS),
)
ACCOUNTS_SRC = _struct(
    ("account", S), ("valid_to", TS), ("client", S), ("create_dt", TS), ("update_dt", TS),
)
CARDS_SRC = _struct(("card_num", S), ("account", S), ("create_dt", TS), ("update_dt", TS))
CLIENTS_SRC = _struct(
    ("client_id", S), ("last_name", S), ("first_name", S), ("patronymic", S),
    ("date_of_birth", TS), ("passport_num", S), ("passport_valid_to", TS),
    ("phone", S), ("create_dt", TS), ("update_dt", TS),
)
META = _struct(("table_db", S), ("table_name", S), ("last_update_dt", TS))
REPORT = T.StructType([
    T.StructField("event_dt", TS, True),
    T.StructField("passport", S, True),
    T.StructField("fio", S, True),
    T.StructField("phone", S, True),
    T.StructField("event_type", T.IntegerType(), False),
    T.StructField("report_dt", TS, True),
    T.StructField("tr_id", S, True),
])
REJECTS = _struct(("file_name", S), ("reason", S), ("raw", S))
VERSION_COLS = ("effective_from", "effective_to", "deleted_flg")


@dataclass(frozen=True)
class DimSpec:
    """One type-2 dimension: natural key, tracked attributes, source schema."""

    name: str          # table_name in the meta table
    key: str
    attrs: tuple[str, ...]
    source: T.StructType

    @property
    def columns(self) -> list[str]:
        return [self.key, *self.attrs]

    @property
    def hist_columns(self) -> list[str]:
        return [self.key, *self.attrs, *VERSION_COLS]

    @property
    def hist_schema(self) -> T.StructType:
        by_name = {f.name: f.dataType for f in self.source.fields}
        fields = [T.StructField(c, by_name[c], True) for c in self.columns]
        fields += [T.StructField("effective_from", TS, True),
                   T.StructField("effective_to", TS, True),
                   T.StructField("deleted_flg", S, True)]
        return T.StructType(fields)


ACCOUNTS = DimSpec("ACCOUNTS", "account", ("valid_to", "client", "create_dt"), ACCOUNTS_SRC)
CARDS = DimSpec("CARDS", "card_num", ("account", "create_dt"), CARDS_SRC)
CLIENTS = DimSpec(
    "CLIENTS", "client_id",
    ("last_name", "first_name", "patronymic", "date_of_birth", "passport_num",
     "passport_valid_to", "phone", "create_dt"),
    CLIENTS_SRC,
)
TERMINALS = DimSpec(
    "TERMINALS", "terminal_id", ("terminal_type", "terminal_city", "terminal_address"),
    TERMINALS_STAGE,
)
DIMS = {d.name: d for d in (ACCOUNTS, CARDS, CLIENTS, TERMINALS)}
