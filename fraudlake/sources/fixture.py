"""Warehouse inputs derived from the driver tables (see FIXTURES.md part B).

``events`` becomes the card transaction feed, ``customer`` the bank's
clients/accounts/cards tables, ``nation`` the terminal cities. Everything is
a lazy projection of the parquet scans, so the work grows with the tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake.functions.expr import trunc_seconds, ts_lit

# Fixed values of the fixture definition.
SNAPSHOT_RUNS = {1: dt.datetime(2024, 1, 2), 2: dt.datetime(2024, 1, 16), 3: dt.datetime(2024, 1, 23)}
BASE_CREATE = dt.datetime(2023, 12, 1)
LATE_CREATE = dt.datetime(2024, 1, 10)
TOUCH_UPDATE = dt.datetime(2024, 1, 14, 12, 0, 0)
RETURN_UPDATE = dt.datetime(2024, 1, 20)
TERMINAL_FROM = dt.datetime(2023, 12, 1)
BLACKLIST_DAYS = (dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 20))


_TABLES: dict[str, tuple[SparkSession, DataFrame]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; the lazy scan is reused within a session (listing and
    footer reads happen once)."""
    path = f"{sf_dir}/{name}.parquet"
    hit = _TABLES.get(path)
    if hit is None or hit[0] is not spark:
        hit = _TABLES[path] = (spark, spark.read.parquet(path))
    return hit[1]


def _pad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def _days(base: dt.datetime, n: Column) -> Column:
    return ts_lit(base) + F.make_dt_interval(n.cast("int"))


def terminal_k(props: Column) -> Column:
    return F.get_json_object(props, "$.k").cast("int")


def _operation() -> list[Column]:
    """Columns of the feed over ``events``."""
    return [
        F.col("event_id").cast("string").alias("transaction_id"),
        trunc_seconds("ts").alias("transaction_date"),
        F.round("value", 2).cast("decimal(10,2)").alias("amount"),
        F.concat(F.lit("C"), _pad(F.col("user_id"), 8)).alias("card_num"),
        F.col("event_type").alias("oper_type"),
        F.when(F.col("event_type") == "purchase", "SUCCESS").otherwise("REJECT").alias("oper_result"),
        F.concat(F.lit("T"), _pad(terminal_k(F.col("props")), 3)).alias("terminal"),
    ]


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(*_operation())


def dated_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with ``event_date``, as the stored fact has it: here the date of the
    raw time, so that a filter on it reaches the scan."""
    return table(spark, sf_dir, "events").select(*_operation(), F.to_date("ts").alias("event_date"))


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as the text file carries it: all strings, decimal comma.

    ``error`` events stand for damaged lines: their amount is unreadable text.
    """
    ev = table(spark, sf_dir, "events")
    amount_text = F.round("value", 2).cast("decimal(10,2)").cast("string")
    return ev.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("transaction_date"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("n/a "), amount_text))
         .otherwise(F.regexp_replace(amount_text, r"\.", ",")).alias("amount"),
        F.concat(F.lit("C"), _pad(F.col("user_id"), 8)).alias("card_num"),
        F.col("event_type").alias("oper_type"),
        F.when(F.col("event_type") == "purchase", "SUCCESS").otherwise("REJECT").alias("oper_result"),
        F.concat(F.lit("T"), _pad(terminal_k(F.col("props")), 3)).alias("terminal"),
        F.concat(F.lit("transactions_"), F.date_format("ts", "ddMMyyyy"), F.lit(".txt")).alias("file_name"),
    )


def terminals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full terminal slice: one row per terminal seen in the feed."""
    ks = table(spark, sf_dir, "events").select(terminal_k(F.col("props")).alias("k")).distinct()
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (ks.join(nation, (F.col("k") % 25) == F.col("n_nationkey"), "left")
              .select(F.concat(F.lit("T"), _pad(F.col("k"), 3)).alias("terminal_id"),
                      F.when(F.col("k") % 2 == 0, "ATM").otherwise("POS").alias("terminal_type"),
                      F.col("n_name").alias("terminal_city"),
                      F.concat(F.lit("addr "), F.col("k").cast("string")).alias("terminal_address"),
                      ts_lit(TERMINAL_FROM).alias("update_dt")))


def _create_dt(cust: Column) -> Column:
    return F.when(cust % 17 == 5, ts_lit(LATE_CREATE)).otherwise(ts_lit(BASE_CREATE))


def clients(spark: SparkSession, sf_dir: str, snapshot: int = 3) -> DataFrame:
    """The bank's clients table as seen at run ``snapshot`` (1, 2 or 3)."""
    cu = table(spark, sf_dir, "customer")
    cust = F.col("c_custkey")
    changed_phone = (cust % 7 == 2) if snapshot >= 2 else F.lit(False)
    update = F.lit(None).cast("timestamp_ntz")
    if snapshot >= 2:
        update = F.when((cust % 7 == 2) | (cust % 13 == 4), ts_lit(TOUCH_UPDATE)).otherwise(update)
    if snapshot >= 3:
        update = F.when(cust % 11 == 3, ts_lit(RETURN_UPDATE)).otherwise(update)
    rows = {1: cust % 17 != 5, 2: cust % 11 != 3, 3: F.lit(True)}[snapshot]
    return cu.filter(rows).select(
        cust.cast("string").alias("client_id"),
        F.col("c_name").alias("last_name"),
        F.col("c_mktsegment").alias("first_name"),
        F.when(cust % 5 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("P"), (cust % 7).cast("string"))).alias("patronymic"),
        _days(dt.datetime(1980, 1, 1), cust % 7000).alias("date_of_birth"),
        F.concat(F.lit("PP"), _pad(cust, 8)).alias("passport_num"),
        F.when(cust % 3 == 0, _days(dt.datetime(2024, 1, 5), cust % 20)).alias("passport_valid_to"),
        F.concat(F.lit("+7"), _pad(cust, 6), F.when(changed_phone, "9").otherwise("0")).alias("phone"),
        _create_dt(cust).alias("create_dt"),
        update.alias("update_dt"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("A"), _pad(cust, 8)).alias("account"),
        _days(dt.datetime(2024, 1, 10), cust % 40).alias("valid_to"),
        cust.cast("string").alias("client"),
        _create_dt(cust).alias("create_dt"),
        F.lit(None).cast("timestamp_ntz").alias("update_dt"),
    )


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card numbers are CHAR(20): blank-padded, as the source stores them."""
    cust = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.rpad(F.concat(F.lit("C"), _pad(cust, 8)), 20, " ").alias("card_num"),
        F.concat(F.lit("A"), _pad(cust, 8)).alias("account"),
        _create_dt(cust).alias("create_dt"),
        F.lit(None).cast("timestamp_ntz").alias("update_dt"),
    )


def _update_dt(touched: Column, returned: Column, snapshot: int) -> Column:
    c = F.lit(None).cast("timestamp_ntz")
    if snapshot >= 2:
        c = F.when(touched, ts_lit(TOUCH_UPDATE)).otherwise(c)
    if snapshot >= 3:
        c = F.when(returned, ts_lit(RETURN_UPDATE)).otherwise(c)
    return c


def accounts_snapshot(spark: SparkSession, sf_dir: str, snapshot: int) -> DataFrame:
    """The accounts table at run ``snapshot``: contracts of ``cust % 6 = 1`` are
    extended in the middle of a day, ``cust % 9 = 4`` are gone in run 2 and back in run 3."""
    cust = F.col("c_custkey")
    rows = {1: cust % 13 != 6, 2: cust % 9 != 4, 3: F.lit(True)}[snapshot]
    more = F.when(cust % 6 == 1, 30).otherwise(0) if snapshot >= 2 else F.lit(0)
    return table(spark, sf_dir, "customer").filter(rows).select(
        F.concat(F.lit("A"), _pad(cust, 8)).alias("account"),
        _days(dt.datetime(2024, 1, 10), cust % 40 + more).alias("valid_to"),
        cust.cast("string").alias("client"), _create_dt(cust).alias("create_dt"),
        _update_dt((cust % 6 == 1) | (cust % 5 == 3), cust % 9 == 4, snapshot).alias("update_dt"))


def cards_snapshot(spark: SparkSession, sf_dir: str, snapshot: int) -> DataFrame:
    """The cards table: cards of ``cust % 8 = 3`` move to the next account,
    ``cust % 7 = 5`` are gone in run 2; half of them are back in run 3."""
    cust = F.col("c_custkey")
    rows = {1: cust % 12 != 7, 2: cust % 7 != 5, 3: cust % 14 != 5}[snapshot]
    to = cust + F.when(cust % 8 == 3, 1).otherwise(0) if snapshot >= 2 else cust
    return table(spark, sf_dir, "customer").filter(rows).select(
        F.rpad(F.concat(F.lit("C"), _pad(cust, 8)), 20, " ").alias("card_num"),
        F.concat(F.lit("A"), _pad(to, 8)).alias("account"), _create_dt(cust).alias("create_dt"),
        _update_dt((cust % 8 == 3) | (cust % 11 == 2), cust % 7 == 5, snapshot).alias("update_dt"))


def terminals_snapshot(spark: SparkSession, sf_dir: str, snapshot: int) -> DataFrame:
    """The terminal slice of a run's day: ``k % 5 = 1`` moves to another city
    in run 2, ``k % 6 = 2`` is missing there."""
    k = F.col("k")
    ks = table(spark, sf_dir, "events").select(terminal_k(F.col("props")).alias("k")).distinct()
    ks = ks.filter({1: k % 7 != 3, 2: k % 6 != 2, 3: F.lit(True)}[snapshot])
    city = (k + F.when(k % 5 == 1, 7).otherwise(0)) % 25 if snapshot >= 2 else k % 25
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (ks.join(nation, city == F.col("n_nationkey"), "left")
              .select(F.concat(F.lit("T"), _pad(k, 3)).alias("terminal_id"),
                      F.when(k % 2 == 0, "ATM").otherwise("POS").alias("terminal_type"),
                      F.col("n_name").alias("terminal_city"),
                      F.concat(F.lit("addr "), k.cast("string")).alias("terminal_address"),
                      ts_lit(SNAPSHOT_RUNS[snapshot]).alias("update_dt")))


# Fixed value of the fixture definition: a week of operations in 20 minutes.
BURST = 504


def burst_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with each week's times squeezed into its first 20 minutes, so
    that chains of attempts on one card stand close together."""
    tr = transactions(spark, sf_dir)
    t = F.col("transaction_date")
    week = F.floor(F.datediff(t, F.lit("2024-01-01").cast("date")) / 7).cast("int")
    start = F.date_add(F.lit("2024-01-01").cast("date"), week * 7)
    seconds = F.datediff(t, start) * 86400 + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
    at = start.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                                          F.floor(seconds / BURST).cast("decimal(18,6)"))
    return tr.withColumn("transaction_date", at)


def blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month-to-date blacklist: ``cust % 10 = 1`` listed, ``cust % 20 = 1`` twice."""
    cust = F.col("c_custkey")
    cu = table(spark, sf_dir, "customer").filter(cust % 10 == 1)
    first = cu.select(ts_lit(BLACKLIST_DAYS[0]).alias("entry_dt"),
                      F.concat(F.lit("PP"), _pad(cust, 8)).alias("passport"))
    again = cu.filter(cust % 20 == 1).select(ts_lit(BLACKLIST_DAYS[1]).alias("entry_dt"),
                                             F.concat(F.lit("PP"), _pad(cust, 8)).alias("passport"))
    return first.unionByName(again)
