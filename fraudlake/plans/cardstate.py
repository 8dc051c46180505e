"""Each card's last operations, carried from day to day for rule 4.

A snapshot (``card_state/run=<folder>``) holds, for every card, its last ``KEEP``
operations up to the end of a day: all that rule 4's lags can reach back to.
The state before a day is the newest valid snapshot merged with the days since,
so a daily run reads one snapshot and the day's partition and no older operation,
however old a card's predecessor is.

A snapshot is valid if no append that began after it was computed holds
operations of its days (``FACT_BEGIN`` rows of the commit log); an older one, or the fact
from its first day, takes the place of one that late operations outdate. The sweep
(``sweep``) leaves the snapshots of the last days only.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlake.plans import commitlog, warehouse as W
from fraudlake.schemas import TRANSACTIONS

KEEP = 4
COLUMNS = ["card_num", "transaction_date", "transaction_id", "amount", "oper_result"]
SCHEMA = T.StructType([TRANSACTIONS[c] for c in COLUMNS])


def last_operations(ops: DataFrame, keep: int = KEEP) -> DataFrame:
    """The last ``keep`` operations of each card (by time, then id); a task
    drops a hot card's older operations before the shuffle."""
    newest = Window.partitionBy("card_num").orderBy(F.desc("transaction_date"), F.desc("transaction_id"))
    return ops.select(*COLUMNS).withColumn("_n", F.row_number().over(newest)).filter(F.col("_n") <= keep).drop("_n")


def _newest(spark: SparkSession, wh: W.Warehouse, day: dt.date) -> tuple[str, dt.date] | None:
    """The folder and day of the newest valid snapshot that ends before ``day``."""
    snaps = W.commit_log(spark, wh, "CARD_STATE").filter(F.col("last_day") < F.lit(day)) \
             .filter(F.col("folder").isin([n.removeprefix("run=") for n in commitlog.listing(spark, wh.card_state)])) \
             .select("folder", "last_day", "committed_at")
    late = W.commit_log(spark, wh, "FACT_BEGIN").select(F.col("first_day").alias("_from"), F.col("committed_at").alias("_at"))
    valid = snaps.join(late, (F.col("_from") <= F.col("last_day")) & (F.col("_at") >= F.col("committed_at")), "left_anti")
    row = valid.agg(F.max(F.struct("last_day", "committed_at", "folder")).alias("m")).first()["m"]
    return (row["folder"], row["last_day"]) if row else None


def before(spark: SparkSession, wh: W.Warehouse, day: dt.date) -> DataFrame:
    """Each card's last operations before ``day``."""
    fact = W.read_fact(spark, wh).filter(F.col("event_date") < F.lit(day))
    snap = _newest(spark, wh, day)
    if snap is None:
        return last_operations(fact)
    folder, upto = snap
    kept = spark.read.schema(SCHEMA).parquet(f"{wh.card_state}/run={folder}")
    if upto == day - dt.timedelta(days=1):
        return kept
    return last_operations(kept.unionByName(fact.filter(F.col("event_date") > F.lit(upto)).select(*COLUMNS)))


def store(spark: SparkSession, wh: W.Warehouse, day: dt.date) -> None:
    """Store the state at the end of ``day``, unless a valid one is there."""
    at = W.next_number(spark, wh)     # what is appended from now on may not be in it
    snap = _newest(spark, wh, day + dt.timedelta(days=1))
    if snap is not None and snap[1] == day:
        return
    folder = W.new_folder("state")
    before(spark, wh, day + dt.timedelta(days=1)).write.parquet(f"{wh.card_state}/run={folder}")
    days = spark.range(1).select(F.lit(day).alias("last_day"))
    W._commit_rows(days, wh, "CARD_STATE", folder, at)
