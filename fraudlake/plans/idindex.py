"""Index of the fact's operation ids: what an append compares a batch with.

``fact_ids/<folder>`` holds ``(transaction_id, event_date)`` of the appended
operations, each folder range-partitioned and sorted by id. A batch looks up
the range between its least and largest id, so row groups outside it are
skipped by their statistics: with ids that rise over time a load reads the end of
the index, however long the history; with ids in no order it reads the ids, never
the fact. The fact's rows are read for ids that are stored already, on their
days only.

Folders are merged ``FAN`` at a time into one of the next level (``L0-``,
``L1-``, ...), so there are at most ``FAN`` per level and O(log loads) in all. One row of the commit
log makes a folder live; the rows of a merge also name what it replaces, in
one file, so a reader sees the old folders or the new one.

An append logs its days before it writes (``FACT_BEGIN``) and its index folder
afterwards (``IDS``). One that died between the two is found by the next append, which
reads the fact's ids on those days and completes the index; a fact older than
the index is indexed once as a whole. There is one appending run at a time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake.plans import warehouse as W

FAN = 8
SCHEMA = "transaction_id string, event_date date"


def _folders(spark: SparkSession, wh: W.Warehouse) -> tuple[list[str], set[str]]:
    """Live folders, and all that were ever committed (a row per load each)."""
    rows = W.commit_log(spark, wh, "IDS").select("folder", "file_name").collect()
    every = {r["folder"] for r in rows}
    return sorted(every - {r["file_name"] for r in rows}), every


def live(spark: SparkSession, wh: W.Warehouse) -> list[str]:
    """Folders that make up the index."""
    return _folders(spark, wh)[0]


def ids(spark: SparkSession, wh: W.Warehouse) -> DataFrame:
    """``(transaction_id, event_date)`` of the live folders."""
    live, _ = _folders(spark, wh)
    if not live:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(*[f"{wh.ids}/{f}" for f in live])


def _write(rows: DataFrame, wh: W.Warehouse, folder: str) -> None:
    rows.select("transaction_id", "event_date").repartitionByRange("transaction_id") \
        .sortWithinPartitions("transaction_id").write.mode("overwrite").parquet(f"{wh.ids}/{folder}")


def begin(spark: SparkSession, wh: W.Warehouse, first: dt.date | None, last: dt.date | None) -> str:
    """Log that operations of the days ``first..last`` are about to be appended."""
    attempt = W.new_folder("L0")
    days = spark.range(1).select(F.lit(first).alias("first_day"), F.lit(last).alias("last_day"))
    W._commit_rows(days, wh, "FACT_BEGIN", attempt)
    return attempt


def add(spark: SparkSession, wh: W.Warehouse, rows: DataFrame, attempt: str) -> None:
    """Make an append's ids known; then merge folders where a level is full."""
    _write(rows, wh, attempt)
    W._commit_rows(spark.range(1), wh, "IDS", attempt)
    level = 0
    while True:
        mine = [f for f in _folders(spark, wh)[0] if f.startswith(f"L{level}-")]
        if len(mine) < FAN:
            break
        merged = W.new_folder(f"L{level + 1}")
        _write(spark.read.schema(SCHEMA).parquet(*[f"{wh.ids}/{f}" for f in mine]), wh, merged)
        gone = spark.createDataFrame([(f,) for f in mine], "file_name string").coalesce(1)
        W._commit_rows(gone, wh, "IDS", merged)
        level += 1


def repair(spark: SparkSession, wh: W.Warehouse) -> None:
    """Complete the index after appends that died, and for a fact without one."""
    begun = W.commit_log(spark, wh, "FACT_BEGIN").select("folder", "first_day", "last_day").collect()
    _, every = _folders(spark, wh)
    fact = W.read_fact(spark, wh).select("transaction_id", "event_date")
    if not begun and not every:
        if not fact.isEmpty():
            add(spark, wh, fact, W.new_folder("L0"))
        return
    for r in begun:
        if r["folder"] not in every:
            days = fact.filter(F.col("event_date").between(F.lit(r["first_day"]), F.lit(r["last_day"])))
            add(spark, wh, days.join(ids(spark, wh).select("transaction_id"), "transaction_id", "left_anti"), r["folder"])


def known(spark: SparkSession, wh: W.Warehouse, batch: DataFrame) -> DataFrame:
    """``(transaction_id, event_date)`` of the batch's ids that are stored."""
    if not live(spark, wh):
        return spark.createDataFrame([], SCHEMA)
    low, high = batch.agg(F.min("transaction_id"), F.max("transaction_id")).first()
    near = ids(spark, wh).filter(F.col("transaction_id").between(F.lit(low), F.lit(high)))
    return near.join(batch.select("transaction_id").distinct(), "transaction_id", "left_semi")


def stored_rows(spark: SparkSession, wh: W.Warehouse, batch: DataFrame, hits: DataFrame | None = None) -> DataFrame:
    """The fact's rows of the batch's ids, read from the days of those ids only.
    ``hits``: ``known`` of the batch, already computed."""
    if hits is None:
        hits = W.cut_lineage(known(spark, wh, batch), "known-ids")
    days = [r["event_date"] for r in hits.select("event_date").distinct().collect()]   # a date a row
    return W.read_fact(spark, wh).filter(F.col("event_date").isin(days)) \
            .join(hits.select("transaction_id"), "transaction_id", "left_semi")
