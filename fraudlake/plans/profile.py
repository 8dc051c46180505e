"""The card profile as stored state, brought up to date from what the loads changed.

``card_profile/run=<folder>`` holds segments of ``asof.card_profile`` (without the
blacklist, which is joined on reading). A refresh finds the cards that a load since the
last one touched, through their card, account or client, computes their segments again
and writes them as one small folder; the other cards are not computed. A reader
takes each card's rows of the greatest ``gen``, so a newer folder hides a card's older
rows; a card without any segment left has one row without a segment.

The state is one file per refresh in ``profile_log``, taken under the next number
(``commitlog``): the live folders and, per dimension, the number of the commit up to
which its loads are in. Of two refreshes at once one wins, the other begins
again. ``FAN`` small folders are merged to one, and ``FAN`` of those with the base into a new
base, so a reader lists fewer than ``2 * FAN`` folders. A repeated or late run,
or one older than the loads whose open versions are kept (``W.RECENT``), is not
followed: the profile is then computed as a whole.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fraudlake.functions.expr import ts_lit
from fraudlake.operators.asof import card_profile, first_listing
from fraudlake.plans import commitlog, warehouse as W
from fraudlake.schemas import ACCOUNTS, CARDS, CLIENTS, DimSpec
from fraudlake.session import cut_lineage

FAN = 8
SPECS = (CARDS, ACCOUNTS, CLIENTS)
BASE, MERGED, DELTA = "B", "M", "D"       # leading letter of a folder
STATE = "folders array<string>, upto map<string, long>"


def state(spark: SparkSession, wh: W.Warehouse) -> tuple[int, list[str], dict[str, int]]:
    """``(number, live folders, commit number per dimension)`` of the last refresh."""
    number = commitlog.head(spark, wh.profile_log)
    if not number:
        return 0, [], {}
    row = spark.read.schema(STATE).json(commitlog.numbered(wh.profile_log, number)).first()
    return number, row["folders"], row["upto"]


def _logs(spark: SparkSession, wh: W.Warehouse) -> dict[str, list]:
    return {s.name: W.history_log(spark, wh, s.name) for s in SPECS}


def _upto(logs: dict[str, list]) -> dict[str, int]:
    """Per dimension the number of its last load (merges change no row)."""
    return {name: max((r["committed_at"] for r in log if r["replaces"] is None), default=0) for name, log in logs.items()}


def _touched(spark: SparkSession, wh: W.Warehouse, spec: DimSpec, log: list, upto: int) -> DataFrame | None:
    """Keys of which loads after commit ``upto`` made or closed a version; None if
    that cannot be told from the folders kept."""
    key = F.col(spec.key).alias("key")
    old = [r for r in log if r["replaces"] is None and r["committed_at"] <= upto]
    new = [r for r in log if r["replaces"] is None and r["committed_at"] > upto]
    if not new:
        return spark.createDataFrame([], "key string")
    if not old:
        return None
    base = max(old, key=lambda r: (r["run_id"], r["committed_at"]))
    runs = [r["run_id"] for r in new]
    if min(runs) <= base["run_id"] or len(set(runs)) < len(runs) or len(runs) >= W.RECENT:
        return None
    closed = W._dim_folders(spark, wh, spec, [r["folder"] for r in new]).filter(F.col("state") == "closed").select(key)
    was = W._dim_folders(spark, wh, spec, [base["folder"]]).filter(F.col("state") == "open").select(key)
    now = W._history(spark, wh, spec, log, max(runs), "open").select(key)
    return closed.unionByName(now.join(was, "key", "left_anti")).distinct()


def touched_cards(spark: SparkSession, wh: W.Warehouse, logs: dict[str, list], upto: dict[str, int]) -> DataFrame | None:
    """Cards whose profile the loads after ``upto`` can have changed, with those of
    changed accounts and of accounts of changed clients, in any version."""
    keys = {s.name: _touched(spark, wh, s, logs[s.name], upto.get(s.name, 0)) for s in SPECS}
    if any(k is None for k in keys.values()):
        return None
    accounts = W._history(spark, wh, ACCOUNTS, logs["ACCOUNTS"])
    cards = W._history(spark, wh, CARDS, logs["CARDS"])
    of_clients = accounts.join(keys["CLIENTS"], accounts["client"] == F.col("key"), "left_semi") \
                         .select(F.col("account").alias("key"))
    changed = keys["ACCOUNTS"].unionByName(of_clients).distinct()
    of_accounts = cards.join(changed, cards["account"] == F.col("key"), "left_semi").select(F.col("card_num").alias("key"))
    return keys["CARDS"].unionByName(of_accounts).distinct().withColumnRenamed("key", "card_num")


def _segments(spark: SparkSession, wh: W.Warehouse, logs: dict[str, list], only: DataFrame | None = None) -> DataFrame:
    """The profile of all cards, or of the cards in ``only`` (each at least one row)."""
    cards, accounts, clients = (W._history(spark, wh, s, logs[s.name]) for s in SPECS)
    if only is None:
        return card_profile(cards, accounts, clients)
    cards = cards.join(only, "card_num", "left_semi")
    accounts = accounts.join(cards.select("account"), "account", "left_semi")
    clients = clients.join(accounts.select(F.col("client").alias("client_id")), "client_id", "left_semi")
    return only.join(card_profile(cards, accounts, clients), "card_num", "left")


def newest(rows: DataFrame) -> DataFrame:
    """Each card's rows of its greatest ``gen``."""
    last = F.max("gen").over(Window.partitionBy("card_num"))
    return rows.withColumn("_last", last).filter(F.col("gen") == F.col("_last")).drop("_last")


def _stored(spark: SparkSession, wh: W.Warehouse, folders: list[str]) -> DataFrame:
    paths = [f"{wh.profile}/run={f}" for f in folders]
    schema = spark.read.parquet(paths[0]).schema
    return spark.read.schema(schema).parquet(*paths)


def _merged(spark: SparkSession, wh: W.Warehouse, folders: list[str]) -> list[str]:
    """Live folders after the merges that are due; a merge takes the newest ones."""
    for kind, into in ((DELTA, MERGED), (MERGED, BASE)):
        mine = [f for f in folders if f.startswith(kind)]
        if len(mine) >= FAN:
            mine = folders if into == BASE else mine
            rows = newest(_stored(spark, wh, mine))
            merged = W.new_folder(into)
            (rows.filter(F.col("seg_from").isNotNull()) if into == BASE else rows).write.parquet(f"{wh.profile}/run={merged}")
            folders = [f for f in folders if f not in mine] + [merged]
    return folders


def refresh(spark: SparkSession, wh: W.Warehouse, attempts: int = 5) -> None:
    """Bring the stored profile up to the last loads of cards, accounts and clients."""
    for _ in range(attempts):
        number, folders, upto = state(spark, wh)
        logs = _logs(spark, wh)
        now = _upto(logs)
        if number and now == upto:
            return
        cards = touched_cards(spark, wh, logs, upto) if number else None
        if cards is None:
            folder, rows, folders = W.new_folder(BASE), _segments(spark, wh, logs), []
        else:
            # The cards are needed three times: as the rows' keys and to cut the dimensions.
            folder, rows = W.new_folder(DELTA), _segments(spark, wh, logs, cut_lineage(cards, "touched-cards"))
        rows.withColumn("gen", F.lit(number + 1).cast("long")).write.parquet(f"{wh.profile}/run={folder}")
        live = _merged(spark, wh, [*folders, folder])
        if commitlog.put_once(spark, commitlog.numbered(wh.profile_log, number + 1),
                              json.dumps({"folders": live, "upto": now})):
            return
    raise W.ConcurrentLoad("card profile")


def read(spark: SparkSession, wh: W.Warehouse, blacklist: DataFrame, cards: DataFrame | None = None,
         valid_from: dt.datetime | None = None) -> DataFrame | None:
    """The profile with the passports' first listings, as ``card_profile`` gives it, or
    None if a load came after the last refresh.

    ``cards`` (``card_num``): of these cards only, cut before anything is
    shuffled by passport. ``valid_from``: segments that end at or after it.
    """
    number, folders, upto = state(spark, wh)
    if not number or upto != _upto(_logs(spark, wh)):
        return None
    rows = _stored(spark, wh, folders)
    if cards is not None:
        rows = rows.join(cards, "card_num", "left_semi")
    if len(folders) > 1:
        rows = newest(rows)
    since = F.col("seg_from").isNotNull()
    if valid_from is not None:
        since = since & (F.col("seg_to") >= ts_lit(valid_from))
    rows = rows.filter(since).drop("gen")
    bl = first_listing(blacklist).select(F.col("passport").alias("_bl_passport"), F.col("entry_dt").alias("bl_entry_dt"))
    return rows.join(bl, F.col("cl_passport_num") == F.col("_bl_passport"), "left").drop("_bl_passport")
