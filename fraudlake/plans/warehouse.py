"""Warehouse storage on Parquet: facts, versioned dimensions, commit log, mart.

One commit rule for everything but the fact: a load writes a folder of its
own (``run=<id>-<attempt>``) and then one row in a commit log that names the
folder. Readers look up committed folders only, so a load that dies half way,
or a rerun in progress, is never seen, and what it would replace stays
readable until the commit. Layout under one root folder:

- ``fact_transactions/event_date=YYYY-MM-DD``: append-only fact; an append
  skips ids that are stored, so a rerun adds nothing.
- ``fact_blacklist/run=<folder>``: a full listing per load; the last committed
  one is the blacklist.
- ``dim_<name>/run=<folder>/state=open|closed``: the versions a load produced; a
  dimension's history at run R is the ``open`` rows of R plus the ``closed``
  rows of the committed runs up to R. Closed folders older than the last
  ``RECENT`` loads are merged ``FAN`` to one, level by level (``compact``), so a
  history of N loads reads O(log N) folders.
- ``meta/table_name=.../<n>.json``: commit log of the dimensions ``(table_db,
  table_name, last_update_dt, run_id, folder, committed_at, replaces)``; the latest
  run per table is the watermark (the source system's meta table). Commit n + 1
  can be taken once: of two loads from the same state one wins, the other reads again.
- ``rep_fraud/run=<folder>/report_day=YYYY-MM-DD``: the mart; for each report
  day the last committed folder whose days include it.
- ``rejects/run=<folder>``: refused lines; per file the last committed load.
- ``commits/table_name=...``: commit log of blacklist, report and rejects, and
  the record of loaded and refused files, ordered by numbers taken once in
  ``sequence`` (no driver's clock decides what is newer).
- ``refused_files``: repeats of loaded files.
- ``fact_ids``: sorted index of the fact's ids (``idindex``); ``card_state``: the
  cards' last operations by day (``cardstate``); ``card_profile``, ``profile_log``: the
  cards' segments, kept up to date by changed cards (``profile``).
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlake.functions.expr import open_end, ts_lit
from fraudlake.operators.scd2 import scd2_step
from fraudlake.plans import commitlog
from fraudlake.schemas import (
    BLACKLIST, FIRST_WATERMARK, META, REJECTS, REPORT, TABLE_DB, TRANSACTIONS, DimSpec,
)
from fraudlake.session import cut_lineage
from fraudlake.sources.intake import duplicate_transactions, new_transactions, repeated_ids

META_LOG = T.StructType(META.fields + [T.StructField("run_id", T.LongType(), True),
                                       T.StructField("folder", T.StringType(), True),
                                       T.StructField("committed_at", T.LongType(), True),
                                       T.StructField("replaces", T.ArrayType(T.StringType()), True)])
FAN = 8         # closed folders of a level that are merged into one of the next
RECENT = 8      # loads whose folders are left as they are, so that they can be repeated
COMMITS = T.StructType([
    T.StructField("table_name", T.StringType(), True), T.StructField("folder", T.StringType(), True),
    T.StructField("committed_at", T.LongType(), True), T.StructField("first_day", T.DateType(), True),
    T.StructField("last_day", T.DateType(), True), T.StructField("file_name", T.StringType(), True),
])


def run_id(run_ts: dt.datetime) -> int:
    return int(run_ts.strftime("%Y%m%d%H%M%S"))


def new_folder(rid: int | str) -> str:
    """A folder name for one attempt of a load."""
    return f"{rid}-{uuid.uuid4().hex[:12]}"


@dataclass(frozen=True)
class Warehouse:
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def fact(self) -> str:
        return self.path("fact_transactions")

    @property
    def ids(self) -> str:
        return self.path("fact_ids")

    @property
    def card_state(self) -> str:
        return self.path("card_state")

    @property
    def profile(self) -> str:
        return self.path("card_profile")

    @property
    def profile_log(self) -> str:
        return self.path("profile_log")

    @property
    def blacklist(self) -> str:
        return self.path("fact_blacklist")

    @property
    def commits(self) -> str:
        return self.path("commits")

    @property
    def meta(self) -> str:
        return self.path("meta")

    @property
    def sequence(self) -> str:
        return self.path("sequence")

    @property
    def report(self) -> str:
        return self.path("rep_fraud")

    @property
    def rejects(self) -> str:
        return self.path("rejects")

    @property
    def refused(self) -> str:
        return self.path("refused_files")

    def dim(self, spec: DimSpec) -> str:
        return self.path(f"dim_{spec.name.lower()}")


def _read(spark: SparkSession, path: str, schema: T.StructType, **opts) -> DataFrame:
    """A Parquet table, or an empty one of that schema before its first write."""
    try:
        return spark.read.schema(schema).options(**opts).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return spark.createDataFrame([], schema)
        raise


# --- meta / commit log --------------------------------------------------------

def meta_log(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """The commit log, partitioned by ``table_name`` (a lookup for one table
    reads only that table's folder)."""
    if not commitlog.listing(spark, wh.meta):
        return spark.createDataFrame([], META_LOG)
    return spark.read.schema(META_LOG).option("basePath", wh.meta).json(wh.meta)


def meta_current(log: DataFrame) -> DataFrame:
    """The meta table: per table the row of its latest committed run."""
    last = F.max(F.struct("run_id", "last_update_dt", "table_db")).alias("m")
    return (log.groupBy("table_name").agg(last)
               .select(F.col("m.table_db").alias("table_db"), "table_name",
                       F.col("m.last_update_dt").alias("last_update_dt"),
                       F.col("m.run_id").alias("run_id")))


def meta_advance(meta: DataFrame, table_name: str, run_ts: dt.datetime) -> DataFrame:
    """Set one table's watermark to the run date; other rows unchanged."""
    hit = F.col("table_name") == table_name
    return meta.withColumn("last_update_dt", F.when(hit, ts_lit(run_ts)).otherwise(F.col("last_update_dt")))


def seed_meta(spark: SparkSession, tables: list[str]) -> DataFrame:
    """Initial meta rows: every table at the first watermark."""
    rows = [(TABLE_DB, t, FIRST_WATERMARK, 0, None, 0, None) for t in tables]
    return spark.createDataFrame(rows, META_LOG)


def _log_folder(wh: Warehouse, table: str) -> str:
    return f"{wh.meta}/table_name={table}"


def history_log(spark: SparkSession, wh: Warehouse, table: str) -> list:
    """The rows of a dimension's commit log, one per load or merge, in order."""
    return meta_log(spark, wh).filter(F.col("table_name") == table).orderBy("committed_at").collect()


def live_folders(log: list, upto: int | None = None) -> tuple[dict[int, str], list[str], set[str]]:
    """``(loads, closed, merged)`` of a history at run ``upto`` (default: the
    latest): each run's folder (of a repeated run the last commit's), the folders
    whose closed rows make up the history, and those that a merge replaced.
    A merge that holds later runs is not used."""
    log = [r for r in log if upto is None or r["run_id"] <= upto]
    loads = {r["run_id"]: r["folder"] for r in log if r["replaces"] is None}
    merges = [r for r in log if r["replaces"] is not None]
    merged = {f for r in merges for f in r["replaces"]}
    closed = [f for f in [*loads.values(), *(r["folder"] for r in merges)] if f not in merged]
    return loads, closed, merged


def commit(spark: SparkSession, wh: Warehouse, table: str, rid: int, watermark: dt.datetime | None,
           folder: str, number: int, replaces: list[str] | None = None) -> bool:
    """Make a folder part of a dimension as commit ``number``; False if another
    load or merge took that number."""
    row = {"table_db": TABLE_DB, "last_update_dt": watermark and watermark.isoformat(), "run_id": rid,
           "folder": folder, "committed_at": number, "replaces": replaces}
    return commitlog.put_once(spark, commitlog.numbered(_log_folder(wh, table), number), json.dumps(row))


def commit_log(spark: SparkSession, wh: Warehouse, table: str) -> DataFrame:
    return _read(spark, wh.commits, COMMITS, basePath=wh.commits).filter(F.col("table_name") == table)


def next_number(spark: SparkSession, wh: Warehouse) -> int:
    """A number greater than those of all commits made before."""
    return commitlog.take_number(spark, wh.sequence)


def _commit_rows(rows: DataFrame, wh: Warehouse, table: str, folder: str, at: int | None = None) -> None:
    spark = rows.sparkSession
    out = rows.select(F.lit(table).alias("table_name"), F.lit(folder).alias("folder"),
                      F.lit(next_number(spark, wh) if at is None else at).cast("long").alias("committed_at"),
                      *[(F.col(c) if c in rows.columns else F.lit(None)).cast(COMMITS[c].dataType).alias(c)
                        for c in ("first_day", "last_day", "file_name")])
    out.write.mode("append").partitionBy("table_name").parquet(wh.commits)


# --- dimensions -----------------------------------------------------------------

def _dim_folders(spark: SparkSession, wh: Warehouse, spec: DimSpec, folders: list[str]) -> DataFrame:
    schema = T.StructType(spec.hist_schema.fields + [T.StructField("run", T.StringType(), True),
                                                     T.StructField("state", T.StringType(), True)])
    return spark.read.schema(schema).option("basePath", wh.dim(spec)) \
                .parquet(*[f"{wh.dim(spec)}/run={f}" for f in folders])


def read_dim(spark: SparkSession, wh: Warehouse, spec: DimSpec, rid: int | None = None,
             part: str = "all", valid_from: dt.datetime | None = None) -> DataFrame:
    """History as of committed run ``rid`` (default: the latest).

    ``part``: ``all``, ``open`` or ``closed``; only the live folders are listed
    and the state is a partition filter.
    ``valid_from``: only versions that can be valid at or after that moment,
    a filter on ``effective_to`` that the scan pushes to its row groups.
    """
    return _history(spark, wh, spec, history_log(spark, wh, spec.name), rid, part, valid_from)


def _history(spark: SparkSession, wh: Warehouse, spec: DimSpec, log: list, rid: int | None = None,
             part: str = "all", valid_from: dt.datetime | None = None) -> DataFrame:
    loads, closed, _ = live_folders(log, rid)
    if not loads:
        return spark.createDataFrame([], spec.hist_schema)
    last = loads.get(max(loads) if rid is None else rid)
    folders = {"all": {*closed, last}, "open": {last}, "closed": set(closed)}[part] - {None}
    if not folders:
        return spark.createDataFrame([], spec.hist_schema)
    d = _dim_folders(spark, wh, spec, sorted(folders))
    is_open = (F.col("run") == F.lit(last)) & (F.col("state") == "open")
    # Of the last load's folder only the open rows are read if a merge holds its closed ones.
    is_closed = (F.col("state") == "closed") if last in closed else (F.col("state") == "closed") & (F.col("run") != F.lit(last))
    if valid_from is not None:
        is_closed = is_closed & (F.col("effective_to") >= ts_lit(valid_from))
    cond = {"all": is_open | is_closed, "open": is_open, "closed": is_closed}[part]
    return d.filter(cond).select(*spec.hist_columns)


class ConcurrentLoad(RuntimeError):
    """Other loads of the same dimension were committed again and again."""


def load_dim(spark: SparkSession, wh: Warehouse, spec: DimSpec, source: DataFrame | None,
             run_ts: dt.datetime, keys: DataFrame | None = None,
             extract=None, allow_empty: bool = False, attempts: int = 5) -> int:
    """One SCD2 load of a dimension; returns its run id.

    ``source``: the source table now (normalized), or None when ``extract``
    fetches the changed rows itself. ``extract(source, watermark)`` stages
    the rows since the last committed watermark (default: all of
    ``source``); ``keys`` (default: the source's keys) decide deletions.
    Repeating the same ``run_ts`` replaces that run as a whole; a run whose
    closed rows were merged can no longer be repeated. If another load is
    committed meanwhile, the step is computed again from the new state.
    """
    rid = run_id(run_ts)
    if source is not None and extract is None:
        source = cut_lineage(source, "source")     # a full slice is the staged rows and the keys: computed once
    if keys is None:
        keys = source.select(F.col(spec.key).alias("id"))
    if not allow_empty and keys.isEmpty():
        raise ValueError(f"{spec.name}: empty source snapshot would delete every key")
    for _ in range(attempts):
        number = commitlog.head(spark, _log_folder(wh, spec.name)) + 1
        log = history_log(spark, wh, spec.name)
        if rid <= max((r["run_id"] for r in log if r["replaces"] is not None), default=-1):
            raise ValueError(f"{spec.name}: run {rid} is merged and cannot be repeated")
        earlier = [r for r in log if r["replaces"] is None and r["run_id"] < rid]
        prev = max(earlier, key=lambda r: (r["run_id"], r["committed_at"]), default=None)
        watermark = FIRST_WATERMARK if prev is None else prev["last_update_dt"]
        staged = source if extract is None else extract(source, watermark)
        opened = spark.createDataFrame([], spec.hist_schema) if prev is None \
            else _history(spark, wh, spec, log, prev["run_id"], "open")
        out = scd2_step(opened, staged, keys, run_ts, spec)
        state = F.when(F.col("effective_to") == open_end(), "open").otherwise("closed")
        folder = new_folder(rid)
        (out.withColumn("state", state)
            .write.partitionBy("state").parquet(f"{wh.dim(spec)}/run={folder}"))
        if commit(spark, wh, spec.name, rid, run_ts, folder, number):
            compact(spark, wh, spec)
            return rid
    raise ConcurrentLoad(spec.name)


def compact(spark: SparkSession, wh: Warehouse, spec: DimSpec) -> None:
    """Merge the closed folders before the last ``RECENT`` loads, ``FAN`` or more of a
    level into one of the next (``M1-``, ``M2-``, ...), sorted by ``effective_to`` so
    that later reports skip row groups. One commit row puts a merge in the place of its
    folders; a reader sees them or the merge. A merge that loses to a load
    is left for the next load."""
    level = 0
    while True:
        number = commitlog.head(spark, _log_folder(wh, spec.name)) + 1
        log = history_log(spark, wh, spec.name)
        loads, closed, _ = live_folders(log)
        runs = {r["folder"]: r["run_id"] for r in log}
        recent = {loads[r] for r in sorted(loads)[-RECENT:]}
        mine = [f for f in closed if f not in recent
                and (f.startswith(f"M{level}-") if level else not f.startswith("M"))]
        if len(mine) < FAN:
            return
        merged = new_folder(f"M{level + 1}")
        (_dim_folders(spark, wh, spec, mine).filter(F.col("state") == "closed").drop("run")
            .repartitionByRange("effective_to").sortWithinPartitions("effective_to")
            .write.partitionBy("state").parquet(f"{wh.dim(spec)}/run={merged}"))
        if not commit(spark, wh, spec.name, max(runs[f] for f in mine), None, merged, number, mine):
            return
        level += 1


# --- facts -------------------------------------------------------------------------

def read_fact(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """The fact with its partition column ``event_date`` (day filters prune)."""
    schema = T.StructType(TRANSACTIONS.fields + [T.StructField("event_date", T.DateType(), True)])
    return _read(spark, wh.fact, schema, basePath=wh.fact)


def lookup(spark: SparkSession, wh: Warehouse, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(ids that the fact holds, ids repeated in the batch)``, each computed once: what
    ``duplicates`` and ``append_transactions`` take as ``found``."""
    from fraudlake.plans import idindex
    idindex.repair(spark, wh)
    return (cut_lineage(idindex.known(spark, wh, batch), "known-ids"),
            cut_lineage(repeated_ids(batch), "repeated-ids"))


def append_transactions(spark: SparkSession, wh: Warehouse, batch: DataFrame,
                        found: tuple[DataFrame, DataFrame] | None = None) -> None:
    """Append new operations: one row per id, none already stored.

    Ids are unique over the whole fact; they are looked up in its id index, so
    no stored operation is read. ``found``: ``lookup`` of the batch, or of one that holds it.
    """
    from fraudlake.plans import idindex
    batch = batch.select(*[f.name for f in TRANSACTIONS.fields]) \
                 .withColumn("event_date", F.to_date("transaction_date"))
    known, repeated = found or lookup(spark, wh, batch)
    new = cut_lineage(new_transactions(batch, known, repeated), "new-operations")
    first, last = new.agg(F.min("event_date"), F.max("event_date")).first()
    if first is None:
        return
    attempt = idindex.begin(spark, wh, first, last)
    # One file per day and writer task of that day, not one per task and day.
    new.repartition("event_date", F.pmod(F.xxhash64("transaction_id"), F.lit(8))) \
       .write.mode("append").partitionBy("event_date").parquet(wh.fact)
    idindex.add(spark, wh, new, attempt)


def duplicates(spark: SparkSession, wh: Warehouse, batch: DataFrame,
               found: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Reject rows of a typed batch: ids repeated in it or stored with other values.
    ``found``: ``lookup`` of the batch."""
    from fraudlake.plans import idindex
    known, repeated = found or lookup(spark, wh, batch)
    return duplicate_transactions(batch, idindex.stored_rows(spark, wh, batch, known), repeated)


def replace_blacklist(spark: SparkSession, wh: Warehouse, blacklist: DataFrame, run_ts: dt.datetime) -> None:
    """Store a full listing; readers see it once it is committed."""
    folder = new_folder(run_id(run_ts))
    blacklist.select(*[f.name for f in BLACKLIST.fields]).write.parquet(f"{wh.blacklist}/run={folder}")
    _commit_rows(spark.range(1), wh, "BLACKLIST", folder)


def read_blacklist(spark: SparkSession, wh: Warehouse) -> DataFrame:
    last = current_folders(spark, wh, "BLACKLIST", []).first()[0]
    if last is None:
        return spark.createDataFrame([], BLACKLIST)
    return spark.read.schema(BLACKLIST).parquet(f"{wh.blacklist}/run={last}")


def write_rejects(spark: SparkSession, wh: Warehouse, rejects: DataFrame, files: DataFrame) -> None:
    """Store the refused lines of a load of ``files`` (``file_name``); they
    replace those of earlier loads of the same files, also when there are none."""
    folder = new_folder("rejects")
    rejects.select(*[f.name for f in REJECTS.fields]).write.parquet(f"{wh.rejects}/run={folder}")
    _commit_rows(files.select("file_name").distinct(), wh, "REJECTS", folder)


def read_rejects(spark: SparkSession, wh: Warehouse) -> DataFrame:
    last = current_folders(spark, wh, "REJECTS", ["file_name"]).toDF("_file", "_folder")
    schema = T.StructType(REJECTS.fields + [T.StructField("run", T.StringType(), True)])
    rows = _read(spark, wh.rejects, schema, basePath=wh.rejects)
    return rows.join(last, (F.col("run") == F.col("_folder")) & F.col("file_name").eqNullSafe(F.col("_file"))) \
               .select(*[f.name for f in REJECTS.fields])


def archive_files(spark: SparkSession, wh: Warehouse, files: DataFrame) -> None:
    """Record files as loaded: ``file_name`` and ``folder`` (its time stamp)."""
    _commit_files(files, wh, "LOADED")


def refuse_files(spark: SparkSession, wh: Warehouse, files: DataFrame, reason: str,
                 keep_rejects: bool = False) -> None:
    """Record files as refused, so that later runs pass them over; the same
    name with another time stamp is looked at again."""
    if not keep_rejects:
        rows = files.select("file_name", F.lit(reason).alias("reason"), F.lit(None).cast("string").alias("raw"))
        folder = new_folder("refused")
        rows.write.parquet(f"{wh.refused}/run={folder}")
    _commit_files(files, wh, "REFUSED")


def current_folders(spark: SparkSession, wh: Warehouse, table: str, keys: list[str]) -> DataFrame:
    """Per value of ``keys`` the ``folder`` of the last commit."""
    return commit_log(spark, wh, table).groupBy(*keys).agg(F.max_by("folder", "committed_at").alias("folder"))


def _commit_files(files: DataFrame, wh: Warehouse, table: str) -> None:
    files.select(F.lit(table).alias("table_name"), "folder", F.lit(next_number(files.sparkSession, wh)).cast("long").alias("committed_at"),
                 F.lit(None).cast("date").alias("first_day"), F.lit(None).cast("date").alias("last_day"), "file_name") \
         .write.mode("append").partitionBy("table_name").parquet(wh.commits)


def read_refused(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """``file_name, reason`` of repeated files."""
    return _read(spark, wh.refused, REJECTS).select("file_name", "reason")


# --- mart ----------------------------------------------------------------------------

def write_report(spark: SparkSession, report: DataFrame, wh: Warehouse, first: dt.date,
                 last: dt.date | None = None) -> None:
    """Replace the report days ``first..last``, also those without any row."""
    folder = new_folder("report")
    # Few files per day: rows are spread by id within their day.
    (report.withColumn("report_day", F.date_format("report_dt", "yyyy-MM-dd"))
           .repartition("report_day", F.pmod(F.xxhash64("tr_id"), F.lit(4)))
           .write.partitionBy("report_day").parquet(f"{wh.report}/run={folder}"))
    days = spark.range(1).select(F.lit(first).alias("first_day"), F.lit(last or first).alias("last_day"))
    _commit_rows(days, wh, "REPORT", folder)


def report_folders(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """``(d, folder)``: each report day's last committed folder."""
    day = F.explode(F.sequence("first_day", "last_day"))
    return (commit_log(spark, wh, "REPORT").select(day.alias("d"), "folder", "committed_at")
            .groupBy("d").agg(F.max_by("folder", "committed_at").alias("folder")))


def read_report(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """The mart: every report day as its last committed load left it."""
    latest = report_folders(spark, wh).select(F.date_format("d", "yyyy-MM-dd").alias("report_day"),
                                              F.col("folder").alias("run"))
    schema = T.StructType(REPORT.fields + [T.StructField("run", T.StringType(), True),
                                           T.StructField("report_day", T.StringType(), True)])
    rows = _read(spark, wh.report, schema, basePath=wh.report)
    return rows.join(latest, ["run", "report_day"]).select(*[f.name for f in REPORT.fields])
