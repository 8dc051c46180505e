"""The daily run and the report backfill.

``run_day`` is the whole day's batch: intake of the day's feeds, SCD2 loads
of the four dimensions, then the fraud mart for the report day. Every step
is a Spark job whose result is written before the next step reads it, so a
failed step stops the run and a rerun redoes the day (what a load wrote
counts from its commit on, and the fact append skips stored ids).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake.functions.expr import blank_to_null
from fraudlake.operators.rules import fraud_report, in_days
from fraudlake.operators.scd2 import extract_since, normalize_source
from fraudlake.plans import cardstate, profile
from fraudlake.plans import warehouse as W
from fraudlake.schemas import ACCOUNTS, CARDS, CLIENTS, TERMINALS
from fraudlake.session import cut_lineage
from fraudlake.sources import jdbc, manifest, workbook
from fraudlake.sources.intake import read_transactions_csv, split_typed, typed_lines


@dataclass
class BankSource:
    """The bank's account/card/client tables over JDBC."""

    url: str
    props: dict[str, str] | None = None
    dialect: str = "ansi"
    tables: dict[str, str] | None = None   # dimension name -> table name
    slice_column: str | None = None        # read in parallel ranges of this column
    slice_bounds: tuple | None = None      # its smallest and largest value
    slices: int = 8

    def table(self, name: str) -> str:
        return (self.tables or {}).get(name, name.lower())


@dataclass
class DayFeeds:
    """What arrived for a day; any part may be missing."""

    transactions_raw: DataFrame | None = None   # raw text rows (sources.intake)
    blacklist: DataFrame | None = None          # entry_dt, passport (and file_name)
    terminals: DataFrame | None = None          # full slice, update_dt = file date (and file_name)
    refused: dict[str, tuple[str, DataFrame]] | None = None   # of "blacklist" and "terminals": file, refused rows
    accounts: DataFrame | None = None           # bank tables now (JDBC or files)
    cards: DataFrame | None = None
    clients: DataFrame | None = None
    bank: BankSource | None = None              # extract over JDBC instead


def feeds_from_folder(spark: SparkSession, folder: str, day: dt.date, bank_url: str | None = None,
                      bank_props: dict[str, str] | None = None, dialect: str = "ansi",
                      bank_tables: dict[str, str] | None = None) -> DayFeeds:
    """The day's files in a landing folder (``<kind>_DDMMYYYY.<ext>``) and,
    with ``bank_url``, the bank tables over JDBC: only rows changed since the
    watermark are extracted (the filter runs in the database), plus the key
    column for delete detection."""
    stamp = day.strftime("%d%m%Y")

    def present(pattern: str) -> str | None:
        path = f"{folder.rstrip('/')}/{pattern}"
        try:
            spark.read.format("binaryFile").load(path).select("path").limit(1).collect()
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return None   # that feed did not arrive today
        return path

    tx = present(f"transactions_{stamp}.txt")
    bl = present(f"passport_blacklist_{stamp}.xlsx")
    tm = present(f"terminals_{stamp}.xlsx")
    feeds = DayFeeds(transactions_raw=read_transactions_csv(spark, tx) if tx else None, refused={})
    if bl:
        feeds.blacklist, bad = workbook.split_blacklist(spark, bl)
        feeds.refused["blacklist"] = bl.rsplit("/", 1)[1], bad
    if tm:
        feeds.terminals, bad = workbook.split_terminals(spark, tm)
        feeds.refused["terminals"] = tm.rsplit("/", 1)[1], bad
    if bank_url:
        feeds.bank = BankSource(bank_url, bank_props, dialect, bank_tables)
    return feeds


def load_transactions(spark: SparkSession, wh: W.Warehouse, raw: DataFrame, on_bad: str = "row") -> None:
    """Type a feed, store its rejects (bad lines and duplicate ids), append the
    rest; ``on_bad="file"`` appends nothing of a file that has any reject.

    Rejects are stored first: they are decided against the fact as it was. A
    rerun decides the same, since rows equal to stored ones are replays."""
    typed = cut_lineage(typed_lines(raw), "typed-feed")     # read and typed once
    good, bad = split_typed(typed, on_bad)
    files = typed.select("file_name") if "file_name" in raw.columns else \
        spark.range(1).select(F.lit(None).cast("string").alias("file_name"))
    found = W.lookup(spark, wh, good)
    refused = bad.unionByName(W.duplicates(spark, wh, good, found))
    if on_bad == "file":
        refused = cut_lineage(refused, "rejects")
    W.write_rejects(spark, wh, refused, files)
    if on_bad == "file":
        good = good.join(refused.select("file_name").distinct(), "file_name", "left_anti")
    W.append_transactions(spark, wh, good, found)


def load_feeds(spark: SparkSession, wh: W.Warehouse, feeds: DayFeeds, run_ts: dt.datetime,
               on_bad: str = "row") -> None:
    """Intake and SCD2 loads for one day. A refused workbook leaves what is
    stored as it was; its rejects are stored and the other feeds go on."""
    if feeds.transactions_raw is not None:
        load_transactions(spark, wh, feeds.transactions_raw, on_bad)
    for kind in ("blacklist", "terminals"):
        good = getattr(feeds, kind)
        if good is not None and kind in (feeds.refused or {}):
            name, bad = feeds.refused[kind]
            good, why = checked_workbook(spark, wh, kind, good, bad, on_bad, name)
            feeds = replace(feeds, **{kind: None if why else good.drop("file_name")})
    if feeds.blacklist is not None:
        W.replace_blacklist(spark, wh, feeds.blacklist, run_ts)
    if feeds.terminals is not None:
        # A full slice: it is the staged set and the live key set at once.
        W.load_dim(spark, wh, TERMINALS, normalize_source(feeds.terminals, TERMINALS), run_ts)
    for spec, src in ((ACCOUNTS, feeds.accounts), (CARDS, feeds.cards), (CLIENTS, feeds.clients)):
        if src is not None:
            W.load_dim(spark, wh, spec, normalize_source(src, spec), run_ts, extract=extract_since)
        elif feeds.bank is not None:
            b, table = feeds.bank, feeds.bank.table(spec.name)
            part = (b.slice_column, b.slice_bounds, b.slices)

            def changed(_, watermark, spec=spec, table=table):
                rows = jdbc.extract_since(spark, b.url, table, spec, watermark, b.dialect, b.props, *part)
                return normalize_source(rows, spec)

            keys = jdbc.live_keys(spark, b.url, table, spec, b.props, *part, b.dialect).select(
                blank_to_null("id").alias("id"))
            W.load_dim(spark, wh, spec, None, run_ts, keys=keys, extract=changed)


#: Share of the stored listing's passports, in the months that a new one covers,
#: that may be missing from it: within a month the file accumulates.
MAX_LOST = 0.5
SHRUNK = "listing lacks most passports stored for its months"
EMPTY = "no usable row"


def lost_share(stored: DataFrame, new: DataFrame) -> float:
    """Share of ``stored`` passports that ``new`` lacks, over the months of ``new``."""
    month = F.date_trunc("month", "entry_dt").alias("m")
    months = new.select(month).distinct()
    was = stored.select("passport", month).join(months, "m", "left_semi").select("passport").distinct()
    there = new.select("passport").distinct().withColumn("_there", F.lit(1))
    n, kept = was.join(there, "passport", "left").agg(F.count("*"), F.count("_there")).first()
    return (n - kept) / n if n else 0.0


def checked_workbook(spark: SparkSession, wh: W.Warehouse, kind: str, good: DataFrame, bad: DataFrame,
                     on_bad: str, file_name: str) -> tuple[DataFrame, str | None]:
    """``(rows, reason to refuse)`` of a workbook feed; its rejects are stored.

    Refused: a workbook that cannot be read, one without a usable row, with
    ``on_bad="file"`` one with any reject, and a blacklist that lost more than
    ``MAX_LOST`` of the stored one (see ``lost_share``)."""
    bad, good = cut_lineage(bad, "rejects"), cut_lineage(good, "workbook")
    why = None
    if not bad.filter(F.col("reason").startswith("unreadable file") if on_bad == "row" else F.lit(True)).isEmpty():
        why = "refused workbook"
    elif good.isEmpty():
        why = EMPTY
    elif kind == "blacklist" and lost_share(W.read_blacklist(spark, wh), good) > MAX_LOST:
        why = SHRUNK
    files = spark.range(1).select(F.lit(file_name).alias("file_name"))
    if why in (EMPTY, SHRUNK):
        bad = bad.unionByName(files.select("file_name", F.lit(why).alias("reason"), F.lit(None).cast("string").alias("raw")))
    W.write_rejects(spark, wh, bad, files)
    return good, why


REPEATED_FILE = "file was loaded before"


def run_landing(spark: SparkSession, wh: W.Warehouse, landing: str, run_ts: dt.datetime,
                bank: BankSource | None = None, on_bad: str = "row", **rule_args) -> dict[str, str]:
    """One daily run over a landing folder; returns ``{feed: file name}`` loaded.

    Per feed the oldest file that was neither loaded nor refused is taken
    (its date is in its name). A file that comes again under a loaded name is
    refused; so is a workbook that cannot be read, while the other feeds go
    on. The record of loaded files is the archive: files are not moved. The
    report written is that of the transaction file's date.
    """
    listed = cut_lineage(manifest.list_files(spark, landing).filter(F.col("file_date").isNotNull()), "landing")
    loaded = W.commit_log(spark, wh, "LOADED").select("file_name", "folder")
    stamp = F.col("modificationTime").cast("string")
    again = listed.join(loaded, "file_name", "left_semi") \
                  .join(loaded.withColumnRenamed("folder", "_stamp"), ["file_name"], "left") \
                  .filter(F.col("_stamp") != stamp).select("file_name", stamp.alias("folder")).distinct()
    refused = W.commit_log(spark, wh, "REFUSED").select("file_name", "folder")
    again = cut_lineage(again.join(refused, ["file_name", "folder"], "left_anti"), "again")
    if not again.isEmpty():
        W.refuse_files(spark, wh, again, REPEATED_FILE)
    todo = listed.withColumn("folder", stamp).join(loaded.select("file_name").distinct(), "file_name", "left_anti") \
                 .join(refused, ["file_name", "folder"], "left_anti")
    kinds = [k for k, _ in manifest.FEEDS]
    batch = {r["kind"]: r["file_name"] for r in manifest.oldest_batch(todo).filter(F.col("kind").isin(kinds)).collect()}
    path = {k: f"{landing.rstrip('/')}/{name}" for k, name in batch.items()}
    mtime = {r["file_name"]: r["folder"] for r in todo.filter(F.col("file_name").isin(list(batch.values())))
             .select("file_name", "folder").collect()} if batch else {}
    done: dict[str, str] = {}
    feeds = DayFeeds(bank=bank)
    for kind, split in (("passport_blacklist", workbook.split_blacklist), ("terminals", workbook.split_terminals)):
        if kind not in path:
            continue
        good, bad = split(spark, path[kind])
        feed = "blacklist" if kind == "passport_blacklist" else "terminals"
        good, why = checked_workbook(spark, wh, feed, good, bad, on_bad, batch[kind])
        if why:
            name = spark.createDataFrame([(batch[kind], mtime[batch[kind]])], "file_name string, folder string")
            W.refuse_files(spark, wh, name, why, keep_rejects=True)
            continue
        setattr(feeds, feed, good.drop("file_name"))
        done[kind] = batch[kind]
    if "transactions" in path:
        feeds.transactions_raw = read_transactions_csv(spark, path["transactions"])
        done["transactions"] = batch["transactions"]
    load_feeds(spark, wh, feeds, run_ts, on_bad)
    if "transactions" in done:
        day = dt.datetime.strptime(done["transactions"].rsplit("_", 1)[1][:8], "%d%m%Y").date()
        write_day(spark, wh, day, **rule_args)
    if done:
        W.archive_files(spark, wh, spark.createDataFrame([(n, mtime[n]) for n in done.values()],
                                                         "file_name string, folder string"))
    return done


def warehouse_view(spark: SparkSession, wh: W.Warehouse,
                   valid_from: dt.datetime | None = None) -> dict[str, DataFrame]:
    """Stored tables; with ``valid_from`` the dimensions skip versions that
    ended before it."""
    return {
        "tr": W.read_fact(spark, wh),
        "cards": W.read_dim(spark, wh, CARDS, valid_from=valid_from),
        "accounts": W.read_dim(spark, wh, ACCOUNTS, valid_from=valid_from),
        "clients": W.read_dim(spark, wh, CLIENTS, valid_from=valid_from),
        "terminals": W.read_dim(spark, wh, TERMINALS, valid_from=valid_from),
        "blacklist": W.read_blacklist(spark, wh),
    }


def build_report(spark: SparkSession, wh: W.Warehouse, report_day: dt.date | None = None,
                 until: dt.date | None = None, **rule_args) -> DataFrame:
    # Only the report days' operations are enriched, so versions that ended
    # before the first report day are never needed.
    since = dt.datetime(report_day.year, report_day.month, report_day.day) if report_day else None
    v = warehouse_view(spark, wh, since)
    state = cardstate.before(spark, wh, report_day) if report_day else None
    cards = in_days(v["tr"], report_day, until or report_day).select("card_num").distinct() if report_day else None
    stored = profile.read(spark, wh, v["blacklist"], cards, since)     # None: computed from the dimensions
    return fraud_report(v["tr"], v["cards"], v["accounts"], v["clients"], v["terminals"],
                        v["blacklist"], day=report_day, until=until, before=state, profile=stored, **rule_args)


def run_day(spark: SparkSession, wh: W.Warehouse, feeds: DayFeeds, run_ts: dt.datetime,
            report_day: dt.date, on_bad: str = "row", **rule_args) -> None:
    """One day: feeds in, dimensions loaded, the day's report (re)written."""
    load_feeds(spark, wh, feeds, run_ts, on_bad)
    write_day(spark, wh, report_day, **rule_args)


def write_day(spark: SparkSession, wh: W.Warehouse, report_day: dt.date, **rule_args) -> None:
    """(Re)write the stored report of one day; the cards' state at its end is
    kept for the next one, as is their profile after the day's loads. The state
    before the day is stored too if it is missing: the lags of rule 4 read it several times."""
    profile.refresh(spark, wh)
    cardstate.store(spark, wh, report_day - dt.timedelta(days=1))
    W.write_report(spark, build_report(spark, wh, report_day, **rule_args), wh, report_day)
    cardstate.store(spark, wh, report_day)


def backfill(spark: SparkSession, wh: W.Warehouse, start: dt.date, end: dt.date,
             **rule_args) -> None:
    """Reports for every day in ``[start, end]`` in one pass.

    All rules read the range's fact partitions only; rule 4 also the cards'
    state before ``start``, which is stored if it is missing. Days in range are replaced.
    """
    profile.refresh(spark, wh)
    cardstate.store(spark, wh, start - dt.timedelta(days=1))
    W.write_report(spark, build_report(spark, wh, start, until=end, **rule_args), wh, start, end)
