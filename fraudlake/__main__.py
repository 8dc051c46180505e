"""Command line for the daily run and the backfill (works under spark-submit).

    python -m fraudlake run-day  --warehouse W --landing L --day 2024-01-16 \
        [--bank-url URL --bank-driver CLASS --bank-user U --bank-password P --dialect oracle]
    python -m fraudlake run-landing --warehouse W --landing L --run-ts 2024-01-16 [--on-bad file] [--bank-url ...]
    python -m fraudlake backfill --warehouse W --start 2024-01-01 --end 2024-01-31
    python -m fraudlake sweep --warehouse W [--older-than-hours 24]
"""

from __future__ import annotations

import argparse
import datetime as dt

from fraudlake.plans import daily, sweep
from fraudlake.plans.warehouse import Warehouse
from fraudlake.session import build_session


def _date(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="fraudlake")
    sub = p.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run-day", help="load one day's feeds, then write that day's report")
    run.add_argument("--warehouse", required=True)
    run.add_argument("--landing", required=True)
    run.add_argument("--day", required=True, type=_date)
    run.add_argument("--run-ts", help="SCD2 run time (default: the day's midnight)")
    run.add_argument("--bank-url")
    run.add_argument("--bank-driver")
    run.add_argument("--bank-user")
    run.add_argument("--bank-password")
    run.add_argument("--dialect", default="ansi")
    land = sub.add_parser("run-landing", help="load the oldest new file of each feed, then write that day's report")
    land.add_argument("--warehouse", required=True)
    land.add_argument("--landing", required=True)
    land.add_argument("--run-ts", required=True, help="SCD2 run time")
    for sp in (run, land):
        sp.add_argument("--on-bad", choices=("row", "file"), default="row")
        sp.add_argument("--bank-slice-column", help="read bank tables in parallel ranges of this column")
        sp.add_argument("--bank-slice-bounds", help="its smallest and largest value: LO,HI")
        sp.add_argument("--bank-slices", type=int, default=8)
    land.add_argument("--bank-url")
    land.add_argument("--bank-driver")
    land.add_argument("--bank-user")
    land.add_argument("--bank-password")
    land.add_argument("--dialect", default="ansi")
    back = sub.add_parser("backfill", help="rewrite the report for a range of days")
    back.add_argument("--warehouse", required=True)
    back.add_argument("--start", required=True, type=_date)
    back.add_argument("--end", required=True, type=_date)
    tidy = sub.add_parser("sweep", help="delete folders that no commit needs, marked by an earlier sweep")
    tidy.add_argument("--warehouse", required=True)
    tidy.add_argument("--older-than-hours", type=float, default=24)
    for sp in (run, land, back, tidy):
        sp.add_argument("--master", default=None, help="for local runs; spark-submit sets it")
    a = p.parse_args(argv)

    spark = build_session(a.master) if a.master else build_session_from_submit()
    wh = Warehouse(a.warehouse)
    if a.cmd == "sweep":
        for folder in sweep.sweep(spark, wh, dt.timedelta(hours=a.older_than_hours)):
            print(folder)
        return
    if a.cmd != "backfill":
        props = {k: v for k, v in (("driver", a.bank_driver), ("user", a.bank_user),
                                   ("password", a.bank_password)) if v}
        bounds = tuple(a.bank_slice_bounds.split(",")) if a.bank_slice_bounds else None
        bank = daily.BankSource(a.bank_url, props or None, a.dialect, None, a.bank_slice_column, bounds,
                                a.bank_slices) if a.bank_url else None
    if a.cmd == "run-day":
        feeds = daily.feeds_from_folder(spark, a.landing, a.day)
        feeds.bank = bank
        run_ts = dt.datetime.fromisoformat(a.run_ts) if a.run_ts else \
            dt.datetime(a.day.year, a.day.month, a.day.day)
        daily.run_day(spark, wh, feeds, run_ts, a.day, a.on_bad)
    elif a.cmd == "run-landing":
        daily.run_landing(spark, wh, a.landing, dt.datetime.fromisoformat(a.run_ts), bank, a.on_bad)
    else:
        daily.backfill(spark, wh, a.start, a.end)


def build_session_from_submit():
    """Session from spark-submit's settings plus the package's required ones."""
    from pyspark.sql import SparkSession
    from fraudlake.session import SESSION_CONF
    b = SparkSession.builder.appName("fraudlake")
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    return b.getOrCreate()


if __name__ == "__main__":
    main()
