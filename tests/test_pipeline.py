"""Three-day replay through storage: dims, fact, mart; a rerun is a no-op."""

import datetime as dt
import re

from pyspark.sql import functions as F

from fraudlake.operators.rules import fraud_report
from fraudlake.plans import daily, demo
from fraudlake.plans import warehouse as W
from fraudlake.schemas import ACCOUNTS, CARDS, CLIENTS, TERMINALS
from fraudlake.sources import fixture

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def feeds(spark, n, prev_run):
    run = demo.RUNS[n]
    raw = fixture.raw_transactions(spark, SF)
    day = F.to_timestamp(F.col("transaction_date"))
    raw = raw.filter((day >= F.lit(prev_run)) & (day < F.lit(run + dt.timedelta(days=1))))
    return daily.DayFeeds(
        transactions_raw=raw, blacklist=fixture.blacklist(spark, SF), terminals=fixture.terminals(spark, SF),
        accounts=fixture.accounts(spark, SF), cards=fixture.cards(spark, SF),
        clients=fixture.clients(spark, SF, n))


def test_three_day_replay(spark, scratch):
    wh = W.Warehouse(f"{scratch}/wh")
    prev = dt.datetime(2024, 1, 1)
    for n in (1, 2, 3):
        daily.run_day(spark, wh, feeds(spark, n, prev), demo.RUNS[n], demo.RUNS[n].date())
        prev = demo.RUNS[n] + dt.timedelta(days=1)

    assert rows(W.read_dim(spark, wh, CLIENTS)) == rows(demo.clients_history(spark, SF, 3))
    assert rows(W.read_dim(spark, wh, ACCOUNTS)) == rows(demo.accounts_history(spark, SF))
    assert rows(W.read_dim(spark, wh, CARDS)) == rows(demo.cards_history(spark, SF))
    assert rows(W.read_dim(spark, wh, TERMINALS)) == rows(demo.terminals_history(spark, SF))
    # history as of run 2 is still readable
    rid2 = W.run_id(demo.RUNS[2])
    assert rows(W.read_dim(spark, wh, CLIENTS, rid2)) == rows(demo.clients_history(spark, SF, 2))

    meta = {r["table_name"]: r["last_update_dt"] for r in W.meta_current(W.meta_log(spark, wh)).collect()}
    assert meta == {t: demo.RUNS[3] for t in ("ACCOUNTS", "CARDS", "CLIENTS", "TERMINALS")}

    fact = W.read_fact(spark, wh).drop("event_date")
    assert fact.filter(F.col("transaction_date") >= F.lit(dt.datetime(2024, 1, 24))).count() == 0
    assert fact.count() == fact.select("transaction_id").distinct().count()

    # backfill of every loaded day equals the one-pass report over storage
    daily.backfill(spark, wh, dt.date(2024, 1, 1), dt.date(2024, 1, 23))
    w = demo.warehouse(spark, SF)
    expect = fraud_report(fact, w.cards, w.accounts, w.clients, w.terminals, w.blacklist)
    assert rows(W.read_report(spark, wh)) == rows(expect)

    # pruning closed versions by run changes no report row
    for day in (dt.date(2024, 1, 16), dt.date(2024, 1, 23)):
        v = daily.warehouse_view(spark, wh)
        full = fraud_report(v["tr"], v["cards"], v["accounts"], v["clients"], v["terminals"],
                            v["blacklist"], day=day)
        assert rows(daily.build_report(spark, wh, day)) == rows(full)
    plan = W.read_dim(spark, wh, CLIENTS, valid_from=dt.datetime(2024, 1, 20))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters" in plan and "run#" in plan

    # rerunning day 3 changes nothing
    before_dims = rows(W.read_dim(spark, wh, CLIENTS))
    before_rep = rows(W.read_report(spark, wh))
    daily.run_day(spark, wh, feeds(spark, 3, demo.RUNS[2] + dt.timedelta(days=1)), demo.RUNS[3],
                  demo.RUNS[3].date())
    assert rows(W.read_dim(spark, wh, CLIENTS)) == before_dims
    assert rows(W.read_report(spark, wh)) == before_rep


def test_day_report_prunes_fact_partitions(spark, scratch):
    wh = W.Warehouse(f"{scratch}/wh")
    daily.load_feeds(spark, wh, feeds(spark, 1, dt.datetime(2024, 1, 1)), demo.RUNS[1])
    daily.write_day(spark, wh, dt.date(2024, 1, 1))
    plan = daily.build_report(spark, wh, dt.date(2024, 1, 2))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "= 2024-01-02" in plan
    # rule 4 reads the day and the cards' state at the end of the day before
    assert "card_state" in plan and not re.search(r"event_date#\d+ (>=|<|>) ", plan)


def test_day_from_landing_folder_and_bank(spark, scratch):
    import os
    from xlsx import write_xlsx
    land = f"{scratch}/landing"
    os.makedirs(land)
    with open(f"{land}/transactions_16012024.txt", "w") as f:
        f.write("transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"
                "1;2024-01-16 10:00:00;10,00;C1;pay;SUCCESS;T1\n"
                "2;2024-01-16 10:30:00;10,00;C1;pay;SUCCESS;T2\n")
    write_xlsx(f"{land}/passport_blacklist_16012024.xlsx", [["date", "passport"], ["2024-01-01", "PP1"]])
    write_xlsx(f"{land}/terminals_16012024.xlsx",
               [["terminal_id", "terminal_type", "terminal_city", "terminal_address"],
                ["T1", "ATM", "Moscow", "a"], ["T2", "POS", "Kazan", "b"]])
    url = "jdbc:derby:memory:bank_day;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    c0 = dt.datetime(2023, 12, 1)
    bank = {
        "ACCOUNTS": ([("A1", dt.datetime(2030, 1, 1), "1", c0, None)], ACCOUNTS),
        "CARDS": ([("C1", "A1", c0, None)], CARDS),
        "CLIENTS": ([("1", "L", "F", None, c0, "PP1", None, "+7", c0, None)], CLIENTS),
    }
    for name, (rows_, spec) in bank.items():
        df = spark.createDataFrame(rows_, spec.source)
        df.toDF(*[c.upper() for c in df.columns]).write.mode("overwrite").options(**props).jdbc(url, name)
    feeds = daily.feeds_from_folder(spark, land, dt.date(2024, 1, 16), url, props, "derby")
    wh = W.Warehouse(f"{scratch}/wh")
    daily.run_day(spark, wh, feeds, dt.datetime(2024, 1, 16), dt.date(2024, 1, 16))
    rep = sorted((r["tr_id"], r["event_type"]) for r in W.read_report(spark, wh).collect())
    assert rep == [("1", 1), ("2", 1), ("2", 3)]   # blacklisted passport; Moscow -> Kazan in 30 min
    assert daily.feeds_from_folder(spark, land, dt.date(2024, 1, 17)).transactions_raw is None


def test_command_line_run_day_and_backfill(spark, scratch):
    import os
    from fraudlake.__main__ import main
    from xlsx import write_xlsx
    land = f"{scratch}/landing"
    os.makedirs(land)
    with open(f"{land}/transactions_16012024.txt", "w") as f:
        f.write("transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"
                "1;2024-01-16 10:00:00;10,00;C1;pay;SUCCESS;T1\n")
    write_xlsx(f"{land}/terminals_16012024.xlsx",
               [["terminal_id", "terminal_type", "terminal_city", "terminal_address"], ["T1", "ATM", "M", "a"]])
    wh = f"{scratch}/wh"
    main(["run-day", "--warehouse", wh, "--landing", land, "--day", "2024-01-16", "--master", "local[2]"])
    main(["backfill", "--warehouse", wh, "--start", "2024-01-16", "--end", "2024-01-16",
          "--master", "local[2]"])
    w = W.Warehouse(wh)
    assert W.read_fact(spark, w).count() == 1
    assert W.read_dim(spark, w, TERMINALS).count() == 1
    assert W.read_report(spark, w).count() == 0   # no bank dims loaded: nothing to flag
