"""Plan shape of the flagship report: what the design promises at scale."""

import re

from fraudlake.plans import demo
from fraudlake.operators import rules

SF = "/root/testdata/sf0.001"


def test_month_report_plan(spark):
    w = demo.warehouse(spark, SF)
    df = rules.fraud_report(w.tr, w.cards, w.accounts, w.clients, w.terminals, w.blacklist,
                            profile=w.profile)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # the fact joins the dimension chain once (on the card), not per dimension
    assert not re.search(r"hashpartitioning\(cd_account", plan)
    assert not re.search(r"hashpartitioning\(ac_client", plan)
    # hot keys are spread: the lag windows run on (key, bucket) partitions
    assert re.search(r"hashpartitioning\(card_num#\d+, _bucket", plan)
    assert re.search(r"hashpartitioning\(_wkey#\d+, _day#\d+, _bucket", plan)
    # every window is partitioned: no window over a single partition
    assert "Window []" not in plan and "SinglePartition" not in plan.split("Subquery")[0]


def test_fact_append_reads_ids_only(spark, scratch):
    from pyspark.sql import functions as F
    from fraudlake.plans import idindex, warehouse as W
    from fraudlake.sources import fixture, intake
    wh = W.Warehouse(f"{scratch}/wh")
    tr = fixture.transactions(spark, SF)
    W.append_transactions(spark, wh, tr.filter(F.to_date("transaction_date") <= F.lit("2024-01-10")))
    batch = (tr.filter(F.to_date("transaction_date") == F.lit("2024-01-11"))
               .withColumn("event_date", F.to_date("transaction_date")))
    new = intake.new_transactions(batch, idindex.known(spark, wh, batch))
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "fact_transactions" not in plan and "fact_ids" in plan
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(transaction_id", plan)
    # nothing stored under the batch's ids: no partition of the fact is read
    stored = idindex.stored_rows(spark, wh, batch)
    assert stored.count() == 0 and "fact_transactions" not in stored._jdf.queryExecution().optimizedPlan().toString()
    assert not any("/fact_transactions/" in f for f in stored.inputFiles())
    replay = tr.filter(F.to_date("transaction_date") == F.lit("2024-01-10"))
    again = idindex.stored_rows(spark, wh, replay)
    assert again.count() == replay.count()
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*event_date#\d+ = 2024-01-10", plan)


def test_only_rows_that_can_hit_are_enriched(spark):
    w = demo.warehouse(spark, SF)
    df = rules.fraud_report(w.tr, w.cards, w.accounts, w.clients, w.terminals, w.blacklist, profile=w.profile)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # a child is printed after its parent: the filter sits below the profile join
    can_hit = re.search(r"Filter .*= SUCCESS\) OR .*", plan)
    assert can_hit and can_hit.start() > plan.index("Join LeftOuter")


def test_daily_rule4_reads_bounded_days(spark, scratch):
    import datetime as dt
    from pyspark.sql import functions as F
    from fraudlake.plans import warehouse as W
    from fraudlake.sources import fixture
    wh = W.Warehouse(f"{scratch}/wh")
    tr = fixture.transactions(spark, SF)
    W.append_transactions(spark, wh, tr)
    fact = W.read_fact(spark, wh)
    day = dt.date(2024, 1, 16)
    got = rules.guessing_on_day(fact, day, "7 days")
    plan = got._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert scans and all(">= 2024-01-" in s or "event_date" not in s or re.search(r"= 2024-01-16", s) for s in scans)
    assert all("event_date" in s for s in scans if s)
    every = rules.with_guessing(tr, "7 days").filter(F.col("is_guess") & (F.to_date("transaction_date") == F.lit(day)))
    assert sorted(r["transaction_id"] for r in got.collect()) == sorted(r["transaction_id"] for r in every.collect())


def test_report_of_a_day_reads_its_range(spark):
    from fraudlake.plans.catalog import QUERIES, REPORT_DAY
    plan = QUERIES["fraud_report_day"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.split("\n") if "events.parquet" in x]
    # the day for rules 1-3 and the cards of rule 4, the day and its window before
    assert scans and all("PushedFilters" in x and "(ts," in x.split("PushedFilters")[1] for x in scans)
    assert any(f"GreaterThanOrEqual(ts,{REPORT_DAY}" in x for x in scans)
