"""Registered queries: one per operator group of the inventory.

Each takes ``(spark, sf_dir)``, reads the driver tables under ``sf_dir`` and
returns a lazy DataFrame. Moments far in the future (the 9999 sentinel)
are returned as text and amounts as double so results compare across
engines; the warehouse itself keeps TIMESTAMP_NTZ and decimal(10,2).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake.functions.expr import fio, format_ts
from fraudlake.operators import rules
from fraudlake.operators.asof import asof_join, enrich
from fraudlake.operators.scd2 import (
    changed_keys, close_deleted, current, deleted_keys, extract_since, live_keys,
    normalize_source,
)
from fraudlake.plans import daily, demo, profile
from fraudlake.plans import warehouse as W
from fraudlake.schemas import ACCOUNTS, CARDS, CLIENTS, TERMINALS
from fraudlake.session import checkpoint_base
from fraudlake.sources import fixture, intake, manifest
from fraudlake.streaming.intake import run_intake

Query = Callable[[SparkSession, str], DataFrame]
# The day on which the fact already holds the earlier half of
# the month, and the report day of the daily query.
LOADED_THROUGH = dt.date(2024, 1, 15)
REPORT_DAY = dt.date(2024, 1, 16)
RANGE = (dt.date(2024, 1, 10), dt.date(2024, 1, 20))


def _hist_out(df: DataFrame) -> DataFrame:
    return df.withColumn("effective_to", format_ts("effective_to"))


def _money(df: DataFrame) -> DataFrame:
    return df.withColumn("amount", F.col("amount").cast("double"))


# --- intake -----------------------------------------------------------------

def q_txn_normalize(spark, sf):
    good, _ = intake.type_transactions(fixture.raw_transactions(spark, sf))
    return _money(good.drop("file_name"))


def _csv_feed(spark, sf) -> str:
    """The raw feed as ``;`` text files with header in the session's shared folder."""
    path = f"{checkpoint_base(spark)}/feed-{uuid.uuid4().hex}"
    fixture.raw_transactions(spark, sf).drop("file_name").write.csv(path, sep=";", header=True)
    return path


def q_txn_csv_scan(spark, sf):
    """The feed through text files: scan, bind by position, type."""
    good, _ = intake.type_transactions(intake.read_transactions_csv(spark, _csv_feed(spark, sf)))
    return _money(good.drop("file_name"))


def q_txn_stream(spark, sf):
    """The feed through the run-to-completion file stream into the stored fact."""
    wh = W.Warehouse(f"{checkpoint_base(spark)}/stream-{uuid.uuid4().hex}")
    run_intake(spark, wh, _csv_feed(spark, sf), pattern="part-*.csv")
    return _money(W.read_fact(spark, wh).drop("event_date"))


def q_rejects_stored(spark, sf):
    """Refused lines of the feed as a load stores them (loaded twice)."""
    wh = W.Warehouse(f"{checkpoint_base(spark)}/rejects-{uuid.uuid4().hex}")
    for _ in range(2):
        daily.load_transactions(spark, wh, fixture.raw_transactions(spark, sf))
    return W.read_rejects(spark, wh)


def q_txn_rejects(spark, sf):
    _, bad = intake.type_transactions(fixture.raw_transactions(spark, sf))
    return bad


def q_txn_dedupe(spark, sf):
    """Batch = the whole feed plus a replay of its purchases; the fact already
    holds the days through LOADED_THROUGH. Result: rows to append."""
    tr = fixture.transactions(spark, sf)
    batch = tr.unionByName(tr.filter(F.col("oper_type") == "purchase"))
    existing = tr.filter(F.to_date("transaction_date") <= F.lit(LOADED_THROUGH))
    return _money(intake.new_transactions(batch, existing))


def q_txn_duplicates(spark, sf):
    """Rejects of the same batch: ids repeated in it, and ids that the fact
    holds with other values (the terminal of ``error`` operations)."""
    tr = fixture.transactions(spark, sf)
    day = F.concat(F.lit("transactions_"), F.date_format("transaction_date", "ddMMyyyy"), F.lit(".txt"))
    batch = tr.unionByName(tr.filter(F.col("oper_type") == "purchase")).withColumn("file_name", day)
    existing = tr.filter(F.to_date("transaction_date") <= F.lit(LOADED_THROUGH)).withColumn(
        "terminal", F.when(F.col("oper_type") == "error", "T999").otherwise(F.col("terminal")))
    return intake.duplicate_transactions(batch, existing)


def q_file_manifest_oldest(spark, sf):
    return manifest.oldest_batch(manifest.fixture_manifest(spark, sf))


def q_file_manifest_unseen(spark, sf):
    m = manifest.fixture_manifest(spark, sf)
    archive = m.filter(F.col("file_date") <= F.lit(LOADED_THROUGH).cast("timestamp_ntz")) \
               .select(F.concat("file_name", F.lit(".backup")).alias("file_name"))
    return manifest.unseen(m, archive)


def q_file_manifest_seen(spark, sf):
    m = manifest.fixture_manifest(spark, sf)
    archive = m.filter(F.col("file_date") <= F.lit(LOADED_THROUGH).cast("timestamp_ntz")) \
               .select(F.concat("file_name", F.lit(".backup")).alias("file_name"))
    return manifest.already_loaded(m, archive)


# --- SCD2 building blocks (clients, run 2 over the history of run 1) --------

def _run2_inputs(spark, sf):
    hist1 = demo.clients_history(spark, sf, runs=1)
    snap2 = normalize_source(fixture.clients(spark, sf, 2), CLIENTS)
    return hist1, snap2


def q_extract_since(spark, sf):
    _, snap2 = _run2_inputs(spark, sf)
    return extract_since(snap2, demo.RUNS[1])


def q_live_keys(spark, sf):
    _, snap2 = _run2_inputs(spark, sf)
    return live_keys(snap2, CLIENTS)


def q_scd2_changed_keys(spark, sf):
    hist1, snap2 = _run2_inputs(spark, sf)
    return changed_keys(extract_since(snap2, demo.RUNS[1]), hist1, CLIENTS)


def q_scd2_deleted_keys(spark, sf):
    hist1, snap2 = _run2_inputs(spark, sf)
    return _hist_out(deleted_keys(hist1, live_keys(snap2, CLIENTS), CLIENTS))


def q_scd2_deleted_semi(spark, sf):
    hist1, snap2 = _run2_inputs(spark, sf)
    return _hist_out(close_deleted(hist1, live_keys(snap2, CLIENTS), CLIENTS))


def q_scd2_first_load(spark, sf):
    return _hist_out(demo.clients_history(spark, sf, runs=1))


def q_scd2_second_load(spark, sf):
    return _hist_out(demo.clients_history(spark, sf, runs=2))


def q_scd2_clients(spark, sf):
    return _hist_out(demo.clients_history(spark, sf, runs=3))


def q_scd2_open_rows(spark, sf):
    return _hist_out(current(demo.clients_history(spark, sf, runs=3)))


def q_scd2_accounts(spark, sf):
    return _hist_out(demo.accounts_history(spark, sf))


def q_scd2_cards(spark, sf):
    return _hist_out(demo.cards_history(spark, sf))


def q_scd2_terminals(spark, sf):
    return _hist_out(demo.terminals_history(spark, sf))


def q_scd2_clients_stored(spark, sf):
    """Three loads of clients through storage; the last one is repeated."""
    wh = W.Warehouse(f"{checkpoint_base(spark)}/clients-{uuid.uuid4().hex}")
    for n in (1, 2, 3, 3):
        W.load_dim(spark, wh, CLIENTS, normalize_source(fixture.clients(spark, sf, n), CLIENTS), demo.RUNS[n],
                   extract=extract_since)
    return _hist_out(W.read_dim(spark, wh, CLIENTS))


def q_blacklist_stored(spark, sf):
    """The stored blacklist after two refreshes: the last listing only."""
    wh = W.Warehouse(f"{checkpoint_base(spark)}/blacklist-{uuid.uuid4().hex}")
    full = fixture.blacklist(spark, sf)
    W.replace_blacklist(spark, wh, full.filter(F.col("entry_dt") < F.lit(fixture.BLACKLIST_DAYS[1])), demo.RUNS[1])
    W.replace_blacklist(spark, wh, full, demo.RUNS[2])
    return W.read_blacklist(spark, wh)


def q_scd2_accounts_second(spark, sf):
    """Three loads of accounts: changes, deletes, returns."""
    return _hist_out(demo.replay(spark, ACCOUNTS, lambda n: fixture.accounts_snapshot(spark, sf, n)))


def q_scd2_cards_second(spark, sf):
    return _hist_out(demo.replay(spark, CARDS, lambda n: fixture.cards_snapshot(spark, sf, n)))


def q_scd2_terminals_second(spark, sf):
    return _hist_out(demo.replay(spark, TERMINALS, lambda n: fixture.terminals_snapshot(spark, sf, n),
                                 full_slice=True))


# --- joins --------------------------------------------------------------------

def q_asof_cards(spark, sf):
    tr = fixture.transactions(spark, sf)
    x = asof_join(tr, demo.cards_history(spark, sf), "card_num", "card_num",
                  "transaction_date", ["account"], "cd_")
    return x.select("transaction_id", "card_num", F.col("cd_account").alias("account"))


def q_asof_chain(spark, sf):
    w = demo.warehouse(spark, sf)
    e = enrich(w.tr, w.cards, w.accounts, w.clients, profile=w.profile)
    return e.select("transaction_id", "account", "valid_to", "client", "passport",
                    "passport_valid_to", "phone", "fio")


def q_asof_chain_stored(spark, sf):
    """The same through storage: the profile kept from load to load, each refresh
    computing the cards of changed clients only."""
    wh = W.Warehouse(f"{checkpoint_base(spark)}/asof-chain-stored-{uuid.uuid4().hex}")
    for spec, src in ((ACCOUNTS, fixture.accounts), (CARDS, fixture.cards)):
        W.load_dim(spark, wh, spec, normalize_source(src(spark, sf), spec), demo.RUNS[1])
    for n, run in demo.RUNS.items():
        clients = normalize_source(fixture.clients(spark, sf, n), CLIENTS)
        W.load_dim(spark, wh, CLIENTS, clients, run, extract=extract_since)
        profile.refresh(spark, wh)
    prof = profile.read(spark, wh, fixture.blacklist(spark, sf))
    e = enrich(fixture.transactions(spark, sf), None, None, None, profile=prof)
    return e.select("transaction_id", "account", "valid_to", "client", "passport",
                    "passport_valid_to", "phone", "fio")


def q_asof_terminals(spark, sf):
    tr = fixture.transactions(spark, sf)
    x = asof_join(tr, demo.terminals_history(spark, sf), "terminal", "terminal_id",
                  "transaction_date", ["terminal_city"], "tm_")
    return x.select("transaction_id", "terminal", F.col("tm_terminal_city").alias("city"))


def q_blacklist_first_entry(spark, sf):
    return rules.blacklist_first_entry(fixture.blacklist(spark, sf))


def q_client_fio(spark, sf):
    c = normalize_source(fixture.clients(spark, sf, 3), CLIENTS)
    return c.select("client_id", fio("last_name", "first_name", "patronymic").alias("fio"))


# --- rules and the mart ---------------------------------------------------------

def _enriched(spark, sf, terminals: bool = False):
    w = demo.warehouse(spark, sf)
    return w, enrich(w.tr, w.cards, w.accounts, w.clients, w.terminals if terminals else None,
                     profile=w.profile)


def q_rule1_passport(spark, sf):
    w, e = _enriched(spark, sf)
    return rules.rule_passport(e, w.blacklist)


def q_rule2_contract(spark, sf):
    _, e = _enriched(spark, sf)
    return rules.rule_contract(e)


def q_rule3_cities(spark, sf):
    _, e = _enriched(spark, sf, terminals=True)
    return rules.rule_cities(e)


def _rule4(within: str, strict: bool) -> Query:
    def q(spark, sf):
        w = demo.warehouse(spark, sf)
        return rules.rule_guessing(w.tr, w.cards, w.accounts, w.clients, None, within, strict,
                                   profile=w.profile)
    return q


def _rule4_burst(strict: bool) -> Query:
    """Rule 4 at its own 20 minutes, over the feed with squeezed weeks."""
    def q(spark, sf):
        w = demo.warehouse(spark, sf)
        return rules.rule_guessing(fixture.burst_transactions(spark, sf), w.cards, w.accounts, w.clients, None,
                                   "20 minutes", strict, profile=w.profile)
    return q


def q_fraud_report_burst(spark, sf):
    """The whole mart at its own windows, over the feed with squeezed weeks."""
    w = demo.warehouse(spark, sf)
    return rules.fraud_report(fixture.burst_transactions(spark, sf), w.cards, w.accounts, w.clients, w.terminals,
                              w.blacklist, profile=w.profile)


def q_fraud_report_stored(spark, sf):
    """The mart through storage: daily loads into a warehouse folder (three of the
    clients, who change in the middle of a day), a backfill, and the stored report."""
    wh = W.Warehouse(f"{checkpoint_base(spark)}/fraud-report-stored-{uuid.uuid4().hex}")
    for spec, src in ((TERMINALS, fixture.terminals), (ACCOUNTS, fixture.accounts), (CARDS, fixture.cards)):
        W.load_dim(spark, wh, spec, normalize_source(src(spark, sf), spec), demo.RUNS[1])
    for n, run in demo.RUNS.items():
        clients = normalize_source(fixture.clients(spark, sf, n), CLIENTS)
        W.load_dim(spark, wh, CLIENTS, clients, run, extract=extract_since)
        W.replace_blacklist(spark, wh, fixture.blacklist(spark, sf), run)
    W.append_transactions(spark, wh, fixture.transactions(spark, sf))
    daily.backfill(spark, wh, RANGE[0], RANGE[1], guess_within="7 days")
    daily.write_day(spark, wh, REPORT_DAY, guess_within="7 days")     # a rerun of one day changes nothing
    return W.read_report(spark, wh)


def q_fraud_report_month(spark, sf):
    w = demo.warehouse(spark, sf)
    return rules.fraud_report(w.tr, w.cards, w.accounts, w.clients, w.terminals, w.blacklist,
                              profile=w.profile)


def _report_day(guess_within: str) -> Query:
    def q(spark, sf):
        w = demo.warehouse(spark, sf)
        return rules.fraud_report(fixture.dated_transactions(spark, sf), w.cards, w.accounts, w.clients,
                                  w.terminals, w.blacklist, day=REPORT_DAY, guess_within=guess_within, profile=w.profile)
    return q


def q_fraud_report_range(spark, sf):
    """Backfill of a range of days: rules 1-3 read only those days, rule 4
    from the range start minus its window (plus exact older lookups)."""
    w = demo.warehouse(spark, sf)
    return rules.fraud_report(fixture.dated_transactions(spark, sf), w.cards, w.accounts, w.clients,
                              w.terminals, w.blacklist, day=RANGE[0], until=RANGE[1], guess_within="7 days", profile=w.profile)


QUERIES: dict[str, Query] = {
    "txn_normalize": q_txn_normalize,
    "txn_rejects": q_txn_rejects,
    "txn_dedupe": q_txn_dedupe,
    "txn_csv_scan": q_txn_csv_scan,
    "txn_stream": q_txn_stream,
    "rejects_stored": q_rejects_stored,
    "scd2_clients_stored": q_scd2_clients_stored,
    "blacklist_stored": q_blacklist_stored,
    "txn_duplicates": q_txn_duplicates,
    "file_manifest_oldest": q_file_manifest_oldest,
    "file_manifest_unseen": q_file_manifest_unseen,
    "file_manifest_seen": q_file_manifest_seen,
    "extract_since": q_extract_since,
    "live_keys": q_live_keys,
    "scd2_changed_keys": q_scd2_changed_keys,
    "scd2_deleted_keys": q_scd2_deleted_keys,
    "scd2_deleted_semi": q_scd2_deleted_semi,
    "scd2_first_load": q_scd2_first_load,
    "scd2_second_load": q_scd2_second_load,
    "scd2_clients": q_scd2_clients,
    "scd2_open_rows": q_scd2_open_rows,
    "scd2_accounts": q_scd2_accounts,
    "scd2_cards": q_scd2_cards,
    "scd2_terminals": q_scd2_terminals,
    "scd2_accounts_second": q_scd2_accounts_second,
    "scd2_cards_second": q_scd2_cards_second,
    "scd2_terminals_second": q_scd2_terminals_second,
    "asof_cards": q_asof_cards,
    "asof_chain": q_asof_chain,
    "asof_chain_stored": q_asof_chain_stored,
    "asof_terminals": q_asof_terminals,
    "blacklist_first_entry": q_blacklist_first_entry,
    "client_fio": q_client_fio,
    "rule1_passport": q_rule1_passport,
    "rule2_contract": q_rule2_contract,
    "rule3_cities": q_rule3_cities,
    "rule4_guessing": _rule4("20 minutes", False),
    "rule4_guessing_strict": _rule4("20 minutes", True),
    "rule4_guessing_7d": _rule4("7 days", False),
    "rule4_guessing_strict_7d": _rule4("7 days", True),
    "rule4_guessing_burst": _rule4_burst(False),
    "rule4_guessing_strict_burst": _rule4_burst(True),
    "fraud_report_burst": q_fraud_report_burst,
    "fraud_report_stored": q_fraud_report_stored,
    "fraud_report_month": q_fraud_report_month,
    "fraud_report_day": _report_day("20 minutes"),
    "fraud_report_day_7d": _report_day("7 days"),
    "fraud_report_range": q_fraud_report_range,
}
