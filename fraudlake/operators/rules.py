"""The four fraud rules of the report mart.

Each rule returns rows of the report schema ``event_dt, passport, fio, phone,
event_type, report_dt, tr_id``. With ``day=None`` a rule covers every day of
the input at once (``report_dt`` = the event's day), which is how a backfill
runs in a single pass; with a ``day`` it is the daily report for that day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlake.functions.expr import day_start, on_day, plus_interval, ts_lit
from fraudlake.operators.asof import card_profile, enrich, first_listing
from fraudlake.operators.seqlag import Lag, sequence_lags
from fraudlake.session import cut_lineage
from fraudlake.schemas import (
    EVENT_CITIES, EVENT_CONTRACT, EVENT_GUESSING, EVENT_PASSPORT, NEVER,
    RESULT_REJECT, RESULT_SUCCESS,
)

T = "transaction_date"


def success() -> Column:
    return F.col("oper_result") == RESULT_SUCCESS


def _day(day: dt.date | str | None) -> dt.date | None:
    if day is None or isinstance(day, dt.date):
        return day
    return dt.date.fromisoformat(day)


def report_rows(df: DataFrame, event_type: int, day: dt.date | None) -> DataFrame:
    report_dt = ts_lit(day) if day is not None else day_start(T)
    return df.select(
        F.col(T).alias("event_dt"), F.col("passport"), F.col("fio"), F.col("phone"),
        F.lit(event_type).alias("event_type"), report_dt.alias("report_dt"),
        F.col("transaction_id").alias("tr_id"),
    )


def on_report_day(df: DataFrame, day: dt.date | None) -> DataFrame:
    """The day's operations; a stored fact also prunes to its ``event_date``."""
    if day is None:
        return df
    return in_days(df, day, day)


def in_days(df: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Operations of the days ``first..last``, written so the scan prunes."""
    if first == last:
        if "event_date" in df.columns:
            df = df.filter(F.col("event_date") == F.lit(first))
        return df.filter(on_day(T, first))
    if "event_date" in df.columns:
        df = df.filter(F.col("event_date").between(F.lit(first), F.lit(last)))
    return df.filter((F.col(T) >= ts_lit(first)) & (F.col(T) < ts_lit(last + dt.timedelta(days=1))))


def blacklist_first_entry(blacklist: DataFrame) -> DataFrame:
    """First listing per passport: same truth as the raw list, no join fan-out."""
    return first_listing(blacklist)


def with_listing(e: DataFrame, blacklist: DataFrame, key: str = "passport") -> DataFrame:
    """``entry_dt`` of the passport's first listing, unless the profile brought it."""
    if "entry_dt" in e.columns:
        return e
    bl = blacklist_first_entry(blacklist).withColumnRenamed("passport", "_bl_key")
    return e.join(bl, F.col(key) == F.col("_bl_key"), "left").drop("_bl_key")


def rule_passport(enriched: DataFrame, blacklist: DataFrame, day=None) -> DataFrame:
    """Rule 1: successful operation on a blacklisted or expired passport."""
    day = _day(day)
    e = on_report_day(enriched, day).filter(success())
    hit = (F.col("entry_dt") <= F.col(T)) | (F.col("passport_valid_to") <= F.col(T))
    x = with_listing(e, blacklist).filter(hit)
    return report_rows(x, EVENT_PASSPORT, day)


def rule_contract(enriched: DataFrame, day=None) -> DataFrame:
    """Rule 2: successful operation after the account's contract ended."""
    day = _day(day)
    x = on_report_day(enriched, day).filter(success() & (F.col("valid_to") < F.col(T)))
    return report_rows(x, EVENT_CONTRACT, day)


def rule_cities(enriched: DataFrame, day=None, within: str = "1 hour", skew_safe: bool = True) -> DataFrame:
    """Rule 3: a successful operation in another city than the passport's
    previous one that day, at most ``within`` later. Unknown passports are
    left out rather than paired with each other."""
    day = _day(day)
    e = (on_report_day(enriched, day).filter(success() & F.col("passport").isNotNull())
         .withColumn("_day", F.to_date(T)))
    x = sequence_lags(e, ["passport", "_day"], [T, "transaction_id"], CITY_LAGS, T,
                      skew_safe=skew_safe, detect_hot=False)
    return report_rows(x.filter(cities_hit(within)), EVENT_CITIES, day)


CITY_LAGS = [Lag("_prev_t", T, 1), Lag("_prev_city", "city", 1)]


def cities_hit(within: str) -> Column:
    """Another city than the previous operation, within ``within`` of it."""
    prev_t = F.col("_prev_t")
    return ((F.col("city") != F.col("_prev_city"))
            & F.col(T).between(prev_t - F.expr(f"interval {within}"), plus_interval(prev_t, within)))


GUESS_LAGS = [Lag("_r1", "_rej", 1, 0), Lag("_r2", "_rej", 2, 0), Lag("_r3", "_rej", 3, 0),
              Lag("_r4", "_rej", 4, 0), Lag("_t3", T, 3), Lag("_t4", T, 4),
              Lag("_res2", "oper_result", 2, "0"),
              Lag("_a1", "amount", 1, 0), Lag("_a2", "amount", 2, 0), Lag("_a3", "amount", 3, 0)]


def guessing_condition(within: str = "20 minutes", strict: bool = False,
                       r4: Column | None = None) -> Column:
    """Rule 4 over each card's operations in time order (lags precomputed).

    Default (the source system's code): current not REJECT, previous not
    SUCCESS, the one before that REJECT, at least three of the previous four
    not SUCCESS, within ``within`` of the third previous, amounts strictly
    falling. ``strict``: current SUCCESS and all three previous not SUCCESS.
    """
    c = F.col
    falling = (c("amount") < c("_a1")) & (c("_a1") < c("_a2")) & (c("_a2") < c("_a3"))
    if strict:
        return (success() & (c("_r1") == 1) & (c("_r2") == 1) & (c("_r3") == 1)
                & (c(T) < plus_interval("_t3", within)) & falling)
    r4 = c("_r4") if r4 is None else r4
    score = (F.when((c("_r1") == 0) | (c("oper_result") == RESULT_REJECT), 0)
              .otherwise(c("_r1") + c("_r2") + c("_r3") + r4))
    ch_time = plus_interval(F.coalesce(c("_t3"), ts_lit(NEVER)), within)
    return (score >= 3) & (c(T) < ch_time) & (c("_res2") == RESULT_REJECT) & falling


def with_guessing(tr: DataFrame, within: str = "20 minutes", strict: bool = False,
                  skew_safe: bool = True) -> DataFrame:
    """The fact plus ``is_guess``. Lags run per card in time order (one
    window, ties broken by id); ``skew_safe`` splits hot cards by time."""
    base = tr.withColumn("_rej", _rej())
    x = sequence_lags(base, ["card_num"], [T, "transaction_id"], GUESS_LAGS, T, skew_safe=skew_safe)
    return (x.withColumn("is_guess", guessing_condition(within, strict))
             .drop("_rej", *[lg.name for lg in GUESS_LAGS]))


def _rej() -> Column:
    return F.when(success(), 0).otherwise(1)


def guessing_on_day(tr: DataFrame, day: dt.date, within: str = "20 minutes", strict: bool = False,
                    skew_safe: bool = True, until: dt.date | None = None,
                    before: DataFrame | None = None) -> DataFrame:
    """Rule 4 hits of one day (or of ``day..until``), reading only
    ``[day - within, last day's end]``, or with ``before`` those days alone.

    ``before``: each card's last four operations before ``day``, which with the
    days' own hold every predecessor that the lags reach.

    A hit's third predecessor is less than ``within`` older than it, so the
    operations since ``day - within`` hold predecessors 1-3 of every
    possible hit. Only the fourth one (counted in the default form) can be
    older: lags over that range may miss a rejection there, so they flag a
    subset of the hits. The rest are rows whose fourth predecessor lies
    before the range and whose count reaches 3 only with it; for their cards
    the last operation before the range is looked up (:func:`last_before`).
    Exact, without reading all history.
    """
    last = until or day
    start = ts_lit(day) - F.expr(f"interval {within}")
    end = ts_lit(last + dt.timedelta(days=1))
    # A hit is an operation that was not refused.
    active = in_days(tr, day, last).filter(success() if strict else F.col("oper_result") != RESULT_REJECT) \
        .select("card_num").distinct()
    cols = [c for c in tr.columns if c != "event_date"]
    if before is not None:
        x = before.unionByName(in_days(tr, day, last), allowMissingColumns=True)
        x = x.join(active, "card_num", "left_semi").withColumn("_rej", _rej())
        x = sequence_lags(x, ["card_num"], [T, "transaction_id"], GUESS_LAGS, T, skew_safe=skew_safe)
        return x.filter((F.col(T) >= ts_lit(day)) & guessing_condition(within, strict)).select(*cols)
    recent = tr.filter((F.col(T) >= start) & (F.col(T) < end))
    if "event_date" in tr.columns:   # stored fact: read only the partitions in range
        recent = recent.filter((F.col("event_date") >= F.to_date(start)) & (F.col("event_date") <= F.lit(last)))
    recent = recent.join(active, "card_num", "left_semi").withColumn("_rej", _rej())
    x = sequence_lags(recent, ["card_num"], [T, "transaction_id"], GUESS_LAGS, T, skew_safe=skew_safe)
    x = in_days(x, day, last)
    hits = x.filter(guessing_condition(within, strict)).select(*cols)
    if strict:
        return hits
    maybe = x.filter(F.col("_t4").isNull() & F.col("_t3").isNotNull()
                     & ~guessing_condition(within) & guessing_condition(within, r4=F.lit(1)))
    more = maybe.join(last_before(tr, maybe.select("card_num").distinct(), day, within), "card_num") \
                .filter(F.col("_p4.rej") == 1).select(*cols)
    return hits.unionByName(more)


LOOK_BACK = (7, 30, 120, 365)     # days before the window, one step after the other


def last_before(tr: DataFrame, cards: DataFrame, day: dt.date, within: str) -> DataFrame:
    """``(card_num, _p4)``: each card's last operation before ``day - within``.

    The fact is walked back in steps of days, each step for the cards that are
    still open only, so a card that was used lately costs a few partitions,
    and a step without open cards costs nothing. What is older than the last
    step is read from the fact's first day on. Every scan has a lower and an
    upper bound.
    """
    spark = tr.sparkSession
    at = ts_lit(day) - F.expr(f"interval {within}")
    end = spark.range(1).select(at.alias("t")).first()["t"]
    todo = cut_lineage(cards, "look-back")
    found = None
    for i, back in enumerate((*LOOK_BACK, None)):
        if todo.isEmpty():
            break
        if back is None:
            older = tr.filter(F.col("event_date") <= F.lit(end.date())) if "event_date" in tr.columns else tr
            first = older.filter(F.col(T) < F.lit(end)).agg(F.min("event_date" if "event_date" in tr.columns else T)).first()[0]
            if first is None:
                break
            start = dt.datetime(first.year, first.month, first.day)
        else:
            start = end - dt.timedelta(days=back - (LOOK_BACK[i - 1] if i else 0))
        x = tr.filter((F.col(T) >= F.lit(start)) & (F.col(T) < F.lit(end)))
        if "event_date" in tr.columns:
            x = x.filter(F.col("event_date").between(F.lit(start.date()), F.lit(end.date())))
        step = cut_lineage(x.join(todo, "card_num", "left_semi").groupBy("card_num").agg(
            F.max(F.struct(T, "transaction_id", _rej().alias("rej"))).alias("_p4")), "look-back")
        found = step if found is None else found.unionByName(step)
        todo = cut_lineage(todo.join(step, "card_num", "left_anti"), "look-back")
        end = start
    if found is None:
        empty = tr.select("card_num", F.struct(T, "transaction_id", _rej().alias("rej")).alias("_p4"))
        return spark.createDataFrame([], empty.schema)
    return found


def rule_guessing(tr: DataFrame, cards: DataFrame, accounts: DataFrame, clients: DataFrame,
                  day=None, within: str = "20 minutes", strict: bool = False,
                  skew_safe: bool = True, profile: DataFrame | None = None,
                  until=None, before: DataFrame | None = None) -> DataFrame:
    """Rule 4: amount guessing; flags on the fact first, then enrich the hits.

    ``day``: that day's report; with ``until``, the days ``day..until``
    (each row reported on its own day); neither: every day.
    """
    day, until = _day(day), _day(until)
    if day is None:
        flagged = with_guessing(tr, within, strict, skew_safe).filter("is_guess").drop("is_guess")
    else:
        flagged = guessing_on_day(tr, day, within, strict, skew_safe, until, before)
    e = enrich(flagged, cards, accounts, clients, profile=profile)
    return report_rows(e, EVENT_GUESSING, day if until is None else None)


def flag_rules(e: DataFrame, blacklist: DataFrame, cities_within: str = "1 hour",
               skew_safe: bool = True) -> DataFrame:
    """Rules 1-3 (and rule 4 if ``is_guess`` is present) as columns, one pass.

    Rule 3 runs over successful operations with a known passport, per passport
    and day. Every other row gets a window key of its own (its id), so unknown
    passports never form one big group. The blacklist comes with the card
    profile when it was built with it; otherwise it joins on that window key
    (only rows with a passport can match).
    """
    ok = success() & F.col("passport").isNotNull()
    wkey = F.when(ok, F.col("passport")).otherwise(F.concat(F.lit("~"), F.col("transaction_id")))
    x = e.withColumn("_wkey", wkey).withColumn("_day", F.to_date(T)).withColumn("_ok", ok)
    x = with_listing(x, blacklist, "_wkey")
    # Rule 3 runs on a join result: every (passport, day) is cut by the hour
    # rather than counted first, so the enrichment is not computed twice.
    x = sequence_lags(x, ["_wkey", "_day"], [T, "transaction_id"], CITY_LAGS, T,
                      skew_safe=skew_safe, detect_hot=False, only=F.col("_ok"))
    r1 = success() & ((F.col("entry_dt") <= F.col(T)) | (F.col("passport_valid_to") <= F.col(T)))
    r2 = success() & (F.col("valid_to") < F.col(T))
    r3 = F.col("_ok") & cities_hit(cities_within)
    flags = [F.when(r1, EVENT_PASSPORT), F.when(r2, EVENT_CONTRACT), F.when(r3, EVENT_CITIES)]
    if "is_guess" in e.columns:
        flags.append(F.when(F.col("is_guess"), EVENT_GUESSING))
    return x.withColumn("_types", F.filter(F.array(*flags), lambda t: t.isNotNull()))


def report_from_flags(x: DataFrame, day: dt.date | None) -> DataFrame:
    """One report row per (operation, matched rule)."""
    report_dt = ts_lit(day) if day is not None else day_start(T)
    return x.select(
        F.col(T).alias("event_dt"), F.col("passport"), F.col("fio"), F.col("phone"),
        F.explode("_types").alias("event_type"), report_dt.alias("report_dt"),
        F.col("transaction_id").alias("tr_id"),
    )


def fraud_report(tr: DataFrame, cards: DataFrame, accounts: DataFrame, clients: DataFrame,
                 terminals: DataFrame, blacklist: DataFrame, day=None,
                 cities_within: str = "1 hour", guess_within: str = "20 minutes",
                 strict: bool = False, skew_safe: bool = True,
                 profile: DataFrame | None = None, until=None,
                 before: DataFrame | None = None) -> DataFrame:
    """The fraud mart rows for one day, for ``day..until``, or for every day
    when ``day`` is None.

    Over all days: the rule-4 lags run on the narrow fact (by card and time
    bucket), the fact joins the card profile once (card → account → client
    versions, with the blacklist listing) and the terminals once, and all
    four rules are flags of that one row set. For a day or a range, rules
    1-3 enrich only those days' operations and rule 4 reads from the first
    day minus its window on, or those days and the cards' state ``before`` them.
    """
    day, until = _day(day), _day(until)
    prof = profile if profile is not None else card_profile(cards, accounts, clients, blacklist)
    if day is None:
        # Rules 1-3 need a successful operation, rule 4 its flag: no other row
        # can be reported, so none is enriched.
        can_hit = with_guessing(tr, guess_within, strict, skew_safe).filter(success() | F.col("is_guess"))
        e = enrich(can_hit, cards, accounts, clients, terminals, profile=prof)
        return report_from_flags(flag_rules(e, blacklist, cities_within, skew_safe), None)
    e = enrich(in_days(tr, day, until or day).filter(success()), cards, accounts, clients, terminals, profile=prof)
    r13 = report_from_flags(flag_rules(e, blacklist, cities_within, skew_safe),
                            day if until is None else None)
    r4 = rule_guessing(tr, cards, accounts, clients, day, guess_within, strict, skew_safe, prof, until, before)
    return r13.unionByName(r4)
