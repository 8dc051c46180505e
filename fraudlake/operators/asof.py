"""As-of (version) joins of facts to type-2 dimensions.

A fact row matches the live version of its key whose closed interval
``[effective_from, effective_to]`` holds the event time. The key equality
makes it an equi-join: Catalyst plans a sort-merge (or, when AQE measures a
small side at runtime, a broadcast) hash join on the key with the interval as
a residual filter; versions per key are few, so no range-join machinery is
needed. AQE's skew-join split handles a hot key on the fact side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudlake.functions.expr import fio
from fraudlake.schemas import FLAG_LIVE


def live_versions(dim: DataFrame, key: str, cols: list[str], prefix: str) -> DataFrame:
    """Not-deleted versions of a dimension, prefixed to avoid name clashes."""
    return (dim.filter(F.col("deleted_flg") == FLAG_LIVE)
               .select(F.col(key).alias(f"{prefix}key"),
                       *[F.col(c).alias(f"{prefix}{c}") for c in cols],
                       F.col("effective_from").alias(f"{prefix}from"),
                       F.col("effective_to").alias(f"{prefix}to")))


def asof_join(left: DataFrame, dim: DataFrame, left_key: str, key: str, at: str,
              cols: list[str], prefix: str, how: str = "left") -> DataFrame:
    """Attach ``cols`` of the dimension version valid at ``left[at]``.

    Output columns are ``{prefix}{col}``; interval columns are dropped.
    """
    v = live_versions(dim, key, cols, prefix)
    cond = ((F.col(left_key) == F.col(f"{prefix}key"))
            & F.col(at).between(F.col(f"{prefix}from"), F.col(f"{prefix}to")))
    return left.join(v, cond, how).drop(f"{prefix}key", f"{prefix}from", f"{prefix}to")


def _micro(c: Column, n: int) -> Column:
    """``c`` moved by ``n`` microseconds: the grain of TIMESTAMP_NTZ."""
    return c + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(n / 1_000_000))


def split_by_child(parent: DataFrame, seg_key: list[str], link: str, child: DataFrame,
                   child_key: str, child_cols: list[str], prefix: str) -> DataFrame:
    """Cut each parent segment ``[seg_from, seg_to]`` where child versions start
    and end: covered pieces get the child's ``cols``, uncovered pieces (gaps)
    get NULLs, exactly as a left as-of join would at any time in them.

    One left join, one window and one generator: each matched child version
    emits its covered piece, the gap before it and (if last) the gap after
    it; a parent segment with no child version is one gap. Works on
    dimension rows only (versions per key are few). Pieces are closed
    intervals at microsecond grain, so none overlap and none leave holes.
    """
    v = live_versions(child, child_key, child_cols, prefix)
    cover = ((F.col(link) == F.col(f"{prefix}key")) & (F.col(f"{prefix}from") <= F.col("seg_to"))
             & (F.col(f"{prefix}to") >= F.col("seg_from")) & (F.col(f"{prefix}from") <= F.col(f"{prefix}to")))
    m = parent.join(v, cover, "left").select(
        *parent.columns, *[f"{prefix}{c}" for c in child_cols],
        F.greatest(F.col("seg_from"), F.col(f"{prefix}from")).alias("_lo"),
        F.least(F.col("seg_to"), F.col(f"{prefix}to")).alias("_hi"))
    w = Window.partitionBy(*seg_key).orderBy("_lo")
    m = m.select("*", F.lag("_hi").over(w).alias("_prev_hi"), F.lead("_lo").over(w).alias("_next_lo"))
    others = [c for c in parent.columns if c not in ("seg_from", "seg_to")]
    types = {f.name: f.dataType for f in m.schema.fields}

    def piece(with_child: bool, start: Column, end: Column) -> Column:
        vals = [F.col(f"{prefix}{c}") if with_child else F.lit(None).cast(types[f"{prefix}{c}"])
                for c in child_cols]
        return F.when(start <= end, F.struct(*[F.col(c).alias(c) for c in others],
                                             *[x.alias(f"{prefix}{c}") for x, c in zip(vals, child_cols)],
                                             start.alias("seg_from"), end.alias("seg_to")))

    matched = F.col("_lo").isNotNull()
    lo, hi = F.col("_lo"), F.col("_hi")
    pieces = F.when(~matched, F.array(piece(False, F.col("seg_from"), F.col("seg_to")))).otherwise(F.array(
        piece(True, lo, hi),
        piece(False, F.coalesce(_micro(F.col("_prev_hi"), 1), F.col("seg_from")), _micro(lo, -1)),
        F.when(F.col("_next_lo").isNull(), piece(False, _micro(hi, 1), F.col("seg_to")))))
    return m.select(F.inline(F.filter(pieces, lambda x: x.isNotNull())))


def first_listing(blacklist: DataFrame) -> DataFrame:
    """First blacklist entry per passport: same truth as the raw list, no fan-out."""
    return blacklist.groupBy("passport").agg(F.min("entry_dt").alias("entry_dt"))


def card_profile(cards: DataFrame, accounts: DataFrame, clients: DataFrame,
                 blacklist: DataFrame | None = None) -> DataFrame:
    """Card → account → client versions joined on the dimension side.

    One row per (card, time segment) with the account and client attributes
    valid throughout the segment: the fact then needs a single as-of join on
    ``card_num`` instead of three joins, each a full shuffle of the fact.
    With ``blacklist``, the passport's first listing (``bl_entry_dt``) rides
    along, so rule 1 needs no join on the fact either.
    """
    cd = live_versions(cards, "card_num", ["account"], "cd_").select(
        F.col("cd_key").alias("card_num"), F.col("cd_account").alias("account"),
        F.col("cd_from").alias("seg_from"), F.col("cd_to").alias("seg_to"))
    cd = cd.filter(F.col("seg_from") <= F.col("seg_to")).withColumn("card_from", F.col("seg_from"))
    ca = split_by_child(cd, ["card_num", "card_from"], "account", accounts, "account",
                        ["valid_to", "client"], "ac_")
    ca = ca.withColumn("acc_from", F.col("seg_from"))
    cols = ["passport_num", "passport_valid_to", "phone", "last_name", "first_name", "patronymic"]
    prof = split_by_child(ca, ["card_num", "card_from", "acc_from"], "ac_client", clients, "client_id",
                          cols, "cl_").drop("card_from", "acc_from")
    if blacklist is None:
        return prof
    bl = first_listing(blacklist).select(F.col("passport").alias("_bl_passport"),
                                         F.col("entry_dt").alias("bl_entry_dt"))
    return prof.join(bl, F.col("cl_passport_num") == F.col("_bl_passport"), "left").drop("_bl_passport")


def enrich(tr: DataFrame, cards: DataFrame, accounts: DataFrame, clients: DataFrame,
           terminals: DataFrame | None = None, at: str = "transaction_date",
           prejoin: bool = True, profile: DataFrame | None = None) -> DataFrame:
    """Transaction → card → account → client (→ terminal), all as of the event.

    Adds ``account, valid_to, client, passport, passport_valid_to, phone, fio``
    and, with terminals, ``city``. ``prejoin`` (default) joins the fact once
    to :func:`card_profile` (pass ``profile`` to reuse one already built; a
    profile built with the blacklist also adds ``entry_dt``);
    ``prejoin=False`` chains three as-of joins.
    """
    if not prejoin:
        return _enrich_chain(tr, cards, accounts, clients, terminals, at)
    prof = profile if profile is not None else card_profile(cards, accounts, clients)
    p = prof.select(*[F.col(c).alias(f"pf_{c}") for c in prof.columns])
    cond = (F.col("card_num") == F.col("pf_card_num")) & F.col(at).between(F.col("pf_seg_from"), F.col("pf_seg_to"))
    x = tr.join(p, cond, "left")
    x = (x.withColumn("fio", fio("pf_cl_last_name", "pf_cl_first_name", "pf_cl_patronymic"))
          .withColumnRenamed("pf_account", "account")
          .withColumnRenamed("pf_ac_valid_to", "valid_to")
          .withColumnRenamed("pf_ac_client", "client")
          .withColumnRenamed("pf_cl_passport_num", "passport")
          .withColumnRenamed("pf_cl_passport_valid_to", "passport_valid_to")
          .withColumnRenamed("pf_cl_phone", "phone")
          .withColumnRenamed("pf_bl_entry_dt", "entry_dt")
          .drop(*[c for c in x.columns if c.startswith("pf_")
                  and c not in ("pf_account", "pf_ac_valid_to", "pf_ac_client", "pf_cl_passport_num",
                                "pf_cl_passport_valid_to", "pf_cl_phone", "pf_bl_entry_dt")]))
    if terminals is not None:
        x = (asof_join(x, terminals, "terminal", "terminal_id", at, ["terminal_city"], "tm_")
             .withColumnRenamed("tm_terminal_city", "city"))
    return x


def _enrich_chain(tr: DataFrame, cards: DataFrame, accounts: DataFrame, clients: DataFrame,
                  terminals: DataFrame | None = None, at: str = "transaction_date") -> DataFrame:
    """Transaction → card → account → client (→ terminal), all as of the event.

    Adds ``account, valid_to, client, passport, passport_valid_to, phone, fio``
    and, with terminals, ``city``.
    """
    x = asof_join(tr, cards, "card_num", "card_num", at, ["account"], "cd_")
    x = asof_join(x, accounts, "cd_account", "account", at, ["valid_to", "client"], "ac_")
    x = asof_join(x, clients, "ac_client", "client_id", at,
                  ["passport_num", "passport_valid_to", "phone",
                   "last_name", "first_name", "patronymic"], "cl_")
    x = (x.withColumn("fio", fio("cl_last_name", "cl_first_name", "cl_patronymic"))
          .withColumnRenamed("cd_account", "account")
          .withColumnRenamed("ac_valid_to", "valid_to")
          .withColumnRenamed("ac_client", "client")
          .withColumnRenamed("cl_passport_num", "passport")
          .withColumnRenamed("cl_passport_valid_to", "passport_valid_to")
          .withColumnRenamed("cl_phone", "phone")
          .drop("cl_last_name", "cl_first_name", "cl_patronymic"))
    if terminals is not None:
        x = (asof_join(x, terminals, "terminal", "terminal_id", at, ["terminal_city"], "tm_")
             .withColumnRenamed("tm_terminal_city", "city"))
    return x
