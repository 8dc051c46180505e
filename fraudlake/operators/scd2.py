"""Type-2 history (SCD2) as plain DataFrame rewrites.

``scd2_apply`` replaces the source system's MERGE / INSERT / UPDATE sequence
with one keyed grouping of the open versions, the staged rows and the live
keys (a three-way full-outer join in a single shuffle). Every key is decided
once; closed versions pass through untouched and are never shuffled. Each
side holds one row per natural key, so no group grows with the data and no
hot key can exist here.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlake.functions.expr import blank_to_null, is_current, is_different, open_end, ts_lit
from fraudlake.schemas import FLAG_DELETED, FLAG_LIVE, FIRST_WATERMARK, OPEN_END, DimSpec


def effective_from(df: DataFrame) -> Column:
    """Start of a staged version: ``coalesce(update_dt, create_dt)``."""
    parts = [F.col(c) for c in ("update_dt", "create_dt") if c in df.columns]
    return F.coalesce(*parts) if len(parts) > 1 else parts[0]


def extract_since(src: DataFrame, watermark: dt.datetime | Column | None) -> DataFrame:
    """Rows changed since the watermark (None: since the first watermark, all rows)."""
    if watermark is None:
        watermark = FIRST_WATERMARK
    wm = watermark if isinstance(watermark, Column) else ts_lit(watermark)
    return src.filter(effective_from(src) >= wm)


def live_keys(src: DataFrame, spec: DimSpec) -> DataFrame:
    """All keys present in the source now, tagged with the table name."""
    return src.select(F.col(spec.key).alias("id"), F.lit(spec.name).alias("table_name"))


def stage_latest(staged: DataFrame, spec: DimSpec) -> DataFrame:
    """One staged row per key: the latest version (ties broken on attributes).

    ``max(struct)`` is a plain aggregate, so it combines map-side.
    """
    eff = effective_from(staged)
    best = F.max(F.struct(eff.alias("eff"), *[F.col(a) for a in spec.attrs])).alias("b")
    return (staged.groupBy(spec.key).agg(best)
                  .select(spec.key, *[F.col(f"b.{a}").alias(a) for a in spec.attrs],
                          F.col("b.eff").alias("effective_from")))


def current(hist: DataFrame) -> DataFrame:
    """Open, not-deleted versions."""
    return hist.filter(is_current())


def changed_keys(staged: DataFrame, hist: DataFrame, spec: DimSpec) -> DataFrame:
    """Staged rows whose current version differs in some attribute."""
    s = stage_latest(staged, spec)
    t = current(hist).select(spec.key, *[F.col(a).alias(f"t_{a}") for a in spec.attrs])
    diff = is_different([F.col(a) for a in spec.attrs], [F.col(f"t_{a}") for a in spec.attrs])
    return s.join(t, spec.key, "inner").filter(diff).select(spec.key, *spec.attrs, "effective_from")


def deleted_keys(hist: DataFrame, keys: DataFrame, spec: DimSpec) -> DataFrame:
    """Current versions whose key is gone from the source snapshot."""
    live = keys.select(F.col("id").alias(spec.key)) if "id" in keys.columns else keys.select(spec.key)
    return current(hist).join(live, spec.key, "left_anti")


def close_deleted(hist: DataFrame, keys: DataFrame, spec: DimSpec) -> DataFrame:
    """Versions the delete step closes: ``key in (deleted keys)`` and current."""
    gone = deleted_keys(hist, keys, spec).select(spec.key)
    return current(hist).join(gone, spec.key, "left_semi")


def empty_history(spark, spec: DimSpec) -> DataFrame:
    return spark.createDataFrame([], spec.hist_schema)


def scd2_apply(hist: DataFrame, staged: DataFrame, keys: DataFrame | None,
               run_ts: dt.datetime, spec: DimSpec) -> DataFrame:
    """New history after one load: closed versions pass through untouched,
    open ones go through :func:`scd2_step`."""
    hist = hist.select(*spec.hist_columns)
    closed = hist.filter(F.col("effective_to") != open_end())
    opened = hist.filter(F.col("effective_to") == open_end())
    return closed.unionByName(scd2_step(opened, staged, keys, run_ts, spec))


def scd2_step(opened: DataFrame, staged: DataFrame, keys: DataFrame | None,
              run_ts: dt.datetime, spec: DimSpec) -> DataFrame:
    """Versions that replace the open ones after one load.

    ``opened``: the open versions (``effective_to`` = 9999-12-31) only;
    ``staged``: changed source rows (key, attrs, ``update_dt``/``create_dt``);
    ``keys``: every key in the source now (``id`` or the key column), or None
    when ``staged`` is a full slice; ``run_ts``: start of tombstone versions.

    Per key: *new* (staged, no open version) gets an open ``N`` version;
    *changed* (attributes differ) and *returned* (open ``Y`` version) get the
    old version closed one second before the new one starts; *deleted* (open
    ``N``, key not in the source) is closed one second before ``run_ts`` and
    an open ``Y`` version starts at ``run_ts``; a key that is *back unstaged* (open
    ``Y``, in the source, but not changed since the watermark) gets its last
    attributes as an open ``N`` version from ``run_ts``, so that the open ``N``
    versions always equal the source's keys. An unchanged restaged row keeps
    its open version. The output holds the (possibly just closed) old open
    versions and the new ones; closed history is never read.

    One shuffle: open versions, staged rows and live keys are tagged and
    grouped by key. Each side holds at most one row per key (one open version
    per key; the latest staged row wins via max over a struct led by its start
    time), so the grouping is a keyed full-outer join. The step is written as
    a few SQL texts: building it column by column costs seconds of driver time.
    """
    key, attrs = spec.key, list(spec.attrs)
    types = {f.name: f.dataType.simpleString() for f in spec.hist_schema.fields}
    run, end = (f"timestamp_ntz'{t:%Y-%m-%d %H:%M:%S}'" for t in (run_ts, OPEN_END))
    start = [c for c in ("update_dt", "create_dt") if c in staged.columns]
    fields = [f"`{a}` {types[a]}" for a in attrs]

    def typed(cols: list[str], kinds: list[str]) -> str:
        return f"cast(struct({', '.join(cols)}) as struct<{', '.join(k.replace(' ', ':', 1) for k in kinds)}>)"

    none = lambda kinds: f"cast(null as struct<{', '.join(k.replace(' ', ':', 1) for k in kinds)}>)"
    o_kinds = [*fields, "`from` timestamp_ntz", "`flg` string"]
    s_kinds = ["`from` timestamp_ntz", *fields]
    tagged = opened.selectExpr(f"`{key}`", typed([*attrs, "effective_from", "deleted_flg"], o_kinds) + " o",
                               none(s_kinds) + " s", "cast(null as boolean) live")
    tagged = tagged.unionAll(staged.selectExpr(
        f"`{key}`", none(o_kinds) + " o", typed([f"coalesce({', '.join(start)})", *attrs], s_kinds) + " s", "true live"))
    if keys is not None:
        name = "id" if "id" in keys.columns else key
        tagged = tagged.unionAll(keys.selectExpr(f"`{name}` `{key}`", none(o_kinds) + " o", none(s_kinds) + " s", "true live"))
    same = " and ".join(f"s.`{a}` <=> o.`{a}`" for a in attrs)
    live, dead = f"(o.flg <=> '{FLAG_LIVE}')", f"(o.flg <=> '{FLAG_DELETED}')"
    g = tagged.groupBy(key).agg(F.expr("max(o) o"), F.expr("max(s) s"), F.expr("max(live) live")).selectExpr(
        f"`{key}`", "o", "s",
        f"s is not null and ({dead} or {live} and not ({same})) superseded",
        "s is not null and o is null created",
        f"{live} and s is null and live is null deleted",
        f"{dead} and s is null and live is not null back")
    second = "interval '1' second"

    def version(side: str, since: str, until: str, flag: str) -> str:
        vals = [f"'{key}', `{key}`", *[f"'{a}', {side}.`{a}`" for a in attrs],
                f"'effective_from', {since}", f"'effective_to', {until}", f"'deleted_flg', {flag}"]
        return f"named_struct({', '.join(vals)})"

    until = (f"case when superseded then s.`from` - {second} when deleted or back then {run} - {second} "
             f"else {end} end")
    old = f"if(o is not null, {version('o', 'o.`from`', until, 'o.flg')}, null)"
    new = (f"case when superseded or created then {version('s', 's.`from`', end, repr(FLAG_LIVE))} "
           f"when deleted then {version('o', run, end, repr(FLAG_DELETED))} "
           f"when back then {version('o', run, end, repr(FLAG_LIVE))} end")
    return g.selectExpr(f"inline(filter(array({old}, {new}), v -> v is not null))")


def first_load(spark, src: DataFrame, spec: DimSpec, run_ts: dt.datetime) -> DataFrame:
    """History of a dimension loaded once from an empty warehouse."""
    return scd2_apply(empty_history(spark, spec), src, None, run_ts, spec)


def normalize_source(src: DataFrame, spec: DimSpec) -> DataFrame:
    """Ingest-time cleaning: CHAR padding and Oracle '' = NULL on text columns."""
    out = []
    for f in src.schema.fields:
        c = F.col(f.name)
        if f.dataType.typeName() == "string":
            c = blank_to_null(c)
        out.append(c.alias(f.name))
    return src.select(*out)


def open_counts(hist: DataFrame, spec: DimSpec) -> DataFrame:
    """Per key: number of open versions (invariant: at most one)."""
    return (hist.filter(F.col("effective_to") == open_end())
                .groupBy(spec.key).agg(F.count(F.lit(1)).alias("n_open")))


__all__ = [
    "changed_keys", "close_deleted", "current", "deleted_keys", "effective_from", "empty_history",
    "extract_since", "first_load", "live_keys", "normalize_source", "open_counts", "scd2_apply",
    "scd2_step", "stage_latest",
]
