"""Lag columns over a per-key sequence that stay balanced when a key is hot.

A plain ``lag(...).over(Window.partitionBy(key).orderBy(...))`` sends every
row of a key to one task. If one card (or passport) holds a third of all
operations, that task holds a third of the data. Here a key's sequence is
cut into time buckets when the key is hot:

1. Hot keys are those with more than ``hot_fraction`` of all rows, so there are
   at most ``1 / hot_fraction`` of them: a list with a proven size bound,
   broadcast to every task. Cold keys keep one bucket. Rows with a null key
   belong to no sequence: their lags are the defaults and each is a group of
   its own.
2. Lags run per (key, bucket): the hot key's rows spread over many tasks.
3. Only the first ``k`` rows of a bucket (``k`` = largest offset) can need a
   predecessor from an earlier bucket. The first and last ``k`` rows of every
   hot bucket form a small edge set (at most ``2k`` rows per bucket); lags
   over the edge set, per key, are exact for those first rows, because every
   predecessor within ``k`` positions of them is itself in the edge set.
4. Result = rows whose in-bucket lags are complete, plus the corrected first
   rows of hot buckets. No row is dropped and no group grows with the data
   beyond one bucket of one key.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def wall_seconds(c: Column) -> Column:
    """Seconds since 1970-01-01 00:00 of a TIMESTAMP_NTZ, from its fields.

    Never goes through the session time zone, so it rises with the
    timestamp even across daylight-saving changes (buckets must not reorder).
    """
    days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


@dataclass(frozen=True)
class Lag:
    name: str                 # output column
    source: str               # input column
    offset: int
    default: object = None


def sequence_lags(df: DataFrame, keys: list[str], order: list[str], lags: list[Lag],
                  time_col: str | None = None, bucket_seconds: int = 3600,
                  hot_fraction: float = 1e-5,
                  skew_safe: bool = True, detect_hot: bool = True,
                  only: Column | None = None) -> DataFrame:
    """``df`` plus one column per :class:`Lag`, ordered by ``order`` within ``keys``.

    ``detect_hot=False`` buckets every key (no counting job): the choice for
    inputs that are expensive to compute twice, such as a join result.
    ``only``: rows whose lags are needed; the others keep one bucket and
    skip the edge pass. It must hold for all or none of a key's rows.
    """
    known = reduce(Column.__and__, [F.col(c).isNotNull() for c in keys])
    alone = F.xxhash64(*order)      # the group of a row without a key
    if not skew_safe:
        w = Window.partitionBy(*keys, F.when(~known, alone)).orderBy(*order)
        return df.select("*", *[F.lag(lg.source, lg.offset, lg.default).over(w).alias(lg.name)
                                for lg in lags])
    if not 0 < hot_fraction < 1:
        raise ValueError("hot_fraction must lie between 0 and 1: it bounds the broadcast list")
    k = max(lg.offset for lg in lags)
    time_col = time_col or order[0]
    if detect_hot:
        counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        share = counts.select((F.sum("_n") * F.lit(hot_fraction)).alias("s")).scalar()
        hot = (counts.filter(F.col("_n") > share)
                     .select(*keys, F.lit(True).alias("_hot")))
        # at most 1/hot_fraction keys can exceed that share: safe to broadcast
        x = df.join(F.broadcast(hot), keys, "left")
        is_hot = F.coalesce(F.col("_hot"), F.lit(False))
    else:
        x, is_hot = df, F.lit(True)
    if only is not None:
        is_hot = is_hot & F.coalesce(only, F.lit(False))
    is_hot = is_hot & known
    bucket = (F.when(~known, alone)
               .when(is_hot, F.floor(wall_seconds(F.col(time_col)) / F.lit(bucket_seconds))).otherwise(F.lit(0)))
    x = x.withColumn("_hot", is_hot).withColumn("_bucket", bucket.cast("long"))
    # Hash on (keys, bucket) explicitly: an input already hashed on the keys
    # alone would satisfy the window and keep a hot key in one task.
    x = x.repartition(*keys, "_bucket")

    w_in = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    w_full = w_in.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    x = x.select("*", F.row_number().over(w_in).alias("_pos"), F.count(F.lit(1)).over(w_full).alias("_cnt"),
                 *[F.lag(lg.source, lg.offset, lg.default).over(w_in).alias(lg.name) for lg in lags])
    done = x.filter(~F.col("_hot") | (F.col("_pos") > k))
    edge = x.filter(F.col("_hot") & ((F.col("_pos") <= k) | (F.col("_pos") > F.col("_cnt") - k)))
    w_edge = Window.partitionBy(*keys).orderBy(*order)
    fixed = (edge.drop(*[lg.name for lg in lags])
                 .select("*", *[F.lag(lg.source, lg.offset, lg.default).over(w_edge).alias(lg.name)
                                for lg in lags])
                 .filter(F.col("_pos") <= k))
    cols = [*df.columns, *[lg.name for lg in lags]]
    return reduce(DataFrame.unionByName, [done.select(*cols), fixed.select(*cols)])

