"""Sharding by balanced label propagation: linked rows gather, sizes stay even.

Rows start spread by a hash. In each round every row looks at the shards of
its neighbours of smaller id (so that two rows never swap places for ever),
by a join of the links with the labels, and wishes to move to the shard most
of them are in. A star needs one round, a path as many as it is long. Wishes are granted within quotas: a
shard's room for linked rows, counting those that leave it in the same round, over
its demand is the share of link groups it takes, decided by a hash of the group, so
a group moves together. Rounds go on until no wish is left or can be granted. An
exact repair then moves what stands above a shard's count, rows without links
first, into the shards below theirs.

Law: ``rows``. Counts differ by one at most.

Defined cases: null and repeated ids are rows of their own; a null text is an
empty one (size 16); with fewer rows than shards some shards are empty;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import accumulate, count

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudlake.llm.common import partitions, release, store


def copy_links(rows: DataFrame, group: list[str], most: int) -> DataFrame:
    """Star links ``(src, dst)`` between rows (``vid``) that agree on ``group``.

    A group of over ``most`` rows (a whole shard) is dealt by a hash into stars of
    at most about that many, since one shard could not hold it; no star's links pass through a
    single task except as a count.
    """
    n = rows.groupBy(*group).agg(F.count("*").alias("n")).filter("n > 1")
    parts = F.ceil(F.col("n") / most).cast("int")
    x = rows.join(n, group).select("vid", *group, F.pmod(F.xxhash64("vid"), parts).alias("part"))
    hub = x.groupBy(*group, "part").agg(F.min("vid").alias("dst"))
    return x.join(hub, [*group, "part"]).select(F.col("vid").alias("src"), "dst").filter("src != dst")


def shares(room: list[float], flow: dict[tuple[int, int], int]) -> list[float]:
    """The share of the wishes to each shard that is granted: the largest for which
    no shard's granted inflow is over its ``room`` and its granted outflow.
    ``flow``: ``(from, to) -> wishes``."""
    n = len(room)
    w = np.zeros((n, n))
    for (a, b), k in flow.items():
        w[a, b] = k
    demand = w.sum(axis=0)
    share = (demand > 0).astype(float)
    for _ in range(10_000):   # from all granted downwards; a few thousand numbers a step
        free = np.maximum(0.0, np.array(room)) + w @ share
        nxt = np.minimum(share, np.divide(free, demand, out=np.zeros(n), where=demand > 0))
        done, share = np.abs(nxt - share).max(initial=0.0) < 1e-9, nxt
        if done:
            break
    return share.tolist()


def label_propagation(rows: DataFrame, links: DataFrame, shards: int, rounds: int | None = None,
                      fill: float = 0.95) -> DataFrame:
    """``(vid, shard, slot)`` for every row of ``rows`` (unique ``vid``).

    ``links`` holds ``(src, dst)``; direction is ignored. Slots number each
    shard's rows from 0 without gaps. ``rounds``: at most so many.
    """
    spark = rows.sparkSession
    down = store(links.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
                 .filter("src != dst"), "links")
    # The star (smallest neighbour) a row belongs to decides on its quota.
    star = (down.groupBy(F.col("src").alias("vid")).agg(F.min("dst").alias("star"))
            .unionAll(down.select(F.col("dst").alias("vid"), F.col("dst").alias("star")).distinct())
            .groupBy("vid").agg(F.min("star").alias("star")))
    # Its size, as a power of two: the repair moves small ones first.
    band = star.groupBy("star").agg(F.floor(F.log2(F.count("*").cast("double"))).cast("int").alias("band"))
    star = star.join(band, "star")
    now = rows.select("vid").withColumn("shard", F.pmod(F.xxhash64("vid"), F.lit(shards)).cast("int")) \
              .join(star, "vid", "left")
    now = store(now, "labels")
    total = now.count()
    linked = now.filter(F.col("star").isNotNull()).count()
    limit = max(total * fill, linked) / shards   # for linked rows; the others make room for them
    for r in count() if rounds is None else range(rounds):
        votes = (down.join(now.select(F.col("vid").alias("dst"), F.col("shard").alias("to")), "dst")
                 .groupBy("src", "to").agg(F.count("*").alias("n")))
        best = (votes.join(now.select(F.col("vid").alias("src"), "shard", "star"), "src")
                .groupBy("src", "shard", "star")
                .agg(F.max_by("to", F.struct("n", F.col("to") == F.col("shard"), -F.col("to"))).alias("to"))
                .filter("to != shard"))
        best = store(best, "moves")
        flow = {(x["shard"], x["to"]): x["count"] for x in best.groupBy("shard", "to").count().collect()}
        size = {x["shard"]: x["n"] for x in now.groupBy("shard").agg(F.count("star").alias("n")).collect()}
        share = shares([limit - size.get(s, 0) for s in range(shards)], flow)
        # Expected grants of under one row in all: no wish is left that can be granted.
        if sum(k * share[b] for (_, b), k in flow.items()) < 1:
            release(best)
            break
        quota = F.get(F.array(*[F.lit(x) for x in share]), F.col("to"))
        lot = F.pmod(F.xxhash64("star", F.lit(r)), F.lit(1 << 20)) / F.lit(float(1 << 20))
        moved = best.filter(lot < quota).select(F.col("src").alias("vid"), "to")
        nxt = store(now.join(moved, "vid", "left")
                    .select("vid", F.coalesce("to", "shard").alias("shard"), "star", "band"), "labels")
        release(now)
        release(best)
        now = nxt
    return _even(now, shards, total, partitions(spark))


def _even(labels: DataFrame, shards: int, total: int, blocks: int) -> DataFrame:
    """Exact counts: rows ranked beyond their shard's count fill the others.

    Ranks are taken in two steps, counts per block and then row numbers in a
    block, so no shard is sorted in one task. Linked rows come first, those of large
    stars before others and in the order of their star, so rows without links and
    then small stars are moved first.
    """
    blocks = max(blocks, total // 200_000 + 1)
    x = labels.select("vid", "shard", "star", F.col("star").isNull().alias("free"),
                      F.coalesce(-F.col("band"), F.lit(0)).alias("band"),
                      F.pmod(F.xxhash64(F.coalesce("star", "vid")), F.lit(blocks)).alias("block"),
                      # a large star is ranked in pieces of some 100,000 rows
                      F.expr("pmod(xxhash64(vid, 3), shiftleft(1, greatest(0, coalesce(band, 0) - 16)))").alias("sub"))
    key = ["shard", "free", "band", "block", "sub"]
    n = x.groupBy(*key).agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("free", "band", "block", "sub") \
                   .rowsBetween(Window.unboundedPreceding, -1)
    n = n.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    inside = Window.partitionBy(*key).orderBy("vid")
    ranked = (x.withColumn("i", F.row_number().over(inside) - 1).join(n.drop("n"), key)
              .select("vid", "shard", (F.col("base") + F.col("i")).alias("rank")))
    ranked = store(ranked, "ranked")
    size = {r["shard"]: r["count"] for r in ranked.groupBy("shard").count().collect()}   # one row a shard
    size = [size.get(s, 0) for s in range(shards)]
    want = [total // shards + (s < total % shards) for s in range(shards)]
    over = [max(0, a - b) for a, b in zip(size, want)]
    under = [max(0, b - a) for a, b in zip(size, want)]
    over_at, under_at = [0, *accumulate(over)], [0, *accumulate(under)]
    arr = lambda v: F.array(*[F.lit(int(i)) for i in v]).cast("array<long>")
    at = lambda v, i: F.get(arr(v), i)
    y = ranked.withColumn("want", at(want, F.col("shard")))
    number = at(over_at, F.col("shard")) + F.col("rank") - F.col("want")
    y = y.withColumn("o", F.when(F.col("rank") >= F.col("want"), number))
    ends = arr(under_at[1:])
    y = y.withColumn("to", F.size(F.filter(ends, lambda e: e <= F.col("o"))))
    moved = F.col("o").isNotNull()
    return y.select(
        "vid", F.when(moved, F.col("to")).otherwise(F.col("shard")).cast("int").alias("shard"),
        F.when(moved, at(size, F.col("to")) + F.col("o") - at(under_at, F.col("to")))
         .otherwise(F.col("rank")).cast("long").alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 40, rounds: int | None = None, fill: float = 0.95) -> DataFrame:
    """Every document with its shard: links join documents of equal text."""
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = store(docs.select(
        F.monotonically_increasing_id().alias("vid"), "doc_id",
        (F.octet_length(body) + 16).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
        F.xxhash64(body).alias("text_key")), "rows")
    total = rows.count()
    links = copy_links(rows, ["text_key", "text_crc32", "size"], max(2, total // shards))
    placed = label_propagation(rows, links, shards, rounds, fill)
    return rows.join(placed, "vid").select("doc_id", "size", "text_crc32", "shard", "slot", "text_key")
