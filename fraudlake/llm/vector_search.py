"""Approximate nearest neighbours by cross-polytope hashing.

A vector's direction is turned by fast Hadamard pseudo-rotations (three rounds
of random signs and a Hadamard transform, padded to a power of two) and
assigned to the nearest signed axis. ``turns`` rotations make one code of a
table; each of ``tables`` tables indexes every vector under one code. A query
orders all (norm band, table, code) buckets by how near their axes lie to it
(the sum of its products with them, times the band's largest norm, as the
nearness is the inner product), probes the first ``probes`` of them, and
every vector met is scored exactly in double precision on the original values.

Equal vectors are one class in the index and among the queries, so a vector
that a third of the rows repeat is one row of a bucket. Buckets are dealt into
blocks of ``block`` vectors by ``block`` queries, each a task's group of bounded size.
A class needs only its ``k + 1`` smallest ids: more can never be among the nearest.

The index is fitted on a bounded sample: ``sample`` query vectors (the least by
a hash) are compared with all vectors, and ``probes`` is the least number that
finds ``recall`` of their true neighbours. ``turns`` grows with the number of vectors
(an average bucket holds about ``block``) and falls again only where ``deepest``
probes do not reach the recall (with one turn left, every bucket is probed). So work follows the structure of the vectors: where the
neighbours are near, few probes suffice; the given random vectors have their
20th neighbour at cosine 0.35, and a query meets a third of them. A query
that meets fewer than ``k`` rows is compared with the whole first table, so none
gets fewer than there are.

Defined cases: vectors that are null, empty, zero or hold a null, NaN or infinite
component take no part; vectors of different lengths never meet; every row is
a query or candidate of its own, whatever its id, and only itself is kept from its
answer; null ids are no queries and come last among ties; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudlake.llm.common import partitions, store, whole_groups


def hadamard(x: np.ndarray) -> np.ndarray:
    """Rows times the Hadamard matrix, unscaled, in d log d steps."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x


def axes(x: np.ndarray, table: int, turn: int, seed: int) -> np.ndarray:
    """Products of rotated unit rows with the signed axes (axis i: 2i and 2i + 1)."""
    n, dim = x.shape
    wide = 1 << max(0, dim - 1).bit_length()
    y = np.zeros((n, wide))
    y[:, :dim] = x
    signs = np.random.default_rng([seed, dim, table, turn]).choice([-1.0, 1.0], (3, wide))
    for s in signs:
        y = hadamard(y * s) / np.sqrt(wide)
    out = np.empty((n, 2 * wide))
    out[:, 0::2], out[:, 1::2] = y, -y
    return out


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)       # no overflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


@dataclass(frozen=True)
class Index:
    tables: int = 8
    turns: int = 1
    seed: int = 7

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Rows x tables: the code of the nearest signed axes."""
        u, out = unit(x), np.zeros((len(x), self.tables), np.int64)
        for t in range(self.tables):
            for r in range(self.turns):
                a = axes(u, t, r, self.seed)
                out[:, t] = out[:, t] * a.shape[1] + a.argmax(axis=1)
        return out

    def probes(self, x: np.ndarray, bands: list[float], most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bands, tables and codes of each row's ``most`` best buckets, best first."""
        u = unit(x)
        value, what = [], []
        for t in range(self.tables):
            v, c = np.zeros((len(x), 1)), np.zeros((len(x), 1), np.int64)
            for r in range(self.turns):   # the best sums start with best sums
                a = axes(u, t, r, self.seed)
                v = (v[:, :, None] + a[:, None, :]).reshape(len(x), -1)
                c = (c[:, :, None] * a.shape[1] + np.arange(a.shape[1])).reshape(len(x), -1)
                if v.shape[1] > most:
                    top = np.argpartition(-v, most - 1, axis=1)[:, :most]
                    v, c = np.take_along_axis(v, top, 1), np.take_along_axis(c, top, 1)
            for b, norm in enumerate(bands):
                value.append(v * norm)
                what.append((np.full(c.shape, b), np.full(c.shape, t), c))
        value = np.concatenate(value, axis=1)
        top = np.argsort(-value, axis=1, kind="stable")[:, :most]
        return tuple(np.take_along_axis(np.concatenate(w, axis=1), top, 1) for w in zip(*what))


def stack(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.frombuffer(v, "<f8") for v in vectors])


def exact(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products row by row; one pair's value does not depend on the others."""
    return (q * c).sum(axis=1)


def nearest(q: np.ndarray, c: np.ndarray, low: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best rows of ``c`` for each row of ``q``: ties to smaller ``low``."""
    rough = q @ c.T
    keep = min(k, len(c))
    edge = np.partition(rough, len(c) - keep, axis=1)[:, len(c) - keep]
    slack = 1e-9 * np.abs(q).max(axis=1) * np.abs(c).max() * q.shape[1]
    i, j = np.nonzero(rough >= (edge - slack)[:, None])
    s = exact(q[i], c[j])
    order = np.lexsort((low[j], -s, i))
    i, j, s = i[order], j[order], s[order]
    first = np.searchsorted(i, np.arange(len(q)))
    on = np.arange(len(i)) - first[i] < k
    return i[on], j[on], s[on]


def index_rows(rows: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Stored ``(base, classes)``: the rows that take part as (uid, vec_id, key),
    and one row per different vector with its ``k + 1`` least members."""
    vec = F.col("embedding").cast("array<double>")
    good = (F.coalesce(F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
            & F.coalesce(F.exists(vec, lambda x: x != 0), F.lit(False)))
    # -0.0 counts as 0.0 in equal vectors
    same = F.transform(vec, lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    base = store(rows.filter(good).select(F.monotonically_increasing_id().alias("uid"), "vec_id", same.alias("vec"))
                 .withColumn("key", F.sha2(F.to_json(F.struct("vec")), 256)), "vectors")
    order = [F.col("vec_id").asc_nulls_last(), "uid"]
    place = F.row_number().over(Window.partitionBy("key").orderBy(*order))
    few = base.select("key", "vec_id", "uid").withColumn("i", place).filter(F.col("i") <= k + 1)
    members = few.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("i", "vec_id", "uid"))).alias("members"))
    one = base.groupBy("key").agg(F.min("uid").alias("uid"))
    vecs = one.join(base.select("uid", "vec"), "uid")
    size = F.aggregate("vec", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))
    unit_sum = F.aggregate("vec", F.lit(0.0), lambda a, x: a + (x / F.col("size")) * (x / F.col("size")))
    classes = vecs.withColumn("size", size).withColumn("norm", F.col("size") * F.sqrt(unit_sum)) \
                  .withColumn("band", F.round(F.log2("size") + F.log2(F.sqrt(unit_sum))).cast("int"))
    return base, store(classes.join(members, "key").select("key", "uid", "vec", "norm", "band", "members"), "vectors")


def pack_vectors(*cols: str):
    """A map from rows with ``vec`` to rows with its doubles as bytes."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f[list(cols)].assign(raw=[np.asarray(v, "<f8").tobytes() for v in f["vec"]])
    return run


def by_length(f: pd.DataFrame, at_once: int = 512) -> Iterator[pd.DataFrame]:
    """Parts of a frame whose vectors have one length."""
    for _, g in f.groupby(f["raw"].map(len)):
        for lo in range(0, len(g), at_once):
            yield g.iloc[lo:lo + at_once]


def fit(packed: DataFrame, asks: DataFrame, bands: list[float], ids: list[int], count: int, k: int, tables: int,
        block: int, recall: float, sample: int, deepest: int, seed: int) -> tuple[Index, int]:
    """The index and its number of probes; see the module's text."""
    some = asks.orderBy(F.xxhash64("uid"), "uid").limit(sample).select("uid", "raw").collect()
    mine = [(r["uid"], bytes(r["raw"])) for r in some]
    if not mine:
        return Index(tables, 1, seed), 1
    dim = max(len(v) // 8 for _, v in mine)
    fan = 2 << max(0, dim - 1).bit_length()
    turns = max(1, ceil(log(max(1, count / block)) / log(fan)))
    while True:
        index = Index(tables, turns, seed)
        total = tables * fan**turns * len(bands)
        most = min(deepest, total)
        found = packed.mapInPandas(ranked(mine, index, bands, ids, most, k), "ask int, score double, rank long")
        top = found.withColumn("i", F.row_number().over(Window.partitionBy("ask").orderBy(F.desc("score"), "rank"))) \
                   .filter(F.col("i") <= k).select("rank").collect()
        ranks = sorted(r["rank"] for r in top)
        need = ranks[min(len(ranks) - 1, ceil(recall * len(ranks)) - 1)] + 1 if ranks else 1
        if need <= most or turns == 1:
            return index, need if need <= most else total
        turns -= 1


def ranked(mine: list[tuple[int, bytes]], index: Index, bands: list[float], ids: list[int], most: int, k: int):
    """A map to the best rows for each sampled query and the place of the first
    of their buckets in the query's order (``most``: not among them)."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked = {}
        for i, (_, raw) in enumerate(mine):
            asked.setdefault(len(raw), []).append(i)
        own = np.array([uid for uid, _ in mine])
        place: dict[int, list[dict]] = {}
        for size, who in asked.items():
            p = index.probes(np.stack([np.frombuffer(mine[i][1], "<f8") for i in who]), bands, most)
            place[size] = [dict(zip(zip(*(c[j].tolist() for c in p)), range(p[0].shape[1]))) for j in range(len(who))]
        at = {b: i for i, b in enumerate(ids)}
        for f in frames:
            for g in by_length(f, 4096):
                size = len(g["raw"].iloc[0])
                if size not in asked:
                    continue
                who = np.array(asked[size])
                c = stack(g["raw"])
                q = np.stack([np.frombuffer(mine[i][1], "<f8") for i in who])
                i, j, s = nearest(q, c, g["uid"].to_numpy(), k + 1)
                on = own[who[i]] != g["uid"].to_numpy()[j]
                i, j, s = i[on], j[on], s[on]
                rows, back = np.unique(j, return_inverse=True)
                code = index.codes(c[rows])
                band = [at[b] for b in g["band"].to_numpy()[rows]]
                rank = [min(place[size][a].get((band[b], t, int(x)), most) for t, x in enumerate(code[b]))
                        for a, b in zip(i, back)]
                yield pd.DataFrame({"ask": who[i], "score": s, "rank": rank})
    return run


def dealt(cands: DataFrame, asks: DataFrame, key: list[str], block: int, k: int, spark) -> DataFrame:
    """``(ask, key, score)``: for each query and block of a bucket its ``k``
    best classes. ``cands`` (key columns, vid, low, raw), ``asks`` (key columns, vid, raw)."""
    n = cands.groupBy(*key).agg(F.ceil(F.count("*") / block).cast("int").alias("cn"))
    m = asks.groupBy(*key).agg(F.ceil(F.count("*") / block).cast("int").alias("qn"))
    both = n.join(m, key)
    own = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = cands.join(both, key).select(*key, "vid", "low", "raw", F.lit(False).alias("asks"),
                                        own("vid", "cn").alias("ci"), every("qn").alias("qi"))
    right = asks.join(both, key).select(*key, "vid", F.lit(0).cast("long").alias("low"), "raw", F.lit(True).alias("asks"),
                                        every("cn").alias("ci"), own("vid", "qn").alias("qi"))
    group = [*key, "ci", "qi"]
    met = left.unionByName(right).repartition(partitions(spark), *group).sortWithinPartitions(*group)

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in whole_groups(frames, group):
            ask = g["asks"].to_numpy()
            if ask.all() or not ask.any():
                continue
            q, c = g[ask], g[~ask]
            i, j, s = nearest(stack(q["raw"]), stack(c["raw"]), c["low"].to_numpy(), k)
            yield pd.DataFrame({"ask": q["vid"].to_numpy()[i], "vid": c["vid"].to_numpy()[j], "score": s,
                                "low": c["low"].to_numpy()[j]})

    return met.mapInPandas(compare, "ask long, vid long, score double, low long")


def search(rows: DataFrame, queries, k: int = 20, tables: int = 8, block: int = 2048, recall: float = 0.96,
           sample: int = 256, deepest: int = 2048, seed: int = 7) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` rows of largest inner
    product found for each row for which the condition ``queries`` (on ``vec_id``) holds."""
    spark = rows.sparkSession
    base, classes = index_rows(rows, k)
    asking = base.filter(queries).select("key", "uid", "vec_id")
    # A band for each power of two of the norms: a few thousand rows at most.
    known = classes.groupBy("band").agg(F.max("norm").alias("norm"), F.count("*").alias("n")).orderBy("band").collect()
    ids, bands = [r["band"] for r in known], [r["norm"] for r in known]
    low = F.coalesce(F.col("members")[0]["vec_id"], F.lit(2**63 - 1))
    packed = store(classes.select("uid", low.alias("low"), "band", "vec")
                   .mapInPandas(pack_vectors("uid", "low", "band"), "uid long, low long, band int, raw binary"), "vectors")
    wanted = asking.select("key").distinct().join(classes.select("key", "uid"), "key").select("uid")
    asks = store(packed.join(wanted, "uid"), "asks")
    index, probes = fit(packed, asks, bands, ids, sum(r["n"] for r in known), k, tables, block, recall, sample, deepest, seed)
    at = {b: i for i, b in enumerate(ids)}

    def indexed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for g in by_length(f, 1024):
                code = index.codes(stack(g["raw"]))
                n = np.repeat(np.arange(len(g)), index.tables)
                yield pd.DataFrame({"dim": len(g["raw"].iloc[0]) // 8, "band": g["band"].map(at).to_numpy()[n],
                                    "tab": np.tile(np.arange(index.tables), len(g)), "code": code.ravel(),
                                    "vid": g["uid"].to_numpy()[n], "low": g["low"].to_numpy()[n],
                                    "raw": g["raw"].to_numpy()[n]})

    def probing(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for g in by_length(f, 128):
                band, tab, code = index.probes(stack(g["raw"]), bands, probes)
                n = np.repeat(np.arange(len(g)), code.shape[1])
                yield pd.DataFrame({"dim": len(g["raw"].iloc[0]) // 8, "band": band.ravel(), "tab": tab.ravel(),
                                    "code": code.ravel(), "vid": g["uid"].to_numpy()[n], "raw": g["raw"].to_numpy()[n]})

    key = ["dim", "band", "tab", "code"]
    kind = "dim int, band int, tab int, code long, vid long, {}raw binary"
    index_table = store(packed.mapInPandas(indexed, kind.format("low long, ")), "index")
    probe_table = store(asks.mapInPandas(probing, kind.format("")), "probes")
    found = store(dealt(index_table, probe_table, key, block, k + 1, spark), "found")
    # Rows met by each query, its own class included: short queries see the whole first table.
    size = classes.select(F.col("uid").alias("vid"), F.size("members").alias("n"))
    enough = found.select("ask", "vid").distinct().join(size, "vid").groupBy("ask").agg(F.sum("n").alias("n")) \
                  .filter(F.col("n") > k).select(F.col("ask").alias("uid"))
    short = asks.join(enough, "uid", "left_anti").select(
        (F.octet_length("raw") / 8).cast("int").alias("dim"), F.col("uid").alias("vid"), "raw")
    first = index_table.filter("tab = 0")
    more = short.join(first.select(*key).distinct(), "dim")
    found = found.unionAll(store(dealt(first, more, key, block, k + 1, spark), "found"))
    # A class is met once a table and once more by a short query.
    best = Window.partitionBy("ask").orderBy(F.desc("score"), "low", "vid")
    near = found.withColumn("i", F.row_number().over(best)).filter(F.col("i") <= (k + 1) * (index.tables + 1)) \
                .dropDuplicates(["ask", "vid"]).withColumn("i", F.row_number().over(best)).filter(F.col("i") <= k + 1)
    near = near.join(classes.select(F.col("uid").alias("vid"), "members"), "vid") \
               .select("ask", "score", F.explode("members").alias("m")) \
               .select("ask", "score", F.col("m.vec_id").alias("vec_id"), F.col("m.uid").alias("uid"))
    order = [F.desc("score"), F.col("vec_id").asc_nulls_last(), "uid"]
    near = near.withColumn("i", F.row_number().over(Window.partitionBy("ask").orderBy(*order))).filter(F.col("i") <= k + 1)
    heads = classes.select("key", F.col("uid").alias("ask"))
    each = asking.select("key", F.col("uid").alias("me"), F.col("vec_id").alias("query_id")).join(heads, "key") \
                 .join(near, "ask").filter("me <> uid")
    rank = F.row_number().over(Window.partitionBy("me").orderBy(*order))
    return each.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
