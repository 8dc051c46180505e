"""Near-duplicate embeddings: random-hyperplane sign hashing in several tables,
exact cosine verification, distributed connected components.

Equal vectors are one class first. Each table hashes a vector to the signs of
its products with ``bits`` random planes; vectors that agree in a table meet
and are compared exactly (double precision). A pair that meets in several
tables is counted in the first only, which both signatures tell, so no pair
is ever sent anywhere: a bucket yields, per vector, the number of links and
one link towards each local component. Buckets are dealt into blocks, so a
bucket that holds a third of all vectors is many tasks.

``table_plan`` takes as many planes as keep an average bucket at one block of
vectors, 8 at least, and as many tables as give a pair at the threshold the
chance ``recall`` of meeting: 16 tables of 8 planes up to half a million
different vectors at cosine 0.9. Comparisons then grow with vectors times
tables, not with their square. Counting every link of a vector still takes
as many comparisons as there are pairs in a dense cluster.

Defined cases: a vector that is null, empty, zero or holds a null, NaN or
infinite component links with nothing; vectors of different lengths do not
link; repeated ids and null ids are vectors of their own (a component is
named by its smallest id); an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, log, log2, pi

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlake.llm.common import blocked, connected_components, partitions, store, whole_groups


def table_plan(n: int, least: float, block: int, recall: float) -> tuple[int, int]:
    """``(tables, bits)`` for ``n`` different vectors."""
    bits = max(8, ceil(log2(max(1, n) / block)))
    meet = (1 - acos(min(1.0, least)) / pi) ** bits
    return (ceil(log(1 - recall) / log(1 - meet)) if meet < 1 else 1), bits


def planes(dim: int, tables: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, tables * bits))


def local_links(vecs: np.ndarray, left: np.ndarray, right: np.ndarray, sigs: np.ndarray, table: int,
                least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (one of ``left``, one of ``right``) of cosine ``least`` or more
    that meet in no table before ``table``. With the same rows on both sides,
    each pair once."""
    norm = np.sqrt((vecs * vecs).sum(axis=1))
    cos = (vecs[left] @ vecs[right].T) / np.outer(norm[left], norm[right])
    i, j = np.nonzero(cos >= least)
    if left is right:
        i, j = i[i < j], j[i < j]
    a, b = left[i], right[j]
    if table:
        new = ~(sigs[a, :table] == sigs[b, :table]).any(axis=1)
        a, b = a[new], b[new]
    return a, b


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row of each row's component under the links ``a - b``."""
    root = np.arange(n)
    while True:
        was = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == was).all():
            return root


def near_vectors(rows: DataFrame, least: float = 0.9, tables: int | None = None, bits: int | None = None,
                 seed: int = 7, block: int = 2048, recall: float = 0.995) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, a row per vector. ``tables`` and
    ``bits``: instead of the ones ``table_plan`` gives."""
    vec = F.col("embedding").cast("array<double>")
    good = (F.coalesce(F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
            & F.coalesce(F.exists(vec, lambda x: x != 0), F.lit(False)))
    base = store(rows.select(F.monotonically_increasing_id().alias("vid"), "vec_id",
                             F.when(good, F.col("embedding")).alias("embedding"))
                 .withColumn("key", F.when(F.col("embedding").isNotNull(),
                                           F.sha2(F.to_json(F.struct("embedding")), 256))), "vectors")
    classes = store(base.filter(F.col("key").isNotNull()).groupBy("key")
                    .agg(F.min("vid").alias("rep"), F.count("*").alias("many")), "classes")
    if tables is None or bits is None:
        tables, bits = table_plan(classes.count(), least, block, recall)
    reps = base.join(classes, [base["vid"] == classes["rep"]]).select("vid", "embedding", "many")

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            dims = f["embedding"].map(len)
            for dim, g in f.groupby(dims):
                for lo in range(0, len(g), 2000):
                    h = g.iloc[lo:lo + 2000]
                    v = np.stack(h["embedding"].to_numpy()).astype(np.float64)
                    sign = (v @ planes(dim, tables, bits, seed) >= 0).reshape(len(h), tables, bits)
                    sig = sign.astype(np.int64) @ (1 << np.arange(bits))
                    at = np.tile(np.arange(tables), len(h))
                    own = np.repeat(np.arange(len(h)), tables)
                    yield pd.DataFrame({
                        "tab": at.astype(np.int32), "sig": sig.ravel(), "dim": np.int32(dim),
                        "vid": h["vid"].to_numpy()[own], "many": h["many"].to_numpy()[own],
                        "vec": pd.Series([x.tobytes() for x in v.astype(h["embedding"].iloc[0].dtype)])[own].values,
                        "wide": h["embedding"].iloc[0].dtype.itemsize,
                        "sigs": pd.Series([x.astype("<u4").tobytes() for x in sig])[own].values})

    key = ["tab", "sig", "dim"]
    met = reps.mapInPandas(hashed, "tab int, sig long, dim int, vid long, many long, vec binary, wide int, sigs binary")
    # Bucket sizes come from the signatures alone; the wide rows are shuffled once.
    deal = blocked(met, key, "vid", block)
    group = [*key, "bi", "bj"]
    deal = deal.repartition(partitions(rows.sparkSession), *group).sortWithinPartitions(*group)

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in whole_groups(frames, group):
            if len(g) < 2:
                continue
            table, bi, bj = int(g["tab"].iloc[0]), int(g["bi"].iloc[0]), int(g["bj"].iloc[0])
            kind = np.float32 if g["wide"].iloc[0] == 4 else np.float64
            vecs = np.stack([np.frombuffer(x, kind) for x in g["vec"]]).astype(np.float64)
            sigs = np.stack([np.frombuffer(x, "<u4") for x in g["sigs"]])
            own, vid, many = g["own"].to_numpy(), g["vid"].to_numpy(), g["many"].to_numpy()
            left = np.flatnonzero(own == bi)
            right = left if bi == bj else np.flatnonzero(own == bj)
            a, b = local_links(vecs, left, right, sigs, table, least)
            if not len(a):
                continue
            n = len(vid)
            links = np.bincount(a, many[b], n) + np.bincount(b, many[a], n)
            root = local_roots(n, a, b)
            on = links > 0
            yield pd.DataFrame({"vid": vid[on], "links": links[on].astype(np.int64), "to": vid[root[on]]})

    found = store(deal.mapInPandas(compare, "vid long, links long, to long"), "found")
    comps = connected_components(found.select("vid", "to"), "vid", "to")
    count = found.groupBy("vid").agg(F.sum("links").alias("links"))
    per = (classes.join(count, classes["rep"] == count["vid"], "left").drop("vid")
           .join(comps, F.col("rep") == F.col("id"), "left")
           .select("key", "many", F.coalesce("links", F.lit(0)).alias("links"),
                   F.coalesce("component", "rep").alias("component")))
    out = base.select("vid", "vec_id", "key").join(per, "key", "left") \
              .withColumn("component", F.coalesce("component", "vid"))
    name = out.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return out.join(name, "component").select(
        "vec_id", F.coalesce(F.col("links") + F.col("many") - 1, F.lit(0)).cast("long").alias("n_links"),
        "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
