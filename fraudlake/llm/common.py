"""Helpers shared by the corpus operators: stored intermediates, graph components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names.

    Only a local-mode session without the setting (tests) gets a temporary
    folder; on a cluster a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set; name a shared folder")
        base = tempfile.mkdtemp(prefix="fraudlake-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there,
    so a lost executor costs no recomputation of what stands before."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/llm-{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def release(df: DataFrame | None) -> None:
    """Delete a table written by ``store`` that nothing will read again."""
    path = getattr(df, "_stored_at", None)
    if path:
        jvm = df.sparkSession._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names`` for inner columns, made longer where ``df`` has such a column."""
    have, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in have:
            n += "_"
        have.add(n.lower())
        out.append(n)
    return out


def connected_components(edges: DataFrame, a: str = "a", b: str = "b",
                         max_rounds: int = 60) -> DataFrame:
    """Connected components of an edge list by alternating large-star and
    small-star rounds (each a pre-aggregated minimum and one join).

    Returns ``(id, component)`` for every vertex with an edge to another
    vertex; ``component`` is its smallest reachable id. Self-loops, repeated
    edges and rows with a null end are ignored. No vertex's neighbours are
    ever gathered in one place: each round sends only minima.
    """
    e = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")) \
             .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct()
    cur = store(e, "cc")

    def mark(df):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    seen = mark(cur)
    for _ in range(max_rounds):
        both = cur.select("u", "v").unionAll(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
                    .filter("u != v").distinct()
        large = store(large, "cc")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")) \
                     .unionAll(low.select("u", F.col("m").alias("v"))).filter("u != v").distinct()
        nxt = store(small, "cc")
        release(large)
        release(cur)
        cur, was = nxt, seen
        seen = mark(cur)
        if seen == was:
            break
    else:
        raise RuntimeError("components did not settle")
    heads = cur.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return cur.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(heads)


def blocked(rows: DataFrame, key: list[str], vid: str, most: int, weight: str | None = None) -> DataFrame:
    """Deal each key's rows into blocks of about ``most`` (rows, or of the
    column ``weight``) and each block to its pairings with every block of the
    key: adds ``bi <= bj`` and ``own`` (the row's block). All pairs of a key's
    rows then meet in exactly one (key, bi, bj), those of one block in (b, b);
    no task holds over two blocks. Keys with a single row are dropped."""
    total = F.sum(weight) if weight else F.count("*")
    n = rows.groupBy(*key).agg(total.alias("__n"), F.count("*").alias("__c")).filter("__c > 1").drop("__c")
    q = F.ceil(F.col("__n") / most).cast("int")
    x = rows.join(n, key).withColumn("__q", q) \
            .withColumn("own", F.pmod(F.xxhash64(vid), F.col("__q")).cast("int"))
    x = x.withColumn("__o", F.explode(F.sequence(F.lit(0), F.col("__q") - 1)))
    return x.withColumn("bi", F.least("own", "__o")).withColumn("bj", F.greatest("own", "__o")) \
            .drop("__n", "__q", "__o")


def whole_groups(frames, key: list[str]):
    """The groups of a partition sorted by ``key``, each as one frame, however
    they lie over Arrow batches."""
    import pandas as pd
    rest = None
    for f in frames:
        f = f if rest is None else pd.concat([rest, f], ignore_index=True)
        if f.empty:
            continue
        new = (f[key] != f[key].shift()).any(axis=1).to_numpy().nonzero()[0]
        for a, b in zip(new, new[1:]):
            yield f.iloc[a:b]
        rest = f.iloc[new[-1]:]
    if rest is not None and len(rest):
        yield rest
