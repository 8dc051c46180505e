"""Near-duplicate documents: a multi-index Hamming join over b-bit MinHash
signatures, exact verification, distributed connected components.

A document's set holds its distinct ``words``-word shingles (whole texts,
A-Z lower-cased, words split at ASCII white space; a shorter text is one
shingle of all its words). Its signature is ``SYMBOLS`` min-hash values of 16
bits. Two signatures that differ in at most ``ERRORS`` values, split into
``CHUNKS`` chunks, differ in at most ``ERRORS // CHUNKS`` = 1 value of some
chunk (pigeonhole): leaving out each value of each chunk in turn enumerates the
allowed error, so all such pairs share a key. At similarity 0.8 the chance of
more than ``ERRORS`` differences is below 1 in 1,000, at 0.85 below 1 in
100,000, and most such pairs share a key all the same.

Documents with equal sets are one class: equal hashes of the set, and where
different texts have those, an equal digest of the shingles themselves. Candidates are verified on full
sets (100 * intersection >= ``percent`` * union), first each key's rows
against its smallest row; whole texts are dealt in runs of bounded length
with the common partner, so a partner of a third of all documents is many
tasks. Where a key's rows are still in different components, the rows such
keys link are a cluster, dealt in blocks of bounded size; a pairing of blocks
compares all pairs of different components within the signature distance
and yields links that join components only. A cluster of g documents
that do not link through their smallest rows is sent g / block times.

Defined cases: null, empty and blank texts have an empty set and link with
nothing; repeated rows and null or repeated ids are documents of their own
(a component is named by its smallest id); an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlake.llm.common import blocked, connected_components, fresh, partitions, store, whole_groups

SYMBOLS, ERRORS, CHUNKS = 48, 19, 10
RUN = 64          # comparisons with one partner that are dealt together
BLOCK = 200_000   # shingles that one side of a block comparison holds, about
U = np.uint64
_RNG = np.random.default_rng(20240101)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_BASE = U(0x9E3779B97F4A7C15)
_MUL = _RNG.integers(0, 2**63, SYMBOLS, dtype=np.uint64) * U(2) + U(1)
_ADD = _RNG.integers(0, 2**63, SYMBOLS, dtype=np.uint64)
_PART = _RNG.integers(0, 2**63, 16, dtype=np.uint64) * U(2) + U(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def word_sets(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    """``(document, hash)`` of the distinct shingles, sorted, of a few texts."""
    raw = [t.encode("utf-8", "surrogatepass").lower() if t else b"" for t in texts]
    data = np.frombuffer(b"\n".join([b"", *raw, b""]), np.uint8)
    starts_at = np.cumsum([1] + [len(r) + 1 for r in raw])
    gap = _SPACE[data]
    start = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
    end = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    # Polynomial hash of every word from running sums (arithmetic modulo 2^64).
    power = np.cumprod(np.full(len(data), _BASE))
    run = np.concatenate([[U(0)], np.cumsum(_BYTE[data] * power)])
    back = np.cumprod(np.full(len(data), U(pow(int(_BASE), -1, 1 << 64))))
    h = _mix((run[end] - run[start]) * back[start] + _PART[15] * (end - start).astype(np.uint64))
    doc = np.searchsorted(starts_at, start, "right") - 1
    many = np.bincount(doc, minlength=len(raw))
    full = np.arange(len(h) - words + 1) if len(h) >= words else np.zeros(0, np.int64)
    full = full[doc[full] == doc[full + words - 1]]
    sh = sum((h[full + k] * _PART[k] for k in range(words)), np.zeros(len(full), np.uint64))
    owner = doc[full]
    few = np.flatnonzero((many > 0) & (many < words))     # whole sequence as one shingle
    first = np.searchsorted(doc, few)
    short = np.array([sum(int(h[f + k]) * int(_PART[k]) for k in range(many[d])) * 3 + int(many[d])
                      for d, f in zip(few, first)], object)
    short = np.array([int(x) & (2**64 - 1) for x in short], np.uint64)
    owner, sh = np.concatenate([owner, few]), _mix(np.concatenate([sh, short]))
    order = np.lexsort((sh, owner))
    owner, sh = owner[order], sh[order]
    new = np.ones(len(sh), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (sh[1:] != sh[:-1])
    return owner[new], sh[new]


def summaries(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per text: set size, two hashes of the set, signature (empty sets: 0)."""
    n = len(texts)
    size, k1, k2 = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    sig = np.zeros((n, SYMBOLS), np.int32)
    owner, sh = word_sets(texts, words)
    if len(sh):
        docs, at = np.unique(owner, return_index=True)
        size[docs] = np.diff([*at, len(sh)])
        k1[docs] = np.add.reduceat(sh, at)
        k2[docs] = np.add.reduceat(_mix(sh + U(1)), at)
        for j in range(SYMBOLS):
            low = np.minimum.reduceat(sh * _MUL[j] + _ADD[j], at)
            sig[docs, j] = (_mix(low) >> U(48)).astype(np.int32)
    return size, k1.view(np.int64), k2.view(np.int64), sig


def chunk_keys(sig: np.ndarray) -> np.ndarray:
    """The keys of every signature: one per value left out of its chunk."""
    edges = [SYMBOLS * c // CHUNKS for c in range(CHUNKS + 1)]
    out = []
    v = sig.astype(np.uint64)
    for c in range(CHUNKS):
        cols = range(edges[c], edges[c + 1])
        for gone in cols:
            h = np.full(len(sig), U(gone + 1))
            for k in cols:
                if k != gone:
                    h = _mix(h * U(0x2545F4914F6CDD1D) + v[:, k])
            out.append(h)
    return np.stack(out, axis=1).view(np.int64)


def shingles(text: str, words: int) -> set:
    w = text.encode("utf-8", "surrogatepass").lower().split()
    return set(zip(*(w[k:] for k in range(words)))) if len(w) >= words else ({tuple(w)} if w else set())


def similar(x: set, y: set, percent: int) -> bool:
    both = len(x & y)
    return 100 * both >= percent * (len(x) + len(y) - both) and both > 0


def set_digest(text: str, words: int) -> bytes:
    """SHA-256 of the sorted shingles; no word holds the blanks that part them."""
    return hashlib.sha256(b"\n".join(sorted(b" ".join(s) for s in shingles(text, words)))).digest()


def _with_digests(rows: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """``rows`` (``vid, id, n, k1, k2``) with ``d``, the digest of the set where
    different texts share the set's hashes. Each such text is digested once."""
    several = rows.groupBy("k1", "k2", "n").agg(F.min(F.struct("t1", "t2")).alias("lo"), F.max(F.struct("t1", "t2")).alias("hi")) \
                  .filter("n > 0 and lo <> hi").select("k1", "k2", "n")
    one = rows.join(several, ["k1", "k2", "n"]).groupBy("t1", "t2").agg(F.min("id").alias("doc"))
    read = texts.join(one.select("doc", F.col("t1").alias("s1"), F.col("t2").alias("s2")),
                      texts["__id"].eqNullSafe(F.col("doc")) & (texts["__t1"] == F.col("s1"))
                      & (texts["__t2"] == F.col("s2"))).select("s1", "s2", "text")

    def digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"t1": f["s1"], "t2": f["s2"], "d": [set_digest(t, words) for t in f["text"]]})

    # A text that stands under one id several times gives the same row again.
    sets = read.mapInPandas(digest, "t1 long, t2 string, d binary").groupBy("t1", "t2").agg(F.first("d").alias("d"))
    return rows.join(sets, ["t1", "t2"], "left").select("vid", "id", "n", "k1", "k2", F.coalesce("d", F.lit(b"")).alias("d"))


def _verify(pairs: DataFrame, reps: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are similar."""
    deg = pairs.groupBy("a").agg(F.ceil(F.count("*") / RUN).cast("int").alias("runs"))
    runs = pairs.join(deg, "a").withColumn("run", F.pmod(F.xxhash64("b"), F.col("runs")))
    seats = runs.select("a", "run", F.col("b").alias("vid")) \
                .unionAll(runs.select("a", "run", F.col("a").alias("vid")).distinct())
    seats = seats.join(reps.select("vid", "id", "t1", "t2"), "vid")
    read = texts.join(seats, texts["__id"].eqNullSafe(seats["id"]) & (texts["__t1"] == seats["t1"])
                      & (texts["__t2"] == seats["t2"])).select("a", "run", "vid", "text")
    read = read.repartition(partitions(pairs.sparkSession), "a", "run") \
               .sortWithinPartitions("a", "run", F.col("vid") != F.col("a"))

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, mine = None, set()
        for f in frames:
            hits = []
            for a, run, vid, text in zip(f["a"], f["run"], f["vid"], f["text"]):
                if (a, run) != now or vid == a:
                    now, mine = (a, run), shingles(text, words)     # the common partner comes first
                elif similar(mine, shingles(text, words), percent):
                    hits.append((a, vid))
            yield pd.DataFrame(hits, columns=["a", "b"], dtype="int64")

    return read.mapInPandas(compare, "a long, b long")


def _compare_blocks(seats: DataFrame, texts: DataFrame, words: int, percent: int, n_parts: int) -> DataFrame:
    """Links ``(a, b)`` found between rows of different components of a cluster:
    each block pairing compares full sets of pairs within the signature
    distance, skipping those whose components it has joined already. Only links
    that join components leave the task."""
    group = ["cluster", "bi", "bj"]
    read = texts.join(seats, texts["__id"].eqNullSafe(seats["doc"]) & (texts["__t1"] == seats["s1"])
                      & (texts["__t2"] == seats["s2"])) \
                .select(*group, "own", "vid", "component", "size", "sig", "text")
    read = read.repartition(n_parts, *group).sortWithinPartitions(*group)

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in whole_groups(frames, group):
            g = g.drop_duplicates("vid")
            own, vid, size = g["own"].to_numpy(), g["vid"].to_numpy(), g["size"].to_numpy()
            comp, sig, text = g["component"].to_numpy().copy(), np.stack(g["sig"].to_numpy()), list(g["text"])
            bi, bj = g["bi"].iloc[0], g["bj"].iloc[0]
            sets: dict[int, set] = {}
            hits = []
            right = np.flatnonzero(own == bj)
            for i in np.flatnonzero(own == bi):
                js = right[right > i] if bi == bj else right
                js = js[comp[js] != comp[i]]
                js = js[np.minimum(size[js], size[i]) * 100 >= np.maximum(size[js], size[i]) * percent]
                js = js[(sig[js] != sig[i]).sum(axis=1) <= ERRORS] if len(js) else js
                for j in js:
                    if comp[i] == comp[j]:
                        continue
                    for k in (i, j):
                        if k not in sets:
                            sets[k] = shingles(text[k], words)
                    if similar(sets[i], sets[j], percent):
                        hits.append((vid[i], vid[j]))
                        comp[comp == comp[j]] = comp[i]
            if hits:
                yield pd.DataFrame(hits, columns=["a", "b"])

    return read.mapInPandas(compare, "a long, b long")


def near_documents(docs: DataFrame, words: int = 5, percent: int = 80, row: str | None = None) -> DataFrame:
    """``(vid, doc_id, n_shingles, component_id, kept, first)``, a row per
    document; ``first`` marks one row of each component. ``row``: a column of
    unique row numbers to return as ``vid``."""
    spark = docs.sparkSession
    n_parts = partitions(spark)
    t1, t2 = F.xxhash64("text"), F.concat_ws("-", F.crc32("text"), F.octet_length("text"))
    number = F.col(row) if row else F.monotonically_increasing_id()
    src = docs.select(number.alias("vid"), "doc_id", "text") \
              .select("vid", F.col("doc_id").cast("long").alias("id"), "text", t1.alias("t1"), t2.alias("t2"))

    def sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            cut = np.cumsum([len(t or "") for t in f["text"]]) // 500_000     # about half a megabyte at a time
            for _, g in f.groupby(cut):
                size, k1, k2, sig = summaries(list(g["text"]), words)
                yield pd.DataFrame({"vid": g["vid"], "id": g["id"].astype("Int64"), "t1": g["t1"].astype("Int64"),
                                    "t2": g["t2"], "n": size, "k1": k1, "k2": k2,
                                    "sig": list(sig)})

    rows = store(src.mapInPandas(sketch, "vid long, id long, t1 long, t2 string, n long, k1 long, k2 long, "
                                         "sig array<int>"), "sketches")
    texts = src.select(F.col("id").alias("__id"), F.col("t1").alias("__t1"), F.col("t2").alias("__t2"), "text")
    keyed_rows = store(_with_digests(rows.drop("sig"), texts, words), "sets")
    classes = keyed_rows.filter("n > 0").groupBy("k1", "k2", "n", "d").agg(F.min("vid").alias("rep"))
    classes = store(classes, "classes")
    reps = rows.join(classes.select(F.col("rep").alias("vid")), "vid") \
               .select("vid", "id", "t1", "t2", F.col("n").alias("size"), "sig")
    reps = store(reps, "reps")

    def keyed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for lo in range(0, len(f), 4000):
                g = f.iloc[lo:lo + 4000]
                keys = chunk_keys(np.stack(g["sig"].to_numpy()))
                own = np.repeat(np.arange(len(g)), keys.shape[1])
                yield pd.DataFrame({"key": keys.ravel(), "vid": g["vid"].to_numpy()[own],
                                    "size": g["size"].to_numpy()[own]})

    keys = reps.select("vid", "size", "sig").mapInPandas(keyed, "key long, vid long, size long")
    # Only keys that several documents share matter from here on.
    hubs = keys.groupBy("key").agg(F.min(F.struct("vid", "size")).alias("hub"), F.count("*").alias("c")) \
               .filter("c > 1").select("key", F.col("hub.vid").alias("hub"), F.col("hub.size").alias("hub_size"))
    shared = store(keys.join(hubs, "key"), "keys")
    close = F.least("size", "hub_size") * 100 >= F.greatest("size", "hub_size") * percent
    star = shared.filter((F.col("vid") != F.col("hub")) & close) \
                 .select(F.col("hub").alias("a"), F.col("vid").alias("b")).distinct()
    sigs = reps.select("vid", "sig")
    off = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x != y), lambda z: z))
    star = (star.join(sigs.select(F.col("vid").alias("a"), F.col("sig").alias("sa")), "a")
            .join(sigs.select(F.col("vid").alias("b"), F.col("sig").alias("sb")), "b")
            .filter(off <= ERRORS).select("a", "b"))
    star = store(star, "pairs")
    links = store(_verify(star, reps, texts, words, percent), "links")
    comps = store(connected_components(links), "comps")

    # Keys whose rows are still apart: their rows form clusters (rows linked by
    # such keys), within which all rows of different components are compared.
    at = shared.select("key", "vid", "hub").join(comps.withColumnRenamed("id", "vid"), "vid", "left") \
               .withColumn("component", F.coalesce("component", "vid"))
    apart = at.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")) \
              .filter("lo < hi").select("key")
    left = store(at.join(apart, "key").select("vid", "hub", "component").distinct(), "apart")
    again = None
    if not left.isEmpty():
        cluster = connected_components(left, "hub", "vid").select(F.col("id").alias("vid"), F.col("component").alias("cluster"))
        rest = left.select("vid", "component").distinct().join(cluster, "vid") \
                   .join(reps.select("vid", F.col("id").alias("doc"), F.col("t1").alias("s1"), F.col("t2").alias("s2"),
                                     "size", "sig"), "vid")
        seats = blocked(rest, ["cluster"], "vid", BLOCK, "size")
        again = store(_compare_blocks(seats, texts, words, percent, n_parts), "links")
    if again is not None and not again.isEmpty():
        joined = comps.select(F.col("id").alias("a"), F.col("component").alias("b")).unionAll(again)
        comps = store(connected_components(joined), "comps")

    per = classes.join(comps, F.col("rep") == F.col("id"), "left") \
                 .select("k1", "k2", "n", "d", F.coalesce("component", "rep").alias("component"))
    out = keyed_rows.join(per, ["k1", "k2", "n", "d"], "left") \
              .withColumn("component", F.coalesce("component", "vid"))
    name = out.groupBy("component").agg(F.min("id").alias("component_id"),
                                        F.min_by("vid", F.struct("id", "vid")).alias("first"))
    return out.join(name, "component").select(
        "vid", F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
        (F.col("vid") == F.col("first")).alias("first"))


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component (the smallest id), columns unchanged; rows
    with an empty set all stay. ``docs`` is read more than once and must give its
    rows in the same partitions each time (a stored table)."""
    mine, = fresh(docs, "row")
    x = docs.withColumn(mine, F.monotonically_increasing_id())
    stay = near_documents(x, words, percent, row=mine).filter("first").select(F.col("vid").alias(mine))
    return x.join(store(stay, "stay"), mine).drop(mine)
