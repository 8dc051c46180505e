"""Mixture-controlled packing by deficit round-robin over source queues.

All documents, tokenized and each followed by an end id, stand in one queue
per source. The output stream is a row of windows of ``window`` sequences;
in every window each queue is served its quantum, the target share of the
window's tokens, plus the deficit it carries. Service stops exactly at the
quantum (documents are cut there), so what a queue carries to the next
window, and over the edges of Spark partitions, is the fraction of a token
that rounding left. Shares are counted on running totals
(``floor(prefix share * tokens so far)``), which makes the schedule a closed
form: a document's place follows from the tokens before it in its queue and
needs no state handed from task to task. Every window but the last is full
and holds the target proportions to within a token a source; the sequences
are cut from the stream, so only the very last can have padding.

Targets: by default each source's share of all tokens, so that every window
looks like the corpus. With ``targets`` (source -> weight) the named sources
are served by weight, all others share one queue of weight ``rest``; when a
queue runs dry its share goes to the others (a new phase of the schedule).

Tokens before a document: the tokenizing task numbers its own documents per
source, and a prefix sum over one row per (source, block) adds the rest; no
source is ever brought together, so one may hold most of the rows.

Defined cases: a null or empty text is the end id alone; null sources are a
queue; null or repeated ids are documents of their own; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudlake.llm.common import store

LENGTH = 2048
END_ID = 1


def tokenize(docs: DataFrame) -> DataFrame:
    """``(doc_id, queue, block, at, n, ids)``: ids as little-endian unsigned
    16-bit words, ``at`` = tokens before the document in its block's part of
    the queue."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from fraudlake.llm.tokens import encode
        block, done = TaskContext.get().partitionId(), {}
        for f in frames:
            for lo in range(0, len(f), 512):   # a small batch of ids at a time
                g = f.iloc[lo:lo + 512]
                ids, ats = [], []
                for text, q in zip(g["text"], g["queue"]):
                    a = np.array([*encode(text), END_ID], "<u2")
                    ids.append(a.tobytes())
                    ats.append(done.get(q, 0))
                    done[q] = done.get(q, 0) + len(a)
                yield pd.DataFrame({"doc_id": g["doc_id"].astype("Int64"), "queue": g["queue"], "block": block,
                                    "at": ats, "n": [len(x) // 2 for x in ids], "ids": ids})

    return docs.mapInPandas(run, "doc_id long, queue string, block int, at long, n long, ids binary")


def phases(totals: dict[str, int], targets: dict[str, float]) -> list[tuple]:
    """``(queue, from, n, below, all, start)`` rows of a weighted schedule: in
    the phase whose stream starts at ``start`` and has ``all`` tokens, the
    queue's tokens ``from .. from + n`` are served, ``below`` of the phase's
    tokens belonging to queues that sort before it."""
    weight = {q: Fraction(targets[q]).limit_denominator(10**6) for q in totals}
    if any(w <= 0 for w in weight.values()):
        raise ValueError("target weights must be positive")
    live = {q for q in totals if totals[q] > 0}
    taken, start, out = dict.fromkeys(totals, 0), 0, []
    while live:
        v = min(totals[q] / weight[q] for q in live)   # the next queue to run dry
        upto = {q: totals[q] if totals[q] / weight[q] <= v else int(weight[q] * v) for q in live}
        n = {q: upto[q] - taken[q] for q in live}
        below, size = 0, sum(n.values())
        for q in sorted(live):
            out.append((q, taken[q], n[q], below, size, start))
            below += n[q]
        start += size
        taken.update(upto)
        live = {q for q in live if taken[q] < totals[q]}
    return out


def cut(a: int, n: int, below: int, mine: int, size: int, window: int) -> Iterator[tuple[int, int, int]]:
    """``(start, length, place)`` of the runs of a queue's tokens ``a .. a+n``
    in a phase of ``size`` tokens, ``mine`` of them the queue's own."""
    before = lambda p, k: p * min(k * window, size) // size
    served = lambda k: before(below + mine, k) - before(below, k)
    last = -(-size // window)
    k = min(last - 1, max(0, a * size // (mine * window) - 1))
    while served(k) > a:
        k -= 1
    end = a + n
    while a < end:
        while served(k + 1) <= a:
            k += 1
        upto = min(end, served(k + 1))
        place = min(k * window, size) + before(below, k + 1) - before(below, k) + a - served(k)
        yield a, upto - a, place
        a = upto


def pack(docs: DataFrame, length: int = LENGTH, window: int = 64,
         targets: dict[str, float] | None = None, rest: float = 1.0) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, source, tokens`` (the piece's ids, 16-bit words)."""
    spark = docs.sparkSession
    name = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))
    if targets is not None:
        name = F.when(F.col("source").isin(list(targets)), name).otherwise("rest")
    tok = store(tokenize(docs.select("doc_id", "text", name.alias("queue"))), "tokens")
    parts = tok.groupBy("queue", "block").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("queue").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("queue", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    totals = tok.groupBy("queue").agg(F.sum("n").alias("n"))
    if targets is None:   # one row a source; every queue runs dry at the end
        up = Window.orderBy("queue").rowsBetween(Window.unboundedPreceding, -1)
        plan = totals.select("queue", F.lit(0).cast("long").alias("since"), "n",
                             F.coalesce(F.sum("n").over(up), F.lit(0)).alias("below"),
                             F.sum("n").over(Window.partitionBy()).alias("size"),
                             F.lit(0).cast("long").alias("start"))
        plan = plan.groupBy("queue").agg(F.collect_list(F.struct("since", "n", "below", "size", "start")).alias("plan"))
    else:                 # as many queues as the argument names, and one more
        have = {r["queue"]: r["n"] for r in totals.collect()}
        weights = {f"={k}": v for k, v in targets.items()} | {"rest": rest}
        rows: dict[str, list] = {}
        for q, *x in phases(have, weights):
            rows.setdefault(q, []).append(tuple(x))
        plan = spark.createDataFrame(list(rows.items()), "queue string, plan array<struct<since:long,n:long,below:long,size:long,start:long>>")
    x = tok.join(parts, ["queue", "block"]).join(plan, "queue") \
           .select("doc_id", "queue", (F.col("base") + F.col("at")).alias("at"), "n", "ids", "plan")
    width = window * length

    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for doc, queue, at, n, ids, plan in zip(f["doc_id"], f["queue"], f["at"], f["n"], f["ids"], f["plan"]):
                words = np.frombuffer(ids, "<u2")
                for ph in plan:
                    lo, hi = max(at, ph["since"]), min(at + n, ph["since"] + ph["n"])
                    if lo >= hi:
                        continue
                    for a, size, place in cut(int(lo - ph["since"]), int(hi - lo), int(ph["below"]),
                                              int(ph["n"]), int(ph["size"]), width):
                        place += int(ph["start"])
                        start = a + int(ph["since"]) - int(at)
                        while size:
                            m = min(size, length - place % length)
                            w = words[start:start + m]
                            out.append((None if pd.isna(doc) else int(doc), start, m,
                                        zlib.crc32(w.astype("<u4").tobytes()), int(n), place // length,
                                        place % length, queue[1:] if queue[0] == "=" else None, w.tobytes()))
                            start, place, size = start + m, place + m, size - m
            yield pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                             "sequence_id", "offset", "source", "tokens"]).astype({"doc_id": "Int64"})

    return x.mapInPandas(pieces, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                                 "sequence_id long, offset long, source string, tokens binary")
