"""Benchmark decontamination by pigeonhole edit matching.

An item of ``m`` characters may differ by ``e = m // per_edit`` edits. It is
split into ``e + 1`` pieces: if a document holds the item with at most ``e``
edits, some piece stands in it unchanged. Documents are scanned once for all
pieces (Aho-Corasick), each hit gives a place where the item may stand, and
Myers' bit-parallel distance verifies the place. Whole texts and whole items
are compared, lower-cased, with runs of white space as one space.

Different items are found in Spark first; only those go to every task, at most
``chunk_chars`` characters of them at a time (an item longer than that goes alone).
A larger benchmark is scanned in as many chunks as it needs. The ids that share
an item are joined to its hits.

Defined cases: null or blank texts and items match nothing; an item shorter
than ``per_edit`` must stand exactly and not inside a word; when documents are
dropped, such an item drops only those that hold nothing else, since a word or two stand
in clean texts as well; repeated items are reported under each id; repeated rows
are reported each; an empty table gives an empty result; very long texts and items
are compared whole; other columns pass through or are ignored, whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlake.llm.common import fresh, store


def plain(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def split(item: str, per_edit: int) -> list[tuple[int, str]]:
    """``(offset, piece)`` of the error budget plus one pieces of an item."""
    parts = len(item) // per_edit + 1
    ends = [len(item) * i // parts for i in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(ends, ends[1:]) if a < b]


def myers(item: str, text: str) -> int:
    """Least edit distance of ``item`` to any substring of ``text``
    (Myers 1999, with Python's wide integers as the bit vector)."""
    m = len(item)
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, dist, best = full, 0, m, m
    for c in text:
        eq = masks.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            dist += 1
        if mh & top:
            dist -= 1
            if dist < best:
                best = dist
        ph = (ph << 1) & full      # a match may start anywhere
        mh = (mh << 1) & full
        pv = mh | (full & ~(xv | ph))
        mv = ph & xv
    return best


def apart(text: str, start: int, end: int) -> bool:
    """Whether ``text[start:end]`` neither begins nor ends inside a word."""
    inside = lambda i: 0 < i < len(text) and text[i - 1].isalnum() and text[i].isalnum()
    return not inside(start) and not inside(end)


class Matcher:
    """Finds the items of one chunk in texts."""

    def __init__(self, items: list[tuple[int, str]], per_edit: int, alone_below: int = 0):
        import ahocorasick
        self.items, self.per_edit, self.alone_below = items, per_edit, alone_below
        places: dict[str, list[tuple[int, int]]] = {}
        for n, (_, item) in enumerate(items):
            for at, piece in split(item, per_edit):
                places.setdefault(piece, []).append((n, at))
        self.auto = ahocorasick.Automaton()
        for piece, where in places.items():
            self.auto.add_word(piece, (len(piece), where))
        if places:
            self.auto.make_automaton()
        self.empty = not places
        self.distance = lru_cache(maxsize=4096)(lambda n, window: myers(items[n][1], window))

    def find(self, text: str) -> dict[int, int]:
        """``item number -> least distance found``, within the budgets."""
        if self.empty or not text:
            return {}
        starts: dict[int, set[int]] = {}
        for end, (size, where) in self.auto.iter(text):
            for n, at in where:
                starts.setdefault(n, set()).add(end + 1 - size - at)
        found = {}
        for n, at in starts.items():
            item = self.items[n][1]
            e = len(item) // self.per_edit
            if e == 0 or len(item) < self.alone_below:
                if text == item or len(item) >= self.alone_below and any(apart(text, s, s + len(item)) for s in at):
                    found[n] = 0
                continue
            if any(s >= 0 and text.startswith(item, s) for s in at):
                found[n] = 0
                continue
            runs: list[list[int]] = []
            for s in sorted(at):        # places whose windows overlap are looked at together
                if runs and s - runs[-1][1] <= 2 * e:
                    runs[-1][1] = s
                else:
                    runs.append([s, s])
            best = min(self.distance(n, text[max(0, a - e):b + len(item) + 2 * e]) for a, b in runs)
            if best <= e:
                found[n] = best
        return found


_MATCHER: dict = {}


def _different_items(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(number, item, chars)`` of the different items and ``(item_id, number)``."""
    def normal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f = f.assign(item=[plain(t) for t in f["text"]])
            yield f.loc[f["item"] != "", ["item_id", "item"]].astype({"item_id": "Int64"})

    every = store(benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
                  .mapInPandas(normal, "item_id long, item string").distinct(), "items")
    items = store(every.select("item").distinct().select(F.monotonically_increasing_id().alias("number"), "item",
                                                         F.length("item").cast("long").alias("chars")), "items")
    return items, every.join(items, "item").select("item_id", "number")


def _chunks(items: DataFrame, most: int) -> list[DataFrame]:
    """The items in groups of at most ``most`` characters or one item."""
    parts = (items.agg(F.sum("chars")).first()[0] or 0) // most * 4 + 1
    while True:
        part = F.pmod(F.xxhash64("item"), F.lit(parts))
        sums = {r["part"]: r for r in items.groupBy(part.alias("part")).agg(
            F.sum("chars").alias("n"), F.count("*").alias("c")).collect()}     # four rows a chunk, or a few times that
        if all(r["n"] <= most or r["c"] == 1 for r in sums.values()):
            break
        parts *= 2
    ranges: list[list[int]] = []
    room = -1
    for k in sorted(sums):
        if sums[k]["n"] > room:
            ranges.append([k, k])
            room = most
        ranges[-1][1] = k
        room -= sums[k]["n"]
    return [items.filter(part.between(lo, hi)) for lo, hi in ranges]


def contaminated(docs: DataFrame, benchmark: DataFrame, per_edit: int = 20, chunk_chars: int = 16_000_000,
                 key: str = "doc_id", alone_below: int = 0) -> DataFrame:
    """``(doc_id, item_id, distance)``: items that stand in a document with at
    most one edit per ``per_edit`` characters. ``key``: the documents' id column.
    ``alone_below``: shorter items must be a document's whole text."""
    spark = docs.sparkSession
    items, ids = _different_items(benchmark)
    run = uuid.uuid4().hex
    out = spark.createDataFrame([], "doc_id long, number long, distance int")
    for c, chunk in enumerate(_chunks(items, chunk_chars)):
        sent = spark.sparkContext.broadcast([(r["number"], r["item"]) for r in chunk.collect()])   # chunk_chars at most

        def scan(frames: Iterator[pd.DataFrame], sent=sent, number=c) -> Iterator[pd.DataFrame]:
            mine = (run, number)
            if mine not in _MATCHER:
                _MATCHER.clear()
                _MATCHER[mine] = Matcher(sent.value, per_edit, alone_below)
            m = _MATCHER[mine]
            for f in frames:
                got = []
                for doc, text in zip(f["doc_id"], f["text"]):
                    got += [(doc, m.items[n][0], d) for n, d in m.find(plain(text)).items()]
                yield pd.DataFrame(got, columns=["doc_id", "number", "distance"]) \
                    .astype({"doc_id": "Int64", "number": "Int64"})

        one = docs.select(F.col(key).alias("doc_id"), "text").mapInPandas(scan, "doc_id long, number long, distance int")
        out = one if c == 0 else out.unionAll(one)
    return out.join(ids, "number").select("doc_id", "item_id", "distance")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, per_edit: int = 20) -> DataFrame:
    """The rows of ``docs`` that hold no item, columns unchanged. ``docs`` is
    read twice and must give its rows in the same partitions (a stored table)."""
    row, = fresh(docs, "row")
    x = docs.withColumn(row, F.monotonically_increasing_id())
    bad = contaminated(x, benchmark, per_edit, key=row, alone_below=per_edit).select(F.col("doc_id").alias(row))
    return x.join(store(bad.distinct(), "contaminated"), row, "left_anti").drop(row)
