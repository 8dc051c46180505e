"""Exact substring deduplication with an enhanced suffix array.

Every byte covered by a string of ``least`` bytes that also starts earlier
(smaller document id, or earlier in the same document) is removed.

Suffixes are dealt out so that any two that share ``least`` bytes meet: a
window of ``least`` bytes is keyed by its anchor, the ``ANCHOR``-byte string
in it with the smallest hash, which depends on the window's content alone.
Successive windows with one anchor form a run; a run's context is its bytes.

1. Runs of equal context are one class, whose members after the first are
   repeated as a whole. Members are folded within each block of text, then
   among about the square root of all blocks, then over all: a passage in a
   third of all documents sends one row per block, later one per group of them.
2. Of the classes that share an anchor, the first members' contexts are
   fetched, and per bucket of anchors a suffix array is built over their
   suffixes (those whose first ``least`` bytes are not unique), with its table
   of longest common prefixes. A stack scan walks the common-prefix
   interval tree; an interval whose occurrences are preceded by different
   bytes (or by the edge of a context) cannot be extended to the left and is
   a maximal repeat: all its occurrences but the first are marked.
3. Marks are merged per document.

An anchor with over ``hot`` classes, or over ``hot / 40`` in one group of
blocks, is dealt anew by the hash of each window; equal windows of one bucket
of documents are folded first. A group of blocks passes on at most ``hot / 40``
classes of an anchor and otherwise a note that it is hot, so no task gathers
the classes of a frequent one, however different the texts around it are.

Defined cases: a null text has no bytes; documents shorter than ``least``
stay as they are; null ids come after all others and repeated ids are
documents of their own, in the order of the rows read; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlake.llm.common import partitions, store, whole_groups

ANCHOR = 24
SEGMENT = 1 << 21          # bytes of text worked on at a time
U = np.uint64
_RNG = np.random.default_rng(20240202)
_BYTE = _RNG.integers(0, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_BASE = 0xD1342543DE82EF95
_POWERS: dict[str, np.ndarray] = {}
LAST = np.iinfo(np.int64).max


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U(29))) * U(0xBF58476D1CE4E5B9)
    return h ^ (h >> U(32))


class Hashes:
    """Hashes of any substrings of one byte array (polynomial, modulo 2^64)."""

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if len(_POWERS.get("up", ())) < n:
            size = max(n, SEGMENT + (1 << 18))
            _POWERS["up"] = np.cumprod(np.full(size, U(_BASE)))
            _POWERS["down"] = np.cumprod(np.full(size, U(pow(_BASE, -1, 1 << 64))))
        self.run = np.zeros(n, np.uint64)
        np.cumsum(_BYTE[data] * _POWERS["up"][:n - 1], out=self.run[1:])

    def fixed(self, width: int) -> np.ndarray:
        n = len(self.run) - width
        return _mix((self.run[width:] - self.run[:n]) * _POWERS["down"][:n])

    def spans(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return _mix((self.run[hi] - self.run[lo]) * _POWERS["down"][lo] + (hi - lo).astype(np.uint64) * U(0x9E3779B1))


def anchor_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, least: int):
    """Runs of windows with one anchor in texts ``data[starts:ends]``:
    ``(text, first start, length of the context, anchor hash, context hash)``."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < least:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    hashes = Hashes(data)
    gram = hashes.fixed(ANCHOR)
    # Smallest hash in each window, the leftmost among equals: sort key and place in one word.
    key = (gram & ~U(0xFFFFFF)) | np.arange(len(gram), dtype=np.uint64)
    width, done = least - ANCHOR + 1, 1
    while done < width:
        step = min(done, width - done)
        key = np.minimum(key[:-step], key[step:])
        done += step
    at = (key & U(0xFFFFFF)).astype(np.int64)          # one per window start
    ok = np.zeros(n + 1, np.int32)
    long = ends - starts >= least
    np.add.at(ok, starts[long], 1)
    np.add.at(ok, ends[long] - least + 1, -1)
    s = np.flatnonzero(np.cumsum(ok)[:len(at)] > 0)
    if not len(s):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    cut = np.flatnonzero((np.diff(at[s]) != 0) | (np.diff(s) != 1)) + 1
    lo, hi = s[np.r_[0, cut]], s[np.r_[cut - 1, len(s) - 1]]
    end = hi + least
    return np.searchsorted(starts, lo, "right") - 1, lo, end - lo, gram[at[lo]], hashes.spans(lo, end)


def pack(hard: list[np.ndarray], soft: list[np.ndarray], tail: bytes = b"") -> bytes:
    """Arrays of one length as bytes; only ``soft`` ones are worth compressing."""
    n = len((hard + soft)[0])
    body = b"".join(a.tobytes() for a in soft) + tail
    return np.int64(n).tobytes() + b"".join(a.tobytes() for a in hard) + zstandard.ZstdCompressor(1).compress(body)


def unpack(blob: bytes, hard: list[str], soft: list[str]) -> tuple[list[np.ndarray], bytes]:
    n, at, out = int(np.frombuffer(blob, np.int64, 1)[0]), 8, []
    for kind in hard:
        out.append(np.frombuffer(blob, kind, n, at))
        at += n * np.dtype(kind).itemsize
    body, at = zstandard.ZstdDecompressor().decompress(blob[at:]), 0
    for kind in soft:
        out.append(np.frombuffer(body, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out, body[at:]


RUN_HARD, RUN_SOFT = ["<u4", "<u8"], ["<i8", "<i8", "<i4", "<i4"]      # anchor, context; doc, vid, start, length
MARK = ["<i8", "<i4", "<i4"]                                             # vid, start, end
WANT = ["<u4", "<i8", "<i8", "<i4", "<i4", "<i4", "<i4"]                 # anchor, doc, vid, start, length, bucket, hot
PART = ["<u4", "<i8", "<i8", "<i4", "<i4"]                               # anchor, doc, vid, start, length; bytes


def merged(vid: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """The union of the ranges ``lo .. hi`` of each ``vid``."""
    if not len(vid):
        return vid, lo, hi
    o = np.lexsort((lo, vid))
    vid, lo, hi = vid[o], lo[o].astype(np.int64), hi[o].astype(np.int64)
    _, which = np.unique(vid, return_inverse=True)
    reach = np.maximum.accumulate(hi + which * (1 << 33)) - which * (1 << 33)   # largest end so far of the vid
    new = np.ones(len(vid), bool)
    new[1:] = (which[1:] != which[:-1]) | (lo[1:] > reach[:-1])
    first = np.flatnonzero(new)
    return vid[first], lo[first], reach[np.r_[first[1:] - 1, len(vid) - 1]]


def marks(vid, lo, hi, doc_buckets: int) -> list[tuple]:
    """Rows ``("S", document bucket, marks)``."""
    vid, lo, hi = merged(np.asarray(vid, np.int64), np.asarray(lo, np.int64), np.asarray(hi, np.int64))
    b = vid % doc_buckets
    return [("S", int(k), pack([], [vid[b == k].astype("<i8"), lo[b == k].astype("<i4"), hi[b == k].astype("<i4")]))
            for k in np.unique(b)]


def equal_before(data: np.ndarray, cell: np.ndarray, hashes: np.ndarray, least: int) -> np.ndarray:
    """Which of the windows ``data[cell:cell + least]``, sorted by hash, hold the
    bytes of the one before them."""
    same = np.r_[False, hashes[1:] == hashes[:-1]]
    at = np.flatnonzero(same)
    for lo in range(0, len(at), 50_000):
        i = at[lo:lo + 50_000]
        a, b = (data[cell[k][:, None] + np.arange(least)] for k in (i, i - 1))
        same[i] = (a == b).all(axis=1)
    return same


def suffix_array(parts: list[bytes], frag: np.ndarray, off: np.ndarray):
    """Order of the suffixes ``parts[frag][off:]`` and the common prefix
    length of each with the one before it (0 for the first)."""
    size = np.array([len(p) for p in parts], np.int64)
    base = np.cumsum(np.r_[0, size])
    flat = np.frombuffer(b"".join(parts) + bytes(1), np.uint8)
    length = size[frag] - off
    wide = int(length.max())
    cell = (base[frag] + off)[:, None] + np.arange(wide)
    grid = flat[np.minimum(cell, len(flat) - 1)]
    grid[np.arange(wide) >= length[:, None]] = 0
    by_length = np.argsort(length, kind="stable")     # a padded suffix before longer equals
    order = by_length[np.argsort(np.ascontiguousarray(grid[by_length]).view(f"S{wide}").ravel(), kind="stable")]
    g = grid[order]
    same = g[1:] == g[:-1]
    lcp = np.where(same.all(axis=1), wide, np.argmin(same, axis=1))
    lcp = np.minimum(lcp, np.minimum(length[order][1:], length[order][:-1]))
    return order, np.r_[0, lcp]


def intervals(lcp: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """``(depth, first, last)`` of the common-prefix interval tree's nodes of
    depth ``least`` or more, by one stack scan."""
    stack: list[tuple[int, int]] = []
    for i, d in enumerate([*lcp[1:].tolist(), 0], 1):
        left = i - 1
        while stack and stack[-1][0] > d:
            depth, left = stack.pop()
            yield depth, left, i - 1
        if d >= least and (not stack or stack[-1][0] < d):
            stack.append((d, left))


def maximal_repeats(parts: list[bytes], frag: np.ndarray, off: np.ndarray,
                    least: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(length, suffix numbers)`` of every repeat of ``least`` bytes or more
    among the given suffixes that no common byte before it extends."""
    order, lcp = suffix_array(parts, frag, off)
    before = np.array([parts[f][o - 1] if o else -1 for f, o in zip(frag, off)], np.int32)[order]
    first = np.flatnonzero(lcp < least)                # runs of suffixes joined by long prefixes
    last = np.r_[first[1:], len(order)]
    low, high = np.minimum.reduceat(before, first), np.maximum.reduceat(before, first)
    some = (last - first > 1) & ((low < 0) | (low != high))
    for a, b in zip(first[some], last[some]):
        for depth, i, j in intervals(np.r_[0, lcp[a + 1:b]], least) if b - a > 2 else ((int(lcp[a + 1]), 0, 1),):
            x = before[a + i:a + j + 1]
            if x.min() < 0 or x.min() != x.max():
                yield depth, order[a + i:a + j + 1]


def repeated_ranges(parts: list[bytes], doc, vid, start, least: int):
    """``(vid, start, end)`` of all but the first occurrence of every maximal
    repeat among contexts that stand at ``start`` of their documents."""
    size = np.array([len(p) for p in parts], np.int64)
    base = np.cumsum(np.r_[0, size])
    flat = np.frombuffer(b"".join(parts), np.uint8)
    if len(flat) < least:
        return [], [], []
    window = Hashes(flat).fixed(least)
    here = np.repeat(np.arange(len(parts)), size - least + 1)
    off = np.arange(len(here)) - np.repeat(np.cumsum(np.r_[0, size - least + 1])[:-1], size - least + 1)
    h = window[base[here] + off]
    order = np.argsort(h, kind="stable")
    hs = h[order]
    twice = np.zeros(len(hs), bool)
    twice[1:] |= hs[1:] == hs[:-1]
    twice[:-1] |= hs[1:] == hs[:-1]
    order, hs = order[twice], hs[twice]
    out_v, out_a, out_b = [], [], []
    lo = 0
    while lo < len(order):                              # suffixes of one window hash stay together
        hi = min(lo + 40_000, len(order))
        while hi < len(order) and hs[hi] == hs[hi - 1]:
            hi += 1
        pick = order[lo:hi]
        f, o = here[pick], off[pick]
        at = start[f] + o
        rank = np.empty(len(pick), np.int64)
        rank[np.lexsort((at, vid[f], doc[f]))] = np.arange(len(pick))
        for depth, who in maximal_repeats(parts, f, o, least):
            later = who[rank[who] != rank[who].min()]
            out_v.append(vid[f[later]])
            out_a.append(at[later])
            out_b.append(at[later] + depth)
        lo = hi
    join = lambda x: np.concatenate(x) if x else []
    return join(out_v), join(out_a), join(out_b)


def remove_repeats(docs: DataFrame, least: int = 100, hot: int = 20_000, segment: int = SEGMENT) -> DataFrame:
    """``(doc_id, n_bytes, kept, spans)``: ``kept`` are the bytes that stay,
    ``spans`` the removed ranges (start, end), a row per document. ``docs`` is
    read twice and must give its rows in the same partitions (a stored table)."""
    spark = docs.sparkSession
    n_parts = partitions(spark)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("vid"),
                      F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("text"))
    chars = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    doc_buckets = int(max(n_parts, chars // (2 * segment) + 1))
    buckets = 4 * n_parts
    salts = isqrt(chars // segment) + 1                 # groups of blocks
    few = max(1, hot // 40)

    def segments(f: pd.DataFrame) -> Iterator[tuple[list, list, list, list]]:
        """Pieces of bounded size; a long text's overlap by less than a window."""
        doc, vid, off, raw, size = [], [], [], [], 0
        for d, v, t in zip(f["doc_id"], f["vid"], f["text"]):
            for at in range(0, max(1, len(t) - least + 1), segment):
                piece = t[at:at + segment + least - 1]
                if raw and size + len(piece) > segment:
                    yield doc, vid, off, raw
                    doc, vid, off, raw, size = [], [], [], [], 0
                doc.append(LAST if pd.isna(d) else int(d)), vid.append(v), off.append(at), raw.append(piece)
                size += len(piece)
        if raw:
            yield doc, vid, off, raw

    def packed_runs(key: int, gram, ctx, doc, vid, lo, size) -> tuple:
        return ("A", key, pack([(gram >> U(32)).astype("<u4"), ctx.astype("<u8")],
                               [np.diff(doc, prepend=0).astype("<i8"), np.diff(vid, prepend=0).astype("<i8"),
                                lo.astype("<i4"), size.astype("<i4")]))

    def runs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        salt = TaskContext.get().partitionId()
        for f in frames:
            for doc, vid, off, raw in segments(f):
                ends = np.cumsum([len(r) for r in raw])
                starts = np.r_[0, ends[:-1]].astype(np.int64)
                t, lo, size, gram, ctx = anchor_runs(np.frombuffer(b"".join(raw), np.uint8), starts, ends, least)
                lo = lo - starts[t] + np.array(off, np.int64)[t]
                doc, vid = np.array(doc, np.int64)[t], np.array(vid, np.int64)[t]
                o = np.lexsort((lo, vid, doc, ctx, gram))      # members of a class, the first one first
                later = np.zeros(len(o), bool)
                later[1:] = (gram[o][1:] == gram[o][:-1]) & (ctx[o][1:] == ctx[o][:-1])
                x, keep = o[later], np.sort(o[~later])
                rows = marks(vid[x], lo[x], lo[x] + size[x], doc_buckets)
                b = (gram[keep] % U(buckets)).astype(np.int64)
                o = np.argsort(b, kind="stable")
                keep, b = keep[o], b[o]
                cut = np.r_[np.flatnonzero(np.diff(b, prepend=-1)), len(b)]
                salt = (salt + 1) % salts
                for a, e in zip(cut, cut[1:]):
                    k = keep[a:e]
                    rows.append(packed_runs(int(b[a]) * salts + salt, gram[k], ctx[k], doc[k], vid[k], lo[k], size[k]))
                yield pd.DataFrame(rows, columns=["kind", "key", "data"])

    def fold(last: bool):
        """Classes of runs, of one group of blocks or (``last``) of all."""

        def classes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for g in whole_groups(frames, ["kind", "key"]):
                if g["kind"].iloc[0] != "A":
                    yield g
                    continue
                bucket = int(g["key"].iloc[0]) // (1 if last else salts)
                cols = [unpack(x, RUN_HARD, RUN_SOFT)[0] for x in g["data"]]
                gram, ctx, lo, size = (np.concatenate([c[i] for c in cols]) for i in (0, 1, 4, 5))
                doc, vid = (np.concatenate([np.cumsum(c[i]) for c in cols]) for i in (2, 3))
                noted = np.unique(gram[size == 0])             # hot in some group of blocks
                o = np.flatnonzero(size > 0)
                o = o[np.lexsort((lo[o], vid[o], doc[o], ctx[o], gram[o]))]
                gram, ctx, doc, vid, lo, size = (x[o] for x in (gram, ctx, doc, vid, lo, size))
                first = np.ones(len(o), bool)
                first[1:] = (gram[1:] != gram[:-1]) | (ctx[1:] != ctx[:-1])
                rows = marks(vid[~first], lo[~first], lo[~first] + size[~first], doc_buckets)
                gram, ctx, doc, vid, lo, size = (x[first] for x in (gram, ctx, doc, vid, lo, size))
                _, back, many = np.unique(gram, return_inverse=True, return_counts=True)
                many = many[back]
                much = (many > hot) | np.isin(gram, noted) if last else many > few
                w = np.flatnonzero((many > 1) | much if last else much)
                d = vid[w] % doc_buckets
                for k in np.unique(d):
                    i = w[d == k]
                    rows.append(("W", int(k), pack([], [
                        gram[i].astype("<u4"), doc[i], vid[i], lo[i].astype("<i4"), size[i].astype("<i4"),
                        np.full(len(i), bucket, "<i4"), much[i].astype("<i4")])))
                if not last:
                    note = np.unique(gram[much])
                    none = np.zeros(len(note), np.int64)
                    gram, ctx, doc, vid, lo, size = (np.r_[x[~much], y] for x, y in zip(
                        (gram, ctx, doc, vid, lo, size), (note, none.astype(np.uint64), none, none, none, none)))
                    rows.append(packed_runs(bucket, gram.astype(np.uint64) << U(32), ctx, doc, vid, lo, size))
                yield pd.DataFrame(rows, columns=["kind", "key", "data"])

        return classes

    form = "kind string, key long, data binary"
    found = src.mapInPandas(runs, form)
    for last in (False, True):
        found = found.repartition(n_parts, "kind", "key").sortWithinPartitions("kind", "key") \
                     .mapInPandas(fold(last), form)
    found = store(found, "runs")
    # The texts are dealt out once; both uses below read the same exchange.
    text = src.withColumn("key", F.pmod("vid", F.lit(doc_buckets)))

    def fetch(texts: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        """Contexts of the wanted runs, by bucket of anchors."""
        raw = dict(zip(texts["vid"], texts["text"]))
        cols = [unpack(x, [], WANT)[0] for x in wanted["data"]]
        rows = []
        if cols:
            gram, doc, vid, lo, size, bucket, many = (np.concatenate(c) for c in zip(*cols))
            i = np.flatnonzero(many)
            if len(i):            # hot anchors: each window by its own hash
                flat = np.frombuffer(b"".join(raw[v][a:a + n] for v, a, n in zip(vid[i], lo[i], size[i])), np.uint8)
                n = size[i] - least + 1
                step = np.arange(n.sum()) - np.repeat(np.cumsum(np.r_[0, n])[:-1], n)
                cell = np.repeat(np.cumsum(np.r_[0, size[i]])[:-1], n) + step
                h, i = Hashes(flat).fixed(least)[cell], np.repeat(i, n)
                at = lo[i] + step
                o = np.lexsort((at, vid[i], doc[i], h))
                h, i, at = h[o], i[o], at[o]
                again = equal_before(flat, cell[o], h, least)
                rows += marks(vid[i[again]], at[again], at[again] + least, doc_buckets)
                h, i, at = h[~again], i[~again], at[~again]
                cold = np.flatnonzero(many == 0)
                lo = np.r_[lo[cold], at]
                size = np.r_[size[cold], np.full(len(i), least)]
                bucket = np.r_[bucket[cold], (h % U(buckets)).astype(np.int64)]
                gram = np.r_[gram[cold], (h >> U(32)).astype(np.uint32)]
                doc, vid = np.r_[doc[cold], doc[i]], np.r_[vid[cold], vid[i]]
            for k in np.unique(bucket):
                j = np.flatnonzero(bucket == k)
                body = b"".join(raw[vid[x]][lo[x]:lo[x] + size[x]] for x in j)
                rows.append(("C", int(k), pack([], [gram[j].astype("<u4"), doc[j], vid[j], lo[j].astype("<i4"),
                                                    size[j].astype("<i4")], body)))
        return pd.DataFrame(rows, columns=["kind", "key", "data"])

    def repeats(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in whole_groups(frames, ["kind", "key"]):
            if g["kind"].iloc[0] == "S":
                yield g[["key", "data"]]
                continue
            parts, cols = [], []
            for blob in g["data"]:
                c, body = unpack(blob, [], PART)
                at = np.cumsum(np.r_[0, c[4]])
                parts += [body[a:b] for a, b in zip(at, at[1:])]
                cols.append(c)
            _, doc, vid, lo, _ = (np.concatenate(c) for c in zip(*cols))
            v, a, b = repeated_ranges(parts, doc, vid, lo.astype(np.int64), least)
            if len(v):
                yield pd.DataFrame(marks(v, a, b, doc_buckets), columns=["kind", "key", "data"])[["key", "data"]]

    wanted = found.filter("kind = 'W'").select("key", "data")
    contexts = text.groupBy("key").cogroup(wanted.groupBy("key")).applyInPandas(fetch, form)
    more = contexts.repartition(n_parts, "kind", "key").sortWithinPartitions("kind", "key") \
                   .mapInPandas(repeats, "key long, data binary")
    every = found.filter("kind = 'S'").select("key", "data").unionAll(more)

    def cleaned(texts: pd.DataFrame, gone: pd.DataFrame) -> pd.DataFrame:
        cols = [unpack(x, [], MARK)[0] for x in gone["data"]]
        at: dict[int, list] = {}
        if cols:
            for v, a, b in zip(*(x.tolist() for x in merged(*(np.concatenate(c) for c in zip(*cols))))):
                at.setdefault(v, []).append((a, b))
        out = []
        for doc, vid, raw in zip(texts["doc_id"], texts["vid"], texts["text"]):
            edge, keep = 0, []
            for a, b in at.get(vid, ()):
                keep.append(raw[edge:a])
                edge = b
            out.append((doc, len(raw), b"".join([*keep, raw[edge:]]),
                        [{"start": a, "end": b} for a, b in at.get(vid, ())]))
        x = pd.DataFrame(out, columns=["doc_id", "n_bytes", "kept", "spans"])
        return x.astype({"doc_id": "Int64"})

    return text.groupBy("key").cogroup(every.groupBy("key")).applyInPandas(
        cleaned, "doc_id long, n_bytes long, kept binary, spans array<struct<start:long,end:long>>")
