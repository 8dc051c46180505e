"""Cross-tokenizer alignment of two vocabularies over a corpus.

Each text is encoded by A (byte-level BPE, with a space before the text) and B
(pieces, which add that space themselves). Byte offsets at which both end a token cut the
tokens into groups; every A token is linked with every B token of its group.
A pair of ids is as strong as the number of documents that hold it linked.

Exact-text deduplication: documents are shuffled by their full text, each
different text is encoded and aligned once, its pairs count as often as the text
stands in the corpus, and the measures are joined back to the documents by the
text's SHA-256. So a text that fills a third of the corpus is one row.

Counts: a task sums its own texts' pairs before the shuffle, so a pair costs a
row a task, not a row a text. To bring them back to the texts, pairs are parted
by their count: those above a threshold, at most ``frequent`` of them whatever the
corpus (found from a histogram of the counts), are broadcast and looked up where the
texts lie; all others are shuffled and joined, and none of them is
frequent enough to be a hot key.

A group of many tokens on both sides links every one with every other; its links
are counted from the different ids of each side, not written out one by one.

Defined cases: null and empty texts, and texts whose tokens do not spell the
space and the text byte for byte under both, have no tokens: zeros and an empty
digest; special-token strings are plain text; texts of any length are encoded whole;
null and repeated ids are documents of their own; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlake.llm.common import store
from fraudlake.llm.tokens import ranks_encoder, vocabulary

#: The word mark of pieces and what it stands for.
MARK, SPACE = "▁", " "
#: Groups with more links than this are counted by their different ids.
WIDE = 4096


@lru_cache(maxsize=2)
def byte_tokens(path: str) -> list[bytes]:
    enc = ranks_encoder(path)
    return [enc.decode_single_token_bytes(i) for i in range(enc.n_vocab)]


@lru_cache(maxsize=2)
def pieces(path: str):
    """The processor and the bytes of each of its pieces."""
    import sentencepiece
    p = sentencepiece.SentencePieceProcessor(model_file=path)
    n = p.get_piece_size()
    return p, [bytes([int(s[3:-1], 16)]) if p.is_byte(i) else s.replace(MARK, SPACE).encode()
               for i, s in enumerate(p.id_to_piece(i) for i in range(n))]


@lru_cache(maxsize=4)
def shapes(kind: str, path: str) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Bytes, lengths and decimal names of a vocabulary's ids."""
    tokens = byte_tokens(path) if kind == "bytes" else pieces(path)[1]
    return tokens, np.array([len(t) for t in tokens], np.int64), np.array([str(i) for i in range(len(tokens))], object)


class Alignment:
    """Groups of two id lists that spell the same bytes."""

    def __init__(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray):
        self.a, self.b = a, b
        cut_a, cut_b = np.isin(ends_a, ends_b, assume_unique=True), np.isin(ends_b, ends_a, assume_unique=True)
        self.group_a, self.group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        self.count_a = np.diff(np.flatnonzero(cut_a), prepend=-1)
        self.count_b = np.diff(np.flatnonzero(cut_b), prepend=-1)
        self.links = self.count_a * self.count_b

    def text(self, names_a: np.ndarray, names_b: np.ndarray) -> str:
        """``a1,a2|b1;a3|b2,b3``"""
        order = np.argsort(np.concatenate([self.group_a * 2, self.group_b * 2 + 1]), kind="stable")
        out = np.full(2 * len(order), ",", object)
        out[0::2] = np.concatenate([names_a[self.a], names_b[self.b]])[order]
        ends = np.cumsum(np.stack([self.count_a, self.count_b], axis=1).ravel()) - 1
        out[2 * ends[0::2] + 1], out[2 * ends[1::2] + 1] = "|", ";"
        return "".join(out.tolist()[:-1])

    def pairs(self, base: int) -> tuple[np.ndarray, np.ndarray]:
        """Different pairs (``a * base + b``), ascending, and their links."""
        wide = self.links > WIDE
        each = np.where(wide, 0, self.count_b)[self.group_a]
        first_b = np.cumsum(self.count_b) - self.count_b
        run = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        keys = [np.repeat(self.a, each) * base + self.b[np.repeat(first_b[self.group_a], each) + run]]
        links = [np.ones(len(keys[0]), np.int64)]
        for g in np.flatnonzero(wide):
            ua, na = np.unique(self.a[self.group_a == g], return_counts=True)
            ub, nb = np.unique(self.b[self.group_b == g], return_counts=True)
            keys.append((ua[:, None] * base + ub).ravel())
            links.append((na[:, None] * nb).ravel())
        return summed(np.concatenate(keys), np.concatenate(links))


def summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    if not len(keys):
        return keys, weights
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(weights, first)


def align_texts(texts: list[str], path_a: str, path_b: str) -> Iterator[Alignment | None]:
    """The alignment of each text; None where it has no tokens."""
    tokens_a, long_a, _ = shapes("bytes", path_a)
    tokens_b, long_b, _ = shapes("pieces", path_b)
    encode = ranks_encoder(path_a).encode_ordinary
    for text, b in zip(texts, pieces(path_b)[0].encode(texts, num_threads=1)):
        want = (SPACE + text).encode()
        a = encode(SPACE + text)
        if b"".join([tokens_a[i] for i in a]) != want or b"".join([tokens_b[i] for i in b]) != want:
            yield None
            continue
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        yield Alignment(a, b, np.cumsum(long_a[a]), np.cumsum(long_b[b]))


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row per different text: ``key`` (SHA-256), ``copies``, ``n_a, n_b, n_groups,
    n_links, groups`` (digest), ``pairs`` and ``links`` (64-bit words)."""
    texts = docs.filter(F.col("text") != "").groupBy("text").agg(F.count("*").alias("copies"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names_a, names_b = shapes("bytes", path_a)[2], shapes("pieces", path_b)[2]
        for f in frames:
            for lo in range(0, len(f), 256):
                g = f.iloc[lo:lo + 256]
                out = []
                for x in align_texts(list(g["text"]), path_a, path_b):
                    if x is None:
                        out.append((0, 0, 0, 0, "", b"", b""))
                        continue
                    pairs, links = x.pairs(len(names_b))
                    out.append((len(x.a), len(x.b), len(x.links), int(x.links.sum()),
                                hashlib.sha256(x.text(names_a, names_b).encode()).hexdigest(),
                                pairs.astype("<i8").tobytes(), links.astype("<i8").tobytes()))
                yield pd.DataFrame(out, columns=["n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "links"]) \
                    .assign(key=g["key"].to_numpy(), copies=g["copies"].to_numpy())

    return texts.withColumn("key", F.sha2("text", 256)).mapInPandas(
        run, "key string, copies long, n_a long, n_b long, n_groups long, n_links long, groups string, "
             "pairs binary, links binary")


def pair_counts(aligned: DataFrame, base: int, hold: int = 2_000_000) -> DataFrame:
    """``(pair, n, best)``: documents that hold the pair linked; whether no
    other pair of its A id is in more. A task holds about ``hold`` pairs."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, counts, size = [], [], 0
        for f in frames:
            for pairs, copies in zip(f["pairs"], f["copies"]):
                keys.append(np.frombuffer(pairs, "<i8"))
                counts.append(np.full(len(keys[-1]), copies, np.int64))
                size += len(keys[-1])
                if size > 2 * hold:
                    k, c = summed(np.concatenate(keys), np.concatenate(counts))
                    keys, counts, size = [k], [c], len(k)
                    if size > hold:
                        yield pd.DataFrame({"pair": k, "n": c})
                        keys, counts, size = [], [], 0
        if size:
            k, c = summed(np.concatenate(keys), np.concatenate(counts))
            yield pd.DataFrame({"pair": k, "n": c})

    n = aligned.select("pairs", "copies").mapInPandas(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    n = store(n.withColumn("a", F.expr(f"pair div {base}")), "pairs")
    top = n.groupBy("a").agg(F.max("n").alias("top"))     # an A id a row: as many as the vocabulary has
    return n.join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def threshold(counts: DataFrame, frequent: int) -> tuple[int, bool]:
    """The least count with at most ``frequent`` pairs at or above it, in steps of an
    eighth of a power of two, and whether pairs below it exist."""
    step = F.floor(F.log2("n") * 8).cast("int")
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("c"), F.min("n").alias("low")).orderBy(F.desc("step")).collect()
    total, least = 0, 2**62
    for r in sizes:
        total += r["c"]
        if total > frequent:
            return least, True
        least = r["low"]
    return least, False


def measures(aligned: DataFrame, counts: DataFrame, frequent: int = 1 << 19) -> DataFrame:
    """``(key, n_best, count_sum)`` of each text, over its links."""
    spark = aligned.sparkSession
    least, more = threshold(counts, frequent)
    top = counts.filter(F.col("n") >= least).toPandas().sort_values("pair")
    known = spark.sparkContext.broadcast((top["pair"].to_numpy(np.int64), top["n"].to_numpy(np.int64), top["best"].to_numpy(bool)))

    def looked_up(f: pd.DataFrame) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        pair = known.value[0]
        for key, pairs, links in zip(f["key"], f["pairs"], f["links"]):
            pairs, links = np.frombuffer(pairs, "<i8"), np.frombuffer(links, "<i8")
            at = np.minimum(np.searchsorted(pair, pairs), max(0, len(pair) - 1))
            hit = pair[at] == pairs if len(pair) else np.zeros(len(pairs), bool)
            yield key, pairs, links, at, hit

    def common(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _, n, best = known.value
        for f in frames:
            out = [(key, int(links[hit][best[at[hit]]].sum()), int((links[hit] * n[at[hit]]).sum()))
                   for key, _, links, at, hit in looked_up(f)]
            yield pd.DataFrame(out, columns=["key", "n_best", "count_sum"])

    def other(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for key, pairs, links, _, hit in looked_up(f):
                yield pd.DataFrame({"key": key, "pair": pairs[~hit], "links": links[~hit]})

    words = aligned.select("key", "pairs", "links")
    out = words.mapInPandas(common, "key string, n_best long, count_sum long")
    if not more:
        return out
    rare = words.mapInPandas(other, "key string, pair long, links long").join(counts.filter(F.col("n") < least), "pair")
    rare = rare.select("key", F.when(F.col("best"), F.col("links")).otherwise(F.lit(0)).alias("n_best"),
                       (F.col("links") * F.col("n")).alias("count_sum"))
    return out.unionAll(rare).groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align_documents(docs: DataFrame, path_a: str | None = None, path_b: str | None = None,
                    frequent: int = 1 << 19) -> tuple[DataFrame, DataFrame]:
    """``(documents, pairs)``: ``doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256`` of every document, and ``(a, b, n, best)`` of
    every pair of ids. ``path_a``: a rank file; ``path_b``: a piece model."""
    path_a, path_b = path_a or vocabulary("byte_bpe_50k.tiktoken"), path_b or vocabulary("piece_bpe_32k.model")
    base = len(shapes("pieces", path_b)[0])
    aligned = store(align(docs.select("text"), path_a, path_b), "aligned")
    counts = store(pair_counts(aligned, base), "counts")
    per = aligned.drop("pairs", "links", "copies").join(measures(aligned, counts, frequent), "key")
    ids = docs.select("doc_id", F.sha2("text", 256).alias("key"))
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    out = ids.join(per, "key", "left").select("doc_id", *zero, F.coalesce("groups", F.lit("")).alias("groups_sha256"))
    return out, counts.select(F.expr(f"pair div {base}").alias("a"), (F.col("pair") % base).alias("b"), "n", "best")
