"""Token alignment against plain loops over tokens and links."""

import bisect
import collections
import hashlib
import random

import duckdb
import numpy as np
import pytest

from fraudlake.llm import token_alignment as T
from fraudlake.llm.queries import QUERIES
from fraudlake.llm.tokens import vocabulary


def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    # the byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letter, more = {chr(b): b for b in plain}, 256
    for b in range(256):
        if b not in plain:
            letter[chr(more)] = b
            more += 1
    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))

    def split(text):
        if not text:
            return None
        ids = a.encode(" " + text, add_special_tokens=False).ids
        x = [(i, bytes(letter[c] for c in a.id_to_token(i))) for i in ids]
        y = [(i, bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode())
             for i in sp.encode(text) for p in [sp.id_to_piece(i)]]
        raw = (" " + text).encode()
        return (x, y) if b"".join(t for _, t in x) == raw == b"".join(t for _, t in y) else None

    return split


def brute(rows):
    split, groups, held = tokenizers(), {}, collections.Counter()
    for n, (_, text) in enumerate(rows):
        if not (xy := split(text)):
            continue
        ends = []
        for side in xy:
            at, mine = 0, []
            for _, t in side:
                at += len(t)
                mine.append(at)
            ends.append(mine)
        both = sorted(set(ends[0]) & set(ends[1]))
        parts = [([], []) for _ in both]
        for k, (side, mine) in enumerate(zip(xy, ends)):
            for (i, _), end in zip(side, mine):
                parts[bisect.bisect_left(both, end)][k].append(i)
        groups[n] = parts
        held.update({(a, b) for p in parts for a in p[0] for b in p[1]})
    top = collections.defaultdict(int)
    for (a, _), c in held.items():
        top[a] = max(top[a], c)
    out = []
    for n, (doc, _) in enumerate(rows):
        p = groups.get(n)
        if p is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(a, b) for x in p for a in x[0] for b in x[1]]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in p)
        out.append((doc, sum(len(a) for a, _ in p), sum(len(b) for _, b in p), len(p), len(links),
                    sum(held[x] == top[x[0]] for x in links), sum(held[x] for x in links),
                    hashlib.sha256(text.encode()).hexdigest()))
    return out, held


COLS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


def odd_texts():
    rng = random.Random(1)
    words = ["naïve", "Straße", "hello", "world,", "日本語", "▁", "<|endoftext|>", "<s>", "<0x41>", "ﬁ", "½", "\t", "\n\n", "  ",
             "12345", "🙂", "á", "​", "العربية", "\x00", "x" * 90]
    texts = [None, "", " ", "  two", "end ", "\n", "a"]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 30))) for _ in range(120)]
    texts += [w for w in words] + ["same text here"] * 40 + [None, ""]
    return texts


@pytest.mark.parametrize("frequent", [1 << 19, 200, 0])
def test_odd_texts(spark, frequent):
    """The same measures however many pairs are broadcast and joined."""
    rows = [*enumerate(odd_texts()), (None, "null id"), (3, "same id")]
    df = spark.createDataFrame([(i, t, "k", "p", 1) for i, t in rows], "doc_id long, text string, key string, pairs string, n long")
    out, pairs = T.align_documents(df.repartition(3), frequent=frequent)
    want, held = brute(rows)
    assert order(map(tuple, out.select(*COLS).collect())) == order(want)
    assert {(r["a"], r["b"]): r["n"] for r in pairs.collect()} == dict(held)
    assert T.align_documents(df.limit(0))[0].count() == 0


def test_wide_groups():
    """Groups of many tokens give the pairs that writing out every link gives."""
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 9, 400), rng.integers(0, 7, 300)
    for cuts in ([1000], [10, 500, 1000], [900, 950, 1000]):
        ends = [np.sort(np.concatenate([rng.choice([x for x in range(lo + 1, 999, 2) if x not in cuts], n - len(cuts), replace=False), cuts]))
                for lo, n in ((0, 400), (1, 300))]
        x = T.Alignment(a, b, *ends)
        keys, links = x.pairs(10)
        want = collections.Counter(int(a[i] * 10 + b[j]) for i in range(400) for j in range(300) if x.group_a[i] == x.group_b[j])
        assert dict(zip(keys.tolist(), links.tolist())) == dict(want) and x.links.sum() == sum(want.values())


def test_one_long_text(spark):
    rng = random.Random(3)
    text = " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(500)}" for _ in range(60_000)) + "z" * 50_000
    df = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
    got = [tuple(r) for r in T.align_documents(df)[0].select(*COLS).collect()]
    assert order(got) == order(brute([(1, text), (2, text)])[0])


def test_query_on_the_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"SELECT doc_id, text FROM read_parquet('{sf}/documents.parquet')").fetchall()
    got = QUERIES["op13_token_alignment"](spark, sf)
    assert set(got.columns) == set(COLS)
    assert order(map(tuple, got.select(*COLS).collect())) == order(brute(rows)[0])
