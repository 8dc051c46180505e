"""Corpus operators on small hand-made tables, each against brute force."""

import collections
import hashlib
import random
import re
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fraudlake.llm import decontam, packing, suffix_dedup, toxicity
from fraudlake.llm.common import connected_components
from fraudlake.llm.embed_dedup import near_vectors, table_plan
from fraudlake.llm.line_templates import drop_boilerplate, drop_templates
from fraudlake.llm.minhash_dedup import drop_near_duplicates, near_documents, shingles, similar
from fraudlake.llm.sharding import copy_links, label_propagation, shard_documents
from fraudlake.llm.suffix_dedup import remove_repeats
from fraudlake.llm.token_rollup import TokenRollup, count_tokens
from fraudlake.llm.tokens import SPECIAL, encode, full_tokenizer, vocabulary
from fraudlake.llm.url_filter import Tree, judge

DOCS = "doc_id long, text string, lang string, source string, key string, n long"


def docs(spark, texts, sources=None):
    """Rows with extra columns whose names the operators use inside."""
    rows = [(i, t, "en", (sources or {}).get(i, f"s{i % 3}"), f"k{i}", i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def prose(rng, n, words=400):
    return " ".join(f"{rng.choice('abcdefgh')}{rng.choice('mnop')}{rng.randrange(words)}" for _ in range(n))


def as_dict(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}


# --- graph components -------------------------------------------------------------

def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    edges += [(5, 5), (None, 3), edges[0]]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 1 suffix array ------------------------------------------------------------------

def brute_repeats(texts, least):
    seen, out = set(), {}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - least + 1):
            w = raw[s:s + least]
            if w in seen:
                gone[s:s + least] = b"\1" * least
            seen.add(w)
        runs = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out[i] = (len(raw), bytes(b for b, g in zip(raw, gone) if not g), runs)
    return out


def repeat_texts():
    rng = random.Random(3)
    a, b = prose(rng, 60), prose(rng, 60)
    line = "This very line of a little more than one hundred bytes stands in many of the documents, ähnlich überall."
    texts = [a, None, "", "short", a, a[:150] + "X" + a[151:], b[30:180] + a[20:140], "z" * 700, "z" * 350]
    texts += [prose(rng, 5) + line + prose(rng, 5) for _ in range(40)]
    texts += [a[7:] + b + a[:200], "\0" * 120 + "q", "\0" * 130, b + line + line]
    return texts


@pytest.mark.parametrize("hot", [20_000, 3])
def test_suffix_repeats(spark, hot):
    texts = repeat_texts()
    got = as_dict(remove_repeats(docs(spark, texts).repartition(3), 100, hot=hot))
    for i, (size, kept, runs) in brute_repeats(texts, 100).items():
        r = got[i]
        assert (r["n_bytes"], bytes(r["kept"]), len(r["spans"])) == (size, kept, runs), i
    assert remove_repeats(docs(spark, []), 100).count() == 0


@pytest.mark.parametrize("hot", [20_000, 80, 1])
def test_hot_anchor_in_many_blocks(spark, hot):
    """A passage with other words around it in every text, over many small blocks."""
    rng = random.Random(9)
    a = prose(rng, 25)
    texts = [prose(rng, rng.randrange(30)) + a + prose(rng, rng.randrange(30)) for _ in range(120)]
    texts += [prose(rng, 40) for _ in range(20)] + [texts[3], a[:110], a + a]
    got = as_dict(remove_repeats(docs(spark, texts).repartition(5), 100, hot=hot, segment=2000))
    for i, (size, kept, runs) in brute_repeats(texts, 100).items():
        r = got[i]
        assert (r["n_bytes"], bytes(r["kept"]), len(r["spans"])) == (size, kept, runs), i


def test_long_texts_cross_segments(spark):
    rng = random.Random(5)
    a = prose(rng, 300)
    texts = [a, prose(rng, 40) + a[100:1500], a[300:420]]
    got = as_dict(remove_repeats(docs(spark, texts), 100, segment=300))
    assert {i: (r["n_bytes"], bytes(r["kept"]), len(r["spans"])) for i, r in got.items()} == brute_repeats(texts, 100)


def test_maximal_repeats_have_all_occurrences():
    parts = [b"..abcdefXbcdef", b"zabcdefg", b"qbcdeh"]
    frag, off = zip(*[(f, o) for f, p in enumerate(parts) for o in range(len(p) - 2)])
    groups = {}
    for depth, who in suffix_dedup.maximal_repeats(parts, np.array(frag), np.array(off), 3):
        groups[parts[frag[who[0]]][off[who[0]]:off[who[0]] + depth]] = sorted((frag[w], off[w]) for w in who)
    assert groups == {b"abcdef": [(0, 2), (1, 1)], b"bcdef": [(0, 3), (0, 9), (1, 2)],
                      b"bcde": [(0, 3), (0, 9), (1, 2), (2, 1)]}


# --- 2 urls --------------------------------------------------------------------------

def test_urls(spark):
    rows = [(1, "http://WWW.Example.com/en/1?x#y"), (2, "https://example.com/en/"), (3, "https://a.net/es/z"),
            (4, None), (5, "no scheme/x"), (6, "ftp://h?q"), (7, "http://xnet/es/"), (8, "x://a.NET/fr"),
            (8, "x://a.NET/fr/#"), (None, "http://b.org/p/1/2/3/4/5/6/7/8"), (9, "http://a.com://b/c")]
    rows += [(100 + i, f"http://s.org/bad/{i}.html") for i in range(60)]
    rows += [(200 + i, f"http://s.org/good/{i}.html") for i in range(60)]
    pages = spark.createDataFrame([(*r, "h") for r in rows], "page_id long, url string, host string")
    labels = spark.createDataFrame([(100 + i, True) for i in range(50)] + [(200 + i, False) for i in range(50)]
                                   + [(100, False), (None, True), (201, None)], "page_id long, bad boolean")
    rules = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
             ("net/es/", "block"), ("net/fr/", "block")]
    got = collections.defaultdict(list)
    for r in judge(pages, labels, rules).collect():
        got[r["page_id"]].append((r["host"], r["path"], r["rule"], r["verdict"], r["template"]))
    assert got[1][0][:4] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert got[2][0][:4] == ("example.com", "/en/", "example.com/en/", "block")
    assert got[3][0][:4] == ("a.net", "/es/z", "net/es/", "block")
    assert got[4][0][:2] == got[5][0][:2] == ("", "")
    assert got[6][0][:3] == ("h", "", None) and got[7][0][2] is None
    assert sorted(x[2] or "" for x in got[8]) == ["", "net/fr/"]
    assert got[9][0][:2] == ("a.com:", "//b/c") and got[None][0][0] == "b.org"
    assert got[150][0][3:] == ("block", "/bad/*") and got[250][0][3:] == ("allow", "/good/*")
    assert judge(pages.limit(0), labels, rules).count() == 0
    assert {r["verdict"] for r in judge(pages, labels.limit(0), []).collect()} == {"allow"}


def test_a_bad_section_is_found_on_hosts_of_any_size(spark):
    rows = [(h, f"http://{h}.org/bad/{i}.html") for h in "ab" for i in range(38)]
    rows += [(h, f"http://{h}.org/{'pqrstuvw'[i % 8]}/{i}.html") for h, n in (("a", 2000), ("b", 200)) for i in range(n)]
    pages = spark.createDataFrame([(i, u) for i, (_, u) in enumerate(rows)], "page_id long, url string")
    labels = spark.createDataFrame([(i, "/bad/" in u) for i, (_, u) in enumerate(rows)], "page_id long, bad boolean")
    got = judge(pages, labels, []).groupBy("host", F.col("path").contains("/bad/").alias("bad"), "verdict").count().collect()
    assert sorted((r["host"], r["bad"], r["verdict"]) for r in got) == [
        (h, bad, "block" if bad else "allow") for h in ("a.org", "b.org") for bad in (False, True)]


# --- 3 toxicity ----------------------------------------------------------------------

def test_toxicity(spark):
    rng = random.Random(7)
    bad = ["idiot", "moron", "scum", "clown"]
    texts = []
    for i in range(400):
        w = prose(rng, 80).split()
        for _ in range(i % 4 + 1 if i % 5 == 0 else 0):
            w[rng.randrange(80)] = rng.choice(bad) + rng.choice(["", ",", "!"])
        texts.append(" ".join(w))
    texts += [None, "", prose(rng, 50_000)]
    d = docs(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(0, 300)] + [(1, None), (None, 1), (9999, 1), (5, 0)],
                                   "doc_id long, toxic int")
    model = toxicity.train(d, labels)
    assert list(model.thetas) == sorted(model.thetas) and all(model.weights.get(w, 0) > 0 for w in bad)
    x = toxicity.score(d.withColumn("p_toxic", F.lit("mine")), model)
    got = {r["doc_id"]: r["toxicity"] for r in x.collect()}
    assert len(got) == len(texts) and x.columns[:-1] == [*d.columns, "p_toxic"]
    held_out = [(got[i]["rejected"], i % 5 == 0) for i in range(300, 400)]
    assert sum(a == b for a, b in held_out) >= 98
    assert not any(got[i]["rejected"] for i in (400, 401, 402))
    many, one = texts[395], texts[380]                 # four uses and one
    assert model.score(many)[1] > model.score(one)[1] and 0 <= model.score(many)[1] <= 3
    none = toxicity.train(d, labels.limit(0))
    assert {r["toxicity"]["severity"] for r in toxicity.score(d, none).collect()} == {0.0}
    assert toxicity.score(d.limit(0), model).count() == 0


def test_toxicity_is_not_hidden_by_clean_text(spark):
    rng = random.Random(17)
    bad = ["idiot", "moron", "scum"]
    texts = [" ".join(rng.choice(bad) if i % 4 == 0 and rng.random() < 0.08 else w for w in prose(rng, 90).split())
             + (" scum idiot" if i % 4 == 0 else "") for i in range(500)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)], "doc_id long, toxic int")
    model = toxicity.train(docs(spark, texts), labels)
    clean = " ".join(texts[i] for i in range(300, 320) if i % 4)
    held = [t for i, t in enumerate(texts) if i >= 300 and i % 4 == 0]
    for t in held:
        assert model.score(t + " " + clean)[0] >= model.score(t)[0]
    assert sum(model.score(t + " " + clean)[0] >= 0.5 for t in held) >= 0.9 * len(held)
    assert model.score(clean)[0] < 0.5
    for t in (None, "", "1 2 3", "qqq zzz"):
        assert np.allclose(model.score(t), (0.25, sum(model.base))) and model.base[0] == 0.25


def test_toxicity_fit_is_bounded_in_bytes(spark):
    """Rows are taken in hash order up to the bound; a text over a sixteenth of it is not read."""
    rng = random.Random(3)
    texts = [prose(rng, 40) + (" scum" * 3 if i % 3 == 0 else "") for i in range(200)] + ["scum " * 100_000]
    d = docs(spark, texts).withColumn("said", F.lit(1)).withColumn("size", F.lit("x"))
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(201)], "doc_id long, toxic int")
    model = toxicity.train(d, labels, sample_bytes=20_000)
    assert 0 < len(model.thetas) and 0.2 < model.base[0] < 0.5
    x = toxicity.score(d, model)
    assert x.columns == [*d.columns, "toxicity"] and x.filter("toxicity.rejected").count() >= 1


def test_toxicity_of_word_forms_and_separable_labels():
    """Stems whose forms hardly repeat are learnt; labels that the features part
    completely, or of grades that no row has, leave finite weights in order."""
    rng = random.Random(11)
    form = lambda stem: stem + "".join(rng.choice("aeiou") + rng.choice("nrst") for _ in range(3))
    words, toxic = [], []
    for i in range(1200):
        w = [form(rng.choice(["mor", "tel", "gan", "sip", "bod"])) for _ in range(60)]
        if i % 6 == 0:
            w[:4] = [form("vequt") for _ in range(4)]
        words.append(collections.Counter(w)), toxic.append(i % 6 == 0)
    model = toxicity.fit(words[:600], np.array(toxic[:600]))
    assert np.isfinite([*model.thetas, *model.weights.values()]).all() and list(model.thetas) == sorted(model.thetas)
    said = [model.score(" ".join(c.elements()))[0] >= 0.5 for c in words[600:]]
    assert sum(a == b for a, b in zip(said, toxic[600:])) >= 594


def test_toxicity_of_a_frequent_copy():
    """One toxic text that makes up a third of the rows is learnt."""
    rng = random.Random(12)
    bad = "".join(rng.choice("aeioulmn") for _ in range(40))
    copy = " ".join(bad[i:i + 7] for i in range(0, 35, 7))
    clean = [" ".join("".join(rng.choice("bcdfghjkp") for _ in range(4)) for _ in range(30)) for _ in range(400)]
    texts, toxic = clean + [copy] * 200, [False] * 400 + [True] * 200
    model = toxicity.fit([collections.Counter(t.split()) for t in texts], np.array(toxic))
    assert model.score(copy)[0] >= 0.5 and sum(model.score(t)[0] >= 0.5 for t in clean) <= 4


# --- 4 packing -----------------------------------------------------------------------

def check_pieces(rows, texts, length):
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    assert set(by_doc) == set(range(len(texts)))
    for i, t in enumerate(texts):
        ids = [*encode(t), 1]
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            part = ids[r["start"]:r["start"] + r["length"]]
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            assert list(np.frombuffer(r["tokens"], "<u2")) == part
            at += r["length"]
        assert at == len(ids)
    sizes = []
    for s in sorted(by_seq):
        at = 0
        for r in sorted(by_seq[s], key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        sizes.append(at)
    assert sorted(by_seq) == list(range(len(sizes)))
    assert all(n == length for n in sizes[:-1]) and 0 < sizes[-1] <= length
    return by_seq


def test_packing_follows_the_mixture(spark):
    rng = random.Random(9)
    texts = [prose(rng, rng.randrange(1, 120)) for _ in range(150)] + [None, "", prose(rng, 4000), f"a {SPECIAL} b"]
    sources = {i: "big" if i % 2 else ("small" if i % 4 else None) for i in range(len(texts))}
    d = docs(spark, texts, sources).repartition(5, "doc_id")
    rows = packing.pack(d, length=64, window=8).collect()
    by_seq = check_pieces(rows, texts, 64)
    total = collections.Counter()
    for r in rows:
        total[r["source"]] += r["length"]
    n = sum(total.values())
    for w in range(n // 512):                           # every full window holds the corpus' proportions
        have = collections.Counter()
        for s in range(8 * w, 8 * w + 8):
            for r in by_seq[s]:
                have[r["source"]] += r["length"]
        assert all(abs(have[q] - 512 * total[q] / n) < 2 for q in total), w
    rows = packing.pack(d, length=64, window=8, targets={"big": 3.0}, rest=1.0).collect()
    by_seq = check_pieces(rows, texts, 64)
    have = sum(r["length"] for s in range(8) for r in by_seq[s] if r["source"] == "big")
    assert abs(have - 512 * 3 / 4) < 2
    assert packing.pack(docs(spark, [])).count() == 0


def test_phases_serve_every_token_once():
    totals = {"a": 1000, "b": 10, "c": 333, "d": 0}
    weights = {"a": 1, "b": 5, "c": 2.5, "d": 1}
    rows = packing.phases(totals, weights)
    served = collections.defaultdict(list)
    stream = []
    for q, since, n, below, size, start in rows:
        for a, m, place in (packing.cut(0, n, below, n, size, 50) if n else ()):
            served[q] += range(since + a, since + a + m)
            stream += range(start + place, start + place + m)
    assert {q: sorted(v) for q, v in served.items()} == {q: list(range(totals[q])) for q in "abc"}
    assert sorted(stream) == list(range(1343))


def test_fast_ids_equal_the_full_tokenizer():
    full = full_tokenizer(vocabulary("byte_bpe_50k.json"))
    for t in ["Hello wörld\n\n  12,5% ", "ñandú  \t x", "a" * 500, "日本語 text 🙂", f"x{SPECIAL}y", "\x00\x07"]:
        assert encode(t) == full.encode(t, add_special_tokens=False).ids


# --- 5 decontamination -----------------------------------------------------------------

def edit_in(item, text):
    """Least edit distance of item to a substring of text, by the full table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_myers_equals_the_table():
    rng = random.Random(11)
    for _ in range(300):
        item = "".join(rng.choice("ab c") for _ in range(rng.randrange(1, 80)))
        text = "".join(rng.choice("ab c") for _ in range(rng.randrange(0, 120)))
        assert decontam.myers(item, text) == edit_in(item, text)


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(13)
    items = [prose(rng, n) for n in (40, 25, 30, 3)] + ["", None, prose(rng, 20)]
    items.append(items[1].upper())

    def spoiled(t, k):
        t = list(t)
        for _ in range(k):
            p = rng.randrange(len(t))
            t[p:p + 1] = rng.choice([[], ["#"], ["#", t[p]]])
        return "".join(t)

    texts = [prose(rng, 100) for _ in range(10)] + [None, ""]
    for k in range(0, 14):
        for i in (0, 1, 2):
            texts.append(prose(rng, 30) + " " + spoiled(items[i], k).replace(" ", " \n") + " " + prose(rng, 30))
    texts += [items[0][30:], items[3], prose(rng, 20_000) + items[6], texts[20], texts[20]]
    bench = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)], "item_id long, text string, doc_id string")
    d = docs(spark, texts)
    for chunk in (16_000_000, 200):
        got = {(r["doc_id"], r["item_id"]): r["distance"]
               for r in decontam.contaminated(d, bench, chunk_chars=chunk).collect()}
        want = {}
        for i, t in enumerate(texts):
            for k, item in enumerate(items):
                a, b = decontam.plain(item), decontam.plain(t)
                if a and b:
                    dist = 0 if a in b else (edit_in(a, b) if len(b) < 5000 else len(a))
                    if dist <= len(a) // 20:
                        want[i, k] = dist
        assert got == want
    clean = decontam.drop_contaminated(d, bench)
    assert clean.columns == d.columns
    assert {r["doc_id"] for r in clean.collect()} == set(range(len(texts))) - {i for i, _ in want}
    assert decontam.contaminated(d.limit(0), bench).count() == decontam.contaminated(d, bench.limit(0)).count() == 0


def test_short_items_and_repeated_items(spark):
    """Short items stand between word bounds and drop only what holds nothing else;
    a text under many ids is one item; chunks keep to their size."""
    texts = ["banana split", "a banana", "it is a day", "A", None, "", "the cat sat on the mat by the old door in the rain"]
    items = ["a", "banana", "the cat sat on the mat by the old door"] + ["a"] * 50
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = [(i, t, 7) for i, t in enumerate(texts)]
    d = spark.createDataFrame(rows, "doc_id long, text string, __row int")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(d, bench).collect()}
    many = [0, *range(3, 53)]
    assert got == {(0, 1), (1, 1), (6, 2)} | {(i, k) for i in (1, 2, 3) for k in many}
    kept = decontam.drop_contaminated(d, bench)
    assert kept.columns == d.columns and {r["doc_id"] for r in kept.collect()} == {0, 1, 2, 4, 5}
    numbered, ids = decontam._different_items(bench)
    assert numbered.count() == 3 and ids.count() == 53
    rng = random.Random(3)
    lots = spark.createDataFrame([(i, prose(rng, rng.randrange(1, 40))) for i in range(300)], "item_id long, text string")
    numbered, _ = decontam._different_items(lots)
    chunks = [c.select("number", "chars").collect() for c in decontam._chunks(numbered, 1000)]
    assert len(chunks) > 5 and all(len(c) == 1 or sum(r["chars"] for r in c) <= 1000 for c in chunks)
    assert sorted(r["number"] for c in chunks for r in c) == sorted(r["number"] for r in numbered.collect())


# --- 6 lines ---------------------------------------------------------------------------

def letters(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(n))


def test_line_templates(spark):
    rng = random.Random(15)
    texts = []
    for i in range(40):
        body = [letters(rng, 12) for _ in range(4)]
        body.insert(rng.randrange(5), f"Copyright {2000 + i} the  authors of page {i}. All rights reserved")
        if i % 2:
            body.insert(rng.randrange(6), f"Contact us at name{'abcdefghij'[i // 4]} office today please")
        texts.append("\n".join(body))
    copy = "\n".join(letters(rng, 10) for _ in range(5))
    texts += [copy] * 30 + [None, "", "\n\n", "Copyright 1 the authors of page 2. All rights reserved", letters(rng, 30_000)]
    got = as_dict(drop_templates(docs(spark, texts), dropped="n_dropped"))
    for i, t in enumerate(texts):
        drop = [s for s in (t or "").split("\n") if s.startswith(("Copyright", "Contact"))]
        assert got[i]["n_dropped"] == len(drop), i
        want = t if not drop else "\n".join(s for s in t.split("\n") if s not in drop)
        assert got[i]["text"] == want and got[i]["key"] == f"k{i}"
    assert drop_templates(docs(spark, [])).count() == 0


def test_boilerplate_blocks(spark):
    """Fixed blocks, also between blank lines, go; near copies keep their lines."""
    rng = random.Random(16)
    block = [letters(rng, 9) for _ in range(4)]
    texts = ["\n".join([letters(rng, 12), letters(rng, 12), letters(rng, 12), *block]) for _ in range(12)]
    texts += ["\n\n".join([letters(rng, 12), block[1], letters(rng, 12), letters(rng, 12)]) for _ in range(12)]
    copy = [letters(rng, 12) for _ in range(8)]
    near = ["\n".join([*copy[:i % 8], letters(rng, 12), *copy[i % 8 + 1:]]) for i in range(40)]
    got = as_dict(drop_boilerplate(docs(spark, texts + near), dropped="n_dropped"))
    assert [got[i]["n_dropped"] for i in range(64)] == [4] * 12 + [1] * 12 + [0] * 40
    assert not any(s in got[i]["text"] for i in range(24) for s in block)


def test_a_footer_of_two_lines_goes_everywhere(spark):
    """Sixty different texts with one footer: neither line is kept by its neighbour."""
    rng = random.Random(60)
    foot = [letters(rng, 5), letters(rng, 7)]
    texts = ["\n".join([*(letters(rng, 12) for _ in range(4)), *foot]) for _ in range(60)]
    got = as_dict(drop_boilerplate(docs(spark, texts), dropped="n_dropped"))
    assert [got[i]["n_dropped"] for i in range(60)] == [2] * 60
    assert all(got[i]["text"] == "\n".join(texts[i].split("\n")[:4]) for i in range(60))


def test_copies_do_not_keep_boilerplate(spark):
    """A footer of ten documents goes, though one of them stands in forty near copies."""
    rng = random.Random(18)
    foot, copy = letters(rng, 6), [letters(rng, 12) for _ in range(8)]
    texts = ["\n".join([*(letters(rng, 12) for _ in range(4)), foot]) for _ in range(10)]
    texts += ["\n".join([*copy[:i % 8], letters(rng, 12), *copy[i % 8 + 1:], foot]) for i in range(40)]
    got = as_dict(drop_boilerplate(docs(spark, texts), dropped="n_dropped"))
    assert [got[i]["n_dropped"] for i in range(50)] == [1] * 50


def test_long_passages_need_two_contexts(spark):
    """A line of 60 words goes from two documents; short ones and lines of near copies stay."""
    rng = random.Random(20)
    long, short = letters(rng, 60), letters(rng, 8)
    texts = ["\n".join([letters(rng, 70), s, letters(rng, 70)]) for s in [long] * 2 + [short] * 7]
    copy = [letters(rng, 60) for _ in range(4)]
    texts += ["\n".join([*copy, letters(rng, 60)]) for _ in range(3)]
    got = as_dict(drop_boilerplate(docs(spark, texts), dropped="n_dropped"))
    assert [got[i]["n_dropped"] for i in range(12)] == [1] * 2 + [0] * 10


def test_a_text_of_many_lines_and_clashing_columns(spark):
    rng = random.Random(31)
    say = lambda n: prose(rng, n).translate(str.maketrans("0123456789", "qrstuvwxyz"))
    many = "\n".join("Share this page with your friends today" if i % 3 == 0 else say(6) for i in range(3000))
    texts = [many] + [say(9) + "\nShare this page with your friends today\n" + say(7) for _ in range(20)]
    rows = [(i, t, "a", "b", "c", 1) for i, t in enumerate(texts)]
    d = spark.createDataFrame(rows, "doc_id long, text string, k1 string, k2 string, bits string, gone int")
    for drop in (drop_templates, drop_boilerplate):
        out = drop(d, dropped="n")
        assert out.columns == [*d.columns, "n"]
        got = {r["doc_id"]: r for r in out.collect()}
        assert got[0]["text"] == "\n".join(x for x in many.split("\n") if not x.startswith("Share")) and got[0]["n"] == 1000
        assert all(got[i]["text"] == texts[i].replace("Share this page with your friends today\n", "") for i in range(1, 21))
        assert got[3]["k1"] == "a" and got[3]["gone"] == 1


# --- 7 sharding -------------------------------------------------------------------------

def test_shards_are_even_and_keep_copies_together(spark):
    rng = random.Random(17)
    texts = [prose(rng, 5) for _ in range(500)] + ["same"] * 300
    for i in range(60):
        texts += [f"group {i}"] * rng.randrange(2, 5)
    texts += [None, "", None]
    d = docs(spark, texts).withColumn("doc_id", F.when(F.col("doc_id") != 3, F.col("doc_id")))
    rows = shard_documents(d, 10).collect()
    size = collections.Counter(r["shard"] for r in rows)
    assert len(rows) == len(texts) and max(size.values()) - min(size.values()) <= 1
    for s in range(10):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(size[s]))
    where = collections.defaultdict(set)
    for r in rows:
        if r["doc_id"] is not None:
            t = texts[r["doc_id"]] or ""
            assert (r["size"], r["text_crc32"]) == (len(t.encode()) + 16, zlib.crc32(t.encode()))
            where[t].add(r["shard"])
    small = [t for t in where if t.startswith("group")]
    assert sum(len(where[t]) > 1 for t in small) <= 8   # of 60; a full shard takes no more stars
    few = shard_documents(docs(spark, ["a", "a", "b"]), 10).collect()
    assert sorted(r["slot"] for r in few) == [0, 0, 0]
    assert shard_documents(docs(spark, []), 10).count() == 0


def test_copies_gather_where_all_rows_are_linked(spark):
    """No row is free, no shard has room but by what leaves it; defaults as in production."""
    texts = [f"text {i // 5}" for i in range(2000)] + ["large"] * 60
    rows = shard_documents(docs(spark, texts), 10).collect()
    size, where = collections.Counter(), collections.defaultdict(collections.Counter)
    for r in rows:
        size[r["shard"]] += 1
        where[texts[r["doc_id"]]][r["shard"]] += 1
    assert len(rows) == len(texts) and max(size.values()) - min(size.values()) <= 1
    together = sum(max(c.values()) for t, c in where.items() if t != "large")
    assert together >= 0.85 * 2000                  # about 0.37 for shards drawn at random
    assert max(where["large"].values()) >= 54       # under a shard, over a quarter of one


def test_propagation_over_general_links(spark):
    rows = spark.range(400).select(F.col("id").alias("vid"))
    links = spark.createDataFrame([(10 * g + i, 10 * g + j) for g in range(40) for i in range(10) for j in range(i)],
                                  "src long, dst long")
    got = {r["vid"]: r["shard"] for r in label_propagation(rows, links, 4, rounds=8, fill=1.1).collect()}
    size = collections.Counter(got.values())
    assert max(size.values()) - min(size.values()) <= 1
    cut = sum(got[10 * g + i] != got[10 * g + j] for g in range(40) for i in range(10) for j in range(i))
    assert cut <= 0.25 * 1800                       # 0.75 for shards drawn at random


# --- 8 vectors --------------------------------------------------------------------------

def test_tables_follow_the_number_of_vectors():
    assert table_plan(0, 0.9, 2048, 0.995) == table_plan(500_000, 0.9, 2048, 0.995) == (16, 8)
    for n in (10**6, 10**9):
        tables, bits = table_plan(n, 0.9, 2048, 0.995)
        assert n / 2**bits <= 2048 and 1 - (1 - (1 - np.arccos(0.9) / np.pi) ** bits) ** tables >= 0.995
    assert table_plan(10, 1.0, 2048, 0.995) == (1, 8)


@pytest.mark.parametrize("block", [2048, 16])
def test_vectors_equal_brute_force(spark, block):
    rng = np.random.default_rng(19)
    base = rng.standard_normal((12, 16))
    vecs = [(base[i % 12] + rng.standard_normal(16) * (0.05 + 0.02 * (i % 5))).astype(np.float32).tolist()
            for i in range(150)]
    vecs += [vecs[3]] * 20 + [[2 * x for x in vecs[3]], None, [], [0.0] * 16, [float("nan")] + [1.0] * 15,
                              [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0]]
    df = spark.createDataFrame([(i * 3, v, 0, "x") for i, v in enumerate(vecs)],
                               "vec_id long, embedding array<float>, label int, key string")
    got = as_dict(near_vectors(df, 0.9, tables=24, bits=6, block=block), "vec_id")
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vecs]
    links = collections.defaultdict(set)
    for i in range(len(vecs)):
        for j in range(i):
            if ok[i] and ok[j] and len(vecs[i]) == len(vecs[j]):
                a, b = np.array(vecs[i]), np.array(vecs[j])
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.9:
                    links[i].add(j), links[j].add(i)
    for i in range(len(vecs)):
        comp, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - comp
            comp |= new
            todo += new
        r = got[i * 3]
        assert (r["n_links"], r["component_id"], r["kept"]) == (len(links[i]), 3 * min(comp), i == min(comp)), i
    assert near_vectors(df.limit(0)).count() == 0


# --- 9 near documents ---------------------------------------------------------------------

def near_texts():
    rng = random.Random(21)
    texts = []
    for _ in range(15):
        w = prose(rng, rng.randrange(30, 300)).split()
        for k in range(rng.randrange(1, 8)):
            v = list(w)
            for _ in range(k):
                v[rng.randrange(len(v))] = f"new{rng.randrange(1000)}"
            texts.append(" ".join(v).replace(" ", rng.choice([" ", "\n", "  \t"])))
    texts += [texts[0]] * 5 + [texts[0].upper(), None, "", " \n", "one", "ONE ", "one two", "Über\x0bx Über x", "über x über x",
                               prose(rng, 30_000)]
    return texts


@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
def test_near_documents_equal_brute_force(spark, words, percent):
    texts = near_texts()
    got = as_dict(near_documents(docs(spark, texts).repartition(3), words, percent))
    sets = [shingles(t, words) if t else set() for t in texts]
    for i, t in enumerate(texts):        # the sets themselves, from the definition
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        assert sets[i] == ({tuple(w[k:k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set()))
    for i in range(len(texts)):
        comp, todo = {i}, [i]
        while todo:
            x = todo.pop()
            new = {j for j in range(len(texts)) if j not in comp and similar(sets[x], sets[j], percent)}
            comp |= new
            todo += new
        r = got[i]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[i]), min(comp), i == min(comp)), i


def test_equal_hashes_are_confirmed(spark):
    """Two different words whose polynomial hashes agree (a Thue-Morse word of 1,024
    letters and its complement) are no copies; texts of one set are."""
    one = "".join("ab"[i.bit_count() % 2] for i in range(1024))
    two = one.translate(str.maketrans("ab", "ba"))
    texts = [one, two, one, two.upper(), f" {one}\n", "x y z x y z x y", "X Y Z  X Y Z X Y", None]
    for words in (1, 3):
        got = as_dict(near_documents(docs(spark, texts).repartition(3), words, 85))
        assert [got[i]["component_id"] for i in range(8)] == [0, 1, 0, 1, 0, 5, 5, 7]
    clash = docs(spark, texts).selectExpr("*", "'mine' as __row")
    out = drop_near_duplicates(clash)
    assert out.columns == clash.columns and sorted(r["doc_id"] for r in out.collect()) == [0, 1, 5, 7]
    assert {r["__row"] for r in out.collect()} == {"mine"}


def test_near_documents_odd_rows(spark):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (5, None), (5, "")]
    d = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, vid string")
    stay = drop_near_duplicates(d)
    assert stay.columns == d.columns and stay.count() == 3
    assert near_documents(d.limit(0)).count() == 0


# --- 10 token rollups -----------------------------------------------------------------------

def test_rollup_is_additive_and_idempotent(spark, scratch):
    r = TokenRollup(spark, f"{scratch}/rollup")
    assert r.totals().count() == 0
    cols = "op string, source string, lang string, tokenizer string, tokens long, old_source string, old_lang string, " \
           "old_tokenizer string, old_tokens long"
    put = lambda s, n, t="v1": ("insert", s, "en", t, n, None, None, None, None)
    first = spark.createDataFrame([put("a", 5), put("a", 7), put(None, 3), put("b", 0), put("b", None)], cols)
    second = spark.createDataFrame([("revise", "a", "en", "v2", 6, "a", "en", "v1", 5),
                                    ("delete", None, None, None, None, None, "en", "v1", 3)], cols)
    assert r.commit("one", first) and r.commit("two", second)
    assert not r.commit("one", second)                    # a second delivery changes nothing
    assert r.commit("none", first.limit(0))
    got = {(x["source"], x["tokenizer"]): (x["docs"], x["tokens"]) for x in r.totals().collect()}
    assert got == {("a", "v1"): (1, 7), ("a", "v2"): (1, 6), ("b", "v1"): (2, 0)}
    # a batch that died before its commit record does not count, and its rerun replaces it
    from fraudlake.llm.token_rollup import signed
    signed(first).withColumn("batch", F.lit("three")).write.parquet(f"{r.root}/deltas/three")
    assert {(x["source"], x["tokenizer"]): (x["docs"], x["tokens"]) for x in r.totals().collect()} == got
    assert r.commit("three", spark.createDataFrame([put("b", 4)], cols))
    assert {x["tokens"] for x in r.totals().collect() if x["source"] == "b"} == {4}


def test_token_counts(spark):
    texts = ["Hello wörld", None, "", "x " * 3000]
    got = as_dict(count_tokens(docs(spark, texts), {"byte_bpe_50k": "true", "byte_bpe_multi_50k": "doc_id > 1"}))
    assert [got[i]["byte_bpe_50k"] for i in range(4)] == [len(encode(t)) for t in texts]
    assert [got[i]["byte_bpe_multi_50k"] for i in range(4)] == [None, None, 0, len(encode(texts[3], "byte_bpe_multi_50k"))]


def test_rollup_ids_and_operations(spark, scratch):
    """Any text is a batch id; unknown operations are refused; a read is one generation."""
    cols = "op string, source string, lang string, tokenizer string, tokens long, old_source string, old_lang string, old_tokenizer string, old_tokens long"
    change = lambda op, n: spark.createDataFrame([(op, "s", "en", "t", n, "s", "en", "t", 1)], cols)
    r = TokenRollup(spark, f"{scratch}/rollup")
    assert r.totals().count() == 0
    for i, batch in enumerate(["2024/01", "*", "..", "a=b c", ""]):
        assert r.commit(batch, change("insert", 10)) and not r.commit(batch, change("insert", 10))
        assert [tuple(x) for x in r.totals().collect()] == [("s", "en", "t", i + 1, 10 * (i + 1))]
    for op in ("upsert", None):
        with pytest.raises(ValueError, match="unknown operation"):
            r.commit("bad", change(op, 1))
    assert r.committed().count() == 5 and r.commit("bad", change("revise", 4))
    assert [tuple(x)[3:] for x in r.totals().collect()] == [(5, 53)]
    assert len({f.rsplit("/", 2)[1] for f in r.totals().inputFiles()}) == 1
