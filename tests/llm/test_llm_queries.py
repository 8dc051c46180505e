"""Registered corpus queries against their DuckDB SQL and against brute force."""

import collections
import hashlib
import os
import sys

import duckdb
import numpy as np
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from check_oracle import digest  # noqa: E402
from fraudlake.llm import toxicity  # noqa: E402
from fraudlake.llm.common import store  # noqa: E402
from fraudlake.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_is_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, len(QUERIES) + 1)]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    res = con.execute(ORACLE_SQL[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(cols, res.fetchall())[0]


def test_op1_matches_brute_force(spark, con):
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op1_suffix_repeats"](spark, SF).collect()}
    seen = set()
    for doc, text in con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall():
        raw, gone = text.encode(), bytearray(len(text.encode()))
        for s in range(len(raw) - 99):
            w = raw[s:s + 100]
            if w in seen:
                gone[s:s + 100] = b"\1" * 100
            seen.add(w)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        assert got[doc] == (doc, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest())


def test_op3_flags_the_labelled(spark, con):
    got = {r["doc_id"]: r["rejected"] for r in QUERIES["op3_ordinal_toxicity"](spark, "/root/testdata/sf0.01").collect()}
    labels = con.execute("SELECT doc_id, toxic FROM read_parquet('/root/testdata/sf0.01/labels.parquet')").fetchall()
    assert sum(got[d] == (t == 1) for d, t in labels) >= 0.99 * len(labels)


def test_op3_held_out(con):
    """Half of sf0.1's labelled rows fit, the other half judges."""
    rows = con.execute("""SELECT d.doc_id, any_value(d.text), max(l.toxic) FROM read_parquet('/root/testdata/sf0.1/documents.parquet') d
        JOIN read_parquet('/root/testdata/sf0.1/labels.parquet') l USING (doc_id)
        WHERE l.toxic IS NOT NULL GROUP BY d.doc_id ORDER BY hash(d.doc_id)""").fetchall()
    half, rest = rows[::2], rows[1::2]
    words = [collections.Counter(toxicity.WORD.findall((t or "").lower())) for _, t, _ in half]
    model = toxicity.fit(words, np.array([y == 1 for _, _, y in half]))
    said = [(model.score(t)[0] >= 0.5, y == 1) for _, t, y in rest]
    assert sum(a for a, b in said if b) >= 0.9 * sum(b for _, b in said)
    assert sum(a for a, b in said if not b) <= 0.005 * len(said)


def test_op7_law(spark):
    rows = QUERIES["op7_balanced_shards"](spark, SF).collect()
    n = collections.Counter(r["shard"] for r in rows)
    assert len(rows) == 200 and max(n.values()) - min(n.values()) <= 1 and set(n) == set(range(40))


def test_op10_matches_counts(spark, con):
    from fraudlake.llm.tokens import encode
    rows = con.execute("SELECT doc_id, source, lang, text FROM documents").fetchall()
    first = {}
    for doc, _, _, text in sorted(rows):
        first.setdefault(text, doc)
    want = collections.Counter()
    for doc, source, lang, text in rows:
        if first[text] == doc:
            name = "byte_bpe_50k" if lang == "en" else "byte_bpe_multi_50k"
            want[source, lang, name, "docs"] += 1
            want[source, lang, name, "tokens"] += len(encode(text, name))
    got = {}
    for r in QUERIES["op10_token_rollup"](spark, SF).collect():
        for c in ("docs", "tokens"):
            got[r["source"], r["lang"], r["tokenizer"], c] = r[c]
    assert got == dict(want)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cols, texts = docs.columns, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = store(stage(spark, docs, SF), name)
        assert out.columns == cols
        if name == "line_dedup":
            assert out.count() == docs.count()
        docs = out
    n = docs.count()
    assert 0 < n < 200
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert pieces.select("doc_id").distinct().count() == n
    whole = corpus_pipeline.run(spark, SF).select("doc_id", "start", "length", "ids_crc32")
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, pieces.select(*whole.columns).collect()))
