"""Cross-polytope search against brute force."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from fraudlake.llm import vector_search as V
from fraudlake.llm.queries import QUERIES

KIND = "vec_id long, embedding array<float>, label int, uid string, score string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "u", "s") for i, v in rows], KIND)


def brute(rows, k, asks):
    good = [(n, i, np.array(v, np.float32).astype(float)) for n, (i, v) in enumerate(rows)
            if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for n, i, v in good:
        if i is not None and asks(i):
            x = [(-float(v @ w), j is None, j or 0) for m, j, w in good if m != n and len(w) == len(v)]
            out.setdefault(i, []).append([(None if no else j, -s) for s, no, j in sorted(x)[:k]])
    return out


def answers(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def test_rotations_keep_length_and_codes_are_best_probes():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((40, 24)) * 10.0 ** rng.integers(-200, 150, (40, 1))
    assert np.allclose((V.axes(V.unit(x), 2, 1, 7) ** 2).sum(axis=1), 2)
    h = V.hadamard(np.eye(8))
    assert (h @ h.T == 8 * np.eye(8)).all()
    for index in (V.Index(3, 1), V.Index(2, 2)):
        band, tab, code = index.probes(x, [1.0], 300)
        own = index.codes(x)
        for i in range(len(x)):
            seen = list(zip(tab[i], code[i]))
            assert len(set(seen)) == len(seen)
            assert all(next(c for t, c in seen if t == u) == own[i, u] for u in range(index.tables))


def test_probe_order_is_that_of_all_sums():
    x = np.random.default_rng(5).standard_normal((3, 4))
    index = V.Index(1, 2)
    a, b = (V.axes(V.unit(x), 0, r, 7) for r in (0, 1))
    for i, codes in enumerate(index.probes(x, [1.0], 20)[2]):
        sums = (a[i][:, None] + b[i]).ravel()
        assert np.allclose(sums[codes], np.sort(sums)[::-1][:20])


@pytest.mark.parametrize("block", [2048, 16])
def test_odd_rows(spark, block):
    """Copies, ties, null and repeated ids, other lengths, other norms; all are found."""
    rng = np.random.default_rng(1)
    rows = [(i, list(map(float, rng.integers(-2, 3, 6)))) for i in range(120)]
    rows += [(i, [1.0, 2.0, 0.0, 0.0, 1.0, 0.0]) for i in range(200, 260)]
    rows += [(i, list(map(float, 40 * rng.standard_normal(6)))) for i in range(300, 330)]
    rows += [(None, rows[3][1]), (20, rows[5][1]), (20, rows[20][1]), (40, None), (60, []), (60, [0.0] * 6), (80, [None] * 6),
             (80, [float("nan")] * 6), (100, [float("inf")] + [1.0] * 5), (400, [1.0, 2.0]), (401, [3.0, 1.0]), (420, [5.0]),
             (440, [-0.0, 2.0])]
    got = answers(V.search(table(spark, rows), F.col("vec_id") % 20 == 0, 20, recall=1.0, block=block))
    for i, lists in brute(rows, 20, lambda i: i % 20 == 0).items():
        mine = got.pop(i, [])
        assert sorted((v if v is not None else -1, round(s, 6)) for _, v, s in mine) == \
            sorted((v if v is not None else -1, round(s, 6)) for x in lists for v, s in x), i
        if len(lists) == 1:
            assert [(v, round(s, 6)) for _, v, s in mine] == [(v, round(s, 6)) for v, s in lists[0]]
            assert [r for r, _, _ in mine] == list(range(1, len(mine) + 1))
    assert not got


def test_short_answers_are_filled(spark):
    """One probe finds little; then the whole first table is compared."""
    rng = np.random.default_rng(2)
    rows = [(i, list(map(float, rng.standard_normal(16)))) for i in range(15)]
    got = answers(V.search(table(spark, rows), F.col("vec_id") % 5 == 0, 20, recall=0.01))
    assert {i: [v for _, v, _ in x] for i, x in got.items()} == \
        {i: [v for v, _ in x[0]] for i, x in brute(rows, 20, lambda i: i % 5 == 0).items()}
    assert V.search(table(spark, []), F.col("vec_id") % 5 == 0).count() == 0
    assert V.search(table(spark, [(5, [1.0])]), F.col("vec_id") % 5 == 0).count() == 0


def test_several_turns(spark):
    """Codes of several rotations, where the vectors lie in tight groups."""
    rng = np.random.default_rng(4)
    heads = rng.standard_normal((60, 16))
    rows = [(i, list(map(float, heads[i % 60] + 0.05 * rng.standard_normal(16)))) for i in range(3000)]
    got = answers(V.search(table(spark, rows), F.col("vec_id") % 50 == 0, 20, block=16))
    want = brute(rows, 20, lambda i: i % 50 == 0)
    hit = sum(len({v for _, v, _ in got[i]} & {v for v, _ in x[0]}) for i, x in want.items())
    assert hit >= 0.9 * 20 * len(want) and all(len(x) == 20 for x in got.values())


def test_recall_on_the_table(spark):
    sf = "/root/testdata/sf0.1"
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM read_parquet('{sf}/embeddings.parquet')").fetchall()
    got = answers(QUERIES["op12_polytope_search"](spark, sf))
    want = brute(rows, 20, lambda i: i % 20 == 0)
    assert set(got) == set(want)
    hit = sum(len({v for _, v, _ in got[i]} & {v for v, _ in x[0]}) for i, x in want.items())
    print("recall", hit / (20 * len(want)))
    assert hit >= 0.9 * 20 * len(want)
    at = dict(rows)
    for i, x in got.items():
        for _, v, s in x:
            assert abs(s - float(np.array(at[i], float) @ np.array(at[v], float))) < 1e-12
