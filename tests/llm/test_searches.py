"""The two vector searches against brute force, with copies, ties, bad vectors and empty tables."""

import numpy as np
import pytest

from ledgerlark.llm import ann_search, hamming_search, queries

SCHEMA = "vec_id bigint, embedding array<float>, rank int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 7) for i, v in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd_rows():
    random = np.random.default_rng(3)
    rows = [(i, [float(x) for x in random.standard_normal(12).astype(np.float32)]) for i in range(300)]
    rows += [(1000 + i, rows[50][1]) for i in range(120)]  # copies of a query
    rows += [(2000, None), (2001, [0.0] * 12), (2002, [float("nan")] * 12), (2003, [1.0, None] * 6)]
    rows += [(2004, [1.0] * 5), (None, rows[0][1]), (2005, [float("inf")] * 12), rows[7], (2006, [])]
    return rows


def usable(rows, zero=False):
    return {
        (i, tuple(v))
        for i, v in rows
        if i is not None and v and len(v) == 12 and None not in v and np.isfinite(v).all() and (zero or any(v))
    }


def test_ann_on_odd_rows(spark, odd_rows):
    found = ann_search.nearest_vectors(table(spark, odd_rows), lambda i: i % 50 == 0, k=5, probed=1.0).collect()
    good = sorted(usable(odd_rows))
    ids = np.array([i for i, _ in good])
    x = np.array([v for _, v in good])
    for q in [i for i in ids if i % 50 == 0]:
        v = x[list(ids).index(q)]
        score = x @ v / np.linalg.norm(x, axis=1) / np.linalg.norm(v)
        order = [j for j in np.lexsort((ids, -score.round(12))) if ids[j] != q][:5]
        ours = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q)
        assert [r[0] for r in ours] == [1, 2, 3, 4, 5]
        assert [r[1] for r in ours] == ids[order].tolist()
        assert np.allclose([r[2] for r in ours], score[order])


def test_ann_recall(spark):
    random = np.random.default_rng(5)
    x = random.standard_normal((3000, 32)).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA)
    found = ann_search.nearest_vectors(rows, lambda i: i % 50 == 0).toPandas()
    u = x.astype(float) / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 3000, 50):
        s = u @ u[q]
        s[q] = -9
        hits += len(set(np.argsort(-s)[:5]) & set(found[found.query_id == q].vec_id))
    assert len(found) == 300 and hits / 300 >= 0.9


def test_scan_without_doubt_is_exact():
    random = np.random.default_rng(1)
    x = random.standard_normal((500, 40))
    blocks = [x[:, c : c + 16] for c in range(0, 40, 16)]
    q = random.standard_normal(40)
    d = ((x - q) ** 2).sum(1)
    assert set(np.argsort(d)[:6]) - set(ann_search.scan(blocks, q, 6)) == set()


def test_hamming_on_odd_rows(spark, odd_rows):
    codes = hamming_search.sign_codes(table(spark, odd_rows))
    found = hamming_search.nearest_codes(codes, lambda i: i % 20 == 0, k=4).collect()
    good = sorted(usable(odd_rows, zero=True))
    for q, v in [(i, v) for i, v in good if i % 20 == 0]:
        want = sorted((sum((a > 0) != (b > 0) for a, b in zip(v, w)), i) for i, w in good if i != q)[:4]
        ours = sorted((r["rank"], r["distance"], r["vec_id"]) for r in found if r["query_id"] == q)
        assert [r[1:] for r in ours] == want


def test_segment_index_is_exact():
    random = np.random.default_rng(2)
    for size in (1, 3, 8, 17):
        codes = random.integers(0, 256, (400, size)).astype(np.uint8)
        index = hamming_search.SegmentIndex(codes)
        for _ in range(10):
            q = random.integers(0, 256, size).astype(np.uint8)
            d = np.unpackbits(codes ^ q, axis=1).sum(1)
            kth = np.sort(d)[4]
            at, distance = index.search(q, 5)
            assert sorted(at) == np.flatnonzero(d <= kth).tolist() and (d[at] == distance).all()


def test_empty_tables(spark):
    empty = table(spark, [])
    assert ann_search.nearest_vectors(empty, lambda i: i % 50 == 0).count() == 0
    assert hamming_search.nearest_codes(hamming_search.sign_codes(empty), lambda i: i % 20 == 0).count() == 0
    single = table(spark, [(0, [1.0, 2.0])])
    assert ann_search.nearest_vectors(single, lambda i: i % 50 == 0).count() == 0


def test_queries_run_whole(spark):
    for name in ("op3_ann_search", "op6_hamming_search"):
        assert queries.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
