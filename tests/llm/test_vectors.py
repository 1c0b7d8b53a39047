"""Exact search and near-duplicate vectors against brute force."""

import numpy as np
import pytest

from tessera.llm import vectors


def make(spark, x, ids=None, extra=()):
    rows = [(int(i), None if v is None else [None if c is None else float(c) for c in v], "n") for i, v in zip(ids if ids is not None else range(len(x)), x, strict=True)]
    return spark.createDataFrame(rows + list(extra), "vec_id long, embedding array<float>, mult string")


def test_segment_bound_holds():
    rng = np.random.default_rng(3)
    a, b = rng.standard_normal((20, 30)), rng.standard_normal((25, 30))
    for s in (1, 4, 7, 30):
        assert (vectors.segment_features(a, s) @ vectors.segment_features(b, s).T >= a @ b.T - 1e-9).all()


@pytest.mark.parametrize("block", [5, 10_000])
def test_top_k(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "QUERY_BLOCK", block)
    rng = np.random.default_rng(4)
    x = np.floor(256 * np.concatenate([rng.standard_normal((600, 24)), rng.integers(0, 2, (400, 24))])).astype(int)
    ids = rng.permutation(1000)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)] + [(5000, None), (None, [1] * 24), (5050, [7, 7])], "vec_id long, ints array<long>")
    got = {}
    for r in vectors.top_k(df.where("vec_id % 50 = 0"), df, 5).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    where = {int(i): k for k, i in enumerate(ids)}
    assert set(got) == {q for q in range(0, 1000, 50)}
    for q in got:
        score = x @ x[where[q]]
        best = sorted(((-int(score[k]), int(i)) for k, i in enumerate(ids) if i != q))[:5]
        assert got[q] == {n + 1: (i, -s) for n, (s, i) in enumerate(best)}


def test_top_k_with_few_or_no_rows(spark):
    df = spark.createDataFrame([(0, [1, 2]), (50, [3, 4]), (7, [0, 0])], "vec_id long, ints array<long>")
    got = sorted(map(tuple, vectors.top_k(df.where("vec_id % 50 = 0"), df).collect()))
    assert got == [(0, 1, 50, 11), (0, 2, 7, 0), (50, 1, 0, 11), (50, 2, 7, 0)]
    assert vectors.top_k(df.where("vec_id < 0"), df.where("vec_id < 0")).count() == 0


def brute(rows, threshold=0.9):
    ok = {i: np.asarray(v, np.float32).astype(float) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v) and any(v)}
    ids = [i for i, _ in rows]
    links = {i: set() for i in ids}
    for i in ok:
        for j in ok:
            if i < j and len(ok[i]) == len(ok[j]):
                c = ok[i] @ ok[j] / np.sqrt(ok[i] @ ok[i]) / np.sqrt(ok[j] @ ok[j])
                if c >= threshold:
                    links[i].add(j), links[j].add(i)
    comp = {}
    for i in sorted(ids):
        if i not in comp:
            todo = [i]
            while todo:
                k = todo.pop()
                if k not in comp:
                    comp[k] = i
                    todo += links[k]
    return links, comp


def planted(seed, d=32):
    rng = np.random.default_rng(seed)
    x = [v for v in rng.standard_normal((250, d))]
    for k in range(150):
        x.append(x[k] + rng.standard_normal(d) * rng.choice([0.1, 0.3, 0.45]) * 0.9)
    x += [x[0]] * 40 + [2 * x[1], -x[1], np.zeros(d)]
    return [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)] + [(900, None), (901, [None] * d), (902, [float("nan")] * d), (903, [float("inf")] * d), (904, [1.0, 2.0]), (905, [1.0, 2.1]), (906, [])]


@pytest.mark.parametrize("cell", [1024, 4])
def test_near_vectors(spark, monkeypatch, cell):
    monkeypatch.setattr(vectors, "CELL", cell)
    rows = planted(6)
    df = spark.createDataFrame([(i, v, "z") for i, v in rows], "vec_id long, embedding array<float>, node string")
    got = {r["vec_id"]: r for r in vectors.near_vectors(df).collect()}
    links, comp = brute(rows)
    found, total = sum(r["n_links"] for r in got.values()), sum(map(len, links.values()))
    assert all(got[i]["n_links"] <= len(links[i]) for i in got) and found >= 0.99 * total
    wrong = [i for i in got if got[i]["component_id"] != comp[i]]
    assert len(wrong) <= 0.01 * len(rows) and all(got[i]["kept"] == (got[i]["component_id"] == i) for i in got)


@pytest.mark.parametrize("shape", ["first half", "decay", "one half", "eight dimensions"])
def test_near_vectors_of_uneven_energy(spark, shape):
    d, i = 64, np.arange(64)
    scale = {"first half": np.where(i < 32, 10, 1), "decay": 1 / (i + 1), "one half": (i < 32) * 1, "eight dimensions": (i < 8) * 1}[shape]
    rng = np.random.default_rng(11)
    x, z = rng.standard_normal((2, 300, d)) * scale
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    both = np.concatenate([x, 0.9005 * x + np.sqrt(1 - 0.9005**2) * z])
    rows = [(k, v.astype(np.float32).tolist()) for k, v in enumerate(both)]
    got = {r["vec_id"]: r["n_links"] for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    links, _ = brute(rows)
    assert all(got[k] <= len(links[k]) for k in got)
    recall = sum(got.values()) / sum(map(len, links.values()))
    print(f"{shape}: {recall:.4f}")
    assert recall >= 0.99


def test_near_vectors_edges(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0])], "vec_id long, embedding array<float>")
    assert sorted((tuple(r) for r in vectors.near_vectors(df).collect()), key=str) == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False)], key=str)
    assert vectors.near_vectors(df.where("vec_id > 5")).count() == 0


def test_decode_lists_all_filters_over_the_cap():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((40, 20))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    books = vectors.codebook(20, 12)
    all_ = np.array([[np.concatenate([a, b]) @ v for a in books[0] for b in books[1]] for v in x])
    books_of_many = vectors.codebook(20, 40)
    for v, codes in zip(x, vectors.decode(x, books_of_many, 9.0, 7), strict=True):  # none over the cap: the best of all pairs
        every = np.array([np.concatenate([a, b]) @ v for a in books_of_many[0] for b in books_of_many[1]])
        assert (codes == np.sort(np.argsort(-every)[:7])).all()
    for v, codes in zip(all_, vectors.decode(x, books, 1.5, 5), strict=True):
        expected = np.flatnonzero(v >= 1.5 / np.sqrt(20))
        assert (codes == (expected if len(expected) >= 5 else np.sort(np.argsort(-v)[:5]))).all()


def test_recall_at_the_threshold():
    rng = np.random.default_rng(8)
    x, z = rng.standard_normal((2, 1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    books = vectors.codebook(64, vectors.CODEWORDS)
    a, b = (vectors.decode(v, books, vectors.CAP) for v in (x, 0.9 * x + np.sqrt(1 - 0.81) * z))
    assert np.mean([len(np.intersect1d(p, q)) > 0 for p, q in zip(a, b, strict=True)]) >= 0.99


@pytest.mark.parametrize("size", [200_000, 10**7, 10**9])
def test_filters_of_large_tables(size):
    """Recall stays, a filter's share of random vectors falls with the table, and a vector joins but few more filters."""
    codewords, cap = vectors.book_size(size, 64, 0.9)
    rng = np.random.default_rng(5)
    n = 300
    x, z = rng.standard_normal((2, n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    books = vectors.codebook(64, codewords)
    a, b = (vectors.decode(v, books, cap) for v in (x, 0.9 * x + np.sqrt(1 - 0.81) * z))
    recall = np.mean([len(np.intersect1d(p, q)) > 0 for p, q in zip(a, b, strict=True)])
    filters = np.mean([len(p) for p in a])
    print(f"{size}: {codewords} codewords, cap {cap:.2f}, recall {recall:.3f}, {filters:.0f} filters a vector, {size * filters / codewords**2:.0f} vectors a filter")
    assert recall >= 0.92 and filters < 120 and size * filters / codewords**2 < 4 * vectors.FILTER
    assert vectors.book_size(40_000, 64, 0.9) == (vectors.CODEWORDS, vectors.CAP)


def test_near_vectors_with_filters_of_a_large_table(spark):
    rows = planted(6, 64)
    df = spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<double>")
    codewords, cap = vectors.book_size(10**6, 64, 0.9)
    got = {r["vec_id"]: r for r in vectors.near_vectors(df, codewords=codewords, cap=cap).collect()}
    links, _ = brute(rows)
    assert all(got[i]["n_links"] <= len(links[i]) for i in got) and sum(r["n_links"] for r in got.values()) >= 0.97 * sum(map(len, links.values()))
