"""MinHash near-duplicates against all pairs, and the edge cases of the contract."""

import random
import re

import numpy as np
import oracle
import pytest

from tessera.llm import near, queries
from tessera.llm.words import shingle_sets


def plain(rows, k, percent):
    """Sets by definition, all pairs, union-find."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    ids = [r[0] for r in rows]
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = find(ids[i]), find(ids[j])
                root[max(a, b)] = min(a, b)
    return {(i, len(s), find(i), find(i) == i) for i, s in zip(ids, sets, strict=True)}


def corpus(seed, n=160):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["The", "the", "É", "a b"]
    rows = []
    for i in range(n):
        if i and rng.random() < 0.6:
            w = rows[rng.randrange(len(rows))][1].split(" ")
            for _ in range(rng.choice([0, 1, 2, 4, 8])):
                w[rng.randrange(len(w))] = rng.choice(words)
        else:
            w = [rng.choice(words) for _ in range(rng.choice([1, 2, 5, 30, 80, 200]))]
        rows.append((i * 3 + 1, " ".join(w)))
    return rows + [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "x"), (1004, "X"), (1005, "x y"), (1006, "x  y")]


@pytest.mark.parametrize(("seed", "k"), [(1, 2), (2, 5), (3, 1)])
def test_against_all_pairs(spark, seed, k):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, node string, kept string")
    assert {tuple(r) for r in near.near_duplicates(df, k=k).collect()} == plain(rows, k, 80)


def test_large_group_of_near_copies_needs_cells(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 8)  # so that buckets are split
    rng = random.Random(5)
    base = [f"v{i}" for i in range(120)]
    rows = []
    for i in range(120):
        w = list(base)
        for j in rng.sample(range(120), rng.randrange(4, 16)):
            w[j] = f"u{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in near.near_duplicates(df, k=2).collect()} == plain(rows, 2, 80)


def test_repeated_rows_and_missing_ids(spark):
    df = spark.createDataFrame([(5, "a b c d"), (5, "a b c d"), (7, "a b c d"), (None, "a b c d"), (None, "z y x"), (9, None)], "doc_id long, text string")
    got = sorted((tuple(r) for r in near.near_duplicates(df, k=2).collect()), key=str)
    assert got == sorted([(5, 3, 5, True), (5, 3, 5, True), (7, 3, 5, False), (None, 3, 5, False), (None, 2, None, False), (9, 0, 9, True)], key=str)


def test_empty_table(spark):
    assert near.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_text(spark):
    long = " ".join(f"t{i}" for i in range(60_000))
    df = spark.createDataFrame([(1, long), (2, long + " end"), (3, "t1")], "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in near.near_duplicates(df).collect()} == {1: 1, 2: 1, 3: 3}


def test_bounds_keep_links():
    least = near.least_matches(0.8, near.MISS)
    assert all(a <= b for a, b in zip(list(least.values()), list(least.values())[1:], strict=False))
    rng = np.random.default_rng(0)
    kept = 0
    for _ in range(60):
        s = np.unique(rng.integers(0, 1 << 63, 900, dtype=np.uint64))
        a, b = s[:850], s[50:]
        kept += len(near.surviving(near.signature(a)[None], near.signature(b)[None], least))
    assert kept == 60
    a, b = (near.signature(rng.integers(0, 1 << 63, 500, dtype=np.uint64))[None] for _ in range(2))
    assert len(near.surviving(a, b, least)) == 0


def test_shingles_of_short_texts():
    a, b, c = shingle_sets([b"one", b"", b"one two"], 5)
    assert len(a) == 1 and len(b) == 0 and len(c) == 1 and a[0] != c[0]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, sf, name):
    got = queries.QUERIES[name](spark, sf).toPandas()
    oracle.same(got, oracle.connect(sf).execute(queries.ORACLES[name]).df())


def test_stage_keeps_columns_and_one_of_each_group(spark):
    text = " ".join(f"k{i}" for i in range(40))
    df = spark.createDataFrame([(3, text, "a"), (1, text + " more", "b"), (2, "other words here", "c")], "doc_id long, text string, component_id string")
    got = near.stage(spark, df, "")
    assert got.columns == df.columns and sorted(r["doc_id"] for r in got.collect()) == [1, 2]


def test_stage_decides_by_row(spark):
    text, other = " ".join(f"k{i}" for i in range(40)), " ".join(f"m{i}" for i in range(40))
    rows = [(4, text), (4, text), (4, other), (None, "alone without an id"), (None, text), (None, other + " x"), (9, None), (9, None), (8, ""), (3, text + " more")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, component_id int").repartition(3)
    got = sorted(((r["doc_id"], r["text"]) for r in near.stage(spark, df, "").collect()), key=str)
    assert got == sorted([(3, text + " more"), (4, other), (None, "alone without an id"), (9, None), (9, None), (8, "")], key=str)
    assert near.stage(spark, df.where("false"), "").count() == 0


def test_components_of_a_hub_and_a_path(spark):
    from tessera.llm import graph, runtime

    links = [(0, i) for i in range(1, 500)] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7), (2000, 1060)]
    got = {r["node"]: r["component"] for r in graph.components(runtime.Scratch(spark), spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(500)} | {1000 + i: 1000 for i in range(61)} | {2000: 1000}
