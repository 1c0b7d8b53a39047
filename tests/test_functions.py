"""Text, sequence and number functions against small models."""

import math

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tessera.functions import num, seq, text as X


def model_run(tokens):
    best = run = 0
    for i, x in enumerate(tokens):
        run = run + 1 if i and x == tokens[i - 1] else 1
        best = max(best, run)
    return best


def model_repeat(tokens):
    if len(tokens) < 4:
        return 1
    best = 1
    for n in range(2, min(4, max(2, len(tokens) // 2)) + 1):
        for s in range(len(tokens)):
            k = 1
            while tokens[s : s + n] == tokens[s + k * n : s + (k + 1) * n] and len(tokens[s + k * n : s + (k + 1) * n]) == n:
                k += 1
            best = max(best, k)
    return best


def model_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=14), min_size=1, max_size=40))
def test_runs_and_repeats(spark, lists):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, t array<string>")
    rows = df.select("i", seq.max_run(F.col("t")).alias("run"), seq.max_ngram_repeat(F.col("t")).alias("rep")).collect()
    for r in rows:
        assert r["run"] == model_run(lists[r["i"]])
        assert r["rep"] == model_repeat(lists[r["i"]])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(*[st.lists(st.sampled_from(["a", "bb", "ccc", "d'"]), max_size=8)] * 2), min_size=1, max_size=30))
def test_word_error_rate(spark, pairs):
    df = spark.createDataFrame([(i, " ".join(a), " ".join(b)) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    for r in df.select("i", X.error_rate(F.col("a"), F.col("b"), F.lit("en")).alias("e")).collect():
        a, b = pairs[r["i"]]
        expected = 0.0 if not a and not b else 1.0 if not a else model_distance(a, b) / len(a)
        assert math.isclose(r["e"], expected)


def test_language_and_forms(spark):
    df = spark.createDataFrame([(0, "你好 World"), (1, "It's 5!"), (2, ""), (3, None)], "i int, t string")
    rows = {r["i"]: r for r in df.select("i", X.language(F.col("t")).alias("l"), X.normalized(F.col("t"), F.lit("en")).alias("en"), X.normalized(F.col("t"), F.lit("zh")).alias("zh"), X.text_units(F.col("t"), X.language(F.col("t"))).alias("u")).collect()}
    assert [rows[i]["l"] for i in range(4)] == ["zh", "en", "auto", "auto"]
    assert rows[0]["zh"] == "你好world" and rows[0]["u"] == 2
    assert rows[1]["en"] == "it's 5" and rows[3]["en"] == ""


def test_nfkc_and_transcript(spark):
    df = spark.createDataFrame([("<|zh|>ｆｕｌｌ▁width",), (None,)], "t string")
    assert [r[0] for r in df.select(X.nfkc(X.clean_transcript(F.col("t")))).collect()] == ["full width", None]


def test_chinese_error_rate_counts_characters(spark):
    df = spark.createDataFrame([("明天见", "后天见")], "a string, b string")
    assert math.isclose(df.select(X.error_rate(F.col("a"), F.col("b"), F.lit("zh"))).first()[0], 1 / 3)


def test_coercion_and_slug(spark):
    df = spark.createDataFrame([(" 1.5 ", "Yes", "a b/c"), ("", "off", "??"), ("x", None, None)], "f string, b string, s string")
    rows = df.select(X.to_float(F.col("f")), X.to_bool(F.col("b"), True), X.slug(F.col("s"))).collect()
    assert [tuple(r) for r in rows] == [(1.5, True, "a_b_c"), (None, False, "item"), (None, True, "item")]


def test_ratio_cosine_pearson(spark):
    df = spark.createDataFrame([(1.0, 0.0, [1.0, 0.0], [0.0, 0.0]), (3.0, 2.0, [1.0, 1.0], [1.0, 0.0])], "a double, b double, x array<double>, y array<double>")
    rows = df.select(num.safe_ratio(F.col("a"), F.col("b")), num.cosine(F.col("x"), F.col("y"))).collect()
    assert tuple(rows[0]) == (None, None) and rows[1][0] == 1.5 and math.isclose(rows[1][1], 0.5**0.5)
    assert df.agg(num.pearson(F.col("a"), F.col("b"))).first()[0] is None
    flat = spark.createDataFrame([(1.0, float(i)) for i in range(5)], "x double, y double")
    assert flat.agg(num.pearson(F.col("x"), F.col("y"))).first()[0] is None


def test_segments_keep_known_words(spark):
    df = spark.createDataFrame([("明天 go,后天abc1",)], "t string")
    assert df.select(X.segments(F.col("t"), ("明天", "后天"))).first()[0] == ["明天", "go", "后天", "abc1"]


def test_word_errors_over_large_vocabularies(spark):
    n = 70_000  # past the surrogates
    a = [f"w{i}" for i in range(n)]
    v = spark.createDataFrame([(a, [a[5], a[54_000], a[56_500], a[-1], a[5]])], "v array<string>, w array<string>")
    s = v.select(X.as_symbols(F.col("w"), F.col("v")).alias("s")).first()["s"]
    assert len(s) == 5 and len(set(s)) == 4 and s[0] == s[4]


def test_array_pearson(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    a, b = rng.standard_normal((2, 40)).tolist()
    holes = [float("nan"), None, float("inf"), *a[3:]]
    rows = [(1, a, b), (2, holes, b), (3, [1.0, 2.0], [3.0, 5.0]), (4, [1.0] * 5, [1.0, 2.0, 3.0, 4.0, 5.0]), (5, None, b)]
    got = {r["i"]: r["c"] for r in spark.createDataFrame(rows, "i int, a array<double>, b array<double>").select("i", num.array_pearson(F.col("a"), F.col("b")).alias("c")).collect()}
    assert math.isclose(got[1], np.corrcoef(a, b)[0, 1], rel_tol=1e-9) and math.isclose(got[2], np.corrcoef(a[3:], b[3:])[0, 1], rel_tol=1e-9)
    assert got[3] is got[4] is got[5] is None


def turns(spark, sf):
    """Consecutive user and assistant turns as the views give them, by plain Python."""
    import re

    rows = {(r["conv_id"], r["turn"]): r for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()}
    plain = lambda t: re.sub("[^a-z0-9 ]+", " ", t.lower()).strip(" ")
    return {k: (plain(r["text"]), plain(rows[k[0], k[1] + 1]["text"])) for k, r in rows.items() if r["role"] == "user" and (k[0], k[1] + 1) in rows and rows[k[0], k[1] + 1]["role"] == "assistant"}


def score(reference, heard):
    return None if not reference or not heard else max(0.0, 1 - model_distance(reference, heard) / len(reference))


def test_queries_over_transcripts_against_plain_versions(spark, sf):
    from tessera.registry import QUERIES

    pairs = turns(spark, sf)
    assert len(pairs) > 20 and max(len(a) for a, _ in pairs.values()) > 200
    run = lambda name: {(r["conv_id"], r["turn"]): r for r in QUERIES[name](spark, sf).collect()}
    words, mismatch, repeats, cut, against = (run(n) for n in ("x05_word_error_rate", "q04_transcript_mismatch", "q06_repetition", "q07_truncation", "x08_repetition_against_expected"))
    assert set(words) == set(mismatch) == set(repeats) == set(cut) == set(against) == set(pairs)
    for (conv, turn), (a, b) in pairs.items():
        k, e, h = (conv, turn), a.split(), b.split()
        assert math.isclose(words[k]["err"], round(0.0 if not e and not h else 1.0 if not e else model_distance(e, h) / len(e), 6), abs_tol=2e-6)
        s = score(e, h)
        flags = ["tgt_asr_error"] * (turn % 3 == 0) + ["tgt_asr_mismatch"] * (s is not None and s < 0.65)
        dense = len(e) / 5 > 4.5
        runs, loops = (lambda x: model_run(x) >= 4 and model_run(x) >= model_run(e) + 2), (lambda x: model_repeat(x) >= 3 and model_repeat(x) >= model_repeat(e) + 1)
        own = lambda x: ["tgt_asr_stutter_suspect"] * bool(x and runs(x)) + ["tgt_asr_loop_suspect"] * bool(x and loops(x))
        ref_dense = ["ref_text_density_high"] * (len(e) / 30 > 4.5)
        truncated = ["tgt_truncation_suspect"] * (s is not None and s < 0.65)  # the tail is abrupt on all of them
        floor = ["speaker_sim_missing"]
        assert mismatch[k]["flags"] == "|".join([*flags, *ref_dense, *["tgt_text_density_high"] * dense, *own(h), *truncated, *floor]), k
        heard = " ".join([b.split(" ")[0]] * (turn % 6) + [b]).split() if turn % 6 else h
        s = score(e, heard)
        assert repeats[k]["flags"] == "|".join(own(heard))
        assert cut[k]["flags"] == "|".join(["tgt_truncation_suspect"] * (s is not None and s < 0.65 and (turn % 2 == 0 or dense)))
        three = h * 3
        assert against[k]["run"] == model_run(three) and against[k]["loops"] == (model_repeat(three) > model_repeat(e))


def test_item_clusters_against_a_plain_version(spark, sf):
    import numpy as np

    from tessera.registry import QUERIES

    rows = {r["vec_id"]: np.array(r["embedding"], float) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    got = {(r["item"], r["idx"]): r["cluster"] for r in QUERIES["v04_item_clusters"](spark, sf).collect()}
    assert set(got) == {(i // 8, i) for i in rows}
    for item in {i // 8 for i in rows}:
        groups = [frozenset([i]) for i in rows if i // 8 == item]
        cos = lambda x, y: float(rows[x] @ rows[y] / np.linalg.norm(rows[x]) / np.linalg.norm(rows[y]))
        while len(groups) > 1:
            mean, a, b = max((np.mean([cos(x, y) for x in a for y in b]), a, b) for n, a in enumerate(groups) for b in groups[:n])
            if mean < 0.1:
                break
            groups = [g for g in groups if g not in (a, b)] + [a | b]
        assert {frozenset(i for i in rows if i // 8 == item and got[item, i] == c) for c in {got[item, i] for i in rows if i // 8 == item}} == set(groups)
