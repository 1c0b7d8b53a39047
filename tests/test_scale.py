"""What is computed once, what is shuffled, and numbers and choices over tables of several files or with ties."""

import time

from pyspark.sql import functions as F

from tessera import registry
from tessera.functions import num, seq, text as X
from tessera.operators import spans


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_ordinal_over_several_files(spark, tmp_path):
    at = f"{tmp_path}/documents.parquet"
    for ids in ([40, 7, None], [3, 10**12, -5], [8]):
        spark.createDataFrame([(i, "x") for i in ids], "doc_id long, text string").coalesce(1).write.mode("append").parquet(at)
    got = {(r["doc_id"], r["ordinal"]) for r in registry.QUERIES["s03_file_ordinal"](spark, str(tmp_path)).collect()}
    assert got == {(-5, 0), (3, 1), (7, 2), (8, 3), (40, 4), (10**12, 5), (None, 6)}


def test_medoid_of_equal_means(spark, tmp_path):
    rows = [(i, [1.0, float(i % 2)]) for i in reversed(range(32))]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r["item"]: r["medoid"] for r in registry.QUERIES["v05_medoid"](spark, str(tmp_path)).collect()}
    assert got == {0: 0, 1: 8, 2: 16, 3: 24}
def test_tokens_are_made_once(spark):
    df = spark.createDataFrame([("a b a b c",), ("",), (None,)], "t string")
    tokens = X.tokens(F.col("t"), F.lit("en"))
    got = df.select(seq.max_ngram_repeat(tokens).alias("n"))
    assert _plan(got).count("split(") == 1 and [r["n"] for r in got.collect()] == [2, 1, 1]
    score = df.select(X.match_score(F.col("t"), F.lit("a b a x c"), F.lit("en")).alias("n"))
    assert _plan(score).count("lower(") <= 1 and [r["n"] for r in score.collect()] == [0.8, None, None]


def test_correlation_takes_each_mean_once(spark):
    df = spark.createDataFrame([([1.0, 2.0, 4.0, None], [2.0, 4.0, 8.0, 1.0]), ([1.0, 1.0, 1.0], [1.0, 2.0, 3.0]), ([1.0], [2.0]), (None, [1.0])], "a array<double>, b array<double>")
    got = df.select(F.round(num.array_pearson(F.col("a"), F.col("b")), 9).alias("r"))
    assert _plan(got).count("arrays_zip(") == 1 and [r["r"] for r in got.collect()] == [1.0, None, None, None]


ROW = "audio_id string, words array<struct<text string, start_ms bigint, end_ms bigint>>"


def test_spans_of_a_long_text(spark):
    words = ["abcdefgh"] * 40_000
    words[7:9] = ["xan,", "dthey"]
    rows = spark.createDataFrame([("long", [(w, i, i + 1) for i, w in enumerate(words)]), ("none", [("b", 0, 1)]), ("null", None)], ROW)
    began = time.time()
    got = [tuple(r) for r in spans.select_spans(rows, "regex", regex="andthe").collect()]
    assert got == [("long", 0, 7, 9, ["xan,", "dthey"], [7, 8])] and time.time() - began < 30


def test_spans_by_words_in_between_without_letters(spark):
    rows = spark.createDataFrame([("a", [("one", 0, 1), ("--", 1, 2), ("...", 2, 3), ("two", 3, 4), ("!", 4, 5)])], ROW)
    got = [tuple(r)[1:] for r in spans.select_spans(rows, "regex", regex="e--t|wo").orderBy("span").collect()]
    assert got == [(0, 0, 4, ["one", "--", "...", "two"], [0, 1, 2, 3]), (1, 3, 4, ["two"], [3])]
    got = [tuple(r)[1:] for r in spans.select_spans(rows, "filler_words", filler_word_list=["t.wo", None, "--"]).orderBy("span").collect()]
    assert got == [(0, 1, 2, ["--"], [1]), (1, 3, 4, ["two"], [3])]


def test_spans_shuffle_hits_only(spark, sf):
    for name in ("n02_span_anchor", "n03_span_filler", "n04_span_regex"):
        plan = _plan(registry.QUERIES[name](spark, sf))
        assert "collect_list" not in plan and plan.count("Join") == 0
