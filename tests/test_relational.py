"""Duplicates, nulls and order of the building blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import relational as R
from tessera.operators.relational import first_wins, last_wins, numbered
from tessera.plans.planning import assign_groups


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_first_and_last_wins(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 3, None)], "k string, o int, v string")
    assert rows(R.last_wins(df, ["k"], "o")) == [("a", 2, "y"), ("b", 3, None)]
    assert rows(R.first_wins(df, ["k"], "o")) == [("a", 1, "x"), ("b", 3, None)]


def test_numbered_has_no_gaps(spark):
    ids = sorted(np.random.default_rng(1).choice(100_000, 500, replace=False).tolist())
    df = spark.createDataFrame([(i,) for i in ids], "i long")
    got = sorted((r["i"], r["n"]) for r in R.numbered(df, "i", "n", width=1000).collect())
    assert got == [(i, k) for k, i in enumerate(ids)]


def test_overlay_takes_nulls_of_a_match(spark):
    left = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "k int, v string, w int")
    right = spark.createDataFrame([(1, None, 9)], "k int, v string, z int")
    assert rows(R.overlay(left, right, ["k"])) == [(1, None, 5, 9), (2, "b", 6, None)]


def test_upsert_ignores_empty_keys(spark):
    main = spark.createDataFrame([(1, "p", ""), (2, "q", "r"), (3, None, "s")], "id int, a string, b string")
    new = spark.createDataFrame([(10, "", "p"), (11, "s", "")], "id int, a string, b string")
    assert rows(R.upsert_by_any_key(main, new, ["a", "b"], "id")) == [(10, "", "p"), (11, "s", ""), (2, "q", "r")]


def test_lookup_prefers_direct_then_first_alias(spark):
    s = spark.createDataFrame([(0, "p", "x", 1), (1, "p", "y", 2), (2, "x", "z", 3), (3, "q", "z", 4)], "o int, path string, alias string, v int")
    got = {r["path"]: r["v"] for r in R.lookup_table(s, "path", ["alias"], "o").collect()}
    assert got == {"p": 2, "x": 3, "q": 4, "y": 2, "z": 3}


def test_drop_reasons_in_order_and_unknown_fails(spark):
    df = spark.createDataFrame([(1, 5), (None, 5), (3, 0)], "a int, b int")
    got = [r[0] for r in df.select(R.drop_reasons(df, [("a", "a >= 1"), ("b", "b >= 1")])).collect()]
    assert got == [None, "a", "b"]


def test_merged_intervals(spark):
    df = spark.createDataFrame([(0, 0, 10), (0, 12, 20), (0, 40, 41), (0, 2, 30)], "k int, s int, e int")
    assert rows(R.merged_intervals(df, ["k"], "s", "e", 5, 2)) == [(0, 0, 30)]


def test_ring_pick_is_never_the_row_itself(spark):
    df = spark.range(50).withColumnRenamed("id", "r")
    picks = df.select("r", R.ring_pick(df, "r", F.lit(50), "1", "r", 0).alias("at")).collect()
    assert all(p["r"] != p["at"] and 0 <= p["at"] < 50 for p in picks) and len({p["at"] for p in picks}) > 20


def test_greedy_groups_balance(spark):
    df = spark.createDataFrame([("a", 9), ("b", 7), ("c", 6), ("d", 5), ("e", 5)], "k string, w long")
    got = {r["k"]: r["grp"] for r in assign_groups(df, "w", ["k"], 2).collect()}
    assert got == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 1}


def test_fallback_only_where_missing(spark):
    main = spark.createDataFrame([("a", 1)], "k string, v int")
    extra = spark.createDataFrame([("a", 9), ("b", 3), ("b", 2)], "k string, v int")
    assert rows(R.with_fallback(main, extra, "k", "v")) == [("a", 1), ("b", 2)]


ALIGNMENT = [("明天", 0, 320), ("下午", 320, 650), ("两点", 650, 980), ("我", 980, 1080), ("们", 1080, 1180), ("开", 1180, 1280), ("会", 1280, 1380)]


def test_spans(spark):
    from tessera.operators import spans

    rows = spark.createDataFrame([("s.wav", ALIGNMENT), ("none", [])], "audio_id string, words array<struct<text string, start_ms bigint, end_ms bigint>>")
    pick = lambda mode, **p: [tuple(r)[1:4] + (list(r["anchor_word_indices"]),) for r in spans.select_spans(rows, mode, **p).where("audio_id = 's.wav'").orderBy("span").collect()]
    assert pick("anchor_word", anchor_word="明天。") == [(0, 0, 320, [0])] and pick("anchor_word", anchor_word="没有") == []
    assert pick("regex", regex="两点我们") == [(0, 650, 1180, [2, 3, 4])]
    assert pick("regex", regex="天|开|会") == [(0, 0, 320, [0]), (1, 1180, 1280, [5]), (2, 1280, 1380, [6])]
    assert pick("filler_words", filler_word_list=["我", "会", ""]) == [(0, 980, 1080, [3]), (1, 1280, 1380, [6])]
    assert pick("manual_span", start_ms=5, end_ms=9) == [(0, 5, 9, [])]
    assert spans.select_spans(rows, "filler_words", filler_word_list=[]).count() == 0
    with pytest.raises(ValueError):
        spans.select_spans(rows, "other")


def test_fallback_alignment(spark):
    from tessera.operators import spans

    rows = spark.createDataFrame([("a", "明天下午开会", 1000), ("b", "", 500), ("c", "明天 is fine!", 7)], "audio_id string, ref_text string, duration_ms long")
    got = {r["audio_id"]: r["words"] for r in spans.fallback_alignment(rows, ("明天", "下午")).collect()}
    assert [w["text"] for w in got["a"]] == ["明天", "下午", "开", "会"] and sum(w["syllables"] for w in got["a"]) == 6 and got["b"] == []
    assert [(w["start_ms"], w["end_ms"]) for w in got["a"]] == [(0, 333), (333, 667), (667, 833), (833, 1000)]
    assert [w["text"] for w in got["c"]] == ["明天", "isfine"] and got["c"][-1]["end_ms"] == 7
    words = [{"text": "a", "start_ms": 0, "end_ms": 100}, {"text": "b", "start_ms": 250, "end_ms": 300}, {"text": "c", "start_ms": 399, "end_ms": 420}]
    df = spark.createDataFrame([(words,), ([],)], "w array<struct<text string, start_ms bigint, end_ms bigint>>")
    assert [[tuple(p) for p in r[0]] for r in df.select(spans.pauses(F.col("w"))).collect()] == [[(0, 100, 150)], []]


def test_constructors_of_both_languages(spark):
    from tessera import config
    from tessera.operators import pairs

    zh, en = pairs.constructors(config.ZH), pairs.constructors(config.EN)
    assert dict(zh["B"].rules)["edit_not_neutral"] == "e_neutral >= 0.7" and dict(en["B"].rules)["edit_not_neutral"] == "e_neutral >= 0.3"
    assert dict(zh["D"].rules)["cosine"] == "ro_cos >= 0.95" and dict(zh["D_cross_emo"].rules)["neutral_max"] == "r_neutral <= 0.5 AND o_neutral <= 0.5"
    assert "edit_sv" in dict(zh["H2"].rules) and "edit_sv" not in dict(en["H2"].rules) and dict(zh["H2"].rules)["ref_top1"] == "r_top1 = 'neutral'"
    schema = "source_row_index long, edit_tag string, ref_audio string, edited_audio string, e_neutral double, r_neutral double, e_top1 string, r_top1 string, e_sv string, ref_text string, instruction string"
    rows = [
        (0, "style_radio", "r0", "e0", 0.95, 0.6, "neutral", "neutral", "neutral", "t", "i"),
        (1, "style_radio", "r1", "e1", 0.95, 0.6, "neutral", "neutral", "happy", "t", "i"),  # the second labeller disagrees
        (2, "style_radio", "r2", "e2", 0.95, 0.6, "neutral", "sad", "neutral", "t", "i"),
        (3, "style_radio", "r3", "e3", 0.95, 0.96, "neutral", "neutral", "neutral", "t", "i"),  # not more neutral
        (4, "style_news", "r4", "e4", 0.95, 0.6, "neutral", "neutral", "neutral", "t", "i"),
        (5, "style_radio", "r5", "e5", 0.95, None, "neutral", None, "neutral", "t", "i"),
        (6, "style_radio", "r6", "e6", 0.95, 0.1, "unk", "sad", "neutral", "t", "i"),
    ]
    df = spark.createDataFrame(rows, schema)
    kept = lambda c: [r["source_row_index"] for r in c.build(df).orderBy("pair_id").collect()]
    assert kept(zh["H2"]) == [0] and kept(zh["B"]) == [2, 5] and kept(zh["C"]) == [2, 5] and kept(en["B"]) == []
    margin = {**config.ZH, "h2": {**config.ZH["h2"], "target_more_neutral_margin": 0.4}}
    assert kept(pairs.constructors(margin)["H2"]) == []
    selfed = pairs.constructors({**config.ZH, "h2": {**config.ZH["h2"], "mode": "self"}})["H2"]
    assert kept(selfed) == [0, 2, 3, 5] and {r["reference_audio"] == r["target_audio"] for r in selfed.build(df).collect()} == {True}
    record = zh["B"].records(df, ("from {ref_emotion} to {tgt_emotion}",), split="s").orderBy("pair_id").first()
    assert record["pair_id"] == "s_B_000000" and record["instruction"] == "from neutral to sad" and record["reference_text"] == "t" and record["tgt_emotion"]["top1_label"] == "sad" and record["meta"]["editx_instruction"] == "i"


def test_transfer_and_speed_pairs(spark):
    from tessera.operators import pairs

    jobs = spark.createDataFrame([(i, 10 - i, f"p{i}", "pt", f"v{i}", f"out{i}", "") for i in range(6)], "job_id long, source_row_index long, prosody_ref_audio string, prosody_ref_text string, timbre_ref_audio string, output_audio string, target_text string")
    results = spark.createDataFrame([(0, 1, True, "a0"), (1, 1, True, ""), (2, 1, False, "a2"), (3, 1, True, "a3"), (3, 2, False, "b3"), (5, 1, None, "a5")], "job_id long, ordinal long, ok boolean, audio string")
    got = [tuple(r)[:6] for r in pairs.transfer_pairs(jobs, results).select("pair_id", "job_id", "target_audio", "target_text", "timbre_ref_audio", "pair_type").orderBy("pair_id").collect()]
    assert got == [("I_000000", 1, "out1", "pt", "v1", "I"), ("I_000001", 0, "a0", "pt", "v0", "I")]
    there = spark.createDataFrame([("a0",)], "path string")
    assert [r["job_id"] for r in pairs.transfer_pairs(jobs, results, existing=there).collect()] == [0]
    report = spark.createDataFrame([(0, "up", "a", "t", "x", None), (1, "other", "a", "t", "x", "u"), (2, "down", "a", "t", "", "u"), (3, "down", "b", "t", "y", "u")], "source_row_index long, edit_tag string, audio1 string, text1 string, audio2 string, text2 string")
    got = [(r["pair_id"], r["target_audio"], r["target_text"]) for r in pairs.speed_pairs(report, {"up": "J_fast", "down": "J_slow"}).orderBy("source_row_index").collect()]
    assert got == [("J_fast_000000", "x", "t"), ("J_slow_000001", "y", "u")]


def test_configuration_files(tmp_path):
    import json

    from tessera import config

    at = tmp_path / "c.json"
    at.write_text(json.dumps({"bc": {"edited_neutral_min": 0.4}, "paths": {"vcdata_root": "/a", "outputs_root": "/b"}}))
    got = config.load_config(str(at), {"VCDATA_ROOT": "/c"})
    assert got["bc"] == {"edited_neutral_min": 0.4} and got["paths"] == {"vcdata_root": "/c", "outputs_root": "/b"}
    assert config.load_config(None, {"PAIR_CONFIG": str(at)})["paths"]["vcdata_root"] == "/a"
    assert config.load_config(None, {})["bc"]["edited_neutral_min"] == 0.7
    yaml = pytest.importorskip("yaml")
    (tmp_path / "c.yaml").write_text(yaml.safe_dump({"d": {"cosine_min": 0.9}}))
    assert config.load_config(str(tmp_path / "c.yaml"), {})["d"] == {"cosine_min": 0.9}


def test_numbers_of_sparse_ordinals(spark):
    import random

    rng = random.Random(2)
    at = sorted({rng.randrange(10**15) for _ in range(300)} | {10**17 + i for i in range(200)})
    df = spark.createDataFrame([(x,) for x in at], "o long").repartition(5)
    got = {r["o"]: r["n"] for r in numbered(df, "o", "n", width=50, sparse=True).collect()}
    assert got == {x: i for i, x in enumerate(at)}
    assert numbered(df.where("false"), "o", "n", sparse=True).count() == 0


def test_wins_with_null_ordinals_and_keys(spark):
    rows = [(1, None, "a"), (1, 5, "b"), (1, 7, "c"), (None, 1, "d"), (None, 0, "e"), (2, None, "f")]
    df = spark.createDataFrame(rows, "k int, o int, v string")
    assert sorted((r["v"] for r in last_wins(df, ["k"], "o").collect())) == ["c", "d", "f"]
    assert sorted((r["v"] for r in first_wins(df, ["k"], "o").collect())) == ["a", "e", "f"]
