"""The gate's traps: unknown values, soft flags that still gate, floors."""

import pytest
from pyspark.sql import functions as F

from tessera.config import Gate
from tessera.operators.quality import judge, prosody_flags, rejections

GOOD = {"reference_text": "good day", "target_text": "good day", "reference_audio": "r", "target_audio": "t", "ref_load_ok": True, "tgt_load_ok": True, "ref_duration_sec": 3.0, "tgt_duration_sec": 3.0, "speaker_similarity": 0.9, "ref_top1_label": "neutral", "tgt_top1_label": "happy", "ref_p_neutral": None, "tgt_p_neutral": None, "ref_dnsmos_ovrl": None, "tgt_dnsmos_ovrl": None, "ref_asr_text": "good day", "tgt_asr_text": "good day", "tgt_asr_ok": True}
SCHEMA = "reference_text string, target_text string, reference_audio string, target_audio string, ref_load_ok boolean, tgt_load_ok boolean, ref_duration_sec double, tgt_duration_sec double, speaker_similarity double, ref_top1_label string, tgt_top1_label string, ref_p_neutral double, tgt_p_neutral double, ref_dnsmos_ovrl double, tgt_dnsmos_ovrl double, ref_asr_text string, tgt_asr_text string, tgt_asr_ok boolean"


def one(spark, pair_name, gate=Gate(), **changes):
    row = GOOD | changes
    return judge(spark.createDataFrame([tuple(row[k] for k in GOOD)], SCHEMA), pair_name, gate).first()


@pytest.mark.parametrize(
    ("pair_name", "changes", "flags", "passed"),
    [
        ("B", {}, [], 1),
        ("B", {"ref_dnsmos_ovrl": 1.0}, ["ref_dnsmos_low"], 1),
        ("B", {"tgt_dnsmos_ovrl": 1.0}, ["tgt_dnsmos_low"], 0),
        ("B", {"ref_top1_label": None}, ["semantic_ref_not_neutral"], 0),
        ("B", {"tgt_top1_label": None}, ["semantic_tgt_not_non_neutral"], 0),
        ("B", {"target_text": ""}, ["semantic_missing_text"], 0),
        ("B", {"speaker_similarity": None}, ["speaker_sim_missing"], 0),
        ("B", {"speaker_similarity": 0.59}, ["speaker_sim_low"], 0),
        ("A", {"target_text": "other"}, ["tgt_asr_mismatch"], 0),
        ("H3", {"target_text": "day good sir", "tgt_asr_text": None, "speaker_similarity": None}, [], 1),
        ("H3", {"tgt_asr_text": None, "target_audio": "r"}, ["semantic_same_audio", "semantic_same_text"], 0),
        ("C", {}, ["semantic_ref_not_non_neutral", "semantic_tgt_not_neutral"], 0),
        ("D", {"ref_top1_label": "sad"}, ["semantic_top1_not_same"], 0),
        ("D_cross_emo", {"ref_top1_label": "sad"}, [], 1),
        ("A", {"tgt_load_ok": None, "tgt_asr_text": None}, ["tgt_audio_load_failed"], 0),
        ("A", {"tgt_asr_ok": False}, ["tgt_asr_error"], 0),
        ("A", {"tgt_asr_text": "good good good good good day"}, ["tgt_asr_mismatch", "tgt_asr_stutter_suspect"], 0),
        ("A", {"tgt_duration_sec": 0.3}, ["tgt_too_short", "tgt_text_density_high"], 0),
    ],
)
def test_flags(spark, pair_name, changes, flags, passed):
    r = one(spark, pair_name, **changes)
    assert r["flags"] == flags and r["qc_pass"] == passed


def test_unchecked_semantics_are_null(spark):
    assert one(spark, "A")["semantic_ok"] is None and one(spark, "B")["semantic_ok"] == 1


def test_more_neutral_tolerates_rounding(spark):
    same = {"ref_top1_label": "neutral", "tgt_top1_label": "neutral", "ref_p_neutral": 0.9, "tgt_p_neutral": 0.9}
    assert one(spark, "H2", **same)["flags"] == []
    assert one(spark, "H2", **same | {"tgt_p_neutral": 0.8})["flags"] == ["semantic_tgt_not_more_neutral"]


def test_truncation_needs_mismatch_and_density(spark):
    long = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    r = one(spark, "A", target_text=long, tgt_asr_text="one two three")
    assert "tgt_truncation_suspect" in r["hard_fail_flags"] and "tgt_text_density_high" in r["soft_fail_flags"]


def test_gates_can_be_opened(spark):
    gate = Gate(fail_on_speaker_sim=False, fail_on_semantic=False)
    r = one(spark, "B", gate, speaker_similarity=0.1, ref_top1_label="sad")
    assert r["flags"] == ["semantic_ref_not_neutral", "speaker_sim_low"] and r["qc_pass"] == 1


def test_sim_floor_takes_first_positive():
    assert Gate().sim_floor("D_st") == 0.7 and Gate().sim_floor("I") == 0.55 and Gate().sim_floor("H3") is None


def test_speed_pairs_need_metrics(spark):
    df = spark.createDataFrame([(None,)], "prosody_metrics struct<speed_direction_pass:double>")
    assert df.select(F.array_compact(F.array(*prosody_flags(df, "J_fast", Gate())))).first()[0] == ["prosody_metrics_missing"]
    df = spark.createDataFrame([((0.0,),), ((1.0,),)], "prosody_metrics struct<speed_direction_pass:double>")
    assert [r[0] for r in df.select(F.array_compact(F.array(*prosody_flags(df, "J_fast", Gate())))).collect()] == [["speed_direction_fail"], []]


def test_rejections_name_their_stage(spark):
    rows = [GOOD, GOOD | {"tgt_dnsmos_ovrl": 1.0}, GOOD | {"ref_top1_label": "sad"}, GOOD | {"speaker_similarity": 0.0}]
    df = spark.createDataFrame([tuple(r[k] for k in GOOD) for r in rows], SCHEMA)
    got = sorted((r["reject_stage"], r["reject_reason"]) for r in rejections(judge(df, "B")).collect())
    assert got == [("hard", "tgt_dnsmos_low"), ("semantic", "semantic_ref_not_neutral"), ("speaker_sim", "speaker_sim_low")]
