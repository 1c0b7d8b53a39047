"""Round trips and discovery."""

import io
import wave

import numpy as np
import pytest

from tessera.operators.filters import require_subset
from tessera.sources import audio, files
from tessera.streaming import incremental


def wav(x, rate=8000):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1), w.setsampwidth(2), w.setframerate(rate)
        w.writeframes((np.clip(x, -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def test_strict_scan_raises_and_lenient_skips(spark, tmp_path):
    at = tmp_path / "a.jsonl"
    at.write_text('{"a": 1}\n\nnot json\n{"a": 2}\n')
    assert sorted(r[0] for r in files.read_jsonl(spark, str(at), "a long", strict=False).collect()) == [1, 2]
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        files.read_jsonl(spark, str(at), "a long").collect()


def test_nulls_stay_in_json(spark, tmp_path):
    files.write_jsonl(spark.createDataFrame([(1, None)], "a int, b string"), f"{tmp_path}/o")
    assert spark.read.text(f"{tmp_path}/o").first()[0] == '{"a":1,"b":null}'


def test_quotes_survive_csv(spark, tmp_path):
    files.write_csv([spark.createDataFrame([('say "hi", you', ["x", "y"])], "t string, l array<string>")], f"{tmp_path}/c", lists=("l",))
    assert tuple(files.read_csv(spark, f"{tmp_path}/c").first()) == ('say "hi", you', "x|y")


def test_audio_files(spark, tmp_path):
    t = np.arange(8000) / 8000
    (tmp_path / "a").mkdir()
    (tmp_path / "a/split_0001_x.wav").write_bytes(wav(np.where(t < 0.5, np.sin(2000 * t), 0)))
    (tmp_path / "a/bad_0002_x.wav").write_bytes(b"no")
    rows = {r["path"].rsplit("/", 1)[1]: r for r in audio.read_audio(spark, f"{tmp_path}/a").collect()}
    assert rows["bad_0002_x.wav"]["samples"] is None and rows["bad_0002_x.wav"]["error"]
    h = audio.health(np.array(rows["split_0001_x.wav"]["samples"]), 8000)
    assert h["duration_sec"] == 1.0 and abs(h["silence_ratio"] - 0.5) < 0.02 and abs(h["trailing_silence_sec"] - 0.5) < 0.03
    p = audio.prosody(np.array(rows["split_0001_x.wav"]["samples"]), 8000)
    assert len(p["energy"]) == 200 and abs(p["silence_ratio"] - 0.5) < 0.02 and p["pause_count"] == 1 and abs(p["pause_max_sec"] - 0.5) < 0.02 and p["f0"] is None
    index = files.audio_index(files.listing(spark, f"{tmp_path}/a"), [r"split_(\d+)_", r"bad_(\d+)_"])
    assert sorted(r["idx"] for r in index.collect()) == [1, 2]


def test_silence_has_no_level():
    h = audio.health(np.zeros(8000), 8000)
    assert h["silence_ratio"] == 1.0 and h["rms"] < 1e-9 and h["clip_ratio"] == 0.0 and h["leading_silence_sec"] == h["trailing_silence_sec"] == 1.0
    assert audio.health(np.zeros(0), 8000) == {"load_ok": False, "error": "empty_audio"}
    with pytest.raises(ValueError):
        audio.prosody(np.zeros(0), 8000)


def test_silence_is_measured_against_samples():
    # a short loud burst: the 95th percentile of samples is the quiet level, that of frame levels would be higher
    x = np.concatenate([np.full(7000, 0.002), np.full(1000, 0.5)])
    h = audio.health(x, 8000)
    assert h["silence_ratio"] == pytest.approx(43 / 50) and h["leading_silence_sec"] == pytest.approx(0.86) and h["trailing_silence_sec"] == 0
    x = np.concatenate([np.full(7800, 0.002), np.full(200, 0.5)])
    assert audio.health(x, 8000)["silence_ratio"] == 0  # 2 % of 0.002 is under the level of every frame
    assert audio.tail_stats(np.concatenate([np.ones(100), np.full(50, 0.01), np.zeros(50)]), 100)["tail_silence_sec"] == 1.0  # 0.01 isn't over 0.01
    assert audio.tail_stats(np.zeros(0), 100)["tail_silence_ratio"] is None


def test_contours_are_interpolated_between_finite_values():
    x = np.array([0.0, np.nan, 2.0, 4.0])
    assert audio.resized(x, 7).tolist() == pytest.approx([0, 0.5, 1, 1.5, 2, 3, 4])
    assert np.isnan(audio.resized(np.array([1.0, np.nan]), 3)).all()


def test_clusters_by_average_link(spark):
    s = np.array([[1, 0.9, 0.1], [0.9, 1, 0.2], [0.1, 0.2, 1]])
    assert audio.clusters(s, 0.5) == [[0, 1], [2]]
    df = spark.createDataFrame([(1, 0, [1.0, 0.0]), (1, 1, [0.9, 0.1]), (1, 2, [0.0, 1.0])], "item long, idx long, v array<double>")
    assert sorted((r["idx"], r["cluster"]) for r in audio.item_clusters(df, "item", "idx", "v", 0.5).collect()) == [(0, 0), (1, 0), (2, 1)]


def test_report_and_publish(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    assert "| a | 1 |" in files.markdown(df, "Title")
    files.write_jsonl(df, f"{tmp_path}/staged")
    assert not files.publish(f"{tmp_path}/staged", f"{tmp_path}/final", 2, spark)
    assert files.publish(f"{tmp_path}/staged", f"{tmp_path}/final", 1, spark)
    assert files.read_jsonl(spark, f"{tmp_path}/final", "k string, n int").count() == 1


def test_subset_check():
    assert require_subset(["a"], ["a", "b"]) == ["a"]
    with pytest.raises(ValueError, match="z"):
        require_subset(["z"], ["a"])


def test_stream_takes_up_where_it_ended(spark, tmp_path):
    (tmp_path / "in").mkdir()
    run = lambda: incremental.run_available(incremental.normalized_stream(incremental.manifest_stream(spark, f"{tmp_path}/in", "audio string, text string"), "text", "audio"), f"{tmp_path}/out", f"{tmp_path}/ck")
    (tmp_path / "in/1.json").write_text('{"audio": "a", "text": "你好"}\n{"audio": "", "text": "x"}\n')
    run()
    (tmp_path / "in/2.json").write_text('{"audio": "b", "text": "hello"}\n')
    run()
    got = spark.read.schema("audio string, text string, language string").json(f"{tmp_path}/out")
    assert sorted((r["audio"], r["language"]) for r in got.collect()) == [("a", "zh"), ("b", "en")]


def test_plans_push_filters_and_prune(spark, sf):
    from tessera import registry

    plan = registry.Inputs(spark, sf).sql("SELECT p_partkey FROM {part} WHERE p_size >= 10 + 5")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(p_size,15)" in plan and "p_retailprice" not in plan.split("ReadSchema")[-1]
    plan = registry.QUERIES["j12_resume"](spark, sf)._jdf.queryExecution().toString()
    assert "LeftAnti" in plan


def test_documents_columns_and_cached_index(spark, tmp_path):
    files.write_json(spark, f"{tmp_path}/j", {"b": 1, "a": "é"})
    assert files.read_json(spark, f"{tmp_path}/j") == {"a": "é", "b": 1}
    df = spark.createDataFrame([(1, 2, 3)], "_x int, text int, y int")
    assert files.without_private(df).columns == ["text", "y"] and files.first_column(df, ("audio", "text")) == "text"
    with pytest.raises(ValueError, match="none of"):
        files.first_column(df, ("q",))
    calls = []
    build = lambda: calls.append(1) or spark.range(3)
    assert [files.load_or_build(spark, f"{tmp_path}/i", build, force).count() for force in (False, False, True)] == [3, 3, 3] and len(calls) == 2
