"""Audio as rows: PCM files to samples (s21), and figures that need whole signals (v04, v07, v08, v12, v13)."""

from __future__ import annotations

import io
import wave

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import num


def decode(data: bytes) -> tuple[np.ndarray, int]:
    """Mono samples from -1 to 1 and the rate of a PCM WAV file."""
    with wave.open(io.BytesIO(data)) as w:
        raw, width, channels, rate = w.readframes(w.getnframes()), w.getsampwidth(), w.getnchannels(), w.getframerate()
    kind = {1: np.uint8, 2: "<i2", 4: "<i4"}[width]
    x = np.frombuffer(raw, kind).astype(float)
    x = (x - 128) / 128 if width == 1 else x / float(1 << (8 * width - 1))
    return x.reshape(-1, channels).mean(axis=1), rate


def read_audio(spark: SparkSession, path: str) -> DataFrame:
    """(path, samples, rate, error) of the WAV files; one that can't be read has null samples and an error."""

    def work(frames):
        for pdf in frames:
            rows = []
            for p, data in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    x, rate = decode(bytes(data))
                    rows.append((p, x.tolist(), rate, None))
                except Exception as e:
                    rows.append((p, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "samples", "rate", "error"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    return files.mapInPandas(work, "path string, samples array<double>, rate int, error string")


def _framed(x: np.ndarray, frame: int, hop: int) -> np.ndarray:
    """Levels (root mean squares, at least 1e-6) of frames that begin every hop and lie within x; a shorter x is one frame with zeros behind."""
    if len(x) < frame:
        x = np.pad(x, (0, frame - len(x)))
    return np.sqrt((np.lib.stride_tricks.sliding_window_view(x, frame)[::hop] ** 2).mean(axis=1) + 1e-12)


def _silence(x: np.ndarray) -> float:
    """The level at or under which a frame is silent: 2 % of the 95th percentile of absolute samples, at least 1e-4."""
    return max(1e-4, 0.02 * float(np.percentile(np.abs(x), 95)))


def health(x: np.ndarray, rate: int) -> dict:
    """Peak, level, shares of clipped samples and silent frames of 20 ms, silence at both ends, and the level of the last 0.2 s against the whole.
    An empty signal fails to load."""
    if not len(x):
        return {"load_ok": False, "error": "empty_audio"}
    frame = max(1, int(rate * 0.02))
    silent = _framed(np.pad(x, (0, -len(x) % frame)), frame, frame) <= _silence(x)
    loud = np.flatnonzero(~silent)
    level = float(np.sqrt((x**2).mean()) + 1e-12)
    tail = x[-max(1, int(rate * 0.2)) :]
    return {
        "load_ok": True,
        "duration_sec": len(x) / rate,
        "peak": float(np.abs(x).max()),
        "rms": level,
        "clip_ratio": float((np.abs(x) >= 0.999).mean()),
        "silence_ratio": float(silent.mean()),
        "leading_silence_sec": int(loud[0] if len(loud) else len(silent)) * frame / rate,
        "trailing_silence_sec": int(len(silent) - 1 - loud[-1] if len(loud) else len(silent)) * frame / rate,
        "tail_rms_ratio": (float(np.sqrt((tail**2).mean())) + 1e-12) / level,
    }


def tail_stats(x: np.ndarray, rate: int) -> dict:
    """The evaluation's figures: silence behind the last sample over 1 % of the peak, at least 0.01, in seconds and as a share (null if empty)."""
    peak = float(np.abs(x).max(initial=0))
    active = np.flatnonzero(np.abs(x) > max(0.01, 0.01 * peak))
    tail = (len(x) - int(active[-1]) - 1 if len(active) else len(x)) / rate
    return {
        "duration_sec": round(len(x) / rate, 4),
        "rms": round(float(np.sqrt((x**2).mean())), 6) if len(x) else 0.0,
        "peak": round(peak, 6),
        "tail_silence_sec": round(tail, 4),
        "tail_silence_ratio": round(tail * rate / len(x), 4) if len(x) else None,
    }


def resized(values: np.ndarray, points: int) -> np.ndarray:
    """Values at equal distances, by linear interpolation between the finite ones; NaN if fewer than two are."""
    finite = np.isfinite(values)
    if len(values) == points:
        return values
    if finite.sum() < 2:
        return np.full(points, np.nan)
    return np.interp(np.linspace(0, 1, points), np.linspace(0, 1, len(values))[finite], values[finite])


def prosody(x: np.ndarray, rate: int, frame_ms: float = 20, hop_ms: float = 10, pause: float = 0.15, points: int = 200) -> dict:
    """Level and pauses of a signal, with contours of the logarithmic level and of silence. Pauses are runs of silent frames of `pause` seconds
    or more. Pitch needs a tracker and stays null. An empty signal raises ValueError."""
    if not len(x):
        raise ValueError("empty audio")
    frame, hop = max(1, int(rate * frame_ms / 1000)), max(1, int(rate * hop_ms / 1000))
    level = _framed(x, frame, hop)
    silent = level <= _silence(x)
    edge = np.flatnonzero(np.diff(silent, prepend=False, append=False))
    runs = (edge[1::2] - edge[0::2]) * (hop / rate)
    runs = runs[runs >= pause]
    return {
        "duration_sec": len(x) / rate,
        "rms_mean": float(level.mean()),
        "rms_std": float(level.std()),
        "silence_ratio": float(silent.mean()),
        "pause_count": len(runs),
        "pause_total_sec": float(runs.sum()),
        "pause_mean_sec": float(runs.mean()) if len(runs) else 0.0,
        "pause_max_sec": float(runs.max(initial=0.0)),
        "voiced_ratio": None,
        "energy": resized(np.log(level + 1e-6), points).tolist(),
        "pauses": resized(silent.astype(float), points).tolist(),
        "f0": None,
    }


HEALTH = "load_ok boolean, error string, duration_sec double, peak double, rms double, clip_ratio double, silence_ratio double, leading_silence_sec double, trailing_silence_sec double, tail_rms_ratio double"
TAIL = "duration_sec double, rms double, peak double, tail_silence_sec double, tail_silence_ratio double"
PROSODY = "duration_sec double, rms_mean double, rms_std double, silence_ratio double, pause_count int, pause_total_sec double, pause_mean_sec double, pause_max_sec double, voiced_ratio double, energy array<double>, pauses array<double>, f0 array<double>, error string"


def of_signals(signals: DataFrame, figures, rate: int, fields: str) -> DataFrame:
    """(id, fields) from signals (id, samples): a function of samples and rate over each, in Arrow batches. Null samples give nulls, an error its text
    where `error` is among the fields."""
    names = [f.split()[0] for f in fields.split(", ")]

    def one(x):
        if x is None:
            return {}
        try:
            return figures(np.asarray(x, float), rate)
        except ValueError as e:
            return {"error": str(e)}

    def work(frames):
        for pdf in frames:
            found = [one(x) for x in pdf["samples"]]
            yield pd.DataFrame({"id": pdf["id"]} | {n: pd.Series([f.get(n) for f in found], dtype=object) for n in names})

    return signals.select("id", "samples").mapInPandas(work, f"id long, {fields}")


def pair_prosody(pairs: DataFrame, features: DataFrame, reference: str = "reference", target: str = "target") -> DataFrame:
    """pairs with the prosody of both sides compared (v13): features (id, PROSODY) joined twice. Null where a side has no features; the proxy is the mean of
    the parts that are there."""
    ref, tgt = (features.select(F.col("id").alias(side), F.struct(*[c for c in features.columns if c != "id"]).alias(f"_{s}")) for side, s in ((reference, "r"), (target, "t")))
    both = pairs.join(ref, reference, "left").join(tgt, target, "left")
    parts = {
        "pause_pattern_jaccard": num.weighted_jaccard(F.col("_r.pauses"), F.col("_t.pauses")),
        "energy_contour_corr": num.array_pearson(F.col("_r.energy"), F.col("_t.energy")),
        "f0_contour_corr": num.array_pearson(F.col("_r.f0"), F.col("_t.f0")),
    }
    out = both.select(
        *pairs.columns,
        num.safe_ratio(F.col("_t.duration_sec"), F.col("_r.duration_sec")).alias("duration_ratio_tgt_over_ref"),
        (F.col("_t.pause_count") - F.col("_r.pause_count")).alias("pause_count_delta"),
        (F.col("_t.silence_ratio") - F.col("_r.silence_ratio")).alias("pause_ratio_delta"),
        *[c.alias(n) for n, c in parts.items()],
    )
    there = F.array_compact(F.array(*parts))
    return out.withColumn("prosody_similarity_proxy", F.when(F.size(there) > 0, F.aggregate(there, F.lit(0.0), lambda s, x: s + x) / F.size(there)))


def clusters(similarity: np.ndarray, threshold: float) -> list[list[int]]:
    """Average-link clusters: the two closest are joined while their mean similarity is at or above the threshold; by size, then first member."""
    groups = [[i] for i in range(len(similarity))]
    while len(groups) > 1:
        best, at = -np.inf, None
        for i in range(len(groups)):
            for j in range(i + 1, len(groups)):
                s = similarity[np.ix_(groups[i], groups[j])].mean()
                if s > best:
                    best, at = s, (i, j)
        if best < threshold:
            break
        i, j = at
        groups[i] = sorted(groups[i] + groups[j])
        del groups[j]
    return sorted(groups, key=lambda g: (-len(g), g[0]))


def item_clusters(vectors: DataFrame, item: str, index: str, vector: str, threshold: float) -> DataFrame:
    """(item, idx, cluster) for the few windows of each item (v04)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(index)
        x = np.stack([np.asarray(v, float) for v in pdf[vector]])
        x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        rows = [(pdf[item].iloc[0], int(pdf[index].iloc[m]), c) for c, members in enumerate(clusters(x @ x.T, threshold)) for m in members]
        return pd.DataFrame(rows, columns=["item", "idx", "cluster"])

    return vectors.select(item, index, vector).groupBy(item).applyInPandas(run, "item long, idx long, cluster int")
