"""Thresholds and tables of the two languages, as frozen data."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path
from types import MappingProxyType

# Defaults of the quality gate.
QC_DEFAULTS = MappingProxyType({
    "dnsmos_min": 2.5,
    "ref_asr_min": 0.55,
    "tgt_asr_min": 0.65,
    "min_duration_sec": 0.8,
    "max_clip_ratio": 1e-4,
    "max_silence_ratio": 0.35,
    "max_trailing_silence_sec": 1.2,
    "truncation_tail_silence_max": 0.03,
    "truncation_tail_rms_ratio_min": 0.35,
    "repeat_token_run_threshold": 4,
    "repeat_ngram_repeat_threshold": 3,
    "zh_max_units_per_sec": 8.5,
    "en_max_units_per_sec": 4.5,
})

# Flags that fail a pair by themselves.
HARD_FLAGS = (
    "ref_audio_load_failed",
    "ref_asr_error",
    "ref_asr_mismatch",
    "ref_truncation_suspect",
    "ref_clipping",
    "ref_too_short",
    "ref_asr_stutter_suspect",
    "ref_asr_loop_suspect",
    "tgt_audio_load_failed",
    "tgt_dnsmos_low",
    "tgt_asr_error",
    "tgt_asr_mismatch",
    "tgt_truncation_suspect",
    "tgt_clipping",
    "tgt_too_short",
    "tgt_asr_stutter_suspect",
    "tgt_asr_loop_suspect",
    "prosody_metrics_missing",
    "prosody_metrics_error",
    "prosody_duration_ratio_missing",
    "prosody_duration_ratio_low",
    "prosody_duration_ratio_high",
    "prosody_pause_pattern_missing",
    "prosody_pause_pattern_low",
    "prosody_energy_corr_missing",
    "prosody_energy_corr_low",
    "prosody_similarity_missing",
    "prosody_similarity_low",
    "speed_direction_fail",
)

# Keys that may hold a pair type's similarity floor, in order of preference.
SIM_FLOOR_KEYS = ("timbre_speaker_sim_min_wavlm", "speaker_sim_min_wavlm", "speaker_sim_min", "sim_min")

# Where each pair type's similarity floor stands.
SIM_SECTION = MappingProxyType({
    "A": "a", "B": "bc", "C": "bc", "C_mixed": "c_mixed", "D": "d", "D_st": "d_st", "D_cross_emo": "d_cross_emo", "Genre": "genre",
    "Genre_conv": "genre_conv", "H1": "h1", "H2": "h2", "I": "i", "J_fast": "j_fast", "J_slow": "j_slow",
})

# Target-to-source duration ratios that a speed edit must reach.
SPEED_RULES = MappingProxyType({"speed_faster": ("max", 0.97), "speed_more_faster": ("max", 0.88), "speed_slower": ("min", 1.03), "speed_more_slower": ("min", 1.12)})

_KEPT = {"same_top1_label": True, "ref_top1_not_neutral": True, "tgt_top1_not_neutral": True, "ref_neutral_max": 0.95, "tgt_neutral_max": 0.95}
_TRANSFER = {"timbre_speaker_sim_min_wavlm": 0.55, "duration_ratio_min": 0.85, "duration_ratio_max": 1.15, "pause_pattern_jaccard_min": 0.3, "energy_contour_corr_min": 0.4}
_NEUTRAL_EDIT = {"edited_top1_must_be_neutral": True, "edited_sv_must_be_neutral": False, "ref_top1_not_neutral": True, "ref_neutral_max": 0.95}
_CROSS = {"same_top1_label": False, "ref_top1_not_neutral": True, "tgt_top1_not_neutral": True, "ref_neutral_max": 0.5, "tgt_neutral_max": 0.5, "speaker_sim_min_wavlm": 0.4}
_H2 = {"ref_neutral_min": 0.5, "ref_top1_must_be_neutral": True, "edited_top1_must_be_neutral": True, "require_target_more_neutral": True, "target_more_neutral_margin": 0.0, "mode": "ref_to_edited"}

# The first language's sections, for constructors and the quality gate. Instruction pools come with a user's own file.
ZH = MappingProxyType({
    "emotion_filter": {"forbidden_top1_labels": ["unk"]},
    "a": {"sim_min": 0.0, "speaker_sim_min_wavlm": 0.5, "require_flag_ok": False},
    "bc": {"edit_whitelist": ["style_radio"], "edited_neutral_min": 0.7, **_NEUTRAL_EDIT, "speaker_sim_min": 0.8, "speaker_sim_min_wavlm": 0.6},
    "c_mixed": {"original_top1_not_neutral": True, "speaker_sim_min_wavlm": 0.5},
    "d": {**_KEPT, "cosine_min": 0.95, "speaker_sim_min_wavlm": 0.4},
    "d_cross_emo": _CROSS,
    "d_st": {**_KEPT, "cosine_min": 0.95, "speaker_sim_min": 0.8, "speaker_sim_min_wavlm": 0.7},
    "genre": {"edit_tag_whitelist": ["style_news", "style_chat"], "speaker_sim_min_wavlm": 0.3},
    "genre_conv": {"speaker_sim_min_wavlm": 0.8},
    "h1": {"sim_min": 0.0, "cosine_min": 0.97, "same_top1_label": True, "speaker_sim_min_wavlm": 0.3},
    "h2": {**_H2, "source_edit_tag": "style_radio", "p_neutral_min": 0.9, "require_sv_neutral": True, "speaker_sim_min_wavlm": 0.75},
    "h3": {"negatives_per_anchor": 2, "random_seed": 42},
    "i": _TRANSFER,
    "j_fast": {"speaker_sim_min_wavlm": 0.7, "require_speed_direction_pass": True},
    "j_slow": {"speaker_sim_min_wavlm": 0.7, "require_speed_direction_pass": True},
})

# The second language's sections.
EN = MappingProxyType({
    "emotion_filter": {"forbidden_top1_labels": ["unk"]},
    "a": {"sim_min": 0.0, "speaker_sim_min_wavlm": 0.55, "require_flag_ok": False},
    "bc": {"edit_whitelist": ["style_chat"], "edited_neutral_min": 0.3, **_NEUTRAL_EDIT, "speaker_sim_min": 0.7, "speaker_sim_min_wavlm": 0.55},
    "c_mixed": {"original_top1_not_neutral": True, "speaker_sim_min_wavlm": 0.4},
    "d": {**_KEPT, "cosine_min": 0.93, "speaker_sim_min_wavlm": 0.4},
    "d_cross_emo": _CROSS,
    "d_st": {**_KEPT, "cosine_min": 0.95, "speaker_sim_min": 0.7, "speaker_sim_min_wavlm": 0.55},
    "genre": {"edit_tag_whitelist": ["style_news", "style_radio"], "speaker_sim_min_wavlm": 0.55},
    "genre_conv": {"speaker_sim_min_wavlm": 0.55},
    "h1": {"sim_min": 0.0, "cosine_min": 0.95, "same_top1_label": True, "speaker_sim_min_wavlm": 0.55},
    "h2": {**_H2, "source_edit_tag": "style_chat", "p_neutral_min": 0.5, "require_sv_neutral": False, "speaker_sim_min_wavlm": 0.55},
    "h3": {"negatives_per_anchor": 1, "random_seed": 42},
    "i": _TRANSFER,
    "j_fast": {"speaker_sim_min_wavlm": 0.55, "require_speed_direction_pass": True},
    "j_slow": {"speaker_sim_min_wavlm": 0.55, "require_speed_direction_pass": True},
})

#: Environment variables that take the place of a path in a configuration file.
PATH_VARIABLES = MappingProxyType({"VCDATA_ROOT": "vcdata_root", "EMOTION_EVAL_ROOT": "emotion_eval_root", "PAIR_OUTPUTS_ROOT": "outputs_root"})


def load_config(path: str | None = None, environment: Mapping[str, str] | None = None, defaults: Mapping = ZH) -> dict:
    """Sections of a YAML or JSON file: the path given, else that of PAIR_CONFIG, else the defaults; `paths` of PATH_VARIABLES override the file's."""
    environment = os.environ if environment is None else environment
    path = path or environment.get("PAIR_CONFIG")
    if path is None:
        out = {k: dict(v) for k, v in defaults.items()}
    else:
        text = Path(path).read_text(encoding="utf-8")
        if path.endswith(".json"):
            out = json.loads(text)
        else:
            import yaml  # only for YAML files

            out = yaml.safe_load(text) or {}
    paths = dict(out.get("paths") or {})
    paths |= {name: environment[key] for key, name in PATH_VARIABLES.items() if environment.get(key)}
    return out | {"paths": paths}


@dataclass(frozen=True)
class Gate:
    """What the quality gate needs to know."""

    sections: MappingProxyType = ZH
    thresholds: MappingProxyType = QC_DEFAULTS
    fail_on_speaker_sim: bool = True
    fail_on_semantic: bool = True
    hard: tuple[str, ...] = field(default=HARD_FLAGS)

    def section(self, pair_name: str) -> dict:
        return self.sections.get(SIM_SECTION.get(pair_name, ""), {})

    def sim_floor(self, pair_name: str) -> float | None:
        """The first positive value among the keys, if any."""
        found = (self.section(pair_name).get(k) for k in SIM_FLOOR_KEYS)
        return next((float(v) for v in found if v is not None and float(v) > 0), None)
