"""Settings of the detection-to-dataset flow: two presets of the gate's thresholds, the rest shared."""

from __future__ import annotations

from dataclasses import asdict, dataclass


@dataclass(frozen=True)
class Config:
    min_face_px: int = 80
    min_logo_px: int = 32
    face_det_score: float = 0.5
    logo_det_threshold: float = 0.30
    keyframe_share: float = 0.30
    frame_ms: float = 40.0
    similarity_threshold: float = 0.75
    resolution: float = 0.72
    track_vote_threshold: float = 0.70
    auto_accept_score: float = 0.20
    hitl_low_score: float = 0.13
    known_threshold: float = 0.15
    psi_warn: float = 0.25
    psi_alert: float = 0.35
    gold_f1_min: float = 0.85
    gold_f1_drop_alert: float = 0.02
    hitl_growth_alert: float = 0.20
    auto_drop_alert: float = 0.05
    samples_per_track_cap: int = 500
    pseudo_label_weight: float = 1.0
    hitl_label_weight: float = 2.0
    fine_tune_interval_days: int = 7
    replay_buffer_size: int = 10_000
    target_label_purity: float = 0.95
    auto_purity: float = 0.974
    hitl_purity: float = 0.998

    @property
    def edge_threshold(self) -> float:
        return max(self.similarity_threshold, self.similarity_threshold + (self.resolution - 0.5) * 0.1)

    def items(self) -> list[tuple[str, object]]:
        return list(asdict(self).items())


CONFIG = Config()
DOCUMENTED = Config(auto_accept_score=0.85, hitl_low_score=0.60, known_threshold=0.60)
PRESETS = {"config": CONFIG, "documented": DOCUMENTED}
