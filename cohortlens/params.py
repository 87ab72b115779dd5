"""Run parameters with their documented defaults."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RunParams:
    """Values a run can be tuned with; one object is passed through a whole run."""

    seed: int = 42
    risk_threshold: float = 0.25
    spike_threshold: float = 0.10
    split_week: int = 7
    current_week: int | None = None
    top_k: int = 50
    value_per_pass: float = 1200.0
    uplifts: tuple[float, ...] = (0.03, 0.05, 0.08)
    roi_uplifts: tuple[float, ...] = (0.03, 0.05, 0.08, 0.10)
    roi_costs: tuple[int, ...] = (50, 100, 150, 200, 300)
    n_boot: int = 2000
    cutoff_day: int = 90
    recent_days: int = 30
    model_name: str = "logistic"
    model_options: tuple[tuple[str, object], ...] = ()
    model_version: str = "v1"
