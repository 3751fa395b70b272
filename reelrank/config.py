"""Job parameters (the YAML config of a classic batch recommender, as a dataclass)."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # Fixed defaults of the original pipeline configuration.
    seed: int = 42
    rating_scale: tuple[float, float] = (1.0, 5.0)
    min_movie_ratings: int = 50
    min_user_ratings: int = 10
    data_sample_fraction: float = 0.1
    test_size: float = 0.2
    n_factors: int = 50
    n_epochs: int = 20
    reg_all: float = 0.05
    top_n: int = 10
    relevance_threshold: float = 4.5
    top_k: int = 10
    qualifying_sample_fraction: float = 0.01
    # Spark-side knobs (no counterpart in the original).
    bias_sweeps: int = 2
    broadcast_limit_bytes: int = 256 << 20

    def replace(self, **kw) -> "Params":
        from dataclasses import replace
        return replace(self, **kw)
