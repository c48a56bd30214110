"""Default parameters.

Fixed values that must equal the reference run's configuration so that a
run with defaults computes the same analysis (SURVEY §2.10).
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Defaults:
    # --- fixed values (reference configuration) ---------------------------
    label_cols: tuple[str, ...] = ("label", "attack_cat")
    seed: int = 42
    k_min: int = 2
    k_max: int = 10
    silhouette_sample: int = 10_000
    dbscan_eps: float = 1.5
    dbscan_min_samples: int = 10
    scatter_sample: int = 10_000
    scatter_x: str = "sbytes"
    scatter_y: str = "dbytes"
    rare_share: float = 0.01
    min_support: float = 0.01
    min_confidence: float = 0.70
    contamination: float = 0.04
    n_trees: int = 200
    queue_top_n: int = 20
    kmeans_n_init: int = 10
    kmeans_max_iter: int = 300
    kmeans_tol: float = 1e-4
    rules_top_n: int = 20
    segment_rules_top_n: int = 5
    top_features_n: int = 5
    heatmap_features_n: int = 12
    categorical_items: tuple[str, ...] = ("proto", "service", "state")
    continuous_items: tuple[str, ...] = (
        "outbound_dominance_ratio",
        "packet_rate",
        "bytes_per_packet",
        "packet_asymmetry",
    )
    required_raw: tuple[str, ...] = ("sbytes", "dbytes", "spkts", "dpkts", "dur")


DEFAULTS = Defaults()
