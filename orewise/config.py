"""Settings of the yard analytics."""

from __future__ import annotations

from dataclasses import dataclass, field

# Loose bulk densities in t/m3.
DENSITY = {
    "coal": 0.85, "coke": 0.50, "iron_ore": 2.40, "limestone": 1.55, "sand_gravel": 1.65,
    "wood_chips": 0.30, "scrap_metal": 0.90, "slag": 1.80, "unknown": 1.00,
}


# The defaults.
@dataclass(frozen=True)
class Settings:
    """Thresholds of detection, thermal screening and validation."""

    min_height: float = 0.5
    max_height: float = 40.0
    min_area: float = 25.0
    wall_slope: float = 65.0
    max_wall: float = 0.12
    flat_slope: float = 5.0
    max_flat_top: float = 0.55
    max_ndvi: float = 0.30
    max_fill: float = 0.75
    boom_radius: float = 3.0
    min_coverage: float = 0.8
    sigma_z: float = 0.05
    scrap_roughness: float = 0.6
    scrap_patchiness: float = 0.015
    pool_m: float = 20.0
    fold_block_m: float = 150.0
    folds: int = 5
    seed: int = 42
    wavelength_um: float = 10.9
    landsat_native_m: float = 100.0
    ring_inner_m: float = 30.0
    ring_outer_m: float = 150.0
    anomaly_sigma: float = 2.0
    anomaly_dt: float = 1.0
    persistence: float = 0.5
    noise_rate: float = 0.025
    noise_p: float = 0.01
    hotspot_side_m: float = 5.0
    nhi_anomaly: float = 0.10
    b12_ratio: float = 1.3
    qa_reject: int = (1 << 1) | (1 << 2) | (1 << 3) | (1 << 4) | (1 << 5)
    density: dict = field(default_factory=lambda: dict(DENSITY))


DEFAULT = Settings()
