"""Fixed domain values and tunable settings, passed to functions as arguments."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---- fixed values: geography -------------------------------------------------
# (latitude, longitude) vertices of the area of interest, in order
AREA_POLYGON: tuple[tuple[float, float], ...] = (
    (53.485, -1.635),
    (53.485, -1.340),
    (53.415, -1.300),
    (53.310, -1.330),
    (53.300, -1.600),
    (53.400, -1.680),
)
AREA_CENTRE: tuple[float, float] = (53.3811, -1.4701)
EARTH_RADIUS_M = 6_371_000.0

# ---- fixed values: categories ------------------------------------------------
CANONICAL_CATEGORIES: tuple[str, ...] = (
    "anti-social-behaviour",
    "bicycle-theft",
    "burglary",
    "criminal-damage-arson",
    "drugs",
    "other-theft",
    "possession-of-weapons",
    "public-order",
    "robbery",
    "shoplifting",
    "theft-from-person",
    "vehicle-crime",
    "violent-crime",
    "other-crime",
)
CATEGORY_ALIASES: dict[str, str] = {
    "theft-from-the-person": "theft-from-person",
    "anti-social": "anti-social-behaviour",
    "violence-and-sexual-offences": "violent-crime",
}
FALLBACK_CATEGORY = "other-crime"
VIOLENT_CATEGORIES: tuple[str, ...] = ("violent-crime", "robbery", "possession-of-weapons")

# ---- fixed values: calendar --------------------------------------------------
SEASON_MONTHS: dict[str, tuple[int, ...]] = {
    "winter": (12, 1, 2),
    "spring": (3, 4, 5),
    "summer": (6, 7, 8),
    "autumn": (9, 10, 11),
}


@dataclass(frozen=True)
class CleanSettings:
    polygon: tuple[tuple[float, float], ...] = AREA_POLYGON
    coord_tolerance: float = 1e-5
    dedup_key: tuple[str, ...] = ("category", "month", "street_id")
    order_by: tuple[str, ...] = ("id",)


@dataclass(frozen=True)
class GridSettings:
    cells: int = 50
    hex_cells: int = 60


@dataclass(frozen=True)
class ClusterSettings:
    k_min: int = 3
    k_max: int = 12
    restarts: int = 10
    seed: int = 42
    eps_metres: float = 250.0
    min_samples: int = 25
    # "linear" (squared distances, one pass) or "exact" (all pairs of distinct points); never chosen by size
    silhouette: str = "linear"


@dataclass(frozen=True)
class ForecastSettings:
    horizon: int = 3
    cv_initial: int = 10
    cv_step: int = 2
    max_d: int = 2
    # fixed values: candidate (p, d, q); d is replaced by the chosen order of differencing
    orders: tuple[tuple[int, int, int], ...] = (
        (1, 1, 1), (2, 1, 1), (1, 1, 2), (2, 1, 2),
        (0, 1, 1), (1, 0, 1), (3, 1, 1),
        (0, 0, 1), (1, 0, 0), (2, 0, 0), (0, 1, 2),
    )
    # a unit root is rejected below this p-value
    adf_alpha: float = 0.05
    yearly_seasonality: bool = True
    yearly_period_days: float = 365.25
    fourier_order: int = 3
    changepoints: int = 8
    changepoint_prior: float = 0.05
    # normal quantile of a two-sided 80 % band
    band_z: float = 1.2815515655446004


@dataclass(frozen=True)
class PanelSettings:
    lags: tuple[int, ...] = (1, 2, 3, 6)
    roll: int = 3
    trees: int = 300
    max_depth: int = 30
    seed: int = 42
    horizon: int = 3
    refit: bool = False
    max_bins: int = 255


@dataclass(frozen=True)
class PriorSettings:
    grid_k: int = 20
    fine_k: int = 5
    street_k: int = 10
    lsoa_k: int = 20


@dataclass(frozen=True)
class ClassifierSettings:
    target: str = "is_violent"
    test_share: float = 0.2
    seed: int = 42
    class_weight: str | None = "balanced"
    cv_folds: int = 3
    logistic_c: float = 1.0
    logistic_iter: int = 2000
    forest_trees: int = 400
    forest_depth: int = 15
    forest_leaf: int = 20
    boost_rounds: int = 400
    boost_depth: int = 6
    boost_rate: float = 0.05
    boost_leaf: int = 20
    svm_c: float = 1.0
    svm_features: int = 128
    max_bins: int = 255
    priors: PriorSettings = field(default_factory=PriorSettings)


CLEAN = CleanSettings()
GRID = GridSettings()
CLUSTER = ClusterSettings()
FORECAST = ForecastSettings()
PANEL = PanelSettings()
CLASSIFIER = ClassifierSettings()
