"""Settings that decide results, as plain constants and one frozen dataclass per stage."""

from __future__ import annotations

from dataclasses import dataclass, field

from tidemark.functions.binning import BinLabel, BinSpec

# Labels and bounds of the configured bins.
AGE_BINS = (
    BinLabel("Young", None, 40),
    BinLabel("Middle-Aged", 40, 65),
    BinLabel("Senior", 65, None),
)
TENURE_BINS = (
    BinLabel("New", None, 3),
    BinLabel("Early-Stage", 3, 12),
    BinLabel("Mid-term", 12, 24),
    BinLabel("Loyal", 24, None),
)

# Steps of the exploratory bins, as (bound, label), and the label beyond them.
AGE_STEPS = ((40, "Young"), (65, "Middle-Aged"))
AGE_BEYOND = "Senior"
BALANCE_ZERO = "Zero"
BALANCE_STEPS = ((50_000, "Low"), (100_000, "Medium"))
BALANCE_BEYOND = "High"
SCORE_STEPS = ((600, "Poor"), (700, "Fair"), (800, "Good"))
SCORE_BEYOND = "Excellent"
TENURE_STEPS = ((3, "New"), (12, "Early-Stage"), (24, "Mid-term"))
TENURE_BEYOND = "Loyal"

# Search grids per algorithm. An algorithm without a grid is fitted once.
GRIDS = {
    "rfc": {
        "numTrees": [20, 50, 100],
        "maxDepth": [5, 10, 20],
        "featureSubsetStrategy": ["auto", "sqrt", "log2"],
        "impurity": ["gini", "entropy"],
    },
    "gbt": {
        "maxDepth": [5, 10, 20],
        "featureSubsetStrategy": ["auto", "sqrt", "log2"],
    },
}

# Split, tuning and promotion settings.
SPLIT_RATIO = 0.2
SEED = 42
FOLDS = 3
PROMOTION_MARGIN = 0.1


@dataclass(frozen=True)
class CleanConfig:
    """Cleaning steps, applied in this order unless ``dedup_first`` is set."""

    drop: tuple[str, ...] = ()
    dropna: tuple[str, ...] = ()
    dedup: tuple[str, ...] = ()
    dedup_first: bool = False


@dataclass(frozen=True)
class FeatureConfig:
    """What the feature stages see; ``wide`` keeps one-hots sparse and their index in a table."""

    key: str
    label: str | None
    bins: tuple[BinSpec, ...] = ()
    exclude: tuple[str, ...] = ()
    nulls: str = "impute"
    wide: bool = False


@dataclass(frozen=True)
class TrainConfig:
    """Algorithm, search and split of one training run."""

    algorithm: str = "gbt"
    grid: dict[str, list] = field(default_factory=dict)
    metric: str = "accuracy"
    folds: int = FOLDS
    parallelism: int = 4
    split_ratio: float = SPLIT_RATIO
    seed: int = SEED
    margin: float = PROMOTION_MARGIN
