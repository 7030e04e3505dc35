"""Run configuration and the fixed values the feature rules depend on.

Everything here is plain data: the feature builders and trainers take these
values as arguments, so a caller can swap any of them without touching code.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values. These must stay exactly as written for results to agree with
# the original pipeline's feature rules.
# ---------------------------------------------------------------------------

CLASS_NAMES = ("Did Not Survive", "Survived")

# Regex-title rule (MLP set): intermediate synonym map, then anything outside
# the four common titles becomes "Rare".
TITLE_REPLACEMENTS = {
    "Mlle": "Miss",
    "Ms": "Miss",
    "Mme": "Mrs",
    "Lady": "Royalty",
    "Countess": "Royalty",
    "Sir": "Royalty",
    "Jonkheer": "Royalty",
    "Don": "Royalty",
    "Dona": "Royalty",
    "Col": "Officer",
    "Major": "Officer",
    "Capt": "Officer",
    "Dr": "Officer",
    "Rev": "Officer",
}
COMMON_TITLES = ("Mr", "Mrs", "Miss", "Master")
TITLE_PATTERN = r" ([A-Za-z]+)\."

# Split-title rule (RF set): title between ", " and the first "."; these
# titles are renamed, every other title is kept as it is.
RF_TITLE_MAP = {
    "Mlle": "Miss",
    "Mme": "Mrs",
    "Ms": "Miss",
    "Dr": "Mr",
    "Major": "Mr",
    "Lady": "Mrs",
    "the Countess": "Mrs",
    "Jonkheer": "Mr",
    "Col": "Mr",
    "Rev": "Mr",
    "Capt": "Mr",
    "Sir": "Mr",
    "Don": "Mr",
    "Dona": "Mrs",
}

# Split-title rule (XGB set): three renames, eleven titles folded into "Rare".
XGB_TITLE_MAP = {"Mlle": "Miss", "Ms": "Miss", "Mme": "Mrs"}
XGB_RARE_TITLES = (
    "Dr", "Major", "Lady", "the Countess", "Jonkheer", "Col", "Rev", "Capt", "Sir", "Don", "Dona",
)

# Right-closed bin edges, lowest edge included; values outside get DEFAULT_BIN.
AGE_EDGES = (0.0, 12.0, 20.0, 40.0, 60.0, 80.0)
FARE_EDGES = (-1.0, 8.0, 15.0, 31.0, 100.0, float("inf"))
DEFAULT_BIN = 2
EQUAL_WIDTH_BINS = 5
FARE_QUANTILES = (0.0, 0.25, 0.5, 0.75, 1.0)

TICKET_GROUP_CLIP = (0, 4)
OUTLIER_SIGMAS = 4.0
EMBARKED_FALLBACK = "S"
NO_CABIN_RF = "NoCabin"
NO_CABIN_MLP = "N"
SEEDS = (45, 2025, 777)

# Output feature lists (order is part of the contract of each set).
RF_FEATURES = (
    "age", "embarked", "fare", "pclass", "sex", "family_size", "title2", "ticket_info", "cabin",
)
RF_AGE_INPUTS = (
    "embarked", "fare", "pclass", "sex", "family_size", "title1", "title2", "cabin", "ticket_info",
)
XGB_FEATURES = (
    "age", "age_bin", "embarked", "fare", "fare_bin", "pclass", "sex", "family_size",
    "is_alone", "title2", "ticket_info_freq", "cabin_freq", "sex_pclass", "pclass_age_bin",
)
XGB_AGE_INPUTS = (
    "embarked", "fare", "pclass", "sex", "family_size", "is_alone", "title2",
    "ticket_info_freq", "cabin_freq",
)
MLP_NUMERIC = (
    "sex", "age", "sibsp", "parch", "fare", "family_size", "is_alone", "has_cabin",
    "ticket_group", "age_bin", "fare_bin",
)
MLP_DUMMIES = ("embarked", "title", "cabin_deck", "pclass")

# Grids searched by the tuned trainers.
GB_GRID = {
    "maxIter": (300, 500, 800),
    "stepSize": (0.01, 0.02, 0.05),
    "maxDepth": (3, 4, 5),
    "minSamplesSplit": (2, 4),
    "minInstancesPerNode": (1, 2),
    "subsamplingRate": (0.85, 0.9, 1.0),
}
SVM_GRID = {"C": (0.5, 1.0, 2.0, 5.0), "gamma": ("scale", 0.05, 0.1)}
KNN_GRID = {"k": (7, 11, 15, 21), "weights": ("uniform", "distance"), "p": (1, 2)}


@dataclass(frozen=True)
class TrainingConfig:
    """Knobs of one training run (seed = split seed; model seeds are separate)."""

    val_ratio: float = 0.2
    seed: int = 45
    seeds: tuple[int, ...] = SEEDS
    model_seed: int = 1
    fit_partitions: int = 16  # partitions a model is fitted on at least (operators.layout.partitions_for)
    # forests
    rf_trees: int = 1000
    rf_max_depth: int = 12
    rf_min_instances: int = 6
    tree_memory_mb: int = 1024  # per-pass node statistics; more nodes per pass over the data
    age_forest_trees: int = 2000
    age_forest_depth: int = 10
    # boosting (xgboost-like settings)
    xgb_rounds: int = 600
    xgb_step: float = 0.03
    xgb_depth: int = 3
    xgb_subsample: float = 0.9
    xgb_column_share: float = 0.8   # drawn per tree
    xgb_lambda: float = 1.0
    xgb_min_child: float = 1.0
    max_bins: int = 256
    early_stopping_rounds: int = 50
    models_in_step: int = 24    # grid combinations times folds that are boosted in the same jobs
    gb_grid: dict = field(default_factory=lambda: dict(GB_GRID))
    cv_folds: int = 3
    cv_parallelism: int = 4
    # logistic regression
    lr_max_iter: int = 5000
    # svm by random Fourier features
    rff_dim: int = 64
    svm_max_iter: int = 100
    svm_tol: float = 1e-4
    svm_grid: dict = field(default_factory=lambda: dict(SVM_GRID))
    # mlp
    mlp_hidden: tuple[int, ...] = (256, 128, 64)
    mlp_dropout: float = 0.35
    mlp_batch_rows: int = 128
    mlp_batches: int = 6        # mini-batches of an epoch at most: the original has six; on large tables a batch is a share of the rows
    mlp_epochs: int = 250
    mlp_rate: float = 1e-3
    mlp_decay: float = 1e-4
    patience: int = 30  # epochs without improvement
    # knn
    knn_grid: dict = field(default_factory=lambda: dict(KNN_GRID))


# What the registered model queries train with: the same families, rules and searches (all of the grids) with
# tree counts that a driver run of all queries can afford (README, "Sizes").
QUERY_CONFIG = TrainingConfig(fit_partitions=4, rf_trees=100, age_forest_trees=50)
