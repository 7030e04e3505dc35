"""Feature sets (MLP / RF / XGB) as lazy DataFrame plans over the stacked table.

Input: the stacked passenger table (id, label, is_train, pclass, name, sex,
age, sibsp, parch, ticket, fare, cabin, embarked). Statistics are fitted on
all rows, labelled and unlabelled together, like the original pipeline
(transductive), or on the labelled rows only with ``fit_scope="train"``; the
scaler is fitted on the labelled rows either way.

The order of steps is part of each set's meaning (e.g. a group-filled column
is the input of the global fallback), so every builder is a straight sequence.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifeboat import config as C
from lifeboat.functions import columns as X
from lifeboat.functions import text as TX
from lifeboat.operators import binning, encode, forest, impute
from lifeboat.operators.layout import partitions_for, spread, stage
from lifeboat.operators.lookup import attach

KEYS = ("id", "label", "is_train")


def _keys(df: DataFrame) -> list[str]:
    return [k for k in KEYS if k in df.columns]


def _finish(df: DataFrame, features) -> DataFrame:
    """Select keys + features as doubles with remaining nulls set to 0.0."""
    return df.select(*_keys(df), *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f)
                                   for f in features])


# --- I1: learned age imputation ------------------------------------------------

#: Rows of a group on average from which a forest is trained on groups of rows.
GROUP_ROWS = 8


def impute_age_forest(df: DataFrame, inputs, trees: int = C.TrainingConfig.age_forest_trees,
                      depth: int = C.TrainingConfig.age_forest_depth, seed: int = 42,
                      sigmas: float = C.OUTLIER_SIGMAS, scope=None, partitions: int = C.TrainingConfig.fit_partitions, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Fill null ages with a random-forest regression on ``inputs``.

    Rows that share the bins of all inputs are grouped first (``operators.forest``) if a group has ``group_rows`` rows or more
    on average; the same forest then is trained on the groups, with other bootstrap draws.

    Trained on age-known rows after dropping fare / family-size outliers
    (more than ``sigmas`` sample std from the mean). Skipped when there are no
    null or no known ages.
    """
    known = (scope(df) if scope else df).where(F.col("age").isNotNull())
    if not df.where(F.col("age").isNull()).limit(1).collect() or not known.limit(1).collect():
        return df
    trimmed = impute.trim_outliers(known, ["fare", "family_size"], sigmas)
    vec = VectorAssembler(inputCols=[f"_in_{c}" for c in inputs], outputCol="_age_x")

    def with_inputs(d):
        return d.select("*", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_in_{c}")
                               for c in inputs])

    n, names = known.count(), [f"_in_{c}" for c in inputs]
    if n >= group_rows * 2:
        plain = with_inputs(trimmed)
        cuts = forest.bin_cuts(plain, names, n)
        key = forest.bin_key(names, cuts)
        keyed = plain.select(key.alias("key"), "id", F.col("age").cast("double").alias("label"))
        sizes = stage(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "forest-sizes")
        if sizes.count() * group_rows <= n:
            hot = [r["key"] for r in sizes.where(F.col("n") > forest.TASK_ROWS).collect()]      # few: each has TASK_ROWS rows
            groups = forest.group(keyed, n, trees, seed, hot)
            d = with_inputs(df).withColumn("key", F.when(F.col("age").isNull(), key))
            ask = d.where(F.col("key").isNotNull()).select("key").distinct()
            hats = forest.fit_predict(groups, ask, len(names), trees, depth, seed)
            return attach(d, hats, "key").withColumn("age", F.coalesce(F.col("age"), F.col("hat"))).select(*df.columns)
    train = vec.transform(with_inputs(trimmed)).select("id", "_age_x", "age")
    train = spread(train, partitions_for(n, partitions)).persist(StorageLevel.MEMORY_AND_DISK)
    rf = RandomForestRegressor(featuresCol="_age_x", labelCol="age", predictionCol="_age_hat",
                               numTrees=trees, maxDepth=depth, seed=seed, subsamplingRate=1.0,
                               featureSubsetStrategy="all")
    model = rf.fit(train)
    train.unpersist()
    scored = model.transform(vec.transform(with_inputs(df)))
    drop = ["_age_x", "_age_hat"] + [f"_in_{c}" for c in inputs]
    return scored.withColumn("age", F.coalesce(F.col("age"), F.col("_age_hat"))).drop(*drop)


# --- MLP set -----------------------------------------------------------------------

def _scope(fit_scope: str):
    """What a step is fitted on: the rows themselves (None) or their labelled part."""
    if fit_scope not in ("all", "train"):
        raise ValueError(f"fit_scope is 'all' or 'train', not {fit_scope!r}")
    return (lambda d: None) if fit_scope == "all" else (lambda d: d.where(F.col("is_train")))


def features_mlp(df: DataFrame, fit_scope: str = "all") -> tuple[DataFrame, list[str]]:
    fit = _scope(fit_scope)
    d = stage(df, "features-input").withColumn("title", TX.title_regex("name"))
    d = d.withColumn("sex", X.is_female("sex"))
    d = impute.fill_mode(d, "embarked", default=C.EMBARKED_FALLBACK, fit=fit(d))
    d = impute.fill_median(d, "fare", fit=fit(d))
    d = d.withColumn("family_size", X.family_size("sibsp", "parch", include_self=True))
    d = d.withColumn("is_alone", X.is_alone("family_size"))
    d = d.withColumn("cabin_deck", TX.deck_letter("cabin", C.NO_CABIN_MLP))
    d = d.withColumn("has_cabin", X.has_value("cabin"))
    cats = encode.categories_many(d if fit(d) is None else fit(d), C.MLP_DUMMIES)  # one scan for every dummy column, before the joins
    d = impute.group_size(d, "ticket", "ticket_group", *C.TICKET_GROUP_CLIP, fit=fit(d))
    d = _materialize(d.drop("name", "ticket", "cabin"))     # the medians, the scaler and the result scan it: one join by ticket for all
    d = impute.fill_median_by_group(d, "age", ["title", "pclass"], fit=fit(d))
    d = binning.bin_fixed(d, "age", C.AGE_EDGES, "age_bin", C.DEFAULT_BIN)
    d = binning.bin_fixed(d, "fare", C.FARE_EDGES, "fare_bin", C.DEFAULT_BIN)
    names = list(C.MLP_NUMERIC)
    for c in C.MLP_DUMMIES:
        d, dummies = encode.one_hot_drop_first(d, c, cats=cats[c])
        names += dummies
    return _finish(d, names), names


# --- RF set ------------------------------------------------------------------------

def _titles_tickets_decks(d: DataFrame) -> DataFrame:
    d = d.withColumn("title1", TX.title_split("name"))
    d = d.withColumn("ticket_info", TX.ticket_token("ticket"))
    return d.withColumn("cabin", TX.deck_letter("cabin", C.NO_CABIN_RF))


def features_rf(df: DataFrame, age_trees: int = C.TrainingConfig.age_forest_trees,
                fit_scope: str = "all") -> tuple[DataFrame, list[str]]:
    fit = _scope(fit_scope)
    d = stage(df, "features-input").withColumn("embarked", F.coalesce(F.col("embarked"), F.lit(C.EMBARKED_FALLBACK)))
    d = impute.fill_mean(d, "fare", fit=fit(d))
    d = _titles_tickets_decks(d)
    d = d.withColumn("title2", TX.title_rf("title1"))
    d = d.withColumn("family_size", X.family_size("sibsp", "parch", include_self=False))
    d = encode.category_codes_many(d, ("sex", "embarked", "pclass", "title1", "title2", "cabin", "ticket_info"), fit=fit(d))
    d = _materialize(d)
    d = impute_age_forest(d, C.RF_AGE_INPUTS, trees=age_trees, scope=None if fit_scope == "all" else fit)
    names = list(C.RF_FEATURES)
    return _materialize(_finish(d, names)), names


# --- XGB set -----------------------------------------------------------------------

def features_xgb(df: DataFrame, age_trees: int = C.TrainingConfig.age_forest_trees,
                 fit_scope: str = "all") -> tuple[DataFrame, list[str]]:
    fit = _scope(fit_scope)
    d = stage(df, "features-input")
    d = impute.fill_mode_by_group(d, "embarked", ["pclass"], default=C.EMBARKED_FALLBACK, fit=fit(d))
    d = impute.fill_mean(d, "fare", fit=fit(d))
    d = _titles_tickets_decks(d)
    d = d.withColumn("title2", TX.title_xgb("title1"))
    d = d.withColumn("family_size", X.family_size("sibsp", "parch", include_self=True))
    d = d.withColumn("is_alone", X.is_alone("family_size"))
    d = impute.fill_mode(d, "pclass", fit=fit(d))
    d = impute.frequency_encode(d, "ticket_info", "ticket_info_freq", fit=fit(d))
    d = impute.frequency_encode(d, "cabin", "cabin_freq", fit=fit(d))
    d = encode.category_codes_many(d, ("sex", "embarked", "title2"), fit=fit(d))
    d = _materialize(d)
    d = impute_age_forest(d, C.XGB_AGE_INPUTS, trees=age_trees, scope=None if fit_scope == "all" else fit)
    d = _materialize(d)
    d = binning.bin_quantile(d, "fare", "fare_bin", C.FARE_QUANTILES, fit=fit(d))
    d = impute.fill_median(d, "age", fit=fit(d))
    d = binning.bin_equal_width(d, "age", "age_bin", C.EQUAL_WIDTH_BINS, fit=fit(d))
    d = d.withColumn("sex_pclass", X.product("sex", "pclass"))
    d = d.withColumn("pclass_age_bin", X.product("pclass", "age_bin"))
    names = list(C.XGB_FEATURES)
    return _finish(d, names), names


FEATURE_SETS = {"mlp": features_mlp, "rf": features_rf, "xgb": features_xgb}


def _materialize(d: DataFrame) -> DataFrame:
    """An intermediate that several later fit steps scan (e.g. the forest-filled table)."""
    return stage(d, "features-step")


def build_features(df: DataFrame, feature_set: str, fit_scope: str = "all",
                   cfg: C.TrainingConfig | None = None) -> tuple[DataFrame, list[str]]:
    """Dispatch to a feature set; an unknown name raises."""
    key = (feature_set or "").lower()
    if key not in FEATURE_SETS:
        raise ValueError(f"Unsupported feature set: {feature_set!r} (expected one of {sorted(FEATURE_SETS)})")
    if key == "mlp":
        return features_mlp(df, fit_scope)
    return FEATURE_SETS[key](df, (cfg or C.TrainingConfig()).age_forest_trees, fit_scope)


def prepare(labelled: DataFrame, unlabelled: DataFrame, feature_set: str,
            scale: bool | None = None, fit_scope: str = "all", cfg: C.TrainingConfig | None = None) -> tuple[DataFrame, list[str]]:
    """Stack, build the feature set, scale (MLP set by default), assemble ``features``.

    Returns (DataFrame(id, label, is_train, <features...>, features vector), names).
    """
    from lifeboat.operators.score import union_tagged

    stacked = union_tagged(labelled, unlabelled)  # the builder stages it
    feats, names = build_features(stacked, feature_set, fit_scope, cfg)
    if scale is None:
        scale = feature_set.lower() == "mlp"
    if scale:
        params = encode.fit_scaler(feats.where(F.col("is_train")), names)
        feats = encode.apply_scaler(feats, params)
    vec = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="error")
    return vec.transform(feats), names


def prepare_numeric(df: DataFrame, numeric, categorical=()) -> tuple[DataFrame, list[str]]:
    """Generic prepare for tables that are not passengers: category codes for
    ``categorical``, nulls to 0.0, assembled ``features``."""
    d = df
    for c in categorical:
        d = encode.category_codes(d, c)
    names = list(numeric) + list(categorical)
    d = _finish(d, names)
    return VectorAssembler(inputCols=names, outputCol="features").transform(d), names
