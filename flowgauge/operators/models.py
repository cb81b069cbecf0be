"""Total-duration and extended-recovery models of gradient-boosted trees, by MLlib's rules."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.fixed_values import SEARCH_GRID
from flowgauge.functions.columns import in_test_fold
from flowgauge.functions.stats import area_under_roc, numbered, regression_metrics
from flowgauge.operators.aggregate import class_balance, duration_threshold
from flowgauge.operators.derive import completed_only, with_checkin_features
from flowgauge.operators.trees import Loss, training
from flowgauge.schema import CLASSIFIER_SCHEMA, COMPLETED, REGRESSOR_SCHEMA
from flowgauge.session import settle

# --- Fixed values: features, guard and seed ---------------------------------
CATEGORICALS = ("facility_id", "procedure_type", "anesthesia_type")
FEATURES = (
    "facility_id_enc",
    "procedure_type_enc",
    "anesthesia_type_enc",
    "asa_class",
    "checkin_hour",
    "checkin_dow",
    "dur_checkin_to_preop",
    "dur_preop_to_op",
    "dur_op_to_postop",
)
MIN_ROWS = 100
MOST_CATEGORIES = 10_000  # of a feature; statistics of a tree node have a bin for each
SEED = 42
# ---------------------------------------------------------------------------


def label_encode(df: DataFrame, columns: Sequence[str] = CATEGORICALS) -> DataFrame:
    """Add ``<column>_enc``: the position of each value in sorted order, from 0, null as 'unknown'.

    The distinct values of all categories are numbered in ordered ranges and joined to the rows; the dictionary is settled, so
    its measured size decides how. Only the number of values of each category reaches the driver. ``df`` is read twice.
    """
    present = [name for name in columns if name in df.columns]
    if not present:
        return df
    filled = df.withColumns({f"{name}_text": F.coalesce(F.col(name), F.lit("unknown")) for name in present})
    named = F.array(*[F.struct(F.lit(name).alias("category"), F.col(f"{name}_text").alias("value")) for name in present])
    values = filled.select(F.inline(named)).distinct()
    placed = settle(numbered(values, [F.col("category"), F.col("value")], "place"), "dictionary")
    spans = placed.groupBy("category").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("size"))
    span = {row["category"]: row for row in spans.collect()}  # one row per category
    for name in present:
        first, size = (span[name]["first"], span[name]["size"]) if name in span else (1, 0)
        # tells the trees that the numbers are names, and how many
        nominal = {"ml_attr": {"type": "nominal", "name": f"{name}_enc", "num_vals": size}}
        code = (F.col("place") - first).cast("double").alias(f"{name}_enc", metadata=nominal)
        own = placed.filter(F.col("category") == name).select(F.col("value").alias(f"{name}_text"), code)
        filled = filled.join(own, f"{name}_text", "left")
    return filled.select(*df.columns, *[f"{name}_enc" for name in present])


def prepare_features(df: DataFrame, statuses: Sequence[str] = (COMPLETED,)) -> tuple[DataFrame, list[str]]:
    """Completed cases with encoded categories and check-in features, and the feature names."""
    prepared = with_checkin_features(label_encode(completed_only(df, statuses)))
    return prepared, [name for name in FEATURES if name in prepared.columns]


def without_recovery(features: Sequence[str]) -> list[str]:
    """The features known before recovery: every name without ``postop``."""
    return [name for name in features if "postop" not in name]


def has_rows(df: DataFrame, at_least: int = MIN_ROWS) -> bool:
    """Stops reading once enough rows are found."""
    return df.limit(at_least).count() >= at_least


def _vectors(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """The rows to learn from, with their fold."""
    codes = {name: F.col(name).cast("int") for name in _arity(df, features)}  # whole numbers, which Spark holds closer packed
    return df.na.drop(subset=[*features, label]).select(
        *[codes.get(name, F.col(name)).alias(name) for name in features],
        F.col(label).cast("double").alias("label"),
        in_test_fold().alias("in_test"),
    )


@contextmanager
def _kept(rows: DataFrame) -> Iterator[DataFrame]:
    """Rows held on disk while training and evaluation read them a few times."""
    held = rows.persist(StorageLevel.DISK_ONLY)
    try:
        yield held
    finally:
        held.unpersist()


def _arity(df: DataFrame, features: Sequence[str]) -> dict[str, int]:
    """The number of values of each category among the features."""
    sizes = {name: df.schema[name].metadata.get("ml_attr", {}).get("num_vals", 0) for name in features}
    return {name: size for name, size in sizes.items() if size}


def _bins(df: DataFrame, features: Sequence[str]) -> int:
    """Split bins: at least one per value of the widest category, which must not have too many for a tree."""
    sizes = _arity(df, features)
    for name, size in sizes.items():
        if size > MOST_CATEGORIES:
            raise ValueError(f"{name} has {size} values and trees take {MOST_CATEGORIES} at most: leave it out or group its values")
    return max([64, *sizes.values()])


def _fold_sizes(rows: DataFrame) -> tuple[int, int]:
    counts = rows.agg(F.count_if(~F.col("in_test")).alias("train"), F.count_if(F.col("in_test")).alias("test"))
    first = counts.first()
    return first["train"], first["test"]


def train_discharge_predictor(
    df: DataFrame, features: Sequence[str], *, trees: int = 100, depth: int = 6, learning_rate: float = 0.1
) -> DataFrame | None:
    """Fit ``dur_total`` and return one row of quality figures; None below 100 usable rows.

    Three of the four phases are features, so this predicts what is left after surgery.
    """
    rows = _vectors(df, features, "dur_total")
    if not has_rows(rows):
        return None
    with _kept(rows):
        n_train, n_test = _fold_sizes(rows)
        with training(rows.filter(~F.col("in_test")), n_train, features, _arity(df, features), _bins(df, features), SEED) as held:
            model = held.boost(trees=trees, depth=depth, shrinkage=learning_rate, rate=0.8, share=0.8, seed=SEED)
        scored = model.score(rows.filter("in_test"), "prediction")
        quality = regression_metrics(scored, "label", "prediction").first()
    importance = dict(zip(features, model.importances(), strict=True))
    result = {
        "model_type": "GBTRegressor",
        "target": "dur_total",
        "mae_minutes": None if quality["mae"] is None else round(quality["mae"], 2),
        "r2_score": None if quality["r2"] is None else round(quality["r2"], 4),
        "feature_importance": importance,
        "n_train": n_train,
        "n_test": n_test,
    }
    return df.sparkSession.createDataFrame([result], REGRESSOR_SCHEMA)


def train_recovery_classifier(
    df: DataFrame, features: Sequence[str], *, trees: int = 100, depth: int = 5, learning_rate: float = 0.1
) -> DataFrame | None:
    """Fit the risk of a recovery above the p90 and return one row of quality figures.

    The threshold is taken over all completed cases. Positives are weighted by the class
    ratio of the training fold.
    """
    if not has_rows(df):
        return None
    threshold = duration_threshold(df).first()["threshold"]
    above = F.coalesce(F.col("dur_postop_to_discharge") > F.lit(threshold), F.lit(False)).cast("int")
    used = without_recovery(features)
    rows = _vectors(df.withColumn("extended_recovery", above), used, "extended_recovery")
    with _kept(rows):
        train = rows.filter(~F.col("in_test"))
        weight = float(class_balance(train, "label").first()["positive_weight"])
        n_train, n_test = _fold_sizes(rows)
        with training(train, n_train, used, _arity(df, used), _bins(df, used), SEED, Loss(True, weight)) as held:
            model = held.boost(trees=trees, depth=depth, shrinkage=learning_rate, seed=SEED)
        risk = model.score(rows.filter("in_test"), "risk")
        auc = area_under_roc(risk, "label", "risk").first()["auc"]
    result = {
        "model_type": "GBTClassifier",
        "target": "extended_recovery",
        "p90_threshold_minutes": None if threshold is None else round(threshold, 2),
        "auc_score": round(auc, 4),
        "features_used": used,
        "n_train": n_train,
        "n_test": n_test,
    }
    return df.sparkSession.createDataFrame([result], CLASSIFIER_SCHEMA)


def model_search(
    df: DataFrame,
    features: Sequence[str],
    grid: Sequence[Mapping[str, float]] = SEARCH_GRID,
    at_once: int = 4,
) -> DataFrame | None:
    """Mean absolute error of each setting on the test fold, best first.

    The prepared rows are stored once for all fits, of which ``at_once`` run side by side: what one leaves idle between
    its levels the others use.
    """
    rows = _vectors(df, features, "dur_total")
    if not has_rows(rows):
        return None
    bins = _bins(df, features)

    def outcome(number: int, setting: Mapping[str, float]) -> tuple:
        trees, depth, rate = int(setting["n_estimators"]), int(setting["max_depth"]), float(setting["learning_rate"])
        model = held.boost(
            trees=trees,
            depth=depth,
            shrinkage=rate,
            rate=float(setting.get("subsample", 1.0)),
            share=float(setting.get("colsample", 1.0)),
            seed=SEED,
        )
        mae = regression_metrics(model.score(kept.filter("in_test"), "prediction"), "label", "prediction").first()["mae"]
        return number, depth, trees, rate, mae

    with _kept(settle(rows, "training-rows")) as kept:
        n_train, _ = _fold_sizes(kept)
        with training(kept.filter(~F.col("in_test")), n_train, features, _arity(df, features), bins, SEED) as held:
            with ThreadPoolExecutor(at_once) as pool:
                outcomes = list(pool.map(outcome, range(1, len(grid) + 1), grid))
    schema = "setting int, max_depth int, trees int, learning_rate double, mae_minutes double"
    return df.sparkSession.createDataFrame(outcomes, schema).orderBy("mae_minutes", "setting")
