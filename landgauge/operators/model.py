"""Gradient-boosted price model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgauge.constants import ADVANCED_FEATURES, BASE_FEATURES, TARGET
from landgauge.functions import numeric as N
from landgauge.operators.boosting import BoostedTrees


def model_input(df: DataFrame, features: list[str], target: str | None = None) -> DataFrame:
    """Features as doubles, missing ones null; rows without target are left out; other columns are kept."""
    typed = df.withColumns({f: F.col(f).cast("double") for f in features})
    return typed.dropna(subset=[target]) if target else typed


def advanced_inputs(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "is_high_floor_without_elevator": N.high_floor_without_elevator(
                "floor", "has_elevator"
            ),
            "area_ratio": N.area_ratio("excluUseAr", "landAr"),
        }
    )


def fit_baseline(
    train: DataFrame,
    features: list[str] | None = None,
    target: str = TARGET,
    trees: int = 1_000,
    leaves: int = 63,
    rate: float = 0.05,
) -> BoostedTrees:
    """Boosted trees on the base features, a fixed number of them, of any depth."""
    features = features or BASE_FEATURES
    return BoostedTrees.fit(model_input(train, features, target), features, target, trees=trees, leaves=leaves, rate=rate)


def fit_advanced(
    split: DataFrame,
    features: list[str] | None = None,
    target: str = TARGET,
    trees: int = 2_000,
    leaves: int = 64,
    depth: int = 10,
    rate: float = 0.05,
    patience: int = 50,
) -> BoostedTrees:
    """Boosted trees that stop when the validation rows no longer gain.

    ``split`` carries a ``split`` column; the stop watches 'validation' and never 'test'.
    """
    features = features or ADVANCED_FEATURES
    seen = split.where(F.col("split").isin("train", "validation"))
    data = model_input(seen, features, target).withColumn("is_validation", F.col("split") == "validation")
    return BoostedTrees.fit(
        data, features, target, "is_validation", trees=trees, leaves=leaves, depth=depth, rate=rate, patience=patience
    )


def predict(model: BoostedTrees, df: DataFrame) -> DataFrame:
    """Add ``predicted_log`` and ``predicted_price`` (per square metre)."""
    return model.transform(df, "predicted_log").withColumn("predicted_price", N.price_from_log("predicted_log"))


def feature_importances(model: BoostedTrees, spark) -> DataFrame:
    """(feature, importance, splits), ascending: the share of all gain, and the number of splits that use the feature."""
    kind = "feature string, importance double, splits long"
    return spark.createDataFrame(model.importances(), kind).orderBy("importance", "feature")
