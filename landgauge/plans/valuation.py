"""Fitting the price model and valuing properties with it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landgauge.constants import TARGET
from landgauge.functions import numeric as N
from landgauge.operators.boosting import BoostedTrees
from landgauge.operators.filters import unify_house_type
from landgauge.operators.impute import parking_means
from landgauge.operators.metrics import regression_metrics
from landgauge.operators.model import advanced_inputs, fit_advanced, predict
from landgauge.operators.split import hash_split
from landgauge.plans.features import FeatureEncoders, imputed
from landgauge.sources import artifacts


def served(properties: DataFrame, parking: DataFrame) -> DataFrame:
    """One way from raw properties to model rows, for training and serving alike: labels unified, distance capped,
    gaps filled with what the training rows gave."""
    rows = unify_house_type(properties).withColumn("subway_dist", N.capped_distance("subway_dist"))
    return imputed(rows, parking)


@dataclass
class Valuation:
    """Fill values, encoders and model fitted together, so that new rows meet the mappings of the training."""

    parking: DataFrame
    encoders: FeatureEncoders
    model: BoostedTrees

    @classmethod
    def fit(cls, target: DataFrame, row_id: str, **params) -> tuple[Valuation, DataFrame]:
        """Fit on train and validation rows; returns the valuation and its test metrics."""
        split = hash_split(target, row_id, train=70, validation=10)
        parking = parking_means(split.where(F.col("split") == "train"))
        rows = served(split, parking)
        encoders = FeatureEncoders.fit(rows.where(F.col("split") == "train"))
        ready = advanced_inputs(encoders.transform(rows))
        model = fit_advanced(ready, **params)
        scored = predict(model, ready.where(F.col("split") == "test"))
        scored = scored.withColumn("actual_price", N.price_from_log(TARGET))
        return cls(parking, encoders, model), regression_metrics(scored, "actual_price", "predicted_price")

    def value(self, properties: DataFrame) -> DataFrame:
        """Enriched properties with price per square metre and total value.

        A map plus lookups of fitted tables, so it serves batch and streaming frames alike. Raw rows are prepared here.
        """
        ready = advanced_inputs(self.encoders.transform(served(properties, self.parking)))
        return predict(self.model, ready).withColumn(
            "estimated_value", N.final_value("predicted_price", "excluUseAr")
        )

    def save(self, folder: str) -> None:
        spark = self.parking.sparkSession
        artifacts.save_mapping(self.parking, folder, "parking")
        artifacts.save_mapping(self.encoders.means, folder, "means")
        levels = [(i, level) for i, level in enumerate(self.encoders.levels)]
        artifacts.save_mapping(spark.createDataFrame(levels, "place int, level string"), folder, "levels")
        artifacts.save_model(self.model, spark, f"{folder}/model")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> Valuation:
        levels = artifacts.load_mapping(spark, folder, "levels").orderBy("place").collect()
        encoders = FeatureEncoders([r["level"] for r in levels], artifacts.load_mapping(spark, folder, "means"))
        return cls(artifacts.load_mapping(spark, folder, "parking"), encoders, artifacts.load_model(spark, f"{folder}/model"))
