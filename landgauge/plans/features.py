"""Enriched trades -> price target and model features; chronological features and text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgauge.constants import LABEL_COLUMNS, ROW_HOUSE, SCALED_COLUMNS, TARGET
from landgauge.functions import numeric as N
from landgauge.functions import parsing as P
from landgauge.functions import text as X
from landgauge.operators.encode import (
    LabelEncoder,
    RobustScaler,
    one_hot,
    one_hot_levels,
    target_encode,
    target_means,
)
from landgauge.operators.filters import plausible_prices, unify_house_type
from landgauge.operators.impute import elevator_fill, floors_fill, median_fill, parking_fill
from landgauge.operators.split import chronological_split
from landgauge.session import measured


def price_target(enriched: DataFrame) -> DataFrame:
    """Plausible trades with nominal, adjusted and logged price per square metre."""
    kept = unify_house_type(plausible_prices(enriched))
    priced = kept.withColumn(
        "nominal_price_per_m2", N.nominal_price("dealAmount", "excluUseAr")
    ).withColumn(
        "adjusted_price_per_m2", F.col("nominal_price_per_m2") * F.col("Time_Adjustment")
    )
    return priced.withColumns(
        {
            TARGET: N.log_price("adjusted_price_per_m2"),
            "subway_dist": N.capped_distance("subway_dist"),
        }
    )


@dataclass
class FeatureEncoders:
    """House-type levels and dong target means, from the slice they were fitted on."""

    levels: list[str]
    means: DataFrame

    @classmethod
    def fit(cls, train: DataFrame) -> FeatureEncoders:
        used = train.select("houseType", "umdNm", TARGET).persist()  # the rows are computed once for both
        levels = one_hot_levels(used, "houseType")
        means = measured(target_means(used, "umdNm", TARGET))
        used.unpersist()
        return cls(levels, means)

    def transform(self, df: DataFrame) -> DataFrame:
        levels = self.levels if ROW_HOUSE in self.levels else [*self.levels, ROW_HOUSE]
        return target_encode(one_hot(df, "houseType", levels), self.means, "umdNm")


def imputed(target: DataFrame, parking: DataFrame | None = None) -> DataFrame:
    """Parking by dong (from fitted means, where given), elevator by year, floors by listing."""
    return floors_fill(elevator_fill(parking_fill(target, means=parking)))


def final_features(
    target: DataFrame, train: DataFrame | None = None
) -> tuple[DataFrame, FeatureEncoders]:
    """Imputed and encoded rows. Encoders are fitted on ``train``, or on all rows when not given."""
    rows = imputed(target)
    encoders = FeatureEncoders.fit(rows if train is None else train)
    return encoders.transform(rows), encoders


def chronological_features(
    enriched: DataFrame, row_id: str
) -> tuple[DataFrame, LabelEncoder, RobustScaler]:
    """Cleaned rows with dates, flags, split, label codes, scaled columns and listing text.

    Encoder and scaler see the earliest 80 % of the deals only.
    """
    rows = enriched.withColumn("mhouseNm", P.building_name("mhouseNm"))
    rows = median_fill(rows, ["buildYear", "Age", "floor"])
    rows = rows.withColumn("deal_date", P.deal_date("dealYear", "dealMonth", "dealDay"))
    rows = rows.withColumns(
        {
            "is_subway_area": N.subway_area("subway_dist"),
            "deal_age": N.deal_age("dealYear", "buildYear"),
            "log_price_per_m2": N.log_price("Price_per_m2"),
        }
    )
    rows = chronological_split(rows, "deal_date", row_id)
    # Every column is fitted in a job of its own; the filled rows are computed once for all of them.
    fitted = dict.fromkeys([*LABEL_COLUMNS, *SCALED_COLUMNS])
    train = rows.where(F.col("split") == "train").select(*fitted).persist()
    labels = LabelEncoder.fit(train, LABEL_COLUMNS)
    scaler = RobustScaler.fit(train, SCALED_COLUMNS)
    train.unpersist()
    encoded = scaler.transform(labels.transform(rows))
    return encoded.withColumn("text_context", X.listing_text()), labels, scaler
