"""Encoders and scalers that are fitted on one slice and applied to all rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landgauge.operators.profile import exact_quantiles
from landgauge.session import measured

UNKNOWN = "UNKNOWN"


def label_codes(train: DataFrame, column: str) -> DataFrame:
    """(value, code): rank of the sorted distinct training values, 'UNKNOWN' included.

    The ranking runs on distinct categories only, after a map-side combined distinct.
    """
    spark = train.sparkSession
    values = train.select(F.coalesce(F.col(column).cast("string"), F.lit(UNKNOWN)).alias("value"))
    unknown = spark.createDataFrame([(UNKNOWN,)], "value string")
    levels = values.distinct().unionByName(unknown).distinct()
    return levels.withColumn("code", F.row_number().over(Window.orderBy("value")) - 1)


@dataclass
class LabelEncoder:
    """Codes per column; unseen and null values take the code of 'UNKNOWN'."""

    codes: dict[str, DataFrame]

    @classmethod
    def fit(cls, train: DataFrame, columns: list[str]) -> LabelEncoder:
        return cls({c: measured(label_codes(train, c)) for c in columns})

    def transform(self, df: DataFrame) -> DataFrame:
        for c, table in self.codes.items():
            unknown = table.where(F.col("value") == UNKNOWN).select("code").scalar()
            named = table.select(F.col("value").alias("_value"), F.col("code").alias("_code"))
            df = (
                df.join(named, F.col(c).cast("string") == F.col("_value"), "left")
                .withColumn(f"{c}_encoded", F.coalesce("_code", unknown))
                .drop("_value", "_code")
            )
        return df

    def table(self) -> DataFrame:
        """All mappings as (column, value, code), ready to be saved."""
        out = None
        for c, table in self.codes.items():
            part = table.select(F.lit(c).alias("column"), "value", "code")
            out = part if out is None else out.unionByName(part)
        return out

    @classmethod
    def from_table(cls, table: DataFrame) -> LabelEncoder:
        columns = [r["column"] for r in table.select("column").distinct().collect()]
        return cls({c: table.where(F.col("column") == c).select("value", "code") for c in columns})


@dataclass
class RobustScaler:
    """(x - median) / (75 % - 25 %), with nulls as 0 and a zero spread as 1."""

    stats: dict[str, tuple[float, float]]

    @classmethod
    def fit(cls, train: DataFrame, columns: list[str]) -> RobustScaler:
        filled = train.select(
            *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns]
        )
        rows = exact_quantiles(filled, columns, [0.25, 0.5, 0.75]).collect()
        q = {(r["column"], r["prob"]): r["value"] for r in rows}
        return cls(
            {c: (q[c, 0.5], (q[c, 0.75] - q[c, 0.25]) or 1.0) for c in columns}
        )

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                f"{c}_scaled": (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - center) / spread
                for c, (center, spread) in self.stats.items()
            }
        )

    def table(self, df: DataFrame) -> DataFrame:
        rows = [(c, m, s) for c, (m, s) in self.stats.items()]
        return df.sparkSession.createDataFrame(rows, "column string, center double, spread double")

    @classmethod
    def from_table(cls, table: DataFrame) -> RobustScaler:
        return cls({r["column"]: (r["center"], r["spread"]) for r in table.collect()})


def one_hot_levels(train: DataFrame, column: str, max_levels: int | None = None) -> list[str]:
    """Sorted levels but for the first. Each becomes a column; with ``max_levels`` more of them are refused."""
    levels = train.select(column).dropna().distinct()
    found = (levels if max_levels is None else levels.limit(max_levels + 1)).collect()
    if max_levels is not None and len(found) > max_levels:
        raise ValueError(f"{column} has more than {max_levels} levels; use a target encoding")
    return sorted(str(r[0]) for r in found)[1:]


def one_hot(df: DataFrame, column: str, levels: list[str]) -> DataFrame:
    """0/1 column per level; null and unseen values are 0 everywhere."""
    hot = {
        f"{column}_{level}": F.coalesce(F.col(column).cast("string") == level, F.lit(False)).cast("int")
        for level in levels
    }
    return df.withColumns(hot)


def target_means(train: DataFrame, key: str, target: str) -> DataFrame:
    """Mean target per category."""
    return train.dropna(subset=[key]).groupBy(key).agg(F.avg(target).alias(f"{key}_encoded"))


def target_encode(df: DataFrame, means: DataFrame, key: str) -> DataFrame:
    """Attach the fitted means; categories not seen in the fit stay null."""
    return df.join(measured(means), key, "left")
