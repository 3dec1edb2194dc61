"""The two public tables the workloads were made for: schema, column roles, ratios.

Fixed values throughout: column names and their order as in the published files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tabml.operators.features import add_ratios, rename
from tabml.operators.spec import FeatureSpec

HOUSING_SCHEMA = """
    longitude DOUBLE, latitude DOUBLE, housing_median_age DOUBLE, total_rooms DOUBLE,
    total_bedrooms DOUBLE, population DOUBLE, households DOUBLE, median_income DOUBLE,
    median_house_value DOUBLE, ocean_proximity STRING
"""
HOUSING_RATIOS = {
    "rooms_per_household": ("total_rooms", "households"),
    "bedrooms_per_room": ("total_bedrooms", "total_rooms"),
    "population_per_household": ("population", "households"),
}
HOUSING_IMPUTED = ["total_bedrooms", "bedrooms_per_room"]

CREDIT_CATEGORIES = (
    "SEX", "EDUCATION", "MARRIAGE", "PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6",
)
CREDIT_NUMBERS = (
    "LIMIT_BAL", "AGE",
    "BILL_AMT1", "BILL_AMT2", "BILL_AMT3", "BILL_AMT4", "BILL_AMT5", "BILL_AMT6",
    "PAY_AMT1", "PAY_AMT2", "PAY_AMT3", "PAY_AMT4", "PAY_AMT5", "PAY_AMT6",
)
CREDIT = FeatureSpec(
    key="ID",
    label="label",
    numeric=CREDIT_NUMBERS,
    categorical=CREDIT_CATEGORIES,
    numeric_first=False,
)


def housing_table(raw: DataFrame, key: str | None = None) -> tuple[DataFrame, FeatureSpec]:
    """Ratios added, label renamed, every other column a predictor.

    The published file has no key column; ``key`` names one where the caller added it.
    """
    frame = rename(add_ratios(raw, HOUSING_RATIOS), {"median_house_value": "label"})
    return frame, FeatureSpec.from_schema(frame.schema, "label", ("ocean_proximity",), key)


def credit_table(raw: DataFrame) -> tuple[DataFrame, FeatureSpec]:
    return rename(raw, {"DEFAULT": "label"}), CREDIT
