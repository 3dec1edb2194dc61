"""Which column plays which part."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tabml.functions import require_columns


@dataclass(frozen=True)
class FeatureSpec:
    """Key, label, numeric predictors and categorical predictors of a table.

    ``numeric_first`` sets the slot order of the feature vector: scaled numbers
    before the one-hot slots, or after them.
    """

    label: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...] = ()
    key: str | None = None
    numeric_first: bool = True

    @classmethod
    def from_schema(
        cls,
        schema: T.StructType,
        label: str,
        categorical: tuple[str, ...] = (),
        key: str | None = None,
        numeric_first: bool = True,
    ) -> FeatureSpec:
        """Every column that is not key, label or category is a numeric predictor."""
        taken = {label, key, *categorical}
        numeric = tuple(field.name for field in schema if field.name not in taken)
        wrong = [n for n in numeric if not isinstance(schema[n].dataType, T.NumericType)]
        if wrong:
            raise ValueError(f"not numeric and without a role: {', '.join(wrong)}")
        return cls(label, numeric, tuple(categorical), key, numeric_first)

    def role(self, name: str) -> str:
        if name == self.label:
            return "label"
        if name == self.key:
            return "key"
        if name in self.categorical:
            return "categorical"
        return "numeric" if name in self.numeric else "unused"

    def check(self, frame: DataFrame) -> None:
        names = [self.label, *self.numeric, *self.categorical]
        require_columns(frame, names + ([self.key] if self.key else []))
