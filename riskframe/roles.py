"""Column roles of a labelled table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class Roles:
    """Which column plays which part.  Feature lists must not overlap."""

    key: str
    target: str
    continuous: list[str] = field(default_factory=list)
    ordinal: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)
    sensitive: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        features = self.features
        if len(features) != len(set(features)):
            raise ValueError("a column may have only one of the roles continuous, ordinal, categorical")
        if self.target in features:
            raise ValueError(f"target {self.target!r} is also listed as a feature")

    @property
    def features(self) -> list[str]:
        return [*self.continuous, *self.ordinal, *self.categorical]

    def for_drift(self) -> "Roles":
        """Drift tests treat ordinal codes as categories."""
        return Roles(
            key=self.key,
            target=self.target,
            continuous=list(self.continuous),
            categorical=[*self.categorical, *self.ordinal],
            sensitive=list(self.sensitive),
        )

    def present_in(self, *frames: DataFrame) -> "Roles":
        """Drop every feature that is missing from any of the frames."""
        common = set.intersection(*[set(f.columns) for f in frames])

        def keep(cols: list[str]) -> list[str]:
            return [c for c in cols if c in common]

        return Roles(
            key=self.key,
            target=self.target,
            continuous=keep(self.continuous),
            ordinal=keep(self.ordinal),
            categorical=keep(self.categorical),
            sensitive=keep(self.sensitive),
        )


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] | list[str] = ()) -> list[str]:
    """Names of the numeric columns, in schema order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def split_features_target(df: DataFrame, roles: Roles) -> tuple[DataFrame, DataFrame]:
    """Feature table and target table, both carrying the key, features in role order."""
    return df.select(roles.key, *roles.features), df.select(roles.key, roles.target)
