"""Preparation: modes, medians, filling of missing values, feature selection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the relative rank error of the approximate median.
RANK_ERROR = 0.001


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The most frequent value of each column, as one row.

    NULL is not a value, and the lowest value wins a tie. All columns are
    counted in one scan, one grouping set each; counts are combined map-side
    and no task holds the distinct values of a column.
    """
    columns = list(columns)
    k = len(columns)
    cells = [F.col(f"`{c}`") for c in columns]
    counts = (
        df.select(*cells)
        .groupingSets([[c] for c in cells], *cells)
        .agg(F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_set"))
    )
    best = []
    for i, (name, cell) in enumerate(zip(columns, cells)):
        # The grouping id has a 1 for every column outside the set.
        this_set = (2**k - 1) - 2 ** (k - 1 - i)
        rank = F.when((F.col("_set") == this_set) & cell.isNotNull(), F.struct(-F.col("_n"), cell))
        best.append(F.min_by(cell, rank).alias(name))
    return counts.agg(*best)


def all_modes(df: DataFrame, column: str) -> DataFrame:
    """Every value that is as frequent as the most frequent, ascending; NULL is left out."""
    cell = F.col(column)
    counts = df.filter(cell.isNotNull()).groupBy(cell).agg(F.count(F.lit(1)).alias("_n"))
    most = counts.agg(F.max("_n").alias("_n")).scalar()
    return counts.filter(F.col("_n") == most).select(column).orderBy(column)


def top_value(df: DataFrame, column: str, count: str = "count") -> DataFrame:
    """The most frequent value and its count; the lowest value wins a tie."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(count))
    return counts.orderBy(F.desc(count), F.asc(column)).limit(1)


def approximate_medians(df: DataFrame, columns: Sequence[str], rank_error: float = RANK_ERROR) -> DataFrame:
    """A value of each column whose rank is within `rank_error` of the middle, as one row.

    NULL for a column without values.
    """
    accuracy = round(1 / rank_error)
    return df.agg(*[F.percentile_approx(c, 0.5, accuracy).alias(c) for c in columns])


@dataclass(frozen=True)
class FillValues:
    """Fitted replacements, one value per column."""

    values: dict[str, Any]

    def apply(self, df: DataFrame) -> DataFrame:
        """Fills NULLs; a value is cast to the type of its column."""
        return df.fillna(self.values) if self.values else df


def fit_fill_values(
    df: DataFrame,
    mode_columns: Sequence[str] = (),
    median_columns: Sequence[str] = (),
    rank_error: float = RANK_ERROR,
) -> FillValues:
    """Fits fill values on `df`: an action that brings one value per column back.

    Fit on the training rows and apply to both halves, or fit on all rows to
    reproduce a whole-table fit. A column without values is left unfilled.
    """
    fitted: dict[str, Any] = {}
    if mode_columns:
        fitted.update(modes(df, mode_columns).first().asDict())
    if median_columns:
        fitted.update(approximate_medians(df, median_columns, rank_error).first().asDict())
    return FillValues({c: v for c, v in fitted.items() if v is not None})


def select_features(
    df: DataFrame, categorical: Sequence[str], numeric: Sequence[str], label: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Only the features, the label and the columns to keep; ids and raw columns drop out."""
    return df.select(*dict.fromkeys([*keep, *categorical, *numeric, label]))
