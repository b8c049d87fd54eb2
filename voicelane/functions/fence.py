"""Keep an expensive column from being computed twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later filters use as it is.

    A filter on a derived column is normally pushed below the projection that
    defines it, and the whole derivation is then evaluated for the filter and again
    for the output. That is right for cheap expressions and ruinous for text
    matching. Exploding a one-element array gives the same single row per row, and
    filters on its output stay above it.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
