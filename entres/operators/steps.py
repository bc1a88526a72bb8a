"""Steps of long derivations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def step(df: DataFrame, **columns: Column) -> DataFrame:
    """Add or replace columns, computed once.

    Later steps read the values and not the expressions: the optimizer would else write an array expression into
    each place, and each element of a lambda, that reads it.  A generator of one row stands between; there is no shuffle.
    """
    rest = [F.col(c) for c in df.columns if c not in columns]
    row = F.struct(*rest, *[c.alias(n) for n, c in columns.items()])
    return df.select(F.explode_outer(F.array(row)).alias("__row")).select("__row.*")
