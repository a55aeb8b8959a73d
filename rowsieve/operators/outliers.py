"""G3 statistical (z_score): ``|x - mean| / stddev_samp > threshold``.

The mean and sample standard deviation come from scalar subqueries over the
input.  Catalyst merges all scalar subqueries over the same plan into one
aggregate (partial per partition, final over one row per partition), so any
number of z-score rules costs one extra scan and no shuffle of rows, and the
result reaches each task as a literal rather than through a cross join.
``try_divide`` makes a zero or undefined deviation pass instead of raising.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsieve.functions.columns import TEXT, column_ref, column_type

def numeric_value(df: DataFrame, column: str) -> Column:
    """The column as a number; numbers kept as text are parsed, and text that
    is no number is NULL (it takes no part in the moments and passes)."""
    c = F.col(column_ref(df, column))
    return c.try_cast("double") if isinstance(column_type(df, column), TEXT) else c


def column_moments(df: DataFrame, column: str) -> tuple[Column, Column]:
    x = numeric_value(df, column)
    return df.select(F.avg(x)).scalar(), df.select(F.stddev_samp(x)).scalar()


def zscore_predicate(df: DataFrame, column: str, threshold: float) -> Column:
    mean, sd = column_moments(df, column)
    return F.abs(F.try_divide(numeric_value(df, column) - mean, sd)) > F.lit(float(threshold))


def outliers(df: DataFrame, column: str, threshold: float) -> DataFrame:
    """Rows of ``df`` whose z-score exceeds ``threshold`` (stand-alone G3)."""
    return df.where(zscore_predicate(df, column, threshold))
