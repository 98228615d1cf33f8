"""What the two operators on vectors share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(df: DataFrame, column: str = "embedding") -> DataFrame:
    """The rows whose vector can take part, with the vector as doubles in ``v``; vectors of any length.

    Left out are vectors that are null, empty or zero, or that hold a null, a NaN or an infinity.
    """
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    fit = F.exists("v", lambda x: x != 0) & ~F.exists("v", bad)
    return df.withColumn("v", F.col(column).cast("array<double>")).where(F.coalesce(fit, F.lit(False)))


def stacked(values) -> np.ndarray:
    """A column of equally long arrays as a matrix."""
    return np.stack(list(values)).astype(np.float64)
