"""Row conditions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filled(df: DataFrame, *columns: str) -> DataFrame:
    """The rows without a null in ``columns``, by default in any; a condition that reaches the scan."""
    tests = [F.col(name).isNotNull() for name in columns or df.columns]
    return df.where(reduce(lambda left, right: left & right, tests))
