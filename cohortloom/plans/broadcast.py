"""Static dimensions.

Rows given as a Python list have a known length and are hinted for
broadcast; a dimension given as a DataFrame is joined as the planner (with
adaptive execution) sees fit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dimension(spark, rows, schema) -> DataFrame:
    """A static dimension as a DataFrame ready to join."""
    return rows if isinstance(rows, DataFrame) else F.broadcast(spark.createDataFrame(list(rows), schema))
