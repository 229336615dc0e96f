"""Column functions of the engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    """A column, given as such or by name."""
    return F.col(c) if isinstance(c, str) else c
