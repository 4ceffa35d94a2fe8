"""Building blocks for expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """Evaluates ``value`` once a row; inside a lambda Catalyst would evaluate it for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)
