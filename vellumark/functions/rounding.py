from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, digits: int) -> Column:
    """Round a bounded double; ties go away from zero, with the same result in any SQL engine."""
    scale = float(10**digits)
    up = F.floor(F.abs(value) * scale + F.lit(0.5))
    return F.when(value < 0, -up).otherwise(up) / F.lit(scale)
