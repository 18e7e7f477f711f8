"""Sums of money that come out alike however the rows are dealt over tasks.

Adding doubles rounds in the order of the rows. As decimals the amounts add up exactly; eight
digits after the point are kept. An amount that is no finite number, or has more than 20 digits
before the point, counts as missing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(28,8)"


def _exact(name: str) -> Column:
    return F.col(name).try_cast(AMOUNT)


def total(name: str) -> Column:
    return F.sum(_exact(name)).cast("double")


def average(name: str) -> Column:
    return F.avg(_exact(name)).cast("double")
