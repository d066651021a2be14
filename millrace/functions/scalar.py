"""Small column functions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.operators.routing import hash_shard, shard

__all__ = ["hash_shard", "round_half_even", "shard", "widen"]


def widen(number: Column) -> Column:
    """Whole or fractional numbers as double."""
    return number.cast("double")


def round_half_even(number: Column, digits: int = 1) -> Column:
    return F.bround(number, digits)
