"""Aggregates whose result depends on the data only, never on arrival order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_filled(value: Column, order: Column) -> Column:
    """The non-blank value that comes first by ``order``; empty if there is none.

    Rows that tie on ``order`` are settled by the value itself.
    """
    candidate = F.when(value != "", F.struct(order.alias("at"), value.alias("value")))
    return F.coalesce(F.min(candidate)["value"], F.lit(""))


def most_frequent(value: Column, count: Column) -> Column:
    """The non-blank value with the highest ``count``, the smallest on a tie.

    Works on rows that hold one value and its count each, so no group has to keep
    a table of all its values in memory.
    """
    candidate = F.when(value != "", F.struct((-count).alias("rank"), value.alias("value")))
    return F.coalesce(F.min(candidate)["value"], F.lit(""))
