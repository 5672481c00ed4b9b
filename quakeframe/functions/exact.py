"""Averages that do not depend on the order in which rows are added.

Sums of doubles change in the last digits with the shuffle order, so a rerun after a lost
executor, a merge of panes or a streaming run could round to another value. Magnitudes are
therefore summed as integers of 1e-8, split at 16 bits into two bigint sums, of which neither
overflows below 1e14 rows per group. Numbers that are no magnitudes (50 or more either way) would
take that room; they go into a third sum, of doubles, which has no bound. All stay in whole-stage
code generation and cost about as much as ``avg``; a decimal sum is more than ten times slower.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = 1e8
_BITS = 16
_EXACT_BELOW = 50.0


def exact_sum(value: Column, name: str) -> list[Column]:
    """Three aggregate columns: ``<name>_hi``, ``<name>_lo`` and ``<name>_far``."""
    far = F.abs(value) >= _EXACT_BELOW
    units = F.when(~far, F.rint(F.when(~far, value) * _UNITS).cast("bigint"))
    return [
        F.sum(F.shiftright(units, _BITS)).alias(f"{name}_hi"),
        F.sum(units.bitwiseAND(F.lit((1 << _BITS) - 1))).alias(f"{name}_lo"),
        F.sum(F.when(far, value)).alias(f"{name}_far"),
    ]


def merge_sum(name: str) -> list[Column]:
    """Adds the partial sums of several groups."""
    return [F.sum(f"{name}_{part}").alias(f"{name}_{part}") for part in ("hi", "lo", "far")]


def exact_avg(name: str, count: Column) -> Column:
    """One division of exact integers, where there are no far numbers."""
    total = F.col(f"{name}_hi").cast("double") * float(1 << _BITS) + F.col(f"{name}_lo")
    far = F.col(f"{name}_far") * _UNITS
    return F.when(far.isNull(), total).when(total.isNull(), far).otherwise(total + far) / (count * _UNITS)
