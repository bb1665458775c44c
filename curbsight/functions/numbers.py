"""Numeric and lookup column expressions."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from curbsight import fixed_values as fv


def snap_round(value: Column, places: int) -> Column:
    """Round half up after dropping the noise below 1e-8.

    A double average depends on the order of its additions, so an average of
    exactly 2.005 may come out a hair below it; snapping first makes the
    rounded value the same for every partitioning.
    """
    return F.round(F.round(value, 8), places)


def ratio(total: Column, count: Column) -> Column:
    """Average from a sum and a count; null where nothing was counted."""
    return F.try_divide(total.cast("double"), count)


def exact_sum(value: Column) -> Column:
    """Sum of doubles that have two decimals, added exactly, so in any order; null without values."""
    return F.sum(value.cast("decimal(18,2)")).cast("double")


def exact_mean(value: Column) -> Column:
    """Mean of doubles that have two decimals: added exactly, divided once; null without values."""
    return ratio(F.sum(value.cast("decimal(18,2)")), F.count(value))


def code_lookup(code: Column, mapping: Mapping[str, str], default: str) -> Column:
    """Map a code to its text; unknown codes and nulls get the default."""
    if not mapping:
        return F.lit(default)
    entries = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(entries[code], F.lit(default))


def property_number(property_id: Column, strict: bool = True, prefix: str = fv.ID_PREFIX) -> Column:
    """The number inside an id such as ``CUST_00042``.

    ``strict`` fails the job on a malformed or missing id. Otherwise such an id
    gives null, so the caller can set the row aside.
    """
    number = F.replace(property_id, F.lit(prefix), F.lit("")).try_cast("bigint")
    if not strict:
        return number
    problem = F.concat(F.lit("malformed property id: "), F.coalesce(property_id, F.lit("null")))
    return F.coalesce(number, F.raise_error(problem).cast("bigint"))
