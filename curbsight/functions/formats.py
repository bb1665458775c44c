"""Text column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from curbsight import fixed_values as fv


def pick(values: Sequence[str], index: Column) -> Column:
    """``values[index]`` for a zero-based index column; null beyond the list and for a null index.

    ``get`` and not ``element_at``: the latter takes a null index into an array
    without nulls for a value.
    """
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def code_point_sum(text: Column) -> Column:
    """Sum of the character codes of a string."""
    codes = F.transform(F.split(text, ""), lambda c: F.ascii(c).cast("bigint"))
    return F.aggregate(codes, F.lit(0).cast("bigint"), lambda total, code: total + code)


def strip_whitespace(text: Column) -> Column:
    """Drop white space of every kind on both sides (``trim`` drops blanks only)."""
    return F.btrim(text, F.lit(fv.WHITESPACE))


def dollars(amount: Column) -> Column:
    """``$12,345``, rounded half to even."""
    return F.concat(F.lit("$"), F.format_number(amount, 0))


def number_text(value: Column, places: int, missing: str = fv.NO_FIGURE) -> Column:
    """A number with a fixed count of decimals and no thousands separator; a null reads ``missing``.

    The binary value is rounded, an exact tie to the even digit.
    """
    return F.coalesce(_fixed(value, places), F.lit(missing))


def rounded(value: Column, places: int) -> Column:
    """A number rounded like in :func:`number_text`, as a number; null stays null."""
    return _fixed(value, places).cast("double")


def _fixed(value: Column, places: int) -> Column:
    return F.call_function("format_number", value.cast("double"), F.lit("0." + "0" * places))


def text_or_none(value: Column) -> Column:
    """String form of a value inside a sentence; a null reads ``None``."""
    return F.coalesce(value.cast("string"), F.lit("None"))
