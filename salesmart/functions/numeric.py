"""Numeric coercion with the semantics of a lenient "to number" parse."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import strip

# Decimal number text: optional sign, digits with an optional fraction, optional exponent.
# Anything else (``12d``, ``inf``, ``n/a``, ``two``) is not a number.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def coerce_number(c: Column) -> Column:
    """Parse text to double; null when missing or not a plain decimal number."""
    return stripped_number(strip(c))


def stripped_number(s: Column) -> Column:
    """``coerce_number`` of a text without white space around it."""
    return F.when(s.rlike(NUMBER_PATTERN), s.try_cast("double"))
