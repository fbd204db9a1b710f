"""String cleaning expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from ..constants import STRIP_CHARS


def strip(c: Column | str) -> Column:
    """Python-style ``str.strip()``: remove leading and trailing white space, Unicode's included.

    Trimming searches the list of characters for each end; a text that begins and ends in visible ASCII has nothing to remove.
    """
    col = F.col(c) if isinstance(c, str) else c
    plain = F.substring(col, 1, 1).between("!", "~") & F.substring(col, -1, 1).between("!", "~")
    return F.when(plain, col).otherwise(F.btrim(col, F.lit(STRIP_CHARS)))


def as_py_str(c: Column | str) -> Column:
    """Text a pandas ``astype(str)`` gives: a null becomes ``'None'``."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col, F.lit("None"))


def is_in(c: Column, values: Iterable[str]) -> Column:
    """Null-safe membership: a null is never a member (returns false, not null)."""
    return F.coalesce(c.isin(list(values)), F.lit(False))


def replace_placeholders(c: Column, placeholders: Iterable[str], value: str) -> Column:
    return F.when(is_in(c, placeholders), F.lit(value)).otherwise(c)


def ssis_blank(c: Column) -> Column:
    """SSIS ``ISNULL(c) || LEN(c) == 0``."""
    return c.isNull() | (F.length(c) == 0)
