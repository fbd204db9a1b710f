"""Sources: parquet tables, nested sales JSON, customer JSON."""

from .tables import read_table, read_target  # noqa: F401
