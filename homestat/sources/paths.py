"""File names in one form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def one_name(file: Column) -> Column:
    """Local files are listed with three slashes and read with one."""
    return F.regexp_replace(file, "^file:/+", "file:/")
