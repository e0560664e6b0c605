"""Column names of any characters."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def quoted(name: str) -> Column:
    """The column of that name, whatever dots or quotes are in it."""
    return F.col("`" + name.replace("`", "``") + "`")
