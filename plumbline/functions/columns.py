"""Column expressions shared by all operators: missing text, trimming, fresh column names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Blanks at either end, Unicode separators included.
_EDGE = r"^[\s\p{Z}]+|[\s\p{Z}]+$"


def col(name: str) -> Column:
    """A column by its exact name; dots and backticks in names are no path."""
    return F.col("`" + name.replace("`", "``") + "`")


def trimmed(c: Column) -> Column:
    """Text without blanks at its ends (any Unicode blank)."""
    return F.regexp_replace(c, _EDGE, "")


def is_missing(c: Column) -> Column:
    """NULL, blank, or the text ``nan`` in any case. Never NULL itself."""
    return c.isNull() | F.lower(trimmed(c)).isin("", "nan")


def present(c: Column) -> Column:
    """STR-04: the text, or NULL where it is missing."""
    return F.when(~is_missing(c), c)


def fresh(df_or_names: DataFrame | Iterable[str], *bases: str) -> list[str]:
    """Column names that clash with none of the frame's (compared without case, as Spark resolves them)."""
    names = df_or_names.columns if isinstance(df_or_names, DataFrame) else list(df_or_names)
    taken, out = {n.lower() for n in names}, []
    for base in bases:
        name, k = base, 0
        while name.lower() in taken:
            k += 1
            name = f"{base}_{k}"
        taken.add(name.lower())
        out.append(name)
    return out
