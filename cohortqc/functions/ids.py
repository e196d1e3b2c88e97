"""Identifiers of samples and arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Notations of "no reference" once an identifier is normalised.
NO_REFERENCE = ("", "0", "NA")


def norm_id(col: Column | str) -> Column:
    """Two identifiers are the same if they agree after trimming spaces and upper-casing."""
    return F.upper(F.trim(F.col(col) if isinstance(col, str) else col))


def is_number(col: Column | str) -> Column:
    """Neither null nor NaN; never null itself."""
    c = F.col(col) if isinstance(col, str) else col
    return c.isNotNull() & ~F.isnan(c)


def is_finite(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return is_number(c) & (F.abs(c) != F.lit(float("inf")))


def lot(column: str, seed: int = 42) -> Column:
    """A number from 0 up to 1 that depends on the id and the seed only, whatever the partitions or the engine."""
    text = F.concat_ws(":", F.col(column).cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(float(2**32))
