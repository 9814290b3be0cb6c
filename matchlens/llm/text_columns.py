"""Text expressions that several operators share."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column
from pyspark.sql import functions as F


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is.

    Where a text is ASCII only, ``lower`` does the same and is much faster.
    """
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))
