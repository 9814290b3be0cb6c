"""Join on keys that may be NULL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join where a NULL key meets a NULL key; the keys come once, from the left."""
    a, b = left.alias("l"), right.alias("r")
    matches = reduce(
        lambda x, y: x & y, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    )
    joined = a.join(b, matches, how)
    added = [F.col(f"r.{name}") for name in right.columns if name not in keys]
    return joined.select("l.*", *added)
