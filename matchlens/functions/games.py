"""Match-level values: version, day, duration."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a game day starts three hours before midnight.
DAY_SHIFT_MS = 10_800_000
DAY_MS = 86_400_000


def major_minor(version: Column) -> Column:
    """``13.14.522.7601`` to ``13.14``."""
    return F.substring_index(version, ".", 2)


def version_order(version: Column) -> Column:
    """Sort key comparing major and minor as numbers; unreadable parts sort lowest."""
    parts = F.split(version, "[.]")
    return F.struct(
        F.get(parts, F.lit(0)).try_cast("int").alias("major"),
        F.get(parts, F.lit(1)).try_cast("int").alias("minor"),
    )


def game_day(epoch_ms: Column) -> Column:
    """Day of play of an epoch-millisecond time, independent of the session zone."""
    return F.date_from_unix_date(F.floor((epoch_ms + DAY_SHIFT_MS) / DAY_MS).cast("int"))


def duration_bucket(seconds: Column) -> Column:
    """Five-minute bucket of a game length: ``15``, ``20`` … ``35``, ``35+``."""
    fives = F.ceil(seconds / 300)
    return (
        F.when(fives <= 3, F.lit("15"))
        .when(fives > 7, F.lit("35+"))
        .otherwise((fives * 5).cast("string"))
    )
