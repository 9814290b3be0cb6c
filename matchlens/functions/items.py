"""Item classes from catalogue attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# End-of-line items that are not builds, one item that always is,
# and the catalogue markers.
NOT_COMPLETED = ("4403", "2033", "7000", "2019")
ALWAYS_COMPLETED = "6693"
BOOTS_TAG = "Boots"
MYTHIC_MARK = "<rarityMythic>"
VARIANT_ID_LENGTH = 6


def item_flags(
    item_id: Column, tags: Column, built_from: Column, builds_into: Column, description: Column
) -> dict[str, Column]:
    """``is_boots``, ``is_completed`` and ``is_mythic``; ids of variants get none of them."""
    no = F.lit(False)
    regular = F.length(item_id) < VARIANT_ID_LENGTH
    boots = regular & F.coalesce(F.array_contains(tags, BOOTS_TAG), no)
    mythic = regular & ~boots & F.coalesce(F.contains(description, F.lit(MYTHIC_MARK)), no)
    final = built_from.isNotNull() & builds_into.isNull() & ~item_id.isin(*NOT_COMPLETED)
    completed = (regular & ~boots & (final | mythic)) | (item_id == ALWAYS_COMPLETED)
    return {"is_boots": boots, "is_completed": completed, "is_mythic": mythic}
