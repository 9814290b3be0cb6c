"""Column expressions shared by the operators."""

from matchlens.functions.games import duration_bucket, game_day, major_minor, version_order
from matchlens.functions.items import item_flags
from matchlens.functions.rates import champion_score, grade, rate
from matchlens.functions.tiers import APEX, LADDER, canonical_tier, tier_priority, tier_rank

__all__ = [
    "APEX",
    "LADDER",
    "canonical_tier",
    "champion_score",
    "duration_bucket",
    "game_day",
    "grade",
    "item_flags",
    "major_minor",
    "rate",
    "tier_priority",
    "tier_rank",
    "version_order",
]
