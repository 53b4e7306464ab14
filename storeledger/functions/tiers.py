"""Service tier of a location and how often it is visited."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from storeledger.config import LOWEST_TIER, Config


def sla_tier(monthly_spend: Column, config: Config) -> Column:
    """Highest tier whose threshold the unrounded spend reaches."""
    lowest_first = sorted(config.tier_thresholds.items(), key=lambda item: item[1])
    tier = F.lit(LOWEST_TIER)
    for name, threshold in lowest_first:
        tier = F.when(monthly_spend >= F.lit(float(threshold)), name).otherwise(tier)
    return tier


def visit_frequency(tier: Column, config: Config) -> Column:
    entries = [F.lit(part) for item in config.visit_frequency.items() for part in item]
    return F.try_element_at(F.create_map(*entries), tier)
