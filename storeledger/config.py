"""Settings of a reporting run, and the values that outputs depend on."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- Fixed values -----------------------------------------------------------
# Changing any of these changes results that receivers rely on.

DISTRIBUTOR, CHAIN_A, CHAIN_B = "distributor", "chain_a", "chain_b"

# Union order of the sources; the first source of a location names its chain.
SOURCES = (DISTRIBUTOR, CHAIN_A, CHAIN_B)
# Sources whose locations replace the same locations of the distributor.
AUTHORITATIVE = (CHAIN_A, CHAIN_B)

STANDARD_COLUMNS = (
    "source", "vendor_item", "item_description", "location_code",
    "customer_name", "address", "city", "state", "zip",
    "invoice_date", "invoice_num", "yyyymm", "qty", "unit_price", "total",
)

# CRM names that belong to a chain.
CHAIN_NAME_PATTERNS = {CHAIN_A: "PAIN|QUOTID|LPQ", CHAIN_B: "JOE|JUICE|JTJ"}

TIER_THRESHOLDS = {"Tier 1": 850.0, "Tier 2": 600.0, "Tier 3": 300.0}
LOWEST_TIER = "Tier 4"
VISIT_FREQUENCY = {
    "Tier 1": "Monthly",
    "Tier 2": "Bi-Monthly",
    "Tier 3": "Quarterly",
    "Tier 4": "Annually",
}

MIN_NAME_LENGTH = 6      # shortest name a containment match may use
MIN_ADDRESS_LENGTH = 8   # shortest address an address match may use

TEXT_FIELD, NUMBER_FIELD = 1, 2
HOLDER_TYPE = 2
FORM_NAME, FORM_API_NAME, FORM_STATUS = "Sales Report", "SalesReport", "PROCESSED"
# api name -> (field type, label)
FORM_FIELDS = {
    "ReportMonth": (TEXT_FIELD, "Report Month"),
    "TotalSales": (TEXT_FIELD, "Total Sales"),
    "TotalUnits": (NUMBER_FIELD, "Total Units"),
    **{f"TopSKU{i}": (TEXT_FIELD, f"Top SKU #{i}") for i in range(1, 11)},
}
# ---------------------------------------------------------------------------

# Sums of amounts must not depend on row order, so they are exact decimals.
AMOUNT = T.DecimalType(28, 8)
AMOUNT_LIMIT = 1e19  # a number from here on that does not fit is an error, not bad text

_MONTH = re.compile(r"\d{4}-(0[1-9]|1[0-2])")


def check_month(month: str) -> str:
    if not _MONTH.fullmatch(month):
        raise ValueError(f"report month must be written YYYY-MM, got {month!r}")
    return month


@dataclass(frozen=True)
class Config:
    report_month: str | None = None
    tier_thresholds: Mapping[str, float] = field(default_factory=lambda: dict(TIER_THRESHOLDS))
    visit_frequency: Mapping[str, str] = field(default_factory=lambda: dict(VISIT_FREQUENCY))
    top_n: int = 10
    # group name -> SKUs counted as one product; the first one is shown
    sku_variant_groups: Mapping[str, Sequence[str] | None] = field(default_factory=dict)
    chain_name_patterns: Mapping[str, str] = field(
        default_factory=lambda: dict(CHAIN_NAME_PATTERNS)
    )

    def __post_init__(self) -> None:
        if self.report_month is not None:
            check_month(self.report_month)
