"""Cleaning maps and run settings passed to the jobs."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Cleaning:
    """Value maps per column (exact, case-sensitive; unmapped values pass through)."""

    product: Mapping[str, str] = field(default_factory=dict)
    sector: Mapping[str, str] = field(default_factory=dict)
    location: Mapping[str, str] = field(default_factory=dict)
    # The CRM export maps country spellings the analytics layer keeps.
    crm_country: Mapping[str, str] = field(default_factory=dict)


# The known misspellings of the CRM sample data and their fixes
# (product GTXPro -> GTX Pro, sector technolgy -> technology, office location
# Philipines -> Philippines; the CRM export also maps Korea to the picklist
# value Korea, Republic of).
REFERENCE_CLEANING = Cleaning(
    product={"GTXPro": "GTX Pro"},
    sector={"technolgy": "technology"},
    location={"Philipines": "Philippines"},
    crm_country={"Philipines": "Philippines", "Korea": "Korea, Republic of"},
)
