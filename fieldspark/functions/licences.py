"""Licence texts of the two sources as codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes that are taken as they are, and the codes that an analysis expects.
GBIF_CODES = ("CC0_1_0", "CC_BY_4_0", "CC_BY_NC_4_0")
NBN_CODES = ("OGL", "CC0", "CC-BY", "CC-BY-NC")
EXPECTED = {"GBIF": GBIF_CODES, "NBN": NBN_CODES}


# Patterns by code, in the order in which they are asked (BY-NC before BY, which would match it too).
GBIF_PATTERNS = {"CC0_1_0": "publicdomain/zero/1.0", "CC_BY_NC_4_0": "licenses/by-nc/4.0", "CC_BY_4_0": "licenses/by/4.0"}
NBN_PATTERNS = {
    "OGL": r"open government licence|\bogl\b",
    "CC0": r"\bcc0\b|publicdomain/zero/1.0",
    "CC-BY-NC": r"cc[- ]?by[- ]?nc|licenses/by-nc/4.0",
    "CC-BY": r"cc[- ]?by\b|licenses/by/4.0",
}


def _by_pattern(start: Column, text: Column, patterns: dict[str, str]) -> Column:
    for code, pattern in patterns.items():
        start = start.when(text.rlike(pattern), code)
    return start


def licence_code_gbif(x: Column) -> Column:
    """A code in any case, else by the licence's address; null for anything else."""
    return _by_pattern(F.when(F.upper(x).isin(*GBIF_CODES), F.upper(x)), x, GBIF_PATTERNS)


def licence_code_nbn(x: Column) -> Column:
    """An exact code, else by words in any case; null for anything else."""
    return _by_pattern(F.when(x.isin(*NBN_CODES), x), F.lower(x), NBN_PATTERNS)


def licence_expected(code: Column, expected: tuple[str, ...]) -> Column:
    return F.coalesce(code.isin(*expected), F.lit(False))
