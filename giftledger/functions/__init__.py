"""Column expressions: text normalization and value parsing."""

from .text import (
    address_source,
    is_blank,
    normalize_address,
    normalize_name,
    normalize_zip,
    strip_whitespace,
)
from .values import parse_amount, parse_contribution_date, parse_iso_date, percent, strict_cast

__all__ = [
    "address_source",
    "is_blank",
    "normalize_address",
    "normalize_name",
    "normalize_zip",
    "parse_amount",
    "parse_contribution_date",
    "parse_iso_date",
    "percent",
    "strict_cast",
    "strip_whitespace",
]
