from campfin.functions.predicates import LEGACY_COLLATION, any_changed, collated, newer_than
from campfin.functions.text import (
    coerce_decimal, date_from_mmddyyyy, file_name, fit_text, record_fields, y2_of_year,
)

__all__ = [
    "LEGACY_COLLATION", "any_changed", "collated", "newer_than", "coerce_decimal",
    "date_from_mmddyyyy", "file_name", "fit_text", "record_fields", "y2_of_year",
]
