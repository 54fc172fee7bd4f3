"""Words for the coded columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Meanings as the data dictionary gives them (visa code 2 repeats code 1).
ARRIVAL_MODES = {1: "Air", 2: "Sea", 3: "Land", 4: "Not reported"}
VISA_CODES = {1: "Business", 2: "Business", 3: "Student"}


def code_label(code: Column, meanings: dict[int, str]) -> Column:
    """The word for a code, null for a code without one."""
    pairs = [F.lit(part) for pair in meanings.items() for part in pair]
    return F.element_at(F.create_map(*pairs), code.cast("int"))
