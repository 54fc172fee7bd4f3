"""Text cleaning for the code lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands for a state the port list does not give.
NO_STATE = "NaN"

# Unicode blanks plus the four ASCII separators, which Unicode does not class as blanks.
_BLANK = r"[\s\x{1c}-\x{1f}]"
_ENDS = rf"(?U)^{_BLANK}+|{_BLANK}+$"


def strip_quotes(text: Column) -> Column:
    """Drop every single quote, wherever it stands."""
    return F.replace(text, F.lit("'"), F.lit(""))


def trim_text(text: Column) -> Column:
    """Strip blanks of any kind from both ends; ``trim`` would strip spaces only."""
    return F.regexp_replace(text, _ENDS, "")


def tidy(text: Column) -> Column:
    """Quotes dropped, then ends trimmed."""
    return trim_text(strip_quotes(text))


def place_name(text: Column) -> Column:
    """What stands before the first comma, trimmed."""
    return trim_text(F.substring_index(text, ",", 1))


def place_state(text: Column, missing: str = NO_STATE) -> Column:
    """The part after the comma when there is exactly one comma, else ``missing``."""
    parts = F.split(text, ",")
    return F.when(F.size(parts) == 2, trim_text(F.get(parts, F.lit(1)))).otherwise(F.lit(missing))
