from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters that may not stay in a column name.
UNSAFE_CHARACTERS = r"[ ,;{}()\n\t=:.\-]"


def base_name(path: Column) -> Column:
    """Last component of a path."""
    return F.element_at(F.split(path, "/"), -1)


def case_id(name: Column) -> Column:
    """Case number written after ``case`` in a recording's file name, as text."""
    return F.nullif(F.regexp_extract(name, r"case(\d+)", 1), F.lit(""))


def safe_names(names: list[str]) -> list[str]:
    """Identifier-like names in the same order; a clash gets a numeric suffix instead of hiding a column."""
    taken: dict[str, int] = {}
    result = []
    for name in names:
        safe = re.sub(UNSAFE_CHARACTERS, "_", name).strip("_")
        taken[safe] = taken.get(safe, 0) + 1
        result.append(safe if taken[safe] == 1 else f"{safe}_{taken[safe]}")
    return result


def with_safe_names(df: DataFrame) -> DataFrame:
    return df.toDF(*safe_names(df.columns))


def fixed_decimals(value: Column, digits: int) -> Column:
    """Text with ``digits`` decimals, correctly rounded from the binary value and without separators."""
    return F.call_function("format_number", value, F.lit("0." + "0" * digits))
