"""Numbers rounded for a reader, and sentences from templates."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(value: Column, places: int) -> Column:
    """Text with ``places`` decimals, rounded half to even from the stored binary value.

    ``round`` and ``bround`` decide by the printed decimals instead, so they differ for
    numbers such as 209.05, which is stored slightly above the middle.
    """
    return F.replace(F.format_number(value.cast("double"), places), F.lit(","), F.lit(""))


def nearest(value: Column, places: int) -> Column:
    """The same rounding as a number."""
    return fixed(value, places).cast("double")


def percent(fraction: Column, places: int = 1) -> Column:
    return nearest(fraction * 100, places)


def whole(value: Column) -> Column:
    """Without decimals; an unknown number reads ``nan``."""
    return F.coalesce(fixed(value, 0), F.lit("nan"))


def grouped(value: Column) -> Column:
    return F.format_string("%,d", value.cast("bigint"))


def whole_percent(fraction: Column) -> Column:
    return F.concat(fixed(fraction * 100, 0), F.lit("%"))


def tenth_percent(fraction: Column) -> Column:
    return F.concat(fixed(fraction * 100, 1), F.lit("%"))


def fill(template: str, **values: Column) -> Column:
    """Concatenate the template's literal parts with the named columns."""
    parts = re.split(r"\{(\w+)\}", template)
    columns = [values[part] if index % 2 else F.lit(part) for index, part in enumerate(parts)]
    return F.concat(*[column for column, part in zip(columns, parts) if part])


def lookup(key: Column, table: dict[str, str], default: Column) -> Column:
    entries = [F.lit(text) for pair in table.items() for text in pair]
    return F.coalesce(F.try_element_at(F.create_map(*entries), key), default)
