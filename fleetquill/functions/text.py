"""String expressions for ECU names, fault codes, sales classes and object keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ecu_name(address: Column, text: Column) -> Column:
    """``address - text``; null as soon as one part is null."""
    return F.concat(address, F.lit(" - "), text)


def dfcc_hex(dfcc: Column) -> Column:
    """Fault code as upper-case hex; codes that are no integer give null."""
    return F.upper(F.hex(dfcc.try_cast("int")))


def is_published(status: Column) -> Column:
    return F.upper(status) == "PUBLISHED"


# --- sales classes: "XA (2031 - 2034), XB (2036)" ---------------------------------


def sales_class_entries(text: Column) -> Column:
    """Array of entries without blanks, e.g. ``XA(2031-2034)``."""
    return F.split(F.regexp_replace(text, " ", ""), ",")


def entry_series(entry: Column) -> Column:
    return F.substring(entry, 1, 2)


def entry_start_year(entry: Column) -> Column:
    return F.substring(entry, 4, 4).try_cast("int")


def entry_end_year(entry: Column) -> Column:
    return F.substring(entry, 9, 4).try_cast("int")


def model_years(start: Column, end: Column) -> Column:
    """Years from start up to, but not including, end.

    No start gives no year, no end gives the start year alone. ``sequence`` counts
    downwards when its end lies before its start, hence the guard.
    """
    none = F.array().cast("array<int>")
    return (
        F.when(start.isNull(), none)
        .when(end.isNull(), F.array(start))
        .when(end > start, F.sequence(start, end - 1))
        .otherwise(none)
    )


# --- object keys and requests -------------------------------------------------------

# Fixed value: ``YYYY-MM-DD/`` takes the first eleven characters below the prefix.
FOLDER_CHARS = 11


def key_below(key: Column, prefix: str) -> Column:
    """The key with the inbox prefix taken out."""
    return F.replace(key, F.lit(prefix), F.lit("")) if prefix else key


def with_suffix(name: Column, suffix: str) -> Column:
    return F.when(name.endswith(suffix), name).otherwise(
        F.concat(name, F.lit(suffix))
    )


def raw_object_key(folder: str, day: Column, product: Column, uuid: Column) -> Column:
    """``<folder><day>/<product>_<day>_<uuid>``."""
    return F.format_string(f"{folder}%s/%s_%s_%s", day, product, day, uuid)


def fill_template(template: str, **values: Column) -> Column:
    """Replace every ``{name}`` of a URL template by a column's value."""
    filled = F.lit(template)
    for name, value in values.items():
        filled = F.replace(filled, F.lit("{" + name + "}"), value)
    return filled
