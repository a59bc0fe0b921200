"""Calendar expressions: retention, months in service, folder dates, watermarks."""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the watermark (and first validity date) of a table never loaded before.
BEGINNING_OF_TIME = "1600-01-01"
# Fixed value: months in service above this get no label.
MIS_LABEL_LIMIT = 48


@dataclass(frozen=True)
class Retention:
    """How long a loaded row is kept, as a calendar period."""

    years: int = 15
    months: int = 0
    days: int = 0

    def deletion_date(self, load_date: Column) -> Column:
        """Years and months move together, clipped to the month's end; days come last."""
        return F.date_add(
            F.add_months(load_date, 12 * self.years + self.months), self.days
        )


def as_date(value: str | dt.date) -> Column:
    """A date literal from an ISO text or a Python date."""
    return F.lit(dt.date.fromisoformat(str(value)))


def try_iso_date(text: Column) -> Column:
    """The date of a ``2024-01-31`` text (also without zero padding), null for other texts."""
    return F.try_to_date(text, "yyyy-M-d")


def parse_folder(name: str) -> dt.date | None:
    """``try_iso_date`` of a folder's name, for the few names that the driver reads."""
    match = re.fullmatch(r"(\d{4})-(\d{1,2})-(\d{1,2})", name)
    try:
        return dt.date(*map(int, match.groups())) if match else None
    except ValueError:
        return None


def path_segment(path: Column, index: int = 1) -> Column:
    """One ``/`` segment of an object key, null when the key has fewer segments."""
    return F.get(F.split(path, "/"), index)


def folder_date(path: Column, index: int = 1) -> Column:
    """Date of the snapshot folder a key lies in; null for folders that are no date."""
    return try_iso_date(path_segment(path, index))


def is_newer(candidate: Column, watermark: Column) -> Column:
    """Strictly newer than the watermark; an equal date has been loaded already."""
    return candidate > watermark


def months_in_service(complaint: Column, delivery: Column) -> Column:
    """Whole months from delivery to complaint, rounded down (negative before delivery)."""
    return F.floor(F.months_between(complaint, delivery))


def mis_label(months: Column, limit: int = MIS_LABEL_LIMIT) -> Column:
    """``MIS n`` up to the limit, null above it and for unknown months."""
    return F.when(months <= limit, F.concat(F.lit("MIS "), months.cast("string")))
