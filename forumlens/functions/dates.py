"""Dates, minutes between them, and slots of the day.

Dates are timestamps without time zone, so no result depends on the session's
zone and no hour is lost or doubled by daylight saving.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from forumlens.functions.fields import _col

# Fixed value: the layout of a date, yyyy-MM-dd'T'HH:mm:ss.SSS
DATE_SHAPE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}[.]\d{3}$"

# Fixed value: the day is cut into this many slots
TIME_SLOTS = 4


def parse_date(text: Column | str) -> Column:
    """The date as TIMESTAMP_NTZ, or NULL if the text is no such date."""
    text = _col(text)
    return F.when(text.rlike(DATE_SHAPE), text.try_cast("timestamp_ntz"))


def minutes_between(
    asked: Column | str, answered: Column | str, on_bad_date: int | None = None
) -> Column:
    """Whole minutes from ``asked`` to ``answered``, truncated toward zero.

    With a missing date the result is ``on_bad_date``.
    """
    minutes = (_col(answered) - _col(asked)).cast("interval minute").cast("bigint")
    return minutes if on_bad_date is None else F.coalesce(minutes, F.lit(on_bad_date).cast("bigint"))


def check_slots(slots: int) -> int:
    """``slots`` itself if it cuts 24 hours into equal runs."""
    if slots < 1 or 24 % slots:
        raise ValueError(f"the number of slots must divide 24, got {slots}")
    return slots


def time_slot(date: Column | str, slots: int = TIME_SLOTS) -> Column:
    """The slot of the day, from 0, in which ``date`` falls."""
    width = 24 // check_slots(slots)
    return F.floor(F.hour(_col(date)) / width).cast("int")


def slot_label(slot: Column | str) -> Column:
    return F.concat(F.lit("TimeSlot"), _col(slot).cast("string"))
