"""Column functions. Each one is a composition of Spark's built-in expressions."""

from forumlens.functions.dates import (
    minutes_between,
    parse_date,
    slot_label,
    time_slot,
)
from forumlens.functions.fields import as_id, present, split_tags
from forumlens.functions.points import distance, normalise_minutes, round_half_even

__all__ = [
    "as_id",
    "distance",
    "minutes_between",
    "normalise_minutes",
    "parse_date",
    "present",
    "round_half_even",
    "slot_label",
    "split_tags",
    "time_slot",
]
