"""Points (response time, popularity) and the distance between them.

The functions take SQL text, because clustering writes one such expression per
centre and builds the plan anew in every pass.
"""

from __future__ import annotations

# Fixed value: minutes are divided by this before they are compared
TIME_NORMALISER = 1590397


def round_half_even(value: str) -> str:
    """Two decimal places; a tie goes to the even neighbour."""
    return f"bround(CAST({value} AS DOUBLE), 2)"


def normalise_minutes(minutes: str) -> str:
    return f"bround(CAST({minutes} AS DOUBLE) / {TIME_NORMALISER}.0D, 2)"


def distance(x1: str, y1: str, x2: str, y2: str) -> str:
    """Euclidean distance between two normalised points."""
    return f"sqrt(pow({x1} - {x2}, 2.0D) + pow({y1} - {y2}, 2.0D))"
