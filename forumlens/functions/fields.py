"""Text fields of a post record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def present(c: Column | str) -> Column:
    """Not empty, for use in a filter; NULL fails the comparison and is missing too."""
    return _col(c) != ""


def as_id(name: str) -> Column:
    """A numeric id, or NULL if the text is no whole number.

    A number is digits behind an optional sign, without blanks; one beyond 64 bits is
    none. Only text that starts like a number, that is from ``+`` to ``9`` in byte
    order, is looked at: most posts lack some of the ids.
    """
    number = f"`{name}` BETWEEN '+' AND ':' AND `{name}` RLIKE '^[+-]?[0-9]+$'"
    return F.expr(f"CASE WHEN {number} THEN try_cast(`{name}` AS BIGINT) END")


def split_tags(name: str) -> Column:
    """``<a><b>`` as an array of tags, repeats kept, empty tags left out.

    ``=`` separates tags as ``><`` does, and other angle brackets are dropped.
    """
    flat = f"translate(replace(`{name}`, '><', '='), '<>', '')"
    return F.expr(f"array_remove(split({flat}, '='), '')")
