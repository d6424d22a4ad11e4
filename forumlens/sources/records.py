"""Comma-separated text, one record per line, where a broken line is dropped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_BROKEN = "_broken_line"
_REASON = "_dropped_for"


# Stands for a backslash while breaks are put back
_MARK = "\x00"


def escape_breaks(text: Column) -> Column:
    """Text on one line: a line break as ``\\n`` or ``\\r``, a backslash doubled."""
    for plain, written in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def restore_breaks(text: Column) -> Column:
    """What ``escape_breaks`` was given; a backslash before another letter stays."""
    for written, plain in (("\\\\", _MARK), ("\\n", "\n"), ("\\r", "\r"), (_MARK, "\\")):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def read_records(
    spark: SparkSession,
    path: str,
    names: Sequence[str],
    escape: str = '"',
    breaks: bool = False,
    seen: Observation | None = None,
) -> DataFrame:
    """Text fields ``names`` of every whole line; an empty field is NULL.

    A line with another number of fields, or with a quote left open, is dropped.
    Spark's CSV source takes an open quote in the last field for text, and the
    line itself can no longer be seen there, so the quotes are counted first.
    ``breaks`` puts back line breaks that ``escape_breaks`` has written. ``seen`` counts
    on the way, for whoever runs the result: ``lines``, those ``kept``, and those dropped
    as ``empty``, for an ``open_quote`` or for their ``fields``. Run the whole result
    then: lines behind a limit are not counted.
    """
    line = F.col("value")
    plain = line if escape == '"' else F.regexp_replace(line, r"\\.", "")
    quotes = F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))
    schema = ", ".join(f"{name} string" for name in (*names, _BROKEN))
    options = {
        "sep": ",",
        "quote": '"',
        "escape": escape,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _BROKEN,
    }
    # Through a generator the record is parsed once, and not again in the filter
    record = F.inline(F.array(F.from_csv("value", F.lit(schema), options)))
    if seen is None:
        lines = spark.read.text(path).filter((line != "") & (quotes % 2 == 0))
        whole = lines.select(record).filter(F.col(_BROKEN).isNull()).drop(_BROKEN)
    else:
        empty, open_quote, broken = line == "", quotes % 2 == 1, F.col(_BROKEN).isNotNull()
        reason = F.when(empty, "empty").when(open_quote, "open_quote")
        parsed = spark.read.text(path).select(reason.alias(_REASON), record)
        why = F.coalesce(F.col(_REASON), F.when(broken, "fields"), F.lit("kept"))
        counts = [F.count_if(why == x).alias(x) for x in ("kept", "empty", "open_quote", "fields")]
        counted = parsed.observe(seen, F.count("*").alias("lines"), *counts)
        whole = counted.filter(why == "kept").drop(_REASON, _BROKEN)
    return whole.select(*[restore_breaks(F.col(n)).alias(n) for n in names]) if breaks else whole
