"""What several of the operators share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of other characters than these.
BLANK = r"[\x20\x09-\x0D]"
BLANKS = " \t\n\v\f\r"
WORD = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, as ``--py-files`` would; once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="forumlens-code-"), "forumlens.zip")
    with zipfile.ZipFile(archive, "w") as code:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    code.write(path, os.path.relpath(path, os.path.dirname(top)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def spare(df: DataFrame, name: str) -> str:
    """``name``, or what it is with so many ``_`` behind that no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK + "+"), "")


def n_words(text: Column) -> Column:
    """The number of words without making them: each run becomes one character."""
    ended = F.rtrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.length(F.regexp_replace(ended, f"{BLANK}*{WORD}", "x"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.transform(F.array(value), body)[0]


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)
