"""Language identification by compression.

For each language, labelled texts of a bounded sample become a zstandard
raw-content dictionary. A text is compressed with each of them, in pieces that
each start with the dictionary afresh, so that languages differ as much in a long
text as in a short one; the language whose dictionary makes it smallest wins. A
text is rejected when the best is hardly smaller than the second.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forumlens.session import keep

#: Bytes of a language's dictionary, and the rows per language looked at to fill it.
DICTIONARY_BYTES = 64_000
SAMPLE_ROWS = 1000
LEVEL = 6
#: Bytes of a text compressed at once. A dictionary helps little after its own length, so longer pieces differ less.
PIECE_BYTES = 32_000
UNKNOWN = "und"
#: The pipeline rejects a text if the best size is above this share of the second.
MARGIN = 0.002

_LETTERS = re.compile(r"[^\W\d_]+")


def letters(text: str | None) -> bytes:
    """The words of letters of a text, in lower case: what is compressed."""
    return " ".join(_LETTERS.findall(text.lower())).encode() if text else b""


def fit(labelled: DataFrame, size: int = DICTIONARY_BYTES, rows: int = SAMPLE_ROWS, seed: int = 5) -> dict[str, bytes]:
    """A dictionary per non-null language of ``labelled`` (``doc_id, text, lang``).

    Per language the ``rows`` texts with letters that have the smallest hashes of their
    ids are looked at, and those that still fit are joined up to ``size`` bytes, one at
    least. Of a text of over four times ``size`` a piece is taken, from its first letter
    on, so that a language of long texts is learned too. The result is empty if no row has
    a language and letters.
    """
    known = labelled.where("lang is not null and text is not null").where(F.col("text").rlike(r"\p{L}"))
    known = known.select("doc_id", "text", "lang", F.xxhash64(F.lit(seed), "doc_id").alias("order"))
    # A hash bound from the counts thins out each language before its rows are ranked
    counts = keep(known.groupBy(F.col("lang").alias("lang2")).agg(F.count("*").alias("n")), "languages")
    low = F.shiftrightunsigned("order", 11) / float(2**53)
    thinned = known.join(counts, (F.col("lang") == F.col("lang2")) & (low < 4.0 * rows / F.col("n")))
    first = Window.partitionBy("lang").orderBy("order", "doc_id", F.xxhash64("text"))
    # So many characters are at most four times as many bytes
    piece = F.substr("text", F.regexp_instr("text", F.lit(r"\p{L}")), F.lit(size))
    short = F.when(F.octet_length("text") <= 4 * size, F.col("text")).otherwise(piece)
    chosen = thinned.select("lang", "order", "doc_id", short.alias("text"), F.row_number().over(first).alias("place")).where(F.col("place") <= rows)
    fitting = chosen.withColumn("used", F.sum(F.octet_length("text")).over(Window.partitionBy("lang").orderBy("place")))
    sample = fitting.where(F.col("used") <= 8 * size).select("lang", "place", "text").collect()
    found: dict[str, bytes] = {}
    for row in sorted(sample, key=lambda r: (r["lang"], r["place"])):
        text, have = letters(row["text"]), found.get(row["lang"], b"")
        if not have or len(have) + len(text) < size:
            found[row["lang"]] = have + text + b" "
    return found


def _judge(dictionaries: dict[str, bytes], margin: float, level: int) -> Callable[[str | None], tuple[str, float]]:
    """The language and the score of a text."""
    names = sorted(dictionaries)
    coders = []
    for name in names:
        content = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(level=level)
        coders.append(zstandard.ZstdCompressor(level=level, dict_data=content, write_content_size=False, write_dict_id=False, write_checksum=False))

    def judge(text: str | None) -> tuple[str, float]:
        data = letters(text)
        if not data or not coders:
            return UNKNOWN, 0.0
        pieces = [data[at : at + PIECE_BYTES] for at in range(0, len(data), PIECE_BYTES)]
        sizes = [sum(len(c.compress(piece)) for piece in pieces) for c in coders]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        others = sizes[:best] + sizes[best + 1 :]
        if others and margin and sizes[best] > (1 - margin) * min(others):
            return UNKNOWN, 0.0
        return names[best], max(0.0, 1 - sizes[best] * len(others) / sum(others)) if others else 1.0

    return judge


def identified(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = 0.0, level: int = LEVEL) -> DataFrame:
    """``doc_id, lang_pred, score`` per row of ``docs``, from ``text`` alone.

    ``lang_pred`` is a learned language, or ``und`` if the text is null, empty or
    has no letter, if nothing was learned, or, with a ``margin``, if the best
    size is above ``1 - margin`` times the second. ``score`` is the share by
    which the best size stays below the mean of the others (0 for ``und``). Ties
    go to the first language by name. All of a text counts, in pieces of ``PIECE_BYTES``.
    """

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _judge(dictionaries, margin, level)
        for batch in batches:
            found = [judge(value.as_py()) for value in batch.column(1)]
            columns = [batch.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(label, f"doc_id {kind}, lang_pred string, score double")


def recognised(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN, level: int = LEVEL) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language is not ``und``."""
    place = docs.columns.index("text")

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _judge(dictionaries, margin, level)
        for batch in batches:
            yield batch.filter(pa.array([judge(value.as_py())[0] != UNKNOWN for value in batch.column(place)], pa.bool_()))

    return docs.mapInArrow(passing, docs.schema)
