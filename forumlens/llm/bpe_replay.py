"""Byte-level BPE by replaying the merges over all distinct pieces of a corpus at once.

A text falls into pieces that do not influence each other. The distinct pieces of a
chunk of documents lie one after another as byte tokens, linked to their neighbours.
An inverted index leads from the token that a pair gives, which is the pair's rank, to
the positions of all such pairs. The merges are replayed in rank order; a merge looks
at the two pairs it touches and enters those into the index, nothing else. Tokens whose
bytes can be split in several ways count as one entry, as rank files name bytes, not pairs.

The corpus is cut where Spark cuts it: each task replays its own chunks, so no text and
no vocabulary is shuffled, and a worker remembers pieces it has met.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Characters of text whose distinct pieces are replayed together; a longer text is a chunk by itself.
CHUNK = 8 << 20
#: Pieces whose ids a worker remembers in each of two generations (some 200 bytes each).
CACHE = 400_000
#: Bytes of ids or text in a batch handed to Spark.
BATCH = 4 << 20
#: Bits of a token id.
_SHIFT = 32

# Characters below this have their classes listed, so that the standard library can split them
_LATIN = 0x250


def _latin(*categories: str) -> str:
    """The characters below U+0250 of the general categories that begin like this, for a character class."""
    return "".join(re.escape(chr(c)) for c in range(_LATIN) if unicodedata.category(chr(c)).startswith(categories))


class Merges:
    """The ranks of a vocabulary file: what each pair of tokens gives, and the tokens' bytes."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.token = {rank: data for data, rank in ranks.items()}
        self.single = [ranks[bytes([b])] for b in range(256)]
        # A piece that is a token needs no merge
        self.whole = {data: rank.to_bytes(4, "little") for data, rank in ranks.items()}
        self.gives: dict[int, int] = {}
        for data, rank in ranks.items():
            for cut in range(1, len(data)):
                left, right = ranks.get(data[:cut]), ranks.get(data[cut:])
                if left is not None and right is not None:
                    self.gives[left << _SHIFT | right] = rank
        self.split = regex.compile(pattern)
        letters, numbers = _latin("L"), _latin("N")
        listed = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^\s{letters}{numbers}]")
        self.split_latin = re.compile(listed.replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]"))
        # Controls are left to the other pattern: the libraries differ in which are white space
        self.other = re.compile(rf"[^\t\n\r\x20-\x7e\xa1-{chr(_LATIN - 1)}]")
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def pieces(self, text: str) -> Iterable[str]:
        pattern = self.split if self.other.search(text) else self.split_latin
        return pattern.findall(text) if len(text) <= CHUNK else (m.group() for m in pattern.finditer(text))

    def replay(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, as little-endian unsigned 32-bit integers."""
        single, gives = self.single, self.gives
        starts, tokens = [], []
        for piece in pieces:
            starts.append(len(tokens))
            tokens.extend([single[b] for b in piece])
            # No pair leads over the end of a piece
            tokens.append(-1)
        n = len(tokens)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        index: dict[int, list[int]] = {}
        for at in range(n - 1):
            left, right = tokens[at], tokens[at + 1]
            if left >= 0 <= right and (rank := gives.get(left << _SHIFT | right)) is not None:
                if rank in index:
                    index[rank].append(at)
                else:
                    index[rank] = [at]
        ranks = list(index)
        heapify(ranks)
        while ranks:
            rank = ranks[0]
            places = index[rank]
            # A merge can give a pair of lower rank; that one is next, and the rest of these waits
            while places and ranks[0] == rank:
                at = heappop(places)
                left, right_at = tokens[at], after[at]
                right = tokens[right_at] if left >= 0 else -1
                if right < 0 or gives.get(left << _SHIFT | right) != rank:
                    continue
                tokens[at], tokens[right_at] = rank, -2
                follows = after[right_at]
                after[at], before[follows] = follows, at
                for first, second in ((before[at], at), (at, follows)):
                    if first < 0:
                        continue
                    left, right = tokens[first], tokens[second]
                    if left >= 0 <= right and (new := gives.get(left << _SHIFT | right)) is not None:
                        if new in index:
                            heappush(index[new], first)
                        else:
                            index[new] = [first]
                            heappush(ranks, new)
            if not places and ranks[0] == rank:
                heappop(ranks)
                del index[rank]
        merged = np.array(tokens, dtype=np.int64)
        kept = np.flatnonzero(merged != -2)
        ids = merged[kept]
        data = ids.astype("<u4").tobytes()
        ends = np.flatnonzero(ids == -1).tolist()
        begins = [0, *[e + 1 for e in ends]]
        return [data[4 * a : 4 * b] for a, b in zip(begins, ends)]

    def ids_of(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces, replayed together where they are not remembered."""
        if len(self.known) > CACHE:
            # Pieces that are met again outlive a full memory
            self.known, self.older = {}, self.known
        known, older, whole = self.known, self.older, self.whole
        new: list[str] = []
        for piece in pieces:
            if piece not in known:
                found = older.get(piece)
                if found is None:
                    data = piece.encode()
                    found = whole.get(data)
                    if found is None:
                        new.append(piece)
                        continue
                known[piece] = found
        known.update(zip(new, self.replay([piece.encode() for piece in new])))
        return [known[piece] for piece in pieces]


@lru_cache(maxsize=1)
def merges(path: str, pattern: str) -> Merges:
    """One per worker process, whose memory of pieces outlives a task."""
    return Merges(path, pattern)


def _with(schema: T.StructType, name: str) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(name, T.BinaryType())])


def _in_batches(rows: Iterable[tuple[pa.RecordBatch, int, bytes]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of their batches with a new last column, in batches of bounded size."""
    source, first, values, size = None, 0, [], 0
    for batch, at, value in rows:
        if values and (batch is not source or at != first + len(values) or size >= BATCH):
            yield pa.RecordBatch.from_arrays([*source.slice(first, len(values)).columns, pa.array(values, pa.binary())], names)
            values, size = [], 0
        if not values:
            source, first = batch, at
        values.append(value)
        size += len(value)
    if values:
        yield pa.RecordBatch.from_arrays([*source.slice(first, len(values)).columns, pa.array(values, pa.binary())], names)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """The rows of ``docs`` with column ``ids`` in place of ``text``: little-endian unsigned 32-bit token ids.

    ``path`` is a file of ranks, ``pattern`` what splits a text before the merges. Null and
    empty texts have no ids. All other columns pass as they are, whatever their names and
    values; one that is named like ``ids`` is replaced. Rows may repeat.
    """
    rest = [c for c in docs.columns if c.lower() not in (text.lower(), ids.lower())]
    rows = docs.select(f"`{text}`", *[f"`{c}`" for c in rest])
    schema = _with(rows.drop(text).schema, ids)
    names = schema.names

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, bytes]]:
        table = merges(path, pattern)
        waiting: list[tuple[pa.RecordBatch, int, array]] = []
        numbers: dict[str, int] = {}
        size = 0

        def chunk() -> Iterator[tuple[pa.RecordBatch, int, bytes]]:
            found = table.ids_of(list(numbers))
            for batch, at, own in waiting:
                yield batch, at, b"".join([found[k] for k in own])

        for batch in batches:
            left = pa.RecordBatch.from_arrays(batch.columns[1:], names[:-1])
            for at, value in enumerate(batch.column(0)):
                value = value.as_py() or ""
                number = numbers.setdefault
                waiting.append((left, at, array("I", [number(p, len(numbers)) for p in table.pieces(value)])))
                size += len(value)
                if size >= CHUNK:
                    yield from chunk()
                    waiting, numbers, size = [], {}, 0
        yield from chunk()

    return rows.mapInArrow(lambda batches: _in_batches(encoded(batches), names), schema)


def decode(docs: DataFrame, path: str, pattern: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The rows of ``docs`` with the bytes of their ids in column ``text``.

    Null ids give no bytes; an id that the vocabulary lacks is an error. A column
    that is named like ``text`` is replaced.
    """
    rest = [c for c in docs.columns if c.lower() != text.lower()]
    at_ids = rest.index(ids)
    rows = docs.select(*[f"`{c}`" for c in rest])
    schema = _with(rows.schema, text)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, bytes]]:
        token = merges(path, pattern).token
        for batch in batches:
            for at, value in enumerate(batch.column(at_ids)):
                yield batch, at, b"".join([token[k] for k in np.frombuffer(value.as_py() or b"", "<u4").tolist()])

    return rows.mapInArrow(lambda batches: _in_batches(decoded(batches), schema.names), schema)
