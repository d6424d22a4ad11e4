"""Maximal periodic runs of words: seeds on diagonals, extended to both sides.

A run with smallest period ``q`` has at least ``max(MIN_LENGTH, 2 * q)`` words, so it
overlaps itself, moved by ``q``, in ``max(MIN_LENGTH - q, q)`` words or more. For every
class of lags the k-grams of the smallest overlap guaranteed in it are indexed; two
occurrences in one document whose lag is of the class are a seed. A seed is extended
along its diagonal as far as words a lag apart agree. A table holds for each lag how far
it is covered, and seeds below that are not extended again.

k-grams are named exactly, by pairs of names of shorter ones, and only where both halves
occur again, so most text drops out at short lengths. A k-gram that overlaps itself by
half or more lies in a run of a smaller period. Of such a cluster of occurrences only the
first meets all others: two that are not first extend to a diagonal on which one is, and
two of one cluster have no run of their own. So seeds grow with the words, not with the
pairs of occurrences.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Words a run has at least.
MIN_LENGTH = 12
#: Words of the documents that are looked at together; a longer document is looked at by itself.
BATCH_WORDS = 400_000
#: Words compared at once when a seed is extended, to begin with.
_STEP = 32


class Run(NamedTuple):
    start: int
    length: int
    period: int


def _classes(longest: int) -> Iterator[tuple[int, int, int]]:
    """Lags from, to (not included), and the overlap that a run of such a lag has at least.

    A run of so many words has a period of half at most.
    """
    for low, high in ((1, 2), (2, 4), (4, 6), (6, 12)):
        yield low, high, min(max(MIN_LENGTH - q, q) for q in range(low, high))
    low = MIN_LENGTH
    while 2 * low <= longest:
        yield low, 2 * low, low
        low *= 2


class _Names:
    """Names of k-grams at every place, equal where the k-grams are; -1 where one occurs once."""

    def __init__(self, words: np.ndarray) -> None:
        self.length = 1
        self.names = self._again(np.arange(len(words)), words, len(words))

    @staticmethod
    def _again(places: np.ndarray, keys: np.ndarray, n: int) -> np.ndarray:
        _, named, counts = np.unique(keys, return_inverse=True, return_counts=True)
        names = np.full(n, -1, dtype=np.int64)
        more = counts[named] > 1
        names[places[more]] = named[more]
        return names

    def longer(self, k: int) -> np.ndarray:
        """The names of ``k``-grams, ``k`` being at most twice the length named so far."""
        move, names = k - self.length, self.names
        if move >= len(names):
            return np.full(len(names), -1, dtype=np.int64)
        both = np.flatnonzero((names[: len(names) - move] >= 0) & (names[move:] >= 0))
        keys = names[both] * (len(names) + 1) + names[both + move]
        return self._again(both, keys, len(names))

    def grow(self, k: int) -> np.ndarray:
        """The same, from which longer names go on."""
        while self.length < k:
            step = min(k, 2 * self.length)
            self.names = self.longer(step)
            self.length = step
        return self.names


def _seeds(names: np.ndarray, low: int, high: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and lags of occurrence pairs, ``low <= lag < high``, by lag, then place; of neighbours on a diagonal the first."""
    places = np.flatnonzero(names >= 0)
    places = places[np.argsort(names[places], kind="stable")]
    own = names[places]
    # A gap up to half a k-gram is the k-gram's smallest period; below ``low`` its run has another lag
    near = np.zeros(len(places), dtype=bool)
    near[1:] = (own[1:] == own[:-1]) & (np.diff(places) <= min(k // 2, low - 1))
    cluster = np.cumsum(~near)
    at, first = np.arange(len(places)), np.flatnonzero(~near)
    keys = own * (len(names) + high) + places
    ends = np.searchsorted(keys, keys + high)
    found = []
    # The first of a cluster meets all that follow; the others the firsts that follow
    for of, partners in ((first, at), (np.flatnonzero(near), first)):
        from_ = np.searchsorted(partners, of + 1)
        count = np.searchsorted(partners, ends[of]) - from_
        left = np.repeat(of, count)
        right = partners[np.repeat(from_ - np.cumsum(count) + count, count) + np.arange(len(left))]
        lag = places[right] - places[left]
        fits = (lag >= low) & (cluster[left] != cluster[right])
        found.append((lag[fits], places[left[fits]]))
    lags, starts = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((starts, lags))
    lags, starts = lags[order], starts[order]
    alone = np.ones(len(lags), dtype=bool)
    alone[1:] = (lags[1:] != lags[:-1]) | (starts[1:] > starts[:-1] + 1)
    return starts[alone], lags[alone]


def _extent(words: np.ndarray, place: int, lag: int, ahead: bool) -> int:
    """From ``place`` on, how many words equal those ``lag`` further on."""
    step, total = _STEP, 0
    while True:
        if ahead:
            a, b = place + total, min(place + total + step, len(words) - lag)
            differ = words[a:b] != words[a + lag : b + lag]
        else:
            a, b = max(0, place - total - step), place - total
            differ = (words[a:b] != words[a + lag : b + lag])[::-1]
        if not len(differ):
            return total
        at = int(differ.argmax())
        if differ[at]:
            return total + at
        total += len(differ)
        step = min(4 * step, 1 << 20)


def runs(words: np.ndarray) -> list[Run]:
    """All maximal runs of a sequence of non-negative numbers, by start, then period.

    A number that stands for the end of a document is negative and occurs once.
    """
    found: dict[tuple[int, int], int] = {}
    longest = len(words)
    names = _Names(words)
    for low, high, k in _classes(longest):
        if k <= 11:
            if not (names.grow(6) >= 0).any():
                break
            named = names.longer(k) if k > 6 else names.names
        else:
            named = names.grow(k)
        if not (named >= 0).any():
            if k > 11:
                break
            continue
        # By lag, how far its diagonal is covered
        covered: dict[int, int] = {}
        starts, lags = _seeds(named, low, high, k)
        for place, lag in zip(starts.tolist(), lags.tolist()):
            if place < covered.get(lag, 0):
                continue
            stop = place + _extent(words, place, lag, True)
            start = place - _extent(words, place, lag, False)
            covered[lag] = stop
            if stop - start + lag >= max(MIN_LENGTH, 2 * lag):
                # A multiple of a period has the run of the period
                key = (start, stop + lag)
                found[key] = min(found.get(key, lag), lag)
    return sorted(Run(start, end - start, lag) for (start, end), lag in found.items())


RUNS = T.ArrayType(
    T.StructType([T.StructField(name, T.LongType(), False) for name in Run._fields]), False
)


def _of_documents(texts: list[list[bytes]]) -> list[list[Run]]:
    """The runs of each document, in words of its own."""
    numbers: dict[bytes, int] = {}
    number = numbers.setdefault
    own = [np.fromiter((number(w, len(numbers)) for w in words), np.int64, len(words)) for words in texts]
    # A word is another one in each document, and a number of its own ends a document
    parts = chain.from_iterable((ids + i * len(numbers), np.array([-1 - i])) for i, ids in enumerate(own))
    words = np.concatenate([*parts, np.zeros(0, dtype=np.int64)])
    begins = np.cumsum([0, *[len(ids) + 1 for ids in own]])
    found: list[list[Run]] = [[] for _ in texts]
    for run in runs(words):
        at = int(np.searchsorted(begins, run.start, side="right")) - 1
        found[at].append(run._replace(start=run.start - int(begins[at])))
    return found


def _collapsed(words: list[bytes], found: list[Run]) -> str:
    kept = np.ones(len(words), dtype=bool)
    for run in found:
        kept[run.start + run.period : run.start + run.length] = False
    return b" ".join(words[i] for i in np.flatnonzero(kept)).decode() if found else b" ".join(words).decode()


def with_runs(docs: DataFrame, text: str = "text", found: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """The rows of ``docs`` with all runs of their texts, and the texts without repeats of a period.

    ``runs`` holds structs (start, length, period) by start, then period, in words from 0.
    ``collapsed`` are the words left when each run keeps its first period, joined by one
    space. Words are cut by ASCII white space and compared as they are. Null and empty
    texts have no runs and an empty ``collapsed``. Other columns pass as they are; those
    named like the two new ones are replaced.
    """
    new = {found.lower(), collapsed.lower()}
    rest = [c for c in docs.columns if c.lower() not in new]
    at_text = rest.index(text)
    rows = docs.select(*[f"`{c}`" for c in rest])
    schema = T.StructType([*rows.schema.fields, T.StructField(found, RUNS), T.StructField(collapsed, T.StringType())])
    kind = pa.list_(pa.struct([(name, pa.int64()) for name in Run._fields]))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, waiting, size = 0, [], 0
            for value in chain(batch.column(at_text), [None]):
                last = first + len(waiting) == batch.num_rows
                if waiting and (last or size >= BATCH_WORDS):
                    per_text = _of_documents(waiting)
                    columns = [
                        *batch.slice(first, len(waiting)).columns,
                        pa.array([[run._asdict() for run in own] for own in per_text], kind),
                        pa.array(list(map(_collapsed, waiting, per_text)), pa.string()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, schema.names)
                    first, waiting, size = first + len(waiting), [], 0
                if not last:
                    waiting.append((value.as_py() or "").encode().split())
                    size += len(waiting[-1])

    return rows.mapInArrow(compute, schema)
