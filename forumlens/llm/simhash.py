"""Near duplicates by SimHash fingerprints and Golay-code fuzzy hashing.

Two fingerprints of 64 bits that differ in at most 3 are found through common
keys. The bits fall into blocks; at most three blocks hold a difference, so for
some choice of the other blocks those are equal. What remains is halved, and one
half differs in at most one bit. A key is the equal blocks and the Golay index of
that half: its own index on the one side, its own and near ones on the other.
Pairs that share a key are verified on all bits.

Equal fingerprints are one node from the start. Within a key only the links of a
spanning forest are put out, so that many near copies give as many rows, not as
many pairs; a key with very many fingerprints is dealt over several tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.llm import golay
from forumlens.llm.components import components
from forumlens.llm.common import spare
from forumlens.session import keep

BITS = 64
RADIUS = 3
SEED = 42
#: Blocks the bits are dealt to: one of four is equal, and a key has 16 exact bits and 12 of the code.
BLOCKS = 4
#: Fingerprints of a key compared in one task; a key with more is split.
BUCKET = 4096
#: Keys up to this size are compared pair by pair.
FEW = 8
_ONE = np.uint64(1)
#: Links that connect fingerprints within a radius.
Forest = Callable[[np.ndarray, int], np.ndarray]


def fingerprint(text: str | None, words: int = 3) -> int:
    """The SimHash of a text's shingles of ``words`` words, with repeats; 0 without words.

    A-Z count as a-z. A bit is 1 if it is set in over half of the XXH64 hashes.
    """
    tokens = text.encode().lower().split() if text else []
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    k = min(words, len(tokens))
    begin, end = starts[: len(tokens) - k + 1].tolist(), (starts + lengths)[k - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(begin, end, strict=True)], dtype="<u8")
    counts = np.zeros(BITS, dtype=np.int64)
    for part in range(0, len(hashes), 1 << 16):
        rows = hashes[part : part + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``doc_id, version, fp`` per row of ``docs``; ``fp`` holds the 64 bits as a signed long, ``version`` is a hash of the text."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), words) for t in batch.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))], ["doc_id", "version", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64("text").alias("version"), "text")
    return rows.mapInArrow(compute, f"doc_id {kind}, version long, fp long")


def _layout(blocks: int) -> list[tuple[list[int], list[int]]]:
    """For each table of keys the places of the exact bits and those of the fuzzy half."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [list(range(a, b)) for a, b in zip(edges, edges[1:])]
    tables = []
    for open_ in combinations(range(blocks), RADIUS):
        exact = [b for i, p in enumerate(parts) if i not in open_ for b in p]
        rest = [b for i in open_ for b in parts[i]]
        half = (len(rest) + 1) // 2
        tables += [(exact, rest[:half]), (exact, rest[half:])]
    return tables


def _gather(fps: np.ndarray, places: list[int]) -> np.ndarray:
    """The bits at ``places`` side by side."""
    out = np.zeros(fps.shape, dtype=np.uint64)
    run = 0
    while run < len(places):
        stop = run + 1
        while stop < len(places) and places[stop] == places[stop - 1] + 1:
            stop += 1
        width = np.uint64(stop - run)
        mask = (_ONE << width) - _ONE
        out |= ((fps >> np.uint64(places[run])) & mask) << np.uint64(run)
        run = stop
    return out.view(np.int64)


def keys(fps: np.ndarray, blocks: int = BLOCKS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per table: rows and their keys, one row for each of its own and near keys."""
    for table, (exact, fuzzy) in enumerate(_layout(blocks)):
        near = golay.keys(_gather(fps, fuzzy))
        row, place = np.nonzero(near >= 0)
        yield row, (np.int64(table) << 51) | (_gather(fps, exact)[row] << 12) | near[row, place]


def _forest(fps: np.ndarray, radius: int) -> np.ndarray:
    """Links (pairs of places) that join all of ``fps`` that are connected within ``radius``."""
    left, links = np.arange(len(fps)), [np.empty((0, 2), dtype=np.int64)]
    while len(left):
        reached, left = [int(left[0])], left[1:]
        while reached and len(left):
            here = reached.pop()
            close = np.bitwise_count(fps[left] ^ fps[here]) <= radius
            links.append(np.stack([np.full(int(close.sum()), here), left[close]], axis=1))
            reached += left[close].tolist()
            left = left[~close]
    return np.concatenate(links)


def nearest_forest(fps: np.ndarray, radius: int) -> np.ndarray:
    """As ``_forest``, by shortest links: each tree is joined at the least distances there are."""
    links, here = [], 0
    left = np.arange(1, len(fps))
    least, source = np.full(len(left), BITS + 1), np.zeros(len(left), dtype=np.int64)
    while len(left):
        apart = np.bitwise_count(fps[left] ^ fps[here])
        source = np.where(apart < least, here, source)
        least = np.minimum(apart, least)
        at = int(np.argmin(least))
        here = int(left[at])
        if least[at] <= radius:
            links.append((int(source[at]), here))
        left, least, source = (np.delete(x, at) for x in (left, least, source))
    return np.array(links, dtype=np.int64).reshape(-1, 2)


def _compare(key: np.ndarray, fps: np.ndarray, radius: int, forest: Forest) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows with equal keys, which lie together."""
    bits = fps.view(np.uint64)
    starts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
    sizes = np.diff(np.concatenate([starts, [len(key)]]))
    number = np.repeat(np.arange(len(sizes)), sizes)
    few = np.repeat(sizes <= FEW, sizes)
    a, b = [fps[:0]], [fps[:0]]
    # Keys of few rows all at once, neighbour by neighbour
    for step in range(1, min(FEW, len(fps))):
        at = np.flatnonzero((number[step:] == number[:-step]) & few[step:])
        at = at[np.bitwise_count(bits[at] ^ bits[at + step]) <= radius]
        a.append(fps[at])
        b.append(fps[at + step])
    for i in np.flatnonzero(sizes > FEW):
        members = np.unique(bits[starts[i] : starts[i] + sizes[i]])
        links = forest(members, radius)
        a.append(members[links[:, 0]].view(np.int64))
        b.append(members[links[:, 1]].view(np.int64))
    return np.concatenate(a), np.concatenate(b)


def _met(sorted_rows: DataFrame, radius: int, bucket: int | None, forest: Forest) -> DataFrame:
    """``put_off, a, b`` from rows (``key, fp``) whose equal keys lie together.

    Links of equal keys have ``put_off`` false. Without a ``bucket`` all are
    compared; with one, the rows of a key that has more are put off: ``a`` is the
    key then and ``b`` the fingerprint.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_key = kept_fps = np.empty(0, dtype=np.int64)
        large: int | None = None  # the key being put off

        def batch_of(put_off: bool, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"put_off": np.full(len(a), put_off), "a": a, "b": b})

        def compared(key: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
            if len(key):
                a, b = _compare(key, fps, radius, forest)
                differ = a != b
                yield batch_of(False, np.minimum(a, b)[differ], np.maximum(a, b)[differ])

        for batch in batches:
            key = np.concatenate([kept_key, batch.column(0).to_numpy().astype(np.int64)])
            fps = np.concatenate([kept_fps, batch.column(1).to_numpy().astype(np.int64)])
            if not len(key):
                continue
            if large is not None and key[0] == large:
                stop = int(np.searchsorted(key != large, True))
                yield batch_of(True, key[:stop], fps[:stop])
                key, fps = key[stop:], fps[stop:]
            if bucket is not None and len(key):
                starts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
                sizes = np.diff(np.concatenate([starts, [len(key)]]))
                many = np.repeat(sizes > bucket, sizes)
                if many.any():
                    yield batch_of(True, key[many], fps[many])
                    large = int(key[many][-1])
                    key, fps = key[~many], fps[~many]
            # The last key may go on in the next batch
            whole = int(np.flatnonzero(key == key[-1])[0]) if len(key) else 0
            kept_key, kept_fps = key[whole:], fps[whole:]
            yield from compared(key[:whole], fps[:whole])
        yield from compared(kept_key, kept_fps)

    return sorted_rows.mapInArrow(compare, "put_off boolean, a long, b long")


def linked(fps: DataFrame, blocks: int = BLOCKS, bucket: int = BUCKET) -> DataFrame:
    """``a, b``: links that connect all of ``fps`` (distinct ``fp``) within 3 bits.

    Any two fingerprints within 3 bits are connected by these links, and each
    link is within 3 bits.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy().astype(np.int64)
            for part in range(0, len(values), 20_000):
                fp = values[part : part + 20_000]
                for row, key in keys(fp.view(np.uint64), blocks):
                    yield pa.RecordBatch.from_pydict({"key": key, "fp": fp[row]})

    return met(fps.select("fp").mapInArrow(make, "key long, fp long"), RADIUS, bucket, _forest)


def met(rows: DataFrame, radius: int, bucket: int, forest: Forest) -> DataFrame:
    """``a, b``: links within ``radius`` bits that connect the ``fp`` of each ``key`` in ``rows``.

    A key with more than ``bucket`` fingerprints is dealt out: its rows fall into
    chunks, and every two chunks meet in a task.
    """
    first = keep(_met(rows.repartition("key").sortWithinPartitions("key"), radius, bucket, forest), "simhash-met")
    off = first.where("put_off").select(F.col("a").alias("key"), F.col("b").alias("fp")).distinct()
    sizes = off.groupBy(F.col("key").alias("key2")).agg(F.ceil(F.count("*") / (bucket / 2)).cast("long").alias("chunks"))
    own = F.pmod(F.xxhash64("fp"), F.col("chunks"))
    # A row goes to each pair of chunks that has its own
    dealt = (
        off.join(sizes, F.col("key") == F.col("key2"))
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        .select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "fp")
    )
    second = _met(dealt.repartition("key").sortWithinPartitions("key"), radius, None, forest)
    return first.where("not put_off").select("a", "b").unionByName(second.select("a", "b")).distinct()


def groups(docs: DataFrame, words: int = 3, blocks: int = BLOCKS) -> DataFrame:
    """``doc_id, version, fp, least`` per row: ``least`` is the group's smallest id and, for that id, version."""
    rows = keep(fingerprints(docs, words), "fingerprints")
    # Copies are one node, named by their smallest document
    nodes = keep(rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "version")).alias("least")), "simhash-nodes")
    joined = components(linked(nodes, blocks))
    ends = joined.join(nodes.withColumnRenamed("fp", "node"), "node")
    named = joined.join(ends.groupBy("component").agg(F.min("least").alias("group")), "component").select("node", "group")
    labels = nodes.join(named, F.col("fp") == F.col("node"), "left").select(F.col("fp").alias("fp2"), F.coalesce("group", "least").alias("least"))
    # A table of its own: both sides of the join then come from a shuffle, and Spark can split a hot fingerprint
    labels = keep(labels, "simhash-labels")
    return rows.join(labels, F.col("fp") == F.col("fp2")).drop("fp2")


def near_duplicates(docs: DataFrame, words: int = 3, blocks: int = BLOCKS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` per row of ``docs``.

    ``fingerprint`` is 16 hex digits. Documents whose fingerprints differ in at
    most 3 bits are linked, and ``component_id`` is the smallest doc_id that can
    be reached by links. Texts without words (null, empty) have fingerprint zero
    and are linked like any other; rows that repeat a doc_id are rows of their
    own; a null doc_id comes after all others, so only a group of nulls has a
    null component_id. An empty table gives an empty result.
    """
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return groups(docs, words, blocks).select("doc_id", hexed.alias("fingerprint"), F.col("least.doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """One row of ``docs`` per group of ``found`` (from ``groups``), with all its columns.

    The row with the group's smallest doc_id stays, among rows that repeat that id
    one with the smallest hash of its text; of rows equal in both, one.
    """
    ident, version, once_ = (spare(docs, f"_dup_{n}") for n in ("id", "version", "once"))
    light = found.groupBy("doc_id", "version").agg(F.count("*").alias("_dup_n"), F.min("least").alias("_dup_least"))
    stays = F.col("doc_id").eqNullSafe(F.col("_dup_least.doc_id")) & (F.col("version") == F.col("_dup_least.version"))
    listed = light.where(~stays | (F.col("_dup_n") > 1)).select(F.col("doc_id").alias(ident), F.col("version").alias(version), stays.alias(once_))
    listed = keep(listed, "near-duplicates")
    same = F.col("doc_id").eqNullSafe(F.col(ident)) & (F.xxhash64("text") == F.col(version))
    # The list grows with the documents, so it is never broadcast: the same plan at every size
    joined = docs.join(listed.hint("merge"), same, "left")
    single = joined.where(F.col(version).isNull()).select(*docs.columns)
    once = joined.where(F.col(once_)).dropDuplicates(["doc_id", "text"]).select(*docs.columns)
    return single.unionByName(once)
