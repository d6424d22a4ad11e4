"""Hard negatives by exact inner products, with candidates from sorted coordinate lists.

Rows lie in buckets of nearly equal length, at most some thousand to a hundred thousand
rows each. An anchor that looks for scores of ``theta`` and more needs, in a bucket of
lengths up to ``l``, an angle whose cosine is at least ``theta / (|anchor| * l)``. If that is
over one, the anchor does not go to the bucket at all. Otherwise the angle bounds each
coordinate of the normalised rows: on the anchor's largest coordinates, its focus, a
sorted list of the bucket gives the rows in the feasible range, and the rows in all
ranges are verified by their exact score.

Three passes: anchors in their own bucket only, which bounds from below what their best
positives score; anchors in all buckets for the positives; and again for the negatives,
whose bound follows from the positives. In a pass the rows of a bucket come first, then
its anchors one after another, so a task holds one bucket and a batch of anchors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlens.session import keep

#: Components are multiplied by this, then cut to whole numbers.
SCALE = 256
#: The largest component in whole numbers; so 2,048 of them give a score of 64 bits.
LARGEST = 1 << 26
#: Lengths of a bucket differ by a 16th power of two at most.
CLASSES = 8
#: Rows of a bucket: a 1,024th of all, within these bounds.
ROWS = (1 << 10, 1 << 17)
#: Coordinates of an anchor whose lists are looked at.
FOCUS = 3
_SLACK = 1e-9


class _Class(NamedTuple):
    """Lengths that share buckets, the number of those, and the greatest square of a length."""

    length_class: int
    parts: int
    top: int


def _whole(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))


def _prepared(rows: DataFrame, is_anchor: Column, row_id: str, vector: str, label: str) -> DataFrame:
    """(id, label, vec, square, length_class, anchor) of the rows that take part."""
    finite = lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf"))
    valid = F.col(row_id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & F.forall(vector, finite)
    taken = rows.where(valid).select(
        F.col(row_id).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"),
        _whole(F.col(vector)).alias("vec"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )
    small = taken.where(F.forall("vec", lambda x: x.between(-LARGEST, LARGEST)))
    square = F.aggregate("vec", F.lit(0).cast("long"), lambda total, x: total + x.cast("long") * x)
    return (
        small.withColumn("vec", F.col("vec").cast("array<int>"))
        .withColumn("square", square)
        .withColumn("length_class", F.when(F.col("square") > 0, F.floor(F.log2("square") * CLASSES)).otherwise(-1).cast("int"))
    )


class Bucket:
    """Rows in order of their ids, with a sorted list per coordinate made when it is first asked for."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        order = np.lexsort((labels, ids))
        ids, labels, vectors = ids[order], labels[order], vectors[order].astype(np.int64)
        if (ids[1:] == ids[:-1]).any():
            # A row that repeats another counts once
            _, once = np.unique(np.column_stack([ids, labels, vectors]), axis=0, return_index=True)
            once.sort()
            ids, labels, vectors = ids[once], labels[once], vectors[once]
        self.ids, self.labels = ids, labels
        most = int(np.abs(vectors).max(initial=0))
        # Sums of products below 2 ** 53 are exact in doubles, which multiply faster
        self.kind = np.float64 if most * LARGEST * vectors.shape[1] < 1 << 53 else np.int64
        self.vectors = vectors.astype(self.kind)
        lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        self.longest = float(lengths.max(initial=0))
        self.normal = vectors / np.maximum(lengths, 1e-300)[:, None]
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.lists:
            order = np.argsort(self.normal[:, f], kind="stable")
            self.lists[f] = order, self.normal[order, f]
        return self.lists[f]

    def candidates(self, anchor: np.ndarray, theta: float) -> np.ndarray | None:
        """Rows that may score ``theta`` or more, in no order; None for all."""
        length = float(np.sqrt((anchor.astype(np.float64) ** 2).sum()))
        if theta <= 0 or length == 0:
            return None if theta <= 0 else np.zeros(0, dtype=np.int64)
        cosine = theta / (length * max(self.longest, 1e-300)) - _SLACK
        if cosine > 1:
            return np.zeros(0, dtype=np.int64)
        normal = anchor / length
        focus = np.argsort(-np.abs(normal), kind="stable")[:FOCUS]
        own, wide = np.arccos(np.clip(normal[focus], -1, 1)), np.arccos(cosine)
        low = np.cos(np.minimum(np.pi, own + wide)) - _SLACK
        high = np.cos(np.maximum(0, own - wide)) + _SLACK
        best = None
        for f, a, b in zip(focus.tolist(), low, high):
            order, values = self._list(f)
            begin, end = np.searchsorted(values, a), np.searchsorted(values, b, side="right")
            if best is None or end - begin < len(best[0]):
                best = order[begin:end], f
        rows, listed = best
        for f, a, b in zip(focus.tolist(), low, high):
            if f != listed:
                values = self.normal[rows, f]
                rows = rows[(values >= a) & (values <= b)]
        return rows

    def scored(self, anchor: np.ndarray, theta: float, wanted: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of at least the ``wanted`` rows that score ``theta`` or more, best first, then by id."""
        rows = self.candidates(anchor, theta)
        rows = np.arange(len(self.ids)) if rows is None else rows
        rows = rows[wanted(self.ids[rows], self.labels[rows])]
        scores = (self.vectors[rows] @ anchor.astype(self.kind)).astype(np.int64)
        more = scores >= theta
        rows, scores = rows[more], scores[more]
        order = np.lexsort((rows, -scores))
        return self.ids[rows[order]], scores[order]


_ANCHOR = ("anchor_id", "anchor_label", "anchor_key")
_POSITIVE = "anchor_id long, anchor_label long, anchor_key long, id long, score long"
_NEGATIVE = f"{_POSITIVE}, place int, positive_id long, positive_score long"
_POSITIVES = "array<struct<place int, id long, score long>>"


def _searched(work: DataFrame, find: Callable[[Bucket, dict, np.ndarray], Iterator[tuple]], schema: str) -> DataFrame:
    """``find`` of every anchor in every bucket it is sent to.

    ``work`` has bucket, kind (0 for the bucket's rows, 1 for anchors), id, label, vec, and of
    anchors key, theta and positives.
    """
    columns = [part.split()[0] for part in schema.split(", ")]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows, bucket = None, [], None
        for batch in batches:
            places, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(places):
                continue
            vectors = batch.column(4).flatten().to_numpy().reshape(len(places), -1)
            cuts = np.flatnonzero((np.diff(places) != 0) | (np.diff(kinds) != 0)) + 1
            found: list[tuple] = []
            for part in np.split(np.arange(len(places)), cuts):
                if places[part[0]] != number:
                    number, rows, bucket = places[part[0]], [], None
                some = batch.slice(part[0], len(part))
                if kinds[part[0]] == 0:
                    rows.append((some.column(2).to_numpy(), some.column(3).to_numpy(), vectors[part]))
                    continue
                if bucket is None:
                    bucket, rows = Bucket(*(np.concatenate(x) for x in zip(*rows))) if rows else None, []
                if bucket is not None:
                    for anchor, vector in zip(some.drop_columns(["vec"]).to_pylist(), vectors[part]):
                        found.extend(find(bucket, anchor, vector))
            if found:
                yield pa.RecordBatch.from_pydict({c: pa.array(x) for c, x in zip(columns, zip(*found))}, _arrow(schema))

    dealt = work.repartition("bucket").sortWithinPartitions("bucket", "kind")
    return dealt.mapInArrow(search, schema)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in schema.split(", "))])


def _best(found: DataFrame, most: int, *within: str) -> DataFrame:
    """The first ``most`` rows by score, then id, with their ``rank``."""
    order = Window.partitionBy(*_ANCHOR, *within).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    row_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Scores are inner products of the components, times ``SCALE`` and cut to whole numbers.
    The positives of an anchor, a row for which ``is_anchor`` holds, are the other rows of
    its label that score best, equal scores by id. For each of them come the best
    rows of other labels whose score lies between ``low`` per cent of the positive's and the
    positive's own; ``rank`` counts them from 1. A positive without such rows gives none.

    Rows without id, label or vector, with a missing or non-finite component or with one
    beyond ``LARGEST`` take no part. Shorter vectors count as filled up with zeros. A row that
    equals another in id, label and vector counts once; a row of the anchor's own id is no
    positive of it. Other columns are not looked at. An empty table gives no rows.
    """
    base = keep(_prepared(rows, is_anchor, row_id, vector, label), "vectors")
    # At most CLASSES * 63 + 1 rows
    told = base.groupBy("length_class").agg(
        F.count("*").alias("n"), F.max("square").alias("top"), F.max(F.size("vec")).alias("most"), F.min(F.size("vec")).alias("least")
    ).collect()
    n, size = sum(r.n for r in told), max((r.most for r in told), default=0)
    if any(r.least < size for r in told):
        missing = F.array_repeat(F.lit(0), F.lit(size) - F.size("vec"))
        base = base.withColumn("vec", F.concat("vec", missing))
    if size == 0:
        # All scores of empty vectors are zero
        base = base.withColumn("vec", F.array(F.lit(0)))
    per_bucket = max(ROWS[0], min(ROWS[1], n // 1024))
    classes = [_Class(r.length_class, -(-r.n // per_bucket), r.top) for r in told] or [_Class(-1, 1, 0)]
    case = lambda made, c: made.when(F.col("length_class") == c.length_class, c.parts)
    parts = reduce(case, classes, F)
    own_bucket = _bucket(F.col("length_class"), F.pmod(F.xxhash64("id"), parts))
    work = base.select(
        own_bucket.alias("bucket"), F.lit(0).alias("kind"), "id", "label", "vec",
        F.lit(None).cast("long").alias("key"), F.lit(None).cast("double").alias("theta"),
        F.lit(None).cast(_POSITIVES).alias("positives"),
    )
    anchors = keep(
        base.where("anchor").select("id", "label", "vec", "square", own_bucket.alias("bucket"))
        .withColumn("key", F.xxhash64("id", "label", "vec")).dropDuplicates(["id", "label", "key"]),
        "anchors",
    )

    def sent(asked: DataFrame) -> DataFrame:
        """``work`` and the anchors, which have columns theta and positives, in each bucket that can hold what they ask for."""
        known = F.array(*[F.struct(*[F.lit(x).cast("long").alias(name) for name, x in zip(_Class._fields, c)]) for c in classes])
        reach = lambda c: F.col("theta").isNull() | (F.col("theta") <= F.sqrt(F.col("square").cast("double")) * F.sqrt(c["top"].cast("double")) * (1 + _SLACK) + _SLACK)
        there = asked.withColumn("to", F.explode(F.filter(known, reach)))
        there = there.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("to.parts") - 1)))
        return work.unionByName(there.select(
            _bucket(F.col("to.length_class"), F.col("part")).alias("bucket"), F.lit(1).alias("kind"), "id", "label", "vec", "key", "theta", "positives",
        ))

    def find_positives(bucket: Bucket, anchor: dict, values: np.ndarray) -> Iterator[tuple]:
        theta = -np.inf if anchor["theta"] is None else anchor["theta"]
        ids, scores = bucket.scored(values, theta, lambda i, kinds: (kinds == anchor["label"]) & (i != anchor["id"]))
        for i, score in zip(ids[:positives].tolist(), scores[:positives].tolist()):
            yield anchor["id"], anchor["label"], anchor["key"], i, score

    def find_negatives(bucket: Bucket, anchor: dict, values: np.ndarray) -> Iterator[tuple]:
        ids, scores = bucket.scored(values, anchor["theta"], lambda _, kinds: kinds != anchor["label"])
        falling = -scores
        for p in anchor["positives"]:
            first = int(np.searchsorted(falling, -p["score"]))
            for i, score in zip(ids[first : first + negatives].tolist(), scores[first : first + negatives].tolist()):
                if low * p["score"] <= 100 * score:
                    yield anchor["id"], anchor["label"], anchor["key"], i, score, p["place"], p["id"], p["score"]

    no_theta = F.lit(None).cast("double").alias("theta")
    no_positives = F.lit(None).cast(_POSITIVES).alias("positives")
    at_home = work.unionByName(anchors.select("bucket", F.lit(1).alias("kind"), "id", "label", "vec", "key", no_theta, no_positives))
    bound = (
        _best(_searched(at_home, find_positives, _POSITIVE), positives)
        .groupBy(*_ANCHOR)
        .agg(F.when(F.count("*") == positives, F.min("score")).cast("double").alias("theta"))
    )
    same = [F.col("id") == F.col("anchor_id"), F.col("label") == F.col("anchor_label"), F.col("key") == F.col("anchor_key")]
    asked = anchors.drop("bucket").join(bound, same, "left").select("id", "label", "vec", "square", "key", "theta", no_positives)
    best = _best(_searched(sent(keep(asked, "bounds")), find_positives, _POSITIVE), positives)
    # Below zero no score is between a share of it and itself
    per_anchor = (
        best.where("score >= 0")
        .groupBy(*_ANCHOR)
        .agg(
            F.expr(f"cast(min(score) * {low} div 100 as double)").alias("theta"),
            F.collect_list(F.struct(F.col("rank").cast("int").alias("place"), "id", "score")).alias("positives"),
        )
    )
    wanted = anchors.drop("bucket").join(per_anchor, same).select("id", "label", "vec", "square", "key", "theta", "positives")
    found = _best(_searched(sent(keep(wanted, "positives")), find_negatives, _NEGATIVE), negatives, "place")
    return found.select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def _bucket(length_class: Column, part: Column) -> Column:
    return length_class.cast("long") * (1 << 32) + part
