"""A quality score by Bradley-Terry pairwise ranking.

A document's strength is a linear function of figures of its text. The weights
maximise the likelihood that the better document of a pair wins, that is, they
minimise the logistic loss on the differences of the two documents' figures. The
threshold is a quantile of the strengths of the labelled documents: the share of
them that are marked as bad.

All labelled documents are learned from. Each of the label that more have meets
some of the other, and these pairs are a table; a pass over it adds up the gradient
and the curvature of the loss, and Newton steps between the passes find the weights.
Sums are of whole numbers, so the order of rows changes nothing. The figures are SQL
functions, and scoring is an expression over each row and shuffles nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlens.llm.common import BLANK, n_words, total, words
from forumlens.session import keep

#: How many of the other label a document meets: at least so many, and more until there are so many pairs.
MEETINGS, PAIRS = 4, 20_000
#: The documents of a label are numbered in so many parts.
SLOTS = 4096
#: Weight of the squared weights in the loss, and most passes over the pairs.
RIDGE, STEPS = 1e-3, 60
#: Cells in which a quantile is looked for at once.
CELLS = 1000
#: Rows whose terms are added up in one long.
_ADDED = 1 << 14
#: A score from here on predicts the better label.
THRESHOLD = 0.7


def figures(text: Column) -> list[Column]:
    """Figures of a whole text; all are defined for null and empty texts."""
    t = F.coalesce(text, F.lit(""))
    chars = F.greatest(F.length(t), F.lit(1))
    n = F.greatest(F.col("_q_words"), F.lit(1))
    rest = lambda pattern: (F.length(t) - F.length(F.regexp_replace(t, pattern, ""))) / chars
    return [
        rest(r"[#*$%&|<>{}]"),
        rest("!"),
        rest(r"\p{Lu}"),
        rest("[0-9]"),
        rest("[.,;:?]"),
        rest("\n"),
        F.col("_q_distinct") / n,
        F.log1p(F.col("_q_words")),
        F.length(F.regexp_replace(t, BLANK + "+", "")) / n / 10,
        rest(r"[^\p{L}\p{N}\p{P}\p{S}\x20\x09-\x0D]"),
    ]


def with_figures(docs: DataFrame, name: str = "_q_figures") -> DataFrame:
    """``docs`` with the figures of ``text`` as an array of doubles."""
    counted = docs.withColumns({"_q_words": n_words(F.col("text")), "_q_distinct": F.size(F.array_distinct(words(F.col("text"))))})
    return counted.withColumn(name, F.array(*[c.cast("double") for c in figures(F.col("text"))])).drop("_q_words", "_q_distinct")


def _strength(figures: Column, weights: tuple[float, ...]) -> Column:
    return total([F.get(figures, i) * w for i, w in enumerate(weights)]) if weights else F.lit(0.0)


@dataclass(frozen=True)
class Ranking:
    """Weights of the figures, the strength at the threshold and the scale of scores."""

    weights: tuple[float, ...]
    cut: float
    scale: float

    def score(self, figures: Column) -> Column:
        """0 to 1 and growing with the strength; THRESHOLD at the cut."""
        strength = _strength(figures, self.weights)
        # A little above, so that rounding does not take the cut itself below 0.7
        at_cut = float(np.log(THRESHOLD / (1 - THRESHOLD))) + 1e-9
        z = (strength - self.cut) / self.scale + at_cut
        return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))


def _exact(value: Column) -> Column:
    """A sum that the order of rows does not change."""
    return F.sum(value.cast("decimal(30,12)")).cast("double")


def _numbered(rows: DataFrame, seed: int) -> DataFrame:
    """``rows`` (``_q_id, _q_label``) with ``place``: 0, 1, ... within each label, in an order by hash."""
    own = rows.withColumns({"_q_order": F.xxhash64(F.lit(seed), "_q_id"), "slot": F.pmod(F.xxhash64(F.lit(seed), "_q_id"), F.lit(SLOTS))})
    sizes = own.groupBy(F.col("_q_label").alias("label2"), F.col("slot").alias("slot2")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("label2").orderBy("slot2")) - F.col("n")
    # At most two rows a slot
    starts = F.broadcast(sizes.select("label2", "slot2", before.alias("start")))
    within = F.row_number().over(Window.partitionBy("_q_label", "slot").orderBy("_q_order", "_q_id"))
    numbered = own.withColumn("within", within).join(starts, (F.col("_q_label") == F.col("label2")) & (F.col("slot") == F.col("slot2")))
    return numbered.select("_q_label", "x", (F.col("start") + F.col("within") - 1).alias("place"))


def _pairs(rows: DataFrame, good: int, bad: int, spread: np.ndarray, pairs: int, seed: int) -> DataFrame:
    """``difference``: figures of a good document less those of a bad one, in units of ``spread``.

    Each document of the larger label meets as many of the other, so that all of either take part.
    """
    few, many = min(good, bad), max(good, bad)
    times = min(few, max(MEETINGS, -(-pairs // many)))
    sign = 1 if good >= bad else -1
    large, small = (rows.where(F.col("_q_label") == label) for label in ((1, 0) if good >= bad else (0, 1)))
    turn = F.explode(F.sequence(F.lit(0), F.lit(times - 1)))
    met = large.select(F.col("x").alias("x1"), "place", turn.alias("turn"))
    met = met.select("x1", ((F.col("place") + F.col("turn") * (few // times)) % few).alias("other"))
    both = met.join(small.select(F.col("x").alias("x2"), F.col("place").alias("place2")), F.col("other") == F.col("place2"))
    return both.select(F.array(*[(F.get("x1", i) - F.get("x2", i)) * (sign / float(s)) for i, s in enumerate(spread)]).alias("difference"))


def _sums(pairs: DataFrame, w: np.ndarray, most: float) -> np.ndarray:
    """Loss, gradient and upper curvature at ``w``, added up; no difference exceeds ``most``."""
    scale = 2.0 ** (46 - np.ceil(np.log2(most * most)))
    size = 1 + float(np.abs(w).sum())
    upper = list(zip(*np.triu_indices(len(w)), strict=True))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = batch.column(0).flatten().to_numpy().reshape(-1, len(w))
            for at in range(0, len(d), _ADDED):
                x = d[at : at + _ADDED]
                strength = (x * w).sum(axis=1)
                lose = 1 / (1 + np.exp(np.minimum(strength, 700)))
                bend = lose * (1 - lose)
                terms = [np.logaddexp(0, -strength) / size, *(lose * x[:, i] for i in range(len(w))), *(bend * x[:, i] * x[:, j] for i, j in upper)]
                yield pa.RecordBatch.from_pydict({"sums": pa.array([[int(np.rint(t * scale).astype(np.int64).sum()) for t in terms]], pa.list_(pa.int64()))})

    parts = pairs.select("difference").mapInArrow(add, "sums array<long>").select(F.posexplode("sums").alias("at", "part"))
    found = parts.groupBy("at").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("all")).orderBy("at").collect()
    sums = np.array([float(r["all"]) for r in found]) / scale
    sums[0] *= size
    return sums


def _weights(pairs: DataFrame, figures: int) -> np.ndarray:
    """The weights at which the mean loss over ``pairs`` is least, by Newton steps that are halved if they lead up."""
    n, most = pairs.agg(F.count("*"), F.max(F.array_max(F.transform("difference", F.abs)))).first()
    most = max(1.0, most)
    upper = np.triu_indices(figures)
    w, step, before = np.zeros(figures), np.zeros(figures), np.inf
    for _ in range(STEPS):
        sums = _sums(pairs, w + step, most) / n
        loss = sums[0] + RIDGE / 2 * float(((w + step) ** 2).sum())
        if loss > before + 1e-9:
            step = step / 2
            continue
        w, before = w + step, loss
        bend = np.zeros((figures, figures))
        bend[upper] = sums[1 + figures :]
        bend = np.triu(bend) + np.triu(bend, 1).T + RIDGE * np.eye(figures)
        step = np.linalg.solve(bend, sums[1 : 1 + figures] - RIDGE * w)
        if np.abs(step).max() < 1e-7:
            break
    return w


def _value_at(rows: DataFrame, place: int) -> float:
    """The ``strength`` that so many of ``rows`` come before, by counts in ever narrower cells."""
    low, high = rows.agg(F.min("strength"), F.max("strength")).first()
    while low < high:
        inside = rows.where(F.col("strength").between(low, high))
        cell = F.least(F.floor((F.col("strength") - low) / (high - low) * CELLS), F.lit(CELLS - 1))
        cells = inside.groupBy(cell.alias("cell")).agg(F.count("*").alias("n"), F.min("strength").alias("low"), F.max("strength").alias("high"))
        for r in sorted(cells.collect(), key=lambda r: r.cell):
            if place < r.n:
                low, high = r.low, r.high
                break
            place -= r.n
    return low


def _quantile(rows: DataFrame, n: int, share: float) -> float:
    """As numpy's, between the two values nearest."""
    place, part = divmod(share * (n - 1), 1)
    value = _value_at(rows, int(place))
    return value + part * (_value_at(rows, int(place) + 1) - value) if part else value


def learn(figures: DataFrame, labels: DataFrame, pairs: int = PAIRS, seed: int = 4) -> Ranking:
    """As ``fit``, from figures that are there already (``doc_id, _q_figures``)."""
    chosen = labels.where("label in (0, 1) and doc_id is not null").select(F.col("doc_id").alias("_q_id"), F.col("label").alias("_q_label")).distinct()
    # Rows that repeat an id count once
    marked = figures.select("doc_id", "_q_figures").join(chosen, F.col("doc_id") == F.col("_q_id"))
    rows = keep(_numbered(marked.groupBy("_q_id", "_q_label").agg(F.min("_q_figures").alias("x")), seed), "quality-figures")
    counts = {r["_q_label"]: r["count"] for r in rows.groupBy("_q_label").count().collect()}
    good, bad = counts.get(1, 0), counts.get(0, 0)
    if not good or not bad:
        return Ranking((), 1.0 if bad else 0.0, 1.0)
    n, m = good + bad, len(rows.first()["x"])
    mean = np.array(rows.agg(*[_exact(F.get("x", i)) for i in range(m)]).first()) / n
    squares = rows.agg(*[_exact((F.get("x", i) - float(mean[i])) ** 2) for i in range(m)]).first()
    spread = np.sqrt(np.array(squares) / n) + 1e-9
    met = keep(_pairs(rows, good, bad, spread, pairs, seed), "quality-pairs")
    raw = tuple(map(float, _weights(met, m) / spread))
    strengths = keep(rows.select(_strength(F.col("x"), raw).alias("strength")), "quality-strengths")
    middle = strengths.agg(_exact(F.col("strength"))).first()[0] / n
    deviation = np.sqrt(strengths.agg(_exact((F.col("strength") - middle) ** 2)).first()[0] / n)
    return Ranking(raw, _quantile(strengths, n, bad / n), float(max(1.0, deviation)))


def fit(docs: DataFrame, labels: DataFrame, pairs: int = PAIRS, seed: int = 4) -> Ranking:
    """Learn from the texts of ``docs`` that ``labels`` (``doc_id, label``) marks, from all of them.

    Labels other than 0 and 1 and null ids are left out. There are at least
    ``pairs`` pairs if the labels have as many. Without both labels nothing can be
    ranked: all weights are 0, and every document scores THRESHOLD if only good
    ones are known or none at all, and below it if only bad ones are.
    """
    known = labels.where("label in (0, 1)").select(F.col("doc_id").alias("_q_id")).distinct()
    marked = docs.select("doc_id", "text").join(known, F.col("doc_id") == F.col("_q_id"), "left_semi")
    return learn(with_figures(marked).drop("text"), labels, pairs, seed)


def scored(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``, which replace columns of those names."""
    return with_scores(with_figures(docs.drop("score", "predicted")), ranking)


def with_scores(figures: DataFrame, ranking: Ranking) -> DataFrame:
    """``score`` and ``predicted`` in place of ``_q_figures``."""
    rows = figures.withColumn("score", ranking.score(F.col("_q_figures"))).drop("_q_figures")
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
