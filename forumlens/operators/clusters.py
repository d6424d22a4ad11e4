"""k-means over points (avg_minutes, popularity), several configurations in one pass.

A configuration is a set of starting centres. As long as they are few, the centres sit in
the plan as literals, so assigning a point needs no join; a pass shuffles one
row per centre and task, and returns one row per centre to the driver. Over
``MOST_IN_PLAN`` centres are a table that the points meet through grid cells.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from decimal import ROUND_HALF_EVEN, Decimal
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.functions import distance, normalise_minutes, round_half_even
from forumlens.functions.points import TIME_NORMALISER
from forumlens.operators.joins import complete_features
from forumlens.operators.nearest import nearest
from forumlens.session import keep, written

#: Centres that are written into the plan; more are a table.
MOST_IN_PLAN = 100
# Means of the raw coordinates, compared after normalising them
RAW = "raw"
# Means of the normalised coordinates
NORMALISED = "normalised"


class Centre(NamedTuple):
    config: int
    center: int
    avg_minutes: float
    popularity: float


@dataclass
class Clustering:
    """The last centres, all passes, and the configurations that came to rest.

    ``cycled`` tells that a set of centres came back, so that it never would rest.
    """

    centres: list[Centre]
    sizes: dict[tuple[int, int], int]
    passes: int
    at_rest: dict[int, bool]
    history: list[tuple] = field(default_factory=list)
    cycled: bool = False

    @property
    def converged(self) -> bool:
        return all(self.at_rest.values())


def as_centres(centres: DataFrame | Iterable) -> list[Centre]:
    """Centres as a list, from rows (config, center, avg_minutes, popularity)."""
    if isinstance(centres, DataFrame):
        centres = centres.select(*Centre._fields).collect()
    read = [Centre(int(c), int(i), float(m), float(p)) for c, i, m, p in centres]
    if not read:
        raise ValueError("clustering needs at least one centre")
    return sorted(read)


def normalised_centres(centres: DataFrame | Iterable) -> list[Centre]:
    """Raw starting centres in normalised coordinates."""
    cent = Decimal("0.01")
    return [
        c._replace(
            avg_minutes=float(
                Decimal(repr(c.avg_minutes / TIME_NORMALISER)).quantize(cent, ROUND_HALF_EVEN)
            ),
            popularity=float(Decimal(repr(c.popularity)).quantize(cent, ROUND_HALF_EVEN)),
        )
        for c in as_centres(centres)
    ]


def points(features: DataFrame) -> DataFrame:
    """Complete features with their normalised coordinates x and y."""
    return complete_features(features).selectExpr(
        "*", f"{normalise_minutes('avg_minutes')} AS x", f"{round_half_even('popularity')} AS y"
    )


def _xy(avg_minutes: str, popularity: str, space: str) -> tuple[str, str]:
    scale = normalise_minutes if space == RAW else round_half_even
    return scale(avg_minutes), round_half_even(popularity)


def _nearest(centres: list[Centre], space: str) -> str:
    """The struct of the nearest centre; the lowest number wins a tie."""
    candidates = []
    for c in centres:
        x, y = _xy(f"{c.avg_minutes!r}D", f"{c.popularity!r}D", space)
        candidates.append(
            f"named_struct('distance', {distance('x', 'y', x, y)}, 'center', {c.center},"
            f" 'old_x', {x}, 'old_y', {y})"
        )
    return f"array_min(array({', '.join(candidates)}))"


def assign(points: DataFrame, centres: DataFrame | Iterable, space: str = RAW) -> DataFrame:
    """Each point with its nearest centre per configuration.

    Points with a column ``config`` belong to that configuration only, as when
    each configuration has an input of its own; others take part in all.
    """
    listed = as_centres(centres)
    by_config: dict[int, list[Centre]] = {}
    for c in listed:
        by_config.setdefault(c.config, []).append(c)
    if len(listed) > MOST_IN_PLAN:
        return _assign_many(points, listed, space)
    found = {
        config: f"named_struct('config', {config}, 'nearest', {_nearest(group, space)})"
        for config, group in by_config.items()
    }
    rest = [c for c in points.columns if c != "config"]
    if "config" in points.columns:
        cases = " ".join(f"WHEN {config} THEN {struct}" for config, struct in found.items())
        own = points.where(F.col("config").isin(list(found)))
        rows = own.select(*rest, F.expr(f"inline(array(CASE config {cases} END))"))
    else:
        rows = points.select(*rest, F.expr(f"inline(array({', '.join(found.values())}))"))
    return rows.select(*rest, "config", "nearest.*")


def _assign_many(points: DataFrame, centres: list[Centre], space: str) -> DataFrame:
    """The same with the centres as a table; see ``nearest``."""
    spark = points.sparkSession
    x, y = _xy("avg_minutes", "popularity", space)
    schema = "config int, center int, avg_minutes double, popularity double"
    table = spark.createDataFrame([tuple(c) for c in centres], schema).selectExpr("config", "center", f"{x} AS old_x", f"{y} AS old_y")
    configs = sorted({c.config for c in centres})
    if "config" not in points.columns:
        points = points.withColumn("config", F.explode(F.lit(configs)))
    found = nearest(points, keep(table, "centres"))
    rest = [c for c in points.columns if c != "config"]
    joined = points.join(found.withColumnsRenamed({"x": "found_x", "y": "found_y", "config": "found_config"}), [
        F.col("config") == F.col("found_config"), F.col("x") == F.col("found_x"), F.col("y") == F.col("found_y")
    ])
    return joined.select(*rest, "config", "distance", "center", "old_x", "old_y")


def update(assigned: DataFrame, space: str = RAW) -> DataFrame:
    """New centres: the mean point of each cluster, its size, and how far it moved."""
    first, second = ("avg_minutes", "popularity") if space == RAW else ("x", "y")
    means = assigned.groupBy("config", "center", "old_x", "old_y").agg(
        F.avg(first).alias("avg_minutes"),
        F.avg(second).alias("popularity"),
        F.count("*").alias("size"),
    )
    x, y = _xy("avg_minutes", "popularity", space)
    return means.selectExpr(
        "config",
        "center",
        "avg_minutes",
        "popularity",
        "size",
        f"{distance(x, y, 'old_x', 'old_y')} AS shift",
    )


def step(points: DataFrame, centres: DataFrame | Iterable, space: str = RAW) -> DataFrame:
    """One pass: assign every point, then move the centres."""
    return update(assign(points, centres, space), space)


def _at_rest(shift: Column | float, eps: float, space: str):
    return shift < eps if space == RAW else shift <= eps


def unconverged(moved: DataFrame, eps: float = 1.0, space: str = RAW) -> DataFrame:
    """(config, moving): how many clusters of each configuration still move."""
    return moved.groupBy("config").agg(
        F.count_if(~_at_rest(F.col("shift"), eps, space)).alias("moving")
    )


@dataclass
class _Loop:
    """Where the passes have come to."""

    current: list[Centre]
    eps: float
    min_iter: int
    space: str
    keep_empty: bool
    iteration: int = 0
    at_rest: dict[int, bool] = field(default_factory=dict)
    sizes: dict[tuple[int, int], int] = field(default_factory=dict)
    history: list[tuple] = field(default_factory=list)
    cycled: bool = False
    over: bool = False

    def __post_init__(self) -> None:
        self.seen = {tuple(self.current)}

    def take(self, moved: Iterable) -> None:
        """Go on by a pass, from rows as ``step`` gives them."""
        self.iteration += 1
        self.sizes = {(r.config, r.center): r.size for r in moved}
        empty = [c for c in self.current if (c.config, c.center) not in self.sizes]
        self.at_rest = {c.config: True for c in self.current}
        for r in moved:
            rests = bool(_at_rest(r.shift, self.eps, self.space))
            self.at_rest[r.config] &= rests
            self.history.append((r.config, self.iteration, *r[1:6], rests))
        self.current = sorted([Centre(*r[:4]) for r in moved] + (empty if self.keep_empty else []))
        rest = all(self.at_rest.values())
        self.over = not self.current or (self.iteration >= self.min_iter and rest)
        self.cycled = not self.over and tuple(self.current) in self.seen and not rest
        self.over |= self.cycled
        self.seen.add(tuple(self.current))


_PASS = "config int, center int, avg_minutes double, popularity double, size bigint, shift double"


def _pass_path(output: str, iteration: int) -> str:
    return f"{output}/passes/iteration={iteration}"


def _write_pass(spark: SparkSession, output: str, iteration: int, moved: list) -> None:
    spark.createDataFrame([tuple(r) for r in moved], _PASS).coalesce(1).write.mode("overwrite").parquet(_pass_path(output, iteration))


def read_passes(spark: SparkSession, output: str) -> DataFrame:
    """The passes that ``kmeans`` wrote: ``iteration`` and the columns of ``step``."""
    return spark.read.schema(f"{_PASS}, iteration int").parquet(f"{output}/passes")


def _resume(spark: SparkSession, output: str, loop: _Loop) -> None:
    """Bring ``loop`` to the last whole pass at ``output``, or begin there."""
    start = f"{output}/start"
    if not written(spark, start):
        rows = [tuple(c) for c in loop.current]
        spark.createDataFrame(rows, "config int, center int, avg_minutes double, popularity double").write.mode("overwrite").parquet(start)
        return
    if as_centres(spark.read.parquet(start)) != loop.current:
        raise ValueError(f"the passes at {output} began from other centres")
    while not loop.over and written(spark, _pass_path(output, loop.iteration + 1)):
        loop.take(spark.read.schema(_PASS).parquet(_pass_path(output, loop.iteration + 1)).collect())


def kmeans(
    points: DataFrame,
    centres: DataFrame | Iterable,
    eps: float = 1.0,
    min_iter: int = 1,
    max_iter: int | None = None,
    space: str = RAW,
    keep_empty: bool = False,
    output: str | None = None,
) -> Clustering:
    """Passes until no cluster of any configuration moves by ``eps`` or more.

    In normalised space a move of exactly ``eps`` still counts as rest. A
    cluster without points disappears unless ``keep_empty``. Centres that come
    back in a later pass would do so for ever: the loop ends there too. With
    ``max_iter`` it ends after so many passes at the latest. Either way the
    result marks the configurations that have not come to rest.

    With ``output`` every pass is written to that folder when it is done, for
    ``read_passes``; a call that finds passes there goes on after the last whole one.
    It must be given the same points, centres and rules.
    """
    if max_iter is not None and max_iter < 1:
        raise ValueError("max_iter must be at least 1")
    spark = points.sparkSession
    loop = _Loop(as_centres(centres), eps, min_iter, space, keep_empty)
    if output:
        _resume(spark, output, loop)
    if not loop.over and loop.iteration != max_iter:
        table = keep(points, "points").persist()
        try:
            while not loop.over and loop.iteration != max_iter:
                moved = step(table, loop.current, space).collect()
                if output:
                    _write_pass(spark, output, loop.iteration + 1, moved)
                loop.take(moved)
        finally:
            table.unpersist()
    return Clustering(loop.current, loop.sizes, loop.iteration, loop.at_rest, loop.history, loop.cycled)


def centres_frame(spark: SparkSession, clustering: Clustering) -> DataFrame:
    """(config, center, avg_minutes, popularity, size, at_rest) of the last pass.

    ``at_rest`` tells whether no cluster of the configuration moved any more.
    """
    rows = [
        (*c, clustering.sizes.get((c.config, c.center), 0), bool(clustering.at_rest.get(c.config, True)))
        for c in clustering.centres
    ]
    return spark.createDataFrame(
        rows, "config int, center int, avg_minutes double, popularity double, size bigint, at_rest boolean"
    )


def history_frame(spark: SparkSession, clustering: Clustering) -> DataFrame:
    """The centres of every pass, as ``write_centres`` takes them; ``at_rest`` is of the single centre."""
    return spark.createDataFrame(
        clustering.history,
        "config int, iteration int, center int, avg_minutes double, popularity double,"
        " size bigint, shift double, at_rest boolean",
    )
