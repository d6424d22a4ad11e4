"""The nearest of very many centres for every point, through a grid of cells.

Centres lie in cells of a grid, each also in the eight cells around its own. A point that
meets the centres of its cell so sees all that are at most a cell's width away. If the
nearest of them is that near, no other centre is nearer; else the point goes on to a
grid of wider cells. The first cells hold about one centre each on average, and cells
grow until they are wider than everything, so each point finds its centre.

Points that are equal are looked at once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.functions import distance
from forumlens.session import keep

#: By this the cells of a grid are wider than those of the one before.
WIDER = 4
_SLACK = 1e-9


def _cell(c: str, width: Column) -> Column:
    return F.floor(F.col(c) / width)


def _widths(centres: DataFrame) -> dict[int, float]:
    """Per configuration the width at which a cell holds about one centre; a row per configuration is collected."""
    spans = centres.groupBy("config").agg(
        (F.max("old_x") - F.min("old_x")).alias("x"), (F.max("old_y") - F.min("old_y")).alias("y"), F.count("*").alias("n")
    )
    found = {}
    for r in spans.collect():
        longer = max(r.x, r.y)
        found[r.config] = max(math.sqrt(r.x * r.y / r.n), longer / r.n) or 1.0
    return found


def nearest(points: DataFrame, centres: DataFrame) -> DataFrame:
    """(config, x, y, distance, center, old_x, old_y) of each different point (config, x, y).

    ``centres`` are rows (config, center, old_x, old_y). Of equally near ones the lowest
    number wins. A point of a configuration without centres, or without x or y, is left out.
    """
    widths = _widths(centres)
    left = points.select("config", "x", "y").where("x IS NOT NULL AND y IS NOT NULL").distinct()
    left = keep(left.where(F.col("config").isin(list(widths))), "points")
    done = None
    grow = 1.0
    while widths:
        case = F.coalesce(*[F.when(F.col("config") == c, F.lit(w * grow)) for c, w in widths.items()])
        around = F.explode(F.array(*[F.lit(i) for i in (-1, 0, 1)]))
        there = (
            centres.withColumn("width", case)
            .withColumn("i", around)
            .withColumn("j", around)
            .select("config", (_cell("old_x", F.col("width")) + F.col("i")).alias("gx"), (_cell("old_y", F.col("width")) + F.col("j")).alias("gy"), "center", "old_x", "old_y")
        )
        here = left.select("config", "x", "y", case.alias("width")).withColumns({"gx": _cell("x", F.col("width")), "gy": _cell("y", F.col("width"))})
        met = here.join(there, ["config", "gx", "gy"], "left")
        best = F.expr(f"min(CASE WHEN center IS NOT NULL THEN struct({distance('x', 'y', 'old_x', 'old_y')} AS distance, center, old_x, old_y) END)")
        found = keep(met.groupBy("config", "x", "y", "width").agg(best.alias("best")), "nearest")
        near = F.coalesce(F.col("best.distance") <= F.col("width") * (1 - _SLACK), F.lit(False))
        sure = found.where(near).select("config", "x", "y", "best.*")
        done = sure if done is None else done.unionByName(sure)
        left = found.where(~near).select("config", "x", "y")
        if left.isEmpty():
            return done
        grow *= WIDER
    return left.selectExpr("config", "x", "y", "0D AS distance", "0 AS center", "0D AS old_x", "0D AS old_y")
