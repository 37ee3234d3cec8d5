"""A cover of polygons by cells: which are inside, which the boundary crosses, and only there the edges.

Each row of cells cuts an edge into one run of columns at most. Runs that overlap or touch make one stretch of boundary
cells; between stretches a row is inside or outside throughout, by how many edges the stretches further right have on the
row's middle line. A point meets the stretch or the inside part of its row, cut into tiles of columns for an equi-join,
and only a point of a boundary stretch meets edges: those of that stretch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Columns to a tile, as a power of two.
TILE = 5
#: How far beyond an edge cells count as touched, as a share of a cell: far more than a double's rounding.
MARGIN = 1e-6


@dataclass(frozen=True)
class Cover:
    """parts: (poly_id, row, tile, a, b, run, state), columns a to b of a row in one tile; run is null inside.

    edges: (poly_id, row, run, x1, y1, x2, y2, n), those of each boundary stretch; n: how often the edge is there.
    state: whether the row is inside (1) or outside (0) to the right of the stretch.
    """

    parts: DataFrame
    edges: DataFrame
    cell: float


def stretches(edges: DataFrame, cell: float) -> DataFrame:
    """(poly_id, row, c0, c1, run, edge): the columns that an edge touches in a row, and the number of their stretch in the row."""
    margin = cell * MARGIN
    e = edges.where("y1 <> y2").groupBy("poly_id", "x1", "y1", "x2", "y2").agg(F.count("*").alias("n"))
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    at = lambda v: F.floor(v / cell).cast("long")
    rows = e.withColumn("row", F.explode(F.sequence(at(low - margin), at(high + margin))))
    x = lambda y: F.col("x1") + (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / (F.col("y2") - F.col("y1"))
    begin, end = x(F.greatest(low, F.col("row") * cell - margin)), x(F.least(high, (F.col("row") + 1) * cell + margin))
    cut = rows.withColumns({"c0": at(F.least(begin, end) - margin), "c1": at(F.greatest(begin, end) + margin)})
    by = Window.partitionBy("poly_id", "row").orderBy("c0", "c1", "x1", "y1", "x2", "y2")
    apart = F.col("c0") > F.max("c1").over(by.rowsBetween(Window.unboundedPreceding, -1)) + 1
    return cut.withColumn("_new", F.when(apart, 1).otherwise(0)).withColumn("run", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def polygon_cover(edges: DataFrame, cell: float = 0.25) -> Cover:
    """The cover of polygons (poly_id, x1, y1, x2, y2: a row per edge of closed rings) by cells of ``cell`` degrees.

    A polygon's rings count by parity, so holes are rings inside. Its size follows the length of the boundary in cells.
    """
    cut = stretches(edges, cell)
    middle = (F.col("row") + 0.5) * cell
    across = F.sum(F.when((F.col("y1") > middle) != (F.col("y2") > middle), F.col("n")).otherwise(0))
    runs = cut.groupBy("poly_id", "row", "run").agg(F.min("c0").alias("a"), F.max("c1").alias("b"), across.alias("_n"))
    right = Window.partitionBy("poly_id", "row").orderBy(F.desc("run"))
    runs = runs.withColumns({"state": F.coalesce(F.sum("_n").over(right.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2, "_next": F.lag("a").over(right)})
    boundary = runs.select("poly_id", "row", "a", "b", "run", "state")
    inside = runs.where("state = 1 and _next > b + 1").select("poly_id", "row", (F.col("b") + 1).alias("a"), (F.col("_next") - 1).alias("b"), F.lit(None).cast("long").alias("run"), "state")
    tiled = boundary.union(inside).withColumn("tile", F.explode(F.sequence(F.shiftright("a", TILE), F.shiftright("b", TILE))))
    first = F.shiftleft("tile", TILE)
    parts = tiled.select("poly_id", "row", "tile", F.greatest("a", first).alias("a"), F.least("b", first + (1 << TILE) - 1).alias("b"), "run", "state")
    return Cover(parts, cut.select("poly_id", "row", "run", "x1", "y1", "x2", "y2", "n"), cell)


def met(points: DataFrame, cover: Cover, key: str, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """(key, x, y, poly_id, row, run, state): points in inside parts (run null) or boundary stretches of a polygon. Others are outside."""
    x, y = F.col(lon), F.col(lat)
    at = lambda v: F.floor(v / cover.cell).cast("long")
    fine = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y) & (F.abs(x) < 1e9) & (F.abs(y) < 1e9)
    p = points.where(fine).select(key, x.alias("_x"), y.alias("_y"), at(y).alias("row"), at(x).alias("_col")).withColumn("tile", F.shiftright("_col", TILE))
    return p.join(cover.parts, ["row", "tile"]).where(F.col("_col").between(F.col("a"), F.col("b"))).drop("tile", "_col", "a", "b")


def crossings(of: DataFrame, cover: Cover) -> DataFrame:
    """The points of met() in boundary stretches, a row for each edge of the stretch that lies to the right of the point on its line; one without edge for points that have none."""
    y = F.col("_y")
    right = ((F.col("y1") > y) != (F.col("y2") > y)) & (F.col("_x") < (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1"))
    e = cover.edges.withColumnsRenamed({"poly_id": "_of", "row": "_row", "run": "_run"})
    same = (F.col("poly_id") == F.col("_of")) & (F.col("row") == F.col("_row")) & (F.col("run") == F.col("_run"))
    return of.where("run is not null").join(e, same & right, "left").select(*of.columns, "n")


def inside_cover(points: DataFrame, cover: Cover, key: str, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Keys of points inside a polygon, as inside_polygon() has them. key must tell points apart."""
    of = met(points, cover, key, lon, lat)
    odd = crossings(of, cover).groupBy(key, "poly_id").agg(((F.coalesce(F.sum("n"), F.lit(0)) + F.max("state")) % 2).alias("odd")).where("odd = 1")
    return of.where("run is null").select(key).union(odd.select(key)).distinct()
