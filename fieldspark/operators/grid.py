"""Stage 04: equal-area cells, counts by cell, land mask, presence and rasters."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.projection import project_laea, unproject_laea
from ..functions.scalars import cell_id, pick_column, safe_double
from .cover import Cover, inside_cover

# The names by which a grid table's columns are found.
CENTROID_COLUMNS = {
    "presence": ["presence", "pres", "is_presence"],
    "lon": ["lon_center", "lon_cent", "lon", "longitude"],
    "lat": ["lat_center", "lat_cent", "lat", "latitude"],
    "cell_id": ["cell_id", "grid_id", "id"],
    "n_points": ["n_points_in_cell", "n_points", "count", "n"],
}


@dataclass(frozen=True)
class Extent:
    xmin: float
    ymin: float
    ncol: int
    nrow: int
    cell: float


def box_corners(spark: SparkSession, box=(-25.0, 34.0, 45.0, 72.0)) -> DataFrame:
    w, s, e, n = box
    return spark.createDataFrame([(w, s), (e, s), (e, n), (w, n)], "lon double, lat double")


def box_of(points: DataFrame) -> DataFrame:
    """(w, s, e, n): the box of all points, out to whole degrees; no row without points."""
    box = points.agg(F.floor(F.min("lon")).cast("double").alias("w"), F.floor(F.min("lat")).cast("double").alias("s"), F.ceil(F.max("lon")).cast("double").alias("e"), F.ceil(F.max("lat")).cast("double").alias("n"))
    return box.where("w is not null and s is not null")


def densified(box: DataFrame, still: float = 1.0, levels: int = 14) -> DataFrame:
    """(lon, lat) along the edges of a box (w, s, e, n), halved until the projected bounds stand still to ``still`` metres.

    Parallels curve in the projection, so the corners alone may leave out what lies between them. Each level has twice the
    points of the one before; the first whose bounds are those of the level before is taken, or the last.
    """
    level = F.explode(F.sequence(F.lit(0), F.lit(levels)))
    parts = box.select("w", "s", "e", "n", level.alias("level")).withColumn("i", F.explode(F.sequence(F.lit(0), F.expr("shiftleft(1, level)"))))
    t = F.col("i") / F.expr("shiftleft(1, level)")
    along = lambda a, b: F.col(a) + (F.col(b) - F.col(a)) * t
    sides = F.array(*(F.struct(lon.alias("lon"), lat.alias("lat")) for lon, lat in ((along("w", "e"), F.col("s")), (F.col("e"), along("s", "n")), (along("w", "e"), F.col("n")), (F.col("w"), along("s", "n")))))
    points = parts.select("level", F.explode(sides).alias("p")).select("level", "p.lon", "p.lat")
    x, y = project_laea(F.col("lon"), F.col("lat"))
    bounds = points.groupBy("level").agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1"))
    before = Window.orderBy("level")  # a row per level
    moved = reduce(F.greatest, [F.abs(F.col(c) - F.lag(c).over(before)) for c in ("x0", "x1", "y0", "y1")])
    enough = bounds.withColumn("moved", moved).agg(F.coalesce(F.min(F.when(F.col("moved") < still, F.col("level"))), F.max("level")).alias("level"))
    return points.join(F.broadcast(enough), "level", "left_semi").select("lon", "lat")


def corners_of(points: DataFrame) -> DataFrame:
    """The four corners (lon, lat) of the box of all points, out to whole degrees; no row without points."""
    four = F.array(*(F.struct(F.col(a).alias("lon"), F.col(b).alias("lat")) for a, b in ("ws", "es", "en", "wn")))
    return box_of(points).select(F.explode(four).alias("c")).select("c.lon", "c.lat")


def snapped_extent(corners: DataFrame, cell: float = 25_000.0) -> DataFrame:
    """xmin, xmax, ymin, ymax, ncol, nrow: the projected corners (lon, lat) of a box, or densified() points of its edges, out to whole cells."""
    x, y = project_laea(F.col("lon"), F.col("lat"))
    snap = corners.select(x.alias("x"), y.alias("y")).agg(
        (F.floor(F.min("x") / cell) * cell).alias("xmin"), (F.ceil(F.max("x") / cell) * cell).alias("xmax"), (F.floor(F.min("y") / cell) * cell).alias("ymin"), (F.ceil(F.max("y") / cell) * cell).alias("ymax")
    )
    return snap.withColumns({"ncol": ((F.col("xmax") - F.col("xmin")) / cell).cast("int"), "nrow": ((F.col("ymax") - F.col("ymin")) / cell).cast("int")})


def extent_of(corners: DataFrame, cell: float = 25_000.0) -> Extent:
    r = snapped_extent(corners, cell).first()
    return Extent(r["xmin"], r["ymin"], r["ncol"], r["nrow"], cell)


def grid_cells(spark: SparkSession, g: Extent) -> DataFrame:
    """Every cell: col, row (1 is south), centre, cell_id. The cross join is of two short ranges that span the grid."""
    cells = spark.range(1, g.ncol + 1).select(F.col("id").cast("int").alias("col")).crossJoin(spark.range(1, g.nrow + 1).select(F.col("id").cast("int").alias("row")))
    return cells.withColumns({"x_center": g.xmin + (F.col("col") - 0.5) * g.cell, "y_center": g.ymin + (F.col("row") - 0.5) * g.cell, "cell_id": cell_id(F.col("row"), F.col("col"))})


def assign_cell(df: DataFrame, g: Extent) -> DataFrame:
    """Adds col, row and in_bounds to points with lon and lat."""
    x, y = project_laea(F.col("lon"), F.col("lat"))
    rows = df.withColumns({"_x": x, "_y": y})
    rows = rows.withColumns({"col": (F.floor((F.col("_x") - g.xmin) / g.cell) + 1).cast("int"), "row": (F.floor((F.col("_y") - g.ymin) / g.cell) + 1).cast("int")}).drop("_x", "_y")
    return rows.withColumn("in_bounds", F.coalesce(F.col("col").between(1, g.ncol) & F.col("row").between(1, g.nrow), F.lit(False)))


def cells_met(points: DataFrame, g: Extent) -> DataFrame:
    """The cells of the grid that hold a point, with centre and id."""
    met = assign_cell(points.where("lon is not null and lat is not null"), g).where("in_bounds").select("col", "row").distinct()
    return met.withColumns({"x_center": g.xmin + (F.col("col") - 0.5) * g.cell, "y_center": g.ymin + (F.col("row") - 0.5) * g.cell, "cell_id": cell_id(F.col("row"), F.col("col"))})


def cell_counts(points: DataFrame, g: Extent) -> DataFrame:
    inside = assign_cell(points.where("lon is not null and lat is not null"), g).where("in_bounds")
    return inside.groupBy("species_slug", "row", "col").agg(F.count("*").cast("int").alias("n"))


def cell_tally(points: DataFrame, g: Extent) -> DataFrame:
    """(species_slug, row, col, in_bounds, has_place, n): points counted by cell, those out of bounds without one."""
    placed = assign_cell(points.select("species_slug", "lon", "lat"), g)
    at = {c: F.when(F.col("in_bounds"), F.col(c)) for c in ("row", "col")}
    has = F.col("lon").isNotNull() & F.col("lat").isNotNull()
    return placed.withColumns({**at, "has_place": has}).groupBy("species_slug", "row", "col", "in_bounds", "has_place").agg(F.count("*").alias("n"))


def tally_counts(tally: DataFrame) -> DataFrame:
    """cell_counts() of a cell_tally()."""
    return tally.where("in_bounds and has_place").groupBy("species_slug", "row", "col").agg(F.sum("n").cast("int").alias("n"))


def inside_polygon(points: DataFrame, edges: DataFrame | Cover, key: str, lon: str = "lon", lat: str = "lat", band: float = 1.0) -> DataFrame:
    """Keys of points inside a polygon, by the parity of crossings. key must tell points apart; edges: a row per ring edge.

    A polygon_cover() of many edges spares most points the edges. Otherwise points and edges meet in bands of ``band`` degrees of latitude, an equi-join that Spark broadcasts or shuffles by the
    edges' size. An edge stands in each band that it spans.
    """
    if isinstance(edges, Cover):
        return inside_cover(points, edges, key, lon, lat)
    x, y, at = F.col(lon), F.col(lat), lambda c: F.floor(c / band)
    spans = F.sequence(at(F.least("y1", "y2")), at(F.greatest("y1", "y2")))
    e = edges.where("y1 <> y2").withColumn("_band", F.explode(spans))
    p = points.where(x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)).select(key, lon, lat, at(y).alias("_band"))
    crosses = ((F.col("y1") > y) != (F.col("y2") > y)) & (x < (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1"))
    hits = p.join(e, "_band").where(crosses).groupBy(key, "poly_id").agg((F.count("*") % 2).alias("odd"))
    return hits.where("odd = 1").select(key).distinct()


def land_mask(cells: DataFrame, edges: DataFrame | Cover | None) -> DataFrame:
    """cells with on_land: whether the centre is inside a polygon; True for all without polygons."""
    if edges is None:
        return cells.withColumn("on_land", F.lit(True))
    lon, lat = unproject_laea(F.col("x_center"), F.col("y_center"))
    at = inside_polygon(cells.select("cell_id", lon.alias("lon"), lat.alias("lat")), edges, "cell_id").withColumn("_in", F.lit(True))
    return cells.join(at, "cell_id", "left").withColumn("on_land", F.coalesce("_in", F.lit(False))).drop("_in")


def grid_presence(counts: DataFrame, cells: DataFrame, species: DataFrame) -> DataFrame:
    """Every land cell of every species: n_points_in_cell (0 if none), presence 0/1 and the centre in degrees."""
    land = cells.where("on_land")
    lon, lat = unproject_laea(F.col("x_center"), F.col("y_center"))
    every = land.crossJoin(species.select("species_slug").distinct())  # the asked table has a row per cell and species
    out = every.join(counts, ["species_slug", "row", "col"], "left").withColumn("n_points_in_cell", F.coalesce("n", F.lit(0))).drop("n")
    return out.withColumns({"presence": (F.col("n_points_in_cell") > 0).cast("int"), "lon_center": lon, "lat_center": lat})


def presence_centroids(presence: DataFrame) -> DataFrame:
    fine = (F.col("presence") == 1) & F.col("lon_center").isNotNull() & ~F.isnan("lon_center") & F.col("lat_center").isNotNull() & ~F.isnan("lat_center")
    return presence.where(fine).select("species_slug", F.col("lon_center").alias("lon"), F.col("lat_center").alias("lat"), "cell_id", "n_points_in_cell")


def centroids_of_table(table: DataFrame) -> DataFrame:
    """(lon, lat, cell_id, n_points_in_cell) of the presence cells of any grid table, its columns found by usual names.

    ValueError if the table has no presence, longitude or latitude; cell_id and n_points_in_cell are null where absent.
    """
    at = {name: pick_column(table, names) for name, names in CENTROID_COLUMNS.items()}
    missing = [n for n in ("presence", "lon", "lat") if at[n] is None]
    if missing:
        raise ValueError(f"no column for {missing} among {table.columns[:60]}")
    number = lambda n: safe_double(F.col(f"`{at[n]}`").cast("string"))
    rows = table.where((number("presence") == 1) & number("lon").isNotNull() & number("lat").isNotNull())
    other = lambda n, kind: F.col(f"`{at[n]}`").cast(kind) if at[n] else F.lit(None).cast(kind)
    return rows.select(number("lon").alias("lon"), number("lat").alias("lat"), other("cell_id", "string").alias("cell_id"), other("n_points", "long").alias("n_points_in_cell"))


def tally_summary(tally: DataFrame, presence: DataFrame) -> DataFrame:
    """Counts along the way per species of a cell_tally(), zero rows included."""
    some = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0))
    read = tally.groupBy("species_slug").agg(F.sum("n").alias("n_read"), some("has_place").alias("n_after_non_na"), some("in_bounds").alias("n_in_bounds"))
    kept = presence.groupBy("species_slug").agg(F.sum("n_points_in_cell").alias("n_points_total"), F.sum("presence").alias("n_presence_cells"))
    return read.join(kept, "species_slug", "left").fillna(0)


def grid_summary(points: DataFrame, presence: DataFrame, g: Extent, species: DataFrame) -> DataFrame:
    """Counts along the way per asked species, zero rows included."""
    placed = assign_cell(points, g)
    read = placed.groupBy("species_slug").agg(F.count("*").alias("n_read"), F.count_if(F.col("lon").isNotNull() & F.col("lat").isNotNull()).alias("n_after_non_na"), F.count_if("in_bounds").alias("n_in_bounds"))
    kept = presence.groupBy("species_slug").agg(F.sum("n_points_in_cell").alias("n_points_total"), F.sum("presence").alias("n_presence_cells"))
    out = species.select("species_slug").distinct().join(read, "species_slug", "left").join(kept, "species_slug", "left")
    return out.fillna(0)


def dense_raster(presence: DataFrame, cells: DataFrame, value: str, g: Extent) -> DataFrame:
    """(species_slug, raster_row, line): one north-up line of values per row, null off land."""
    every = cells.select("row", "col").crossJoin(presence.select("species_slug").distinct())
    full = every.join(presence.select("species_slug", "row", "col", F.col(value).alias("v")), ["species_slug", "row", "col"], "left")
    line = F.transform(F.sort_array(F.collect_list(F.struct("col", "v"))), lambda s: s["v"])  # ncol values
    return full.withColumn("raster_row", g.nrow - F.col("row") + 1).groupBy("species_slug", "raster_row").agg(line.alias("line"))


def flag_in_sea(points: DataFrame, edges: DataFrame | Cover, key: str) -> DataFrame:
    """points with in_sea: not inside a polygon, null without coordinates."""
    at = inside_polygon(points, edges, key).withColumn("_in", F.lit(True))
    return points.join(at, key, "left").withColumn("in_sea", F.when(F.col("lon").isNotNull() & F.col("lat").isNotNull(), F.col("_in").isNull())).drop("_in")


def bbox(lon: Column, lat: Column, box: tuple[float, float, float, float]) -> Column:
    w, s, e, n = box
    return lon.between(w, e) & lat.between(s, n)
