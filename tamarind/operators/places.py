"""Map layers and nearest landmarks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.functions.geo import EARTH_RADIUS_KM, haversine_km
from tamarind.functions.labels import marker_color
from tamarind.functions.text import distance_label
from tamarind.session import freeze

#: Landmark lists up to this length travel inside the plan as one array; longer ones are joined by grid cell.
LIST_BOUND = 1000


def site_coordinates(records: DataFrame, site: str, lat: str, lon: str, order: str) -> DataFrame:
    """One coordinate pair per site, taken from its first record in ``order``."""
    first = F.min_by(F.struct(lat, lon), F.when(F.col(lat).isNotNull() & F.col(lon).isNotNull(), F.col(order)))
    return records.groupBy(site).agg(first.alias("_p")).select(site, f"_p.{lat}", f"_p.{lon}")


def marker_layer(records: DataFrame, outcome: str = "class") -> DataFrame:
    """Records with the colour of their marker."""
    return records.withColumn("marker_color", marker_color(F.col(outcome)))


def marker_clusters(
    records: DataFrame, lat: str = "lat", lon: str = "lon", outcome: str = "class", cell_degrees: float = 10.0
) -> DataFrame:
    """Number of records and share of successes per grid cell."""
    return records.groupBy(
        F.floor(F.col(lat) / cell_degrees).alias("cell_lat"), F.floor(F.col(lon) / cell_degrees).alias("cell_lon")
    ).agg(F.count(F.lit(1)).alias("records"), F.avg(outcome).alias("success_rate"))


def zoom_clusters(
    records: DataFrame, lat: str = "lat", lon: str = "lon", outcome: str = "class", deepest: int = 18
) -> DataFrame:
    """Marker clusters of a web map at every zoom from 0 to ``deepest``: one row for each tile that holds a record.

    ``zoom, tile_x, tile_y, records, successes, children``; ``children`` are the tiles of the next zoom below (null at the
    deepest). Tiles are those of the square Mercator map, latitudes beyond its edge lie in the outermost row. Records are
    counted once, by their tile of the deepest zoom; a parent's place is its child's halved, so all other zooms are sums
    of these counts and no record is read again. Records without coordinates or off the globe are on no map.
    """
    side = float(1 << deepest)
    edge = 85.05112877980659  # where the Mercator map of the world is square
    phi = F.radians(F.greatest(F.least(F.col(lat).cast("double"), F.lit(edge)), F.lit(-edge)))
    x = F.floor((F.col(lon) + 180.0) / 360.0 * side)
    y = F.floor((1.0 - F.log(F.tan(phi) + 1.0 / F.cos(phi)) / F.pi()) / 2.0 * side)

    def inside(place: Column) -> Column:
        return F.greatest(F.least(place, F.lit(int(side) - 1)), F.lit(0)).cast("bigint")

    placed = records.filter(F.col(lat).between(-90, 90) & F.col(lon).between(-180, 180))
    finest = placed.groupBy(inside(x).alias("_x"), inside(y).alias("_y")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.when(F.col(outcome) == 1, 1).otherwise(0)).alias("_s")
    )
    up = F.lit(deepest) - F.col("zoom")
    child = F.when(F.col("zoom") < deepest, F.call_function("shiftright", "_x", up - 1) * (1 << deepest)
                   + F.call_function("shiftright", "_y", up - 1))
    levels = finest.withColumn("zoom", F.explode(F.sequence(F.lit(0), F.lit(deepest)))).select(
        "zoom", F.call_function("shiftright", "_x", up).alias("tile_x"), F.call_function("shiftright", "_y", up).alias("tile_y"),
        child.alias("_child"), "_n", "_s",
    )
    # By child first: a tile's children are then rows to count, and the distinct count needs no set.
    by_child = levels.groupBy("zoom", "tile_x", "tile_y", "_child").agg(F.sum("_n").alias("_n"), F.sum("_s").alias("_s"))
    return by_child.groupBy("zoom", "tile_x", "tile_y").agg(
        F.sum("_n").alias("records"),
        F.sum("_s").alias("successes"),
        F.when(F.col("zoom") < deepest, F.count("_child")).alias("children"),
    )


def _landmark(lat: Column, lon: Column, poi: Column) -> Column:
    """Distance first, id second, so that the smallest struct is the nearest landmark and ties go to the lower id."""
    km = haversine_km(lat, lon, poi["poi_lat"], poi["poi_lon"])
    return F.struct(km.alias("km"), poi["poi_id"].alias("poi_id"), poi["poi_name"].alias("poi_name"),
                    poi["poi_lat"].alias("poi_lat"), poi["poi_lon"].alias("poi_lon"))


def nearest_landmark(sites: DataFrame, landmarks: DataFrame, list_bound: int = LIST_BOUND) -> DataFrame:
    """Nearest landmark of every site, with the distance and its label.

    ``sites``: site_id, site_name, lat, lon. ``landmarks``: poi_id, poi_name, lat, lon. A short list of landmarks is
    kept in one array and each site looks through it in its own task: no join and no shuffle. A longer list is joined
    by grid cell, which gives the same result. A site without coordinates keeps its row and gets nulls.
    """
    placed = landmarks.na.drop(subset=["lat", "lon"])
    pois = placed.select("poi_id", "poi_name", F.col("lat").alias("poi_lat"), F.col("lon").alias("poi_lon"))
    if pois.limit(list_bound + 1).count() <= list_bound:
        everything = pois.agg(F.collect_list(F.struct(*pois.columns))).scalar()
        found = F.array_min(F.transform("_pois", lambda p: _landmark(F.col("lat"), F.col("lon"), p)))
        known = F.col("lat").isNotNull() & F.col("lon").isNotNull()
        nearest = sites.withColumn("_pois", everything).withColumn("_best", F.when(known, found))
    else:
        nearest = _nearest_by_cell(sites, pois)
    return nearest.select(
        "site_id", "site_name", "lat", "lon", "_best.poi_id", "_best.poi_name", "_best.poi_lat", "_best.poi_lon", "_best.km",
        F.when(F.col("_best.km").isNotNull(), distance_label(F.col("_best.poi_name"), F.col("_best.km"))).alias("label"),
    )


def _unit_vector(lat: Column, lon: Column) -> list[Column]:
    la, lo = F.radians(lat), F.radians(lon)
    return [F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)]


def _nearest_by_cell(sites: DataFrame, pois: DataFrame, first_size: float = 1 / 256, growth: int = 4) -> DataFrame:
    """Nearest landmark by cells of a cube around the unit sphere.

    A site compares itself with the landmarks of its cell and the 26 cells around it. When the best of these is closer
    than one cell size nothing outside can be nearer, so the site is done; the others go on with larger cells until one
    cell covers the globe. Sites at one coordinate are looked up once, and of landmarks at one coordinate only the first by
    id can be an answer. Every round is frozen, which keeps plans short.
    """
    first = F.min(F.struct("poi_id", "poi_name")).alias("_first")
    pois = pois.groupBy("poi_lat", "poi_lon").agg(first).select("_first.*", "poi_lat", "poi_lon")
    points = freeze(sites.select("lat", "lon").na.drop().distinct(), "points")
    open_points, done, size = points, [], first_size
    while True:
        last = size >= 2.0
        around = F.array(*[F.lit(i) for i in (-1, 0, 1)])
        cell = [F.floor(x / size) for x in _unit_vector(F.col("lat"), F.col("lon"))]
        wanted = open_points.select("lat", "lon", *[c.alias(n) for c, n in zip(cell, ("cx", "cy", "cz"))])
        offered = pois.withColumns(
            {n: F.floor(x / size) for n, x in zip(("cx", "cy", "cz"), _unit_vector(F.col("poi_lat"), F.col("poi_lon")))}
        )
        for axis in ("cx", "cy", "cz"):
            offered = offered.withColumn("_step", F.explode(around)).withColumn(axis, F.col(axis) + F.col("_step")).drop("_step")
        offered = offered.withColumn("_p", F.struct(*pois.columns)).select("cx", "cy", "cz", "_p")
        best = (
            wanted.join(offered, ["cx", "cy", "cz"])
            .groupBy("lat", "lon")
            .agg(F.min(_landmark(F.col("lat"), F.col("lon"), F.col("_p"))).alias("_best"))
        )
        # A chord of one cell size, as an arc; a little less, so that rounding can only delay a site.
        reach = 2 * EARTH_RADIUS_KM * F.asin(F.lit(min(size / 2, 1.0))) * (1 - 1e-9)
        settled = freeze(best if last else best.filter(F.col("_best.km") <= reach), "nearest")
        done.append(settled)
        if last:
            break
        open_points = freeze(open_points.join(settled.select("lat", "lon"), ["lat", "lon"], "left_anti"), "points")
        size = size * growth
    return sites.join(reduce(DataFrame.unionByName, done), ["lat", "lon"], "left")
