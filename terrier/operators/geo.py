"""Distances, radius search, grid cells and proximity counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371000.0
METRES_PER_DEGREE = 111000.0


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres between points in degrees."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def distance_to(df: DataFrame, latitude: float, longitude: float, name: str) -> DataFrame:
    """Located rows with their great-circle distance to one point."""
    there = (F.lit(latitude), F.lit(longitude))
    return df.where(F.col("LATITUDE").isNotNull() & F.col("LONGITUDE").isNotNull()).withColumn(
        name, haversine_m(F.col("LATITUDE"), F.col("LONGITUDE"), *there)
    )


def planar_m(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    dx, dy = x1 - x2, y1 - y2
    return F.sqrt(dx * dx + dy * dy)


def within_radius(
    df: DataFrame, x: float, y: float, radius_m: float, name: str = "DISTANCE_M"
) -> DataFrame:
    """Rows within a radius of a projected point; the box test comes first and is pushed down."""
    px, py = F.col("X_LAMBERT93"), F.col("Y_LAMBERT93")
    box = px.between(x - radius_m, x + radius_m) & py.between(y - radius_m, y + radius_m)
    near = df.where(box).withColumn(name, planar_m(px, py, F.lit(float(x)), F.lit(float(y))))
    return near.where(F.col(name) <= radius_m)


def cell(coordinate: Column, step: float) -> Column:
    """Grid cell number; rounding first keeps computed means off the cell borders."""
    return F.floor(F.round(coordinate, 6) / F.lit(float(step))).cast("bigint")


# Cells per radius: a circle then holds some whole cells and is bordered by small ones.
FINENESS = 3


def sales_near(
    sites: DataFrame,
    points: DataFrame,
    site_id: str,
    weight: str,
    radius_m: float,
) -> DataFrame:
    """Weight of the ``points`` within a radius of each site, and distance of the nearest one.

    Both sides carry ``X_LAMBERT93`` and ``Y_LAMBERT93``. Points at one place are merged first, and
    places summed up in cells with their bounds. Sites meet the cells around them: a cell that lies
    within the circle adds its sum. Only places of cells on the border, and of those that may hold the
    nearest one, are paired with the site, so a dense town centre is not.
    """
    x, y = "X_LAMBERT93", "Y_LAMBERT93"
    step = radius_m / FINENESS
    places = (
        points.where(F.col(x).isNotNull() & F.col(y).isNotNull())
        .groupBy(x, y)
        .agg(F.sum(weight).alias("_w"))
        .select(
            F.col(x).alias("_px"), F.col(y).alias("_py"), "_w",
            cell(F.col(x), step).alias("_cx"), cell(F.col(y), step).alias("_cy"),
        )
    )
    cells = places.groupBy("_cx", "_cy").agg(
        F.sum("_w").alias("_all"), F.min("_px").alias("_x0"), F.max("_px").alias("_x1"),
        F.min("_py").alias("_y0"), F.max("_py").alias("_y1"))
    located = sites.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        site_id, F.col(x).alias("_sx"), F.col(y).alias("_sy")
    )
    around = F.sequence(F.lit(-FINENESS), F.lit(FINENESS))
    spread = (
        located.withColumn("_dx", F.explode(around))
        .withColumn("_dy", F.explode(around))
        .select(
            site_id, "_sx", "_sy",
            (cell(F.col("_sx"), step) + F.col("_dx")).alias("_cx"),
            (cell(F.col("_sy"), step) + F.col("_dy")).alias("_cy"),
        )
    )

    def nearest(c: str, low: str, high: str) -> Column:
        return F.greatest(F.col(low), F.least(F.col(c), F.col(high)))

    def farthest(c: str, low: str, high: str) -> Column:
        return F.when(F.col(c) - F.col(low) > F.col(high) - F.col(c), F.col(low)).otherwise(F.col(high))

    def gap(px: Column, py: Column) -> Column:
        return planar_m(F.col("_sx"), F.col("_sy"), px, py)

    near = (
        spread.join(cells, ["_cx", "_cy"])
        .withColumn("_from", gap(nearest("_sx", "_x0", "_x1"), nearest("_sy", "_y0", "_y1")))
        .withColumn("_to", gap(farthest("_sx", "_x0", "_x1"), farthest("_sy", "_y0", "_y1")))
        .where(F.col("_from") <= radius_m)
        .withColumn("_best", F.min("_to").over(Window.partitionBy(site_id, "_sx", "_sy")))
    )
    # Only cells on the border and those that may hold the nearest place look for their places.
    opened = (F.col("_to") > radius_m) | (F.col("_from") <= F.col("_best"))
    # The others ask for a column that no place has, rather than NULL, which would be one hot key.
    nowhere = F.when(opened, F.lit(0)).otherwise(F.lit(1 << 40))
    asking = near.select(site_id, "_sx", "_sy", "_all", (F.col("_cx") + nowhere).alias("_cx"), "_cy")
    paired = asking.join(places, ["_cx", "_cy"], "left").withColumn("_d", gap(F.col("_px"), F.col("_py")))
    whole = F.col("_px").isNull()
    return (
        paired.where(whole | (F.col("_d") <= radius_m))
        .groupBy(site_id)
        .agg(F.sum(F.when(whole, F.col("_all")).otherwise(F.col("_w"))).alias("nb_near"), F.min("_d").alias("nearest_m"))
    )
