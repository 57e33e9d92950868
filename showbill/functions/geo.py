"""Coordinates and distances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from showbill.functions.text import col, let
from showbill.sources.shared import written

EARTH_KM = 6371.0
#: What every coordinate holds. Blank texts aren't read as numbers: each that fails throws inside the JVM, and most records tell no place.
DIGIT = "[0-9]"


def coordinate(c: Column | str, limit: int) -> Column:
    """A number with point or comma within the limit, to 7 places; zero counts as missing."""
    read = lambda t: F.when(t.rlike(DIGIT), F.replace(F.trim(t), F.lit(","), F.lit(".")).try_cast("double"))
    n = F.expr("try_cast(NULL as double)") if c is None else let(col(c).cast("string"), read)
    return let(n, lambda x: F.when((x != 0) & x.between(-limit, limit), F.bround(x, 7)))


def coordinate_pair(lat: Column | str, lon: Column | str) -> Column:
    """struct(lat, lon) as given, else swapped if that is valid, else null."""
    whole = lambda s: F.when(s["lat"].isNotNull() & s["lon"].isNotNull(), s)
    pair = lambda a, b: let(F.struct(coordinate(a, 90).alias("lat"), coordinate(b, 180).alias("lon")), whole)
    given = F.struct(col(lat).cast("string").alias("a"), col(lon).cast("string").alias("b"))
    return let(given, lambda g: F.coalesce(pair(g["a"], g["b"]), pair(g["b"], g["a"])))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    lat1, lon1, lat2, lon2 = (col(c) for c in (lat1, lon1, lat2, lon2))
    half = lambda a, b: F.pow(F.sin(F.radians(b - a) / 2), F.lit(2))
    a = half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2)
    return EARTH_KM * 2 * F.atan2(F.sqrt(a), F.sqrt(F.greatest(F.lit(0.0), 1 - a)))


def within_box(lat, lon, profile: str = "etl") -> Column:
    south, north, west, east = (20, 27, 117.5, 124) if profile == "etl" else (21.7, 26.5, 118, 122.5)
    return col(lat).between(south, north) & col(lon).between(west, east)


def within_region(places: DataFrame, regions: DataFrame, profile: str = "etl") -> DataFrame:
    """Adds region_ok: the point lies in the circle of its region; for unknown regions, in the box. The etl profile asks for the box always.

    places: region, lat, lon; regions: region, center_lat, center_lon, radius_km, a table of fixed size.
    """
    joined = places.join(regions, "region", "left")
    near = haversine_km("lat", "lon", "center_lat", "center_lon") <= F.col("radius_km")
    box = within_box("lat", "lon", profile)
    known = F.col("radius_km").isNotNull()
    ok = F.when(known, near & box if profile == "etl" else near).otherwise(box)
    return joined.withColumn("region_ok", F.coalesce(ok, F.lit(False))).drop("center_lat", "center_lon", "radius_km")


def nearest(places: DataFrame, lat: float, lon: float, k: int, most_km: float | None = None, tie: str = "key") -> DataFrame:
    """The k places nearest to a point, with distance_km; with most_km, only those within it, found by a box before the distance."""
    df = places.where(F.col("lat").isNotNull() & F.col("lon").isNotNull() & (F.col("lat") != 0) & (F.col("lon") != 0))
    if most_km is not None:
        # A degree of latitude is at least 110 km; a degree of longitude shrinks with the cosine.
        import math

        dlat = most_km / 110.0
        dlon = min(180.0, dlat / max(0.01, math.cos(math.radians(min(89.0, abs(lat) + dlat)))))
        df = df.where(F.col("lat").between(lat - dlat, lat + dlat) & F.col("lon").between(lon - dlon, lon + dlon))
    df = df.withColumn("distance_km", haversine_km(F.lit(lat), F.lit(lon), "lat", "lon"))
    if most_km is not None:
        df = df.where(F.col("distance_km") <= most_km)
    return df.orderBy("distance_km", tie).limit(k)


#: No two places are farther apart.
HALF_ROUND_KM = 20_038.0


def _located(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Rows with coordinates; zero counts as missing."""
    return df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull() & (F.col(lat) != 0) & (F.col(lon) != 0))


def _cells(lat: Column, lon: Column, km: float) -> tuple[Column, Column, Column]:
    """A place's band of latitude and its cell in the band, and the cell's width there in degrees.

    A band is `km` high at least. Its cells are as wide as `km` can reach from it or from the bands beside it, so whatever
    is within `km` of a place is in its own or a neighbouring cell.
    """
    height = km / 110.0
    band = F.floor(lat / height).cast("long")
    return band, F.floor(lon / _width(band, height)).cast("long"), _width(band, height)


def _width(band: Column, height: float) -> Column:
    farthest = F.least(F.greatest(F.abs(band), F.abs(band + 1)) * height + height, F.lit(90.0))
    cosine = F.cos(F.radians(farthest))
    # Half as much again covers the difference between an arc and its extent in longitude for radii of some hundred kilometres; near the poles and beyond, a band is one ring.
    return F.when((farthest > 80.0) | F.lit(height > 5.0), F.lit(720.0)).otherwise(1.5 * height / cosine)


def within_km(points: DataFrame, places: DataFrame, km: float, share: int = 1000) -> DataFrame:
    """point_key, key and distance_km of every point and place at most `km` apart. points: point_key, lat, lon; places: key, lat, lon.

    An equi-join on cells of a grid: each place is in one cell, each point asks the cells of three bands, and distances decide. A cell
    with over 1/share of all places is dealt to as many parts as it has such shares; such cells are fewer than
    `share`, so their list is broadcast. Missing coordinates meet nothing.
    """
    height = km / 110.0
    band, cell, _ = _cells(F.col("lat"), F.col("lon"), km)
    own = _located(places).select("key", F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), band.alias("_band"), cell.alias("_cell"))
    bar = F.greatest(own.agg(F.count("*")).scalar() / share, F.lit(1000.0))
    hot = F.broadcast(own.groupBy("_band", "_cell").agg(F.count("*").alias("_n")).where(F.col("_n") > bar).select("_band", "_cell", F.ceil(F.col("_n") / bar).cast("int").alias("_parts")))
    dealt = own.join(hot, ["_band", "_cell"], "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64("key"), F.col("_parts")).cast("int"), F.lit(0))).drop("_parts")

    asked = _located(points).select("point_key", "lat", "lon", F.explode(F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda i: F.floor(F.col("lat") / height).cast("long") + i)).alias("_band"))
    width = _width(F.col("_band"), height)
    # A point near the date line also asks from beyond it.
    turns = F.filter(F.array(*[F.col("lon") + t for t in (0.0, -360.0, 360.0)]), lambda x: (x + width >= -180.0) & (x - width <= 180.0))
    spans = F.flatten(F.transform(turns, lambda x: F.sequence(F.floor((x - width) / width).cast("long"), F.floor((x + width) / width).cast("long"))))
    asked = asked.withColumn("_cell", F.explode(F.array_distinct(spans))).join(hot, ["_band", "_cell"], "left")
    asked = asked.withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1))).drop("_parts")
    met = asked.join(dealt, ["_band", "_cell", "_part"]).select("point_key", "key", haversine_km("lat", "lon", "_lat", "_lon").alias("distance_km"))
    return met.where(F.col("distance_km") <= km)


def nearest_places(points: DataFrame, places: DataFrame, k: int, start_km: float = 5.0) -> DataFrame:
    """point_key, key, distance_km and place (1 to k) of the k places nearest to each point, of equally near ones the smaller key.

    Rings grow: points that find k places within a ring are done, the others ask a ring twice as wide, the last of
    which holds the whole earth; so a point in a dense part never meets far places. What each ring leaves is written. point_key must tell points apart.
    """
    place = F.row_number().over(Window.partitionBy("point_key").orderBy("distance_km", "key"))
    left, found, km = written(_located(points).select("point_key", "lat", "lon")), [], start_km
    places = written(_located(places).select("key", "lat", "lon"))
    while not left.isEmpty():
        last = km >= HALF_ROUND_KM
        near = written(within_km(left, places, min(km, HALF_ROUND_KM)).withColumn("place", place).where(F.col("place") <= k))
        done = near if last else near.join(near.where(F.col("place") == k).select("point_key"), "point_key", "left_semi")
        found.append(done)
        if last:
            break
        left = written(left.join(done.select("point_key").distinct(), "point_key", "left_anti"))
        km *= 2
    out = left.select("point_key", F.lit(None).cast(dict(places.dtypes)["key"]).alias("key"), F.lit(0.0).alias("distance_km"), F.lit(0).alias("place")).limit(0)
    for df in found:
        out = out.unionByName(df.select("point_key", "key", "distance_km", "place"))
    return out
