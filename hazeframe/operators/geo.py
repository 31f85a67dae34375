"""Nearest settlement of each coordinate, as an exact join on multi-resolution cells.

Places and coordinates become points on the unit sphere, where straight-line distance orders
points as great-circle distance does and neither the poles nor the date line need special care. Space is cut into
cubes whose edge doubles from level to level. For a coordinate, take the finest level at which its own cube holds a
place: that place is at most sqrt(3) < 2 edges away, so the nearest one lies in the block of 27 cubes around
the coordinate one level up. Where these hold many places, as a dense cluster far from the coordinate does, they are
replaced by their occupied parts, level by level, and parts that can't hold the nearest place are dropped; what is left is measured.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeframe.session import cut_lineage

EARTH_RADIUS_KM = 6371.0088
# From about 100 m up to a single cube around the whole sphere.
EDGES = tuple(2.0**power for power in range(-16, 3))
CELL = ("level", "cx", "cy", "cz")
SPOT = ("latitude", "longitude")
# Places in a coordinate's cubes from which the cubes are cut further. It bounds work; the answer doesn't depend on it.
MOST = 256
# On the unit sphere, well above the millimetre that distances are rounded to.
SLACK = 1e-7


def _point(lat: Column, lon: Column) -> Column:
    lat, lon = F.radians(lat), F.radians(lon)
    return F.struct(
        (F.cos(lat) * F.cos(lon)).alias("x"),
        (F.cos(lat) * F.sin(lon)).alias("y"),
        F.sin(lat).alias("z"),
    )


def haversine_km(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Great-circle distance."""
    half_lat = F.radians(lat_b - lat_a) / 2
    half_lon = F.radians(lon_b - lon_a) / 2
    chord = F.sin(half_lat) * F.sin(half_lat) + F.cos(F.radians(lat_a)) * F.cos(
        F.radians(lat_b)
    ) * F.sin(half_lon) * F.sin(half_lon)
    return F.asin(F.sqrt(F.least(chord, F.lit(1.0)))) * F.lit(2 * EARTH_RADIUS_KM)


def _levels() -> Column:
    rows = [F.struct(F.lit(i).alias("level"), F.lit(e).alias("edge")) for i, e in enumerate(EDGES)]
    return F.explode(F.array(*rows))


def _with_cell(df: DataFrame) -> DataFrame:
    """Adds the cube of `point` at `grid.level`."""
    cell = [F.floor((F.col(f"point.{a}") + 1) / F.col("grid.edge")).alias(f"c{a}") for a in "xyz"]
    return df.select("*", F.col("grid.level").alias("level"), *cell)


def _with_neighbours(df: DataFrame) -> DataFrame:
    """The 27 cubes around the cube of each row."""
    steps = F.array(F.lit(-1), F.lit(0), F.lit(1))
    for axis in "xyz":
        df = df.withColumn(f"d{axis}", F.explode(steps)).withColumn(
            f"c{axis}", F.col(f"c{axis}") + F.col(f"d{axis}")
        )
    return df.drop("dx", "dy", "dz")


def _edge() -> Column:
    """Edge of the cubes of `level`."""
    return F.element_at(F.array(*[F.lit(e) for e in EDGES]), F.col("level") + 1)


def _from_cube(far: bool) -> Column:
    """Least or largest straight-line distance of `point` to the places in a row's cube."""
    total = F.lit(0.0)
    for axis in "xyz":
        low = F.col(f"c{axis}") * F.col("edge") - 1
        below, above = low - F.col(f"point.{axis}"), F.col(f"point.{axis}") - low - F.col("edge")
        part = F.greatest(F.abs(below), F.abs(above)) if far else F.greatest(below, above, F.lit(0.0))
        total = total + part * part
    return F.sqrt(total)


def _thinned(cubes: DataFrame, occupied: DataFrame) -> DataFrame:
    """Cubes to search of each coordinate, cut until they hold at most MOST places or are the finest there are."""
    columns = [*SPOT, *CELL, "n"]
    each = Window.partitionBy(*SPOT)
    parts = occupied.select(
        (F.col("level") + 1).alias("level"),
        *[F.floor(F.col(c) / 2).alias(c) for c in CELL[1:]],
        F.struct(*[F.col(c).alias(f"part_{c}") for c in (*CELL, "n")]).alias("part"),
    )
    while True:
        cubes = cut_lineage(cubes.select(*columns))
        crowded = (F.sum("n").over(each) > MOST) & (F.col("level") > 0)
        marked = cubes.withColumn("crowded", crowded)
        if not marked.where("crowded").head(1):
            return cubes
        finer = (
            marked.where("crowded")
            .join(parts, list(CELL))
            .select(*SPOT, *[F.col(f"part.part_{c}").alias(c) for c in (*CELL, "n")])
            .withColumn("point", _point(F.col("latitude"), F.col("longitude")))
            .withColumn("edge", _edge())
            .withColumn("reach", F.min(_from_cube(far=True)).over(each))
            .where(_from_cube(far=False) <= F.col("reach") + SLACK)
        )
        cubes = marked.where(~F.col("crowded")).select(*columns).unionByName(finer.select(*columns))


def nearest_settlement(coordinates: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """(latitude, longitude) -> name, admin1, cc and distance of the nearest place.

    `coordinates` holds distinct pairs; equal distances go to the smallest `place_id`. Coordinates that are
    NULL, or an empty gazetteer, give no row. The search itself runs at once, as its depth depends on the places.
    """
    # Places at one spot are told apart by id alone: keep the first of each spot.
    places = (
        gazetteer.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
        .groupBy("latitude", "longitude")
        .agg(F.min(F.struct("place_id", "name", "admin1", "cc")).alias("named"))
        .select(
            F.struct("latitude", "longitude", "named").alias("place"),
            _point(F.col("latitude"), F.col("longitude")).alias("point"),
        )
    )
    # Spark takes an exploded table to be as small as its input, and would broadcast far more than it believes. The
    # size of a stored one it measures when it is shuffled, and then picks the join.
    place_cells = cut_lineage(_with_cell(places.select("*", _levels().alias("grid"))).select(*CELL, "place"))
    occupied = cut_lineage(place_cells.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n")))

    wanted = coordinates.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    located = wanted.select(*SPOT, _point(F.col("latitude"), F.col("longitude")).alias("point"))
    own_cells = _with_cell(located.select("*", _levels().alias("grid")))
    finest = (
        own_cells.join(occupied, list(CELL), "left_semi")
        .groupBy(*SPOT)
        .agg(F.min("level").alias("finest"))
    )
    searched = (
        finest.withColumn("level", F.least(F.col("finest") + 1, F.lit(len(EDGES) - 1)))
        .withColumn("grid", F.struct("level", _edge().alias("edge")))
        .drop("level")
        .withColumn("point", _point(F.col("latitude"), F.col("longitude")))
    )
    cubes = _thinned(_with_neighbours(_with_cell(searched)).join(occupied, list(CELL)), occupied)
    candidates = cubes.join(place_cells, list(CELL))
    distance = haversine_km(
        F.col("latitude"), F.col("longitude"), F.col("place.latitude"), F.col("place.longitude")
    )
    # Rounded to a millimetre, so that equal distances tie whatever the order of arithmetic.
    # Names travel with the place: a gazetteer that repeats an id must not multiply coordinates.
    ranked = F.struct(F.round(distance, 6).alias("km"), F.col("place.named").alias("named"))
    nearest = (
        candidates.select("latitude", "longitude", ranked.alias("ranked"))
        .groupBy("latitude", "longitude")
        .agg(F.min("ranked").alias("best"))
        .select("latitude", "longitude", "best.named.*", F.col("best.km").alias("distance_km"))
    )
    return nearest.select("latitude", "longitude", "name", "admin1", "cc", "place_id", "distance_km")
