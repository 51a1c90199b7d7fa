"""Matching points to named zones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgrid import profiles
from tripgrid.functions.numeric import as_col
from tripgrid.profiles import Box
from tripgrid.session import scratch_dir

ZONES_BROADCAST = 100_000
SALTS = 16
CROWD = 1_000
DEPTH = 20
#: degrees and share by which the square of a tile may be off
SLACK = 1e-9


def _distance(lat: Column, lon: Column, zone_lat: Column, zone_lon: Column) -> Column:
    dlat, dlon = lat - zone_lat, lon - zone_lon
    return F.sqrt(dlat * dlat + dlon * dlon)


def _first_hit(zones: Column, lat: Column, lon: Column) -> Column:
    """Name of the first zone of an ordered array that holds the point."""
    hits = F.filter(zones, lambda z: _distance(lat, lon, z["lat"], z["lon"]) < z["radius"])
    return F.try_element_at(hits, F.lit(1)).getField("name")


def landmark_name(lat, lon, landmarks=profiles.LANDMARKS) -> Column:
    """First landmark whose circle holds the point, null outside all of them.

    A driver-side list is a literal array in the projection and needs no join at all. Every
    point looks at every landmark, so zones kept in a table go through ``match_zones``.
    """
    zones = F.array(*[
        F.struct(
            F.lit(name).alias("name"), F.lit(a).alias("lat"), F.lit(o).alias("lon"),
            F.lit(r).alias("radius"),
        )
        for name, a, o, r in landmarks
    ])
    return _first_hit(zones, as_col(lat), as_col(lon))


def zone_display_name(lat, lon, rank, landmarks=profiles.LANDMARKS) -> Column:
    return F.coalesce(
        landmark_name(lat, lon, landmarks),
        F.concat(F.lit("Zone "), as_col(rank).cast("string")),
    )


def _square(size: float) -> tuple[Column, Column]:
    """Nearest and farthest distance from a zone's centre to the square of its tile."""
    near, far = [], []
    for c, t in (("lat", "_tile_lat"), ("lon", "_tile_lon")):
        low = F.col(t) * F.lit(size)
        high = low + F.lit(size)
        near.append(F.greatest(low - F.col(c), F.col(c) - high, F.lit(0.0)))
        far.append(F.greatest(F.abs(F.col(c) - low), F.abs(F.col(c) - high)))
    length = lambda d: F.sqrt(d[0] * d[0] + d[1] * d[1])
    return length(near), length(far)


def zone_tiles(
    zones: DataFrame, tile: float, crowd: int = CROWD, depth: int = DEPTH
) -> list[tuple[int, DataFrame]]:
    """Levels with their tiles (_tile_lat, _tile_lon, _zones): the zones a tile touches, in order.

    A tile that touches more than ``crowd`` zones is cut into four, again and again, so tiles of
    all levels together cover each place once. Zones behind the first one that covers a whole tile
    can never be the first hit in it and are left out, and of equal circles only the first is
    kept, so tiles get small lists however many zones lie on top of each other. A tile of the last
    level, 2^-``depth`` of the width, keeps its list whatever its length.
    """
    spark = zones.sparkSession
    root = scratch_dir(spark, "zone-tiles")
    circles = zones.groupBy("lat", "lon", "radius").agg(F.min(F.struct("zone_order", "name")).alias("z"))
    spread = lambda c: F.explode(F.sequence(
        F.floor((F.col(c) - F.col("radius")) / tile), F.floor((F.col(c) + F.col("radius")) / tile)
    ))
    placed = circles.select("z.*", "lat", "lon", "radius").withColumn("_tile_lat", spread("lat"))
    placed = placed.withColumn("_tile_lon", spread("lon"))
    keys, found = ["_tile_lat", "_tile_lon"], []
    for level in range(depth + 1):
        # a tile's square is computed, so a little is added where it may be too small
        near, far = _square(tile / 2**level)
        reach = F.col("radius") * (1 + SLACK) + SLACK
        seen = placed.filter(near < reach).withColumn(
            "_cover", F.when(far + SLACK < F.col("radius") * (1 - SLACK), F.col("zone_order"))
        )
        first = seen.groupBy(*keys).agg(F.min("_cover").alias("_first"))
        useful = seen.join(first, keys).filter(F.col("_first").isNull() | (F.col("zone_order") <= F.col("_first")))
        path = f"{root}/{level}"
        useful.select(*keys, "zone_order", "name", "lat", "lon", "radius").write.parquet(path)
        useful = spark.read.parquet(path)
        crowds = useful.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > crowd)
        full = crowds.select(*keys) if level < depth else crowds.select(*keys).limit(0)
        row = F.struct("zone_order", "name", "lat", "lon", "radius")
        leaves = useful.join(full, keys, "left_anti").groupBy(*keys).agg(
            F.sort_array(F.collect_list(row)).alias("_zones")
        )
        found.append((level, leaves))
        if full.isEmpty():
            break
        child = lambda c: F.explode(F.array(F.col(c) * 2, F.col(c) * 2 + 1))
        placed = useful.join(full, keys, "left_semi").withColumn("_tile_lat", child("_tile_lat"))
        placed = placed.withColumn("_tile_lon", child("_tile_lon"))
    return found


def match_zones(
    points: DataFrame,
    zones: DataFrame,
    lat: str = "latitude",
    lon: str = "longitude",
    tile: float = 0.05,
    broadcast_zones: int = ZONES_BROADCAST,
    salts: int = SALTS,
    crowd: int = CROWD,
    depth: int = DEPTH,
) -> DataFrame:
    """``points`` with ``zone_name``, the first zone of a table holding each; null in none.

    ``zones`` has (zone_order, name, lat, lon, radius). They are listed per tile by ``zone_tiles``,
    and every point meets the one list of its place; points are neither aggregated nor merged. A
    level of tiles is broadcast when its lists are counted to hold at most ``broadcast_zones``
    zones. Beyond that it is repeated ``salts`` times and points are dealt by tile and salt, so
    that a busy tile is spread over that many tasks. Levels beyond the first exist only where
    tiles are crowded.
    """
    keys = ["_tile_lat", "_tile_lon"]
    joined, names = points, []
    for level, tiles in zone_tiles(zones, tile, crowd, depth):
        place = lambda c: F.floor(F.col(c) / F.lit(tile / 2**level))
        located = joined.withColumns({"_tile_lat": place(lat), "_tile_lon": place(lon)})
        listed = tiles.agg(F.sum(F.size("_zones"))).first()[0] or 0
        if listed <= broadcast_zones:
            met = located.join(F.broadcast(tiles), keys, "left")
        else:
            salt = F.pmod(F.xxhash64(lat, lon), F.lit(salts)).cast("int")
            salted = tiles.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
            met = located.withColumn("_salt", salt).join(salted, [*keys, "_salt"], "left")
        names.append(f"_name_{level}")
        hit = _first_hit(F.col("_zones"), F.col(lat), F.col(lon))
        joined = met.select(*points.columns, *names[:-1], hit.alias(names[-1]))
    return joined.select(*points.columns, F.coalesce(*names).alias("zone_name"))


def landmark_table(spark, landmarks=profiles.LANDMARKS) -> DataFrame:
    rows = [(i, *zone) for i, zone in enumerate(landmarks, 1)]
    return spark.createDataFrame(
        rows, "zone_order int, name string, lat double, lon double, radius double"
    )


def box_zone(lat, lon, boxes: dict[str, Box], otherwise: str | None = None) -> Column:
    """Name of the first box holding the point."""
    names = [F.when(box.contains(lat, lon), name) for name, box in boxes.items()]
    return F.coalesce(*names, F.lit(otherwise))


def join_predictions(state: DataFrame, predictions: DataFrame) -> DataFrame:
    """Cells that have both a state and a prediction, by an equi-join on the cell.

    Both sides hold one row per cell.
    """
    return state.join(predictions, "cell_id")
