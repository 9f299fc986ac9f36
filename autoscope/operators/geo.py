"""Geo table for the state map (O1-O3), re-aimed from a single-machine
geo library onto DataFrames.

Polygon coordinates nest 3 levels deep, MultiPolygon 4, so the reader
keeps ``coordinates`` as JSON text and each row is parsed by its type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RING_LIST = "array<array<array<double>>>"      # Polygon: rings -> points -> [x, y]
POLYGON_LIST = "array<array<array<array<double>>>>"  # MultiPolygon: polygons -> rings -> ...

# The outlier part dropped from the map (feature position 1,
# part 38 -- a far-away island that squeezes the rest of the map).
OUTLIER_PART = (1, 38)


def explode_parts(features: DataFrame) -> DataFrame:
    """O1: one row per polygon with its part index.

    Input rows ``(feature_pos, state_id, geom_type, coordinates)``; output
    ``(feature_pos, state_id, part, polygon)`` where ``polygon`` is a list
    of rings.  A Polygon yields one part (index 0).
    """
    parts = (F.when(F.col("geom_type") == "MultiPolygon", F.from_json("coordinates", POLYGON_LIST))
              .otherwise(F.array(F.from_json("coordinates", RING_LIST))))
    return features.select("feature_pos", "state_id", F.posexplode(parts).alias("part", "polygon"))


def drop_part(parts: DataFrame, feature_pos: int = OUTLIER_PART[0], part: int = OUTLIER_PART[1],
              state_id: str | None = None) -> DataFrame:
    """O2: drop one part by (feature position, part position).

    Features read one per line have no position; name the feature by
    ``state_id`` then.  Rows whose position (or state) is null stay.
    """
    feature = (F.col("feature_pos").eqNullSafe(F.lit(feature_pos)) if state_id is None
               else F.col("state_id").eqNullSafe(F.lit(state_id)))
    return parts.filter(~(feature & F.col("part").eqNullSafe(F.lit(part))))


def map_table(parts: DataFrame, state_stats: DataFrame, exclude_state: str | None = None) -> DataFrame:
    """Polygon rows with the state aggregates (inner join on state),
    optionally without one state (D4)."""
    out = parts.join(state_stats, "state_id", "inner")
    if exclude_state is not None:
        out = out.filter(F.col("state_id") != exclude_state)
    return out


def features_from_states(states: DataFrame, key: str, name: str, region: str) -> DataFrame:
    """Test-data stand-in for the state polygons file, derived from a states
    table: Polygon for most states, MultiPolygon for every third state and
    for feature 1 (40 parts, so the outlier part exists).  Rings are unit
    squares placed by key and region; coordinates are JSON text, exactly as
    ``sources.io.read_geojson`` yields them."""
    k = F.col(key)
    n_parts = (F.when(k == 1, 40).when(k % 3 == 0, 2 + k % 4).otherwise(1))
    ring = ("format_string('[[[%d,%d],[%d,%d],[%d,%d],[%d,%d]]]', x0 + j, y0, x0 + j + 1, y0, "
            "x0 + j + 1, y0 + 1, x0 + j, y0)")
    multi = F.expr(f"concat('[', concat_ws(',', transform(sequence(0, n_parts - 1), j -> {ring})), ']')")
    single = F.expr(ring.replace("+ j", "+ 0"))
    base = states.select(k.cast("int").alias("feature_pos"), F.col(name).alias("state_id"),
                         n_parts.alias("n_parts"), (k * 100).cast("int").alias("x0"),
                         (F.col(region) * 10).cast("int").alias("y0"))
    return base.select("feature_pos", "state_id",
                       F.when(F.col("n_parts") > 1, "MultiPolygon").otherwise("Polygon").alias("geom_type"),
                       F.when(F.col("n_parts") > 1, multi).otherwise(single).alias("coordinates"))
