"""Lookup enrichment: city -> state (E1 with I1), unmatched-key audits.

Join strategy: no hints.  The cities dimension is read from files whose
size Spark knows, so the planner broadcasts it while it is under
``spark.sql.autoBroadcastJoinThreshold`` and plans a sort-merge join when it
is not; AQE re-checks with the real size at runtime.  A city holding a third
of all listings is a skewed left side, which AQE's skew-join rule splits for
a left outer join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from autoscope.functions.clean import city_key


def city_dimension(cities: DataFrame) -> DataFrame:
    """Cleaned city -> state rows: ``(us_city, state_id, state_name)``.

    ``us_city`` is the cleaned ``city_ascii``; the cleaned ``city`` is not
    used by the join, so it is not computed.
    """
    return cities.select(city_key("city_ascii").alias("us_city"), "state_id", "state_name")


def union_cities(*dims: DataFrame) -> DataFrame:
    """Bag union (duplicates kept) of city dimensions, by column name."""
    out = dims[0]
    for d in dims[1:]:
        out = out.unionByName(d)
    return out


def attach_state(listings: DataFrame, cities: DataFrame, dedupe: bool = False) -> DataFrame:
    """Left join listings to the city dimension on the cleaned city key.

    The dimension is not de-duplicated by default: a city name present in
    two states fans a listing out to both (the original behaviour).
    ``dedupe=True`` keeps one state per city (smallest state_id), computed
    with a partial aggregate so no city's rows gather in one task.
    """
    if dedupe:
        cities = (cities.groupBy("us_city")
                        .agg(F.min(F.struct("state_id", "state_name")).alias("s"))
                        .select("us_city", "s.state_id", "s.state_name"))
    return listings.join(cities, listings["city"] == cities["us_city"], "left")


def unmatched_by_key(enriched: DataFrame, key: str = "city",
                     match_col: str = "us_city") -> DataFrame:
    """Rows whose lookup failed, counted per key, most frequent first."""
    return (enriched.filter(F.col(match_col).isNull())
                    .groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
                    .orderBy(F.desc("n_rows"), F.asc_nulls_first(key)))


def unmatched_total(enriched: DataFrame, match_col: str = "us_city") -> DataFrame:
    """Total number of rows whose lookup failed (one row)."""
    return enriched.agg(F.count_if(F.col(match_col).isNull()).alias("n_unmatched"))
