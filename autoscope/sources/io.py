"""Scans and sinks: quoted multi-line CSV, Parquet, literal tables, GeoJSON,
model persistence and run-stamped output locations (A1-A9)."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from autoscope.session import shuffles_removed


def string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None,
             multiline: bool = True, partitions: int | None = None,
             null_value: str | None = None) -> DataFrame:
    """A1: header CSV, ``"`` escaped by doubling, newlines kept inside cells.

    Every column is read as string (cleaning types them), by the header's
    names; ``columns`` selects and orders them.  A multi-line CSV file cannot
    be split, so each file is one task; with many input files that is fine,
    for one big file pass ``partitions`` to spread the rows right after the
    scan (or land Parquet once and re-read).
    By default an empty field is null (the raw file's convention); pass the
    writer's ``null_value`` to keep empty strings apart from nulls.
    """
    reader = (spark.read.option("header", "true").option("escape", '"')
              .option("quote", '"').option("multiLine", str(multiline).lower())
              .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
              .option("mode", "PERMISSIVE"))
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    df = reader.csv(path)
    if columns is not None:
        df = df.select(*[F.col(f"`{c}`") for c in columns])
    return df.repartition(partitions) if partitions else df


NULL_MARKER = "\\N"


def write_csv(df: DataFrame, path: str, null_value: str = NULL_MARKER, compression: str = "none") -> None:
    """CSV sink with the same quoting conventions as ``read_csv``; values are
    written verbatim (no whitespace trimming), nulls as ``null_value``.
    ``compression`` is a codec's name; ``read_csv`` knows it by the file names
    (a multi-line file is one task, compressed or not)."""
    (df.write.mode("overwrite").option("header", "true").option("escape", '"')
       .option("quote", '"').option("quoteAll", "true").option("nullValue", null_value)
       .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
       .option("compression", compression).csv(path))


def spread(df: DataFrame, partitions: int, key: str | None = None) -> DataFrame:
    """``partitions`` partitions by one exchange, on ``key`` when given so
    that a later join on it can reuse them.

    For tables stored as one file with one row group (or one multi-line CSV):
    they scan as a single task, and broadcast joins keep that single partition
    all the way up the plan.  Always explicit: what follows a scan must not
    change with the size of the cluster.
    """
    return df.repartition(partitions, key) if key else df.repartition(partitions)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A2: Parquet scan (column pruning and row-group pushdown built in)."""
    return spark.read.parquet(path)


def write_parts(parts: Iterable[DataFrame], path: str) -> None:
    """A4: one Parquet table from several parts, written one after the other:
    only one part's shuffle files are on disk at a time."""
    for i, df in enumerate(parts):
        with shuffles_removed(df.sparkSession):
            df.write.mode("append" if i else "overwrite").option("compression", "zstd").parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """A4: Parquet overwrite sink."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def run_stamp(now: datetime | None = None) -> str:
    """A5: second-resolution run stamp used in model / prediction paths."""
    return (now or datetime.now()).strftime("%Y-%m-%d-%H-%M-%S")


def write_run(df: DataFrame, path: str, run_id: str) -> None:
    """A5 + N3: ``df`` as run ``run_id`` of the runs table at ``path``.

    The rows go to a partition of their own attempt; then the manifest's row of
    the run (a partition, overwritten alone) names that attempt.  Readers go by
    the manifest, so they see whole runs only: a run that fails half-way, or is
    being written again, shows its last whole attempt or nothing.
    """
    attempt = uuid.uuid4().hex
    part = {"run_id": F.lit(run_id), "attempt": F.lit(attempt)}
    df.withColumns(part).write.mode("append").partitionBy("run_id", "attempt").parquet(f"{path}/rows")
    row = df.sparkSession.createDataFrame([(run_id, attempt)], "run_id string, attempt string")
    row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(f"{path}/runs")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all whole runs at ``path`` with their ``run_id``."""
    def typed(name: str) -> DataFrame:  # partition values are text, whatever they look like
        found = spark.read.parquet(f"{path}/{name}").schema
        text = [T.StructField(f.name, T.StringType()) if f.name in ("run_id", "attempt") else f for f in found]
        return spark.read.schema(T.StructType(text)).parquet(f"{path}/{name}")

    return typed("rows").join(typed("runs"), ["run_id", "attempt"], "left_semi").drop("attempt")


def save_model(model, path: str) -> None:
    """Persist a fitted model (overwrite)."""
    if hasattr(model, "write"):
        model.write().overwrite().save(path)
    else:
        model.save(SparkSession.getActiveSession(), path)


def load_model(model_cls, path: str):
    """Load a model saved by ``save_model``."""
    return model_cls.load(path)


def preview(df: DataFrame, n: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows.  With ``order_by`` the rows are deterministic
    (TakeOrderedAndProject: each task keeps its own top n, only n rows per
    task travel)."""
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(n)


# ---------------------------------------------------------------------------
# A3: literal table.
# The 21 frequent dealer cities missing from the cities file,
# added by hand (city, city_ascii, state_id, state_name), in original order.
# ---------------------------------------------------------------------------
EXTRA_CITIES: list[tuple[str, str, str, str]] = [
    ("Van Nuys", "Van Nuys", "CA", "California"),
    ("Wexford", "Wexford", "PA", "Pennsylvania"),
    ("Clinton Township", "Clinton Township", "MI", "Michigan"),
    ("North Hollywood", "North Hollywood", "CA", "California"),
    ("Freehold", "Freehold", "NJ", "New Jersey"),
    ("Toms River", "Toms River", "NJ", "New Jersey"),
    ("Westborough", "Westborough", "MA", "Massachusetts"),
    ("Egg Harbor Township", "Egg Harbor Township", "NJ", "New Jersey"),
    ("Braintree", "Braintree,", "MA", "Massachusetts"),
    ("Long Island City", "Long Island City", "NY", "New York"),
    ("Maple Shade", "Maple Shade", "NJ", "New Jersey"),
    ("East Hartford", "East Hartford", "CT", "Connecticut"),
    ("Orchard Park", "Orchard Park", "NY", "New York"),
    ("City of Industry", "City of Industry", "CA", "California"),
    ("Lynnfield", "Lynnfield", "MA", "Massachusetts"),
    ("Riverhead", "Riverhead", "NY", "New York"),
    ("Sheffield Village", "Sheffield Village", "OH", "Ohio"),
    ("Ft Myers", "Ft Myers", "FL", "Florida"),
    ("New Hudson", "New Hudson", "NY", "New York"),
    ("Mt Pleasant", "Mt Pleasant", "MI", "Michigan"),
    ("Old Bridge", "Old Bridge", "NJ", "New Jersey"),
]

CITY_COLUMNS = ["city", "city_ascii", "state_id", "state_name"]


def extra_cities(spark: SparkSession) -> DataFrame:
    """A3: the literal extra-cities table with an explicit string schema."""
    return spark.createDataFrame(EXTRA_CITIES, string_schema(CITY_COLUMNS))


# ---------------------------------------------------------------------------
# GeoJSON.  Polygon coordinates nest 3 levels, MultiPolygon 4, so one
# schema cannot hold both: read ``coordinates`` as raw JSON text and parse it
# per geometry type later (operators.geo).
# ---------------------------------------------------------------------------
GEO_FEATURE = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("geometry", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.StringType()),
    ])),
])
GEO_COLLECTION = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("features", T.ArrayType(GEO_FEATURE)),
])


def read_geojson(spark: SparkSession, path: str, per_line: bool = False) -> DataFrame:
    """GeoJSON features as rows ``(feature_pos, state_id, geom_type, coordinates)``.

    ``per_line=False`` reads FeatureCollection documents (one per file, a
    file is one task); ``per_line=True`` reads one feature per line, which
    splits across tasks for large inputs.  ``feature_pos`` is the position
    in the collection (or the line order is not defined, so it is null).
    """
    if per_line:
        feats = spark.read.schema(GEO_FEATURE).json(path)
        return feats.select(F.lit(None).cast("int").alias("feature_pos"),
                            F.col("id").alias("state_id"),
                            F.col("geometry.type").alias("geom_type"),
                            F.col("geometry.coordinates").alias("coordinates"))
    doc = spark.read.option("multiLine", "true").schema(GEO_COLLECTION).json(path)
    exploded = doc.select(F.posexplode("features").alias("feature_pos", "f"))
    return exploded.select("feature_pos",
                           F.col("f.id").alias("state_id"),
                           F.col("f.geometry.type").alias("geom_type"),
                           F.col("f.geometry.coordinates").alias("coordinates"))
