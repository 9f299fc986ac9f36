"""Column-cleaning rules as built-in column expressions (no UDFs).

Each rule maps a string column to a typed column and never raises on bad
text: Spark 4 runs ANSI SQL by default, so plain ``cast`` of ``"--"`` would
fail the job; every rule uses the ``try_*`` forms and yields null instead.
All rules stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnLike = Column | str

# ---------------------------------------------------------------------------
# Patterns and words the cleaning rules must use to give the
# original results.
# ---------------------------------------------------------------------------
DATE_FORMAT = "yyyy-MM-dd"
FLAG_TRUE = "TRUE"
FLAG_FALSE = "FALSE"
UNIT_SEPARATOR = " "                      # number before the first space
LETTERS = "[a-zA-Z]"                      # stripped from cylinder text
DIGITS = "[0-9]"                          # stripped from engine text
CITY_PREFIXES = [("fort ", "ft "), ("saint ", "st ")]
NOT_LETTERS = "[^a-zA-Z]"                 # stripped from city keys
NOT_LOWER_ALNUM = "[^a-z0-9]"             # stripped from model keys


def _c(col: ColumnLike) -> Column:
    return F.col(col) if isinstance(col, str) else col


def lower_text(col: ColumnLike) -> Column:
    """Lower-case text."""
    return F.lower(_c(col))


def to_double(col: ColumnLike) -> Column:
    """C4: text to double, null on bad input."""
    return _c(col).try_cast("double")


# Integer text: optional sign, digits, optional decimals that are dropped
# (legacy casts truncated "3.7" to 3 and accepted "1.0").
INT_TEXT_PATTERN = r"^([+-]?\d+)(\.\d*)?$"


def to_int(col: ColumnLike) -> Column:
    """Text to int; decimals truncate, blanks tolerated, overflow -> null."""
    digits = F.regexp_extract(F.trim(_c(col)), INT_TEXT_PATTERN, 1)
    return digits.try_cast("int")


def to_flag(col: ColumnLike) -> Column:
    """TRUE/FALSE text (any case) to 1/0, anything else null."""
    up = F.upper(_c(col))
    return F.when(up == FLAG_TRUE, F.lit(1)).when(up == FLAG_FALSE, F.lit(0))


def to_date(col: ColumnLike, fmt: str = DATE_FORMAT) -> Column:
    """Text to date, null on bad input."""
    return F.try_to_date(_c(col), fmt)


def number_before_space(col: ColumnLike) -> Column:
    """Leading number of a "38.2 in" style value, as double."""
    return F.substring_index(_c(col), UNIT_SEPARATOR, 1).try_cast("double")


def engine_cylinders(col: ColumnLike) -> Column:
    """Strip ASCII letters ("V6 Flex" -> "6 "), then int."""
    return F.regexp_replace(_c(col), LETTERS, "").try_cast("int")


def engine_family(col: ColumnLike) -> Column:
    """Strip digits, lower ("V8 Hybrid" -> "v hybrid")."""
    return F.lower(F.regexp_replace(_c(col), DIGITS, ""))


def city_key(col: ColumnLike) -> Column:
    """C11: lower; leading 'fort ' -> 'ft ', 'saint ' -> 'st '; keep letters only."""
    s = F.lower(_c(col))
    # no short form starts with another long one: one of them is replaced at most
    short_form = s
    for long, short in CITY_PREFIXES:
        short_form = F.when(F.startswith(s, F.lit(long)), F.concat(F.lit(short), F.substring(s, len(long) + 1, 2**31 - 1))).otherwise(short_form)
    return F.regexp_replace(short_form, NOT_LETTERS, "")


def model_key(col: ColumnLike) -> Column:
    """Lower, keep a-z and 0-9."""
    return F.regexp_replace(F.lower(_c(col)), NOT_LOWER_ALNUM, "")


RULES: dict[str, Callable[[ColumnLike], Column]] = {
    "lower": lower_text,
    "double": to_double,
    "int": to_int,
    "flag": to_flag,
    "date": to_date,
    "number_before_space": number_before_space,
    "engine_cylinders": engine_cylinders,
    "engine_family": engine_family,
    "city": city_key,
    "model": model_key,
}

# ---------------------------------------------------------------------------
# The listings schema contract.  Column names and the rule each
# column gets must equal the original jobs' for right results.  Alphabetical,
# as the original chain lists them.
# ---------------------------------------------------------------------------
LISTING_SPEC: dict[str, str] = {
    "back_legroom": "number_before_space",
    "body_type": "lower",
    "city": "city",
    "city_fuel_economy": "double",
    "daysonmarket": "int",
    "dealer_zip": "int",
    "engine_cylinders": "engine_cylinders",
    "engine_displacement": "double",
    "engine_type": "engine_family",
    "exterior_color": "lower",
    "fleet": "flag",
    "frame_damaged": "flag",
    "franchise_dealer": "flag",
    "franchise_make": "lower",
    "front_legroom": "number_before_space",
    "fuel_tank_volume": "number_before_space",
    "fuel_type": "lower",
    "has_accidents": "flag",
    "height": "number_before_space",
    "highway_fuel_economy": "double",
    "horsepower": "double",
    "interior_color": "lower",
    "isCab": "flag",
    "is_new": "flag",
    "latitude": "double",
    "length": "number_before_space",
    "listed_date": "date",
    "listing_color": "lower",
    "longitude": "double",
    "major_options": "lower",
    "make_name": "lower",
    "maximum_seating": "number_before_space",
    "mileage": "double",
    "model_name": "model",
    "owner_count": "int",
    "power": "number_before_space",
    "price": "double",
    "salvage": "flag",
    "savings_amount": "double",
    "seller_rating": "double",
    "sp_name": "lower",
    "theft_title": "flag",
    "torque": "number_before_space",
    "transmission": "lower",
    "transmission_display": "lower",
    "trim_name": "lower",
    "wheel_system": "lower",
    "wheel_system_display": "lower",
    "wheelbase": "number_before_space",
    "width": "number_before_space",
    "year": "int",
}

# Columns the prepare job drops (little data or not useful).
DROPPED_COLUMNS: list[str] = [
    "bed", "bed_height", "bed_length", "cabin", "combine_fuel_economy",
    "is_certified", "main_picture_url", "description", "us_city",
    "is_oemcpo", "is_cpo", "vehicle_damage_category",
    "vin", "listing_id", "sp_id", "trimId",
]


def apply_rules(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """Render a ``{column: rule}`` spec as ONE projection.

    One ``withColumns`` instead of 51 chained ``withColumn`` calls: the
    analyzer resolves the plan once, Catalyst sees a single Project.
    Columns not in the spec pass through unchanged.
    """
    missing = [c for c in spec if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing for cleaning: {missing}")
    return df.withColumns({c: RULES[rule](c).alias(c) for c, rule in spec.items()})


def drop_columns(df: DataFrame, names: list[str] = DROPPED_COLUMNS) -> DataFrame:
    """Drop named columns; absent names are ignored."""
    return df.drop(*names)


def with_row_number(df: DataFrame, name: str = "rowno", part: int = 0) -> DataFrame:
    """Unique (not dense) surrogate key starting at 1, no shuffle; unique over
    the parts (below 2^10) of a table too, each of at most 2^20 partitions."""
    return df.withColumn(name, F.monotonically_increasing_id() + ((part << 53) + 1))
