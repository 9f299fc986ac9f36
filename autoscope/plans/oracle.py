"""DuckDB twins of the listings pipeline, used to check every query.

The raw inputs come from the same portable derivation as the Spark adapter
(``sources.testdata``); the cleaning rules, city join and every query are
re-written here in plain SQL, independently of the Spark code.
"""

from __future__ import annotations

from autoscope.functions.clean import DROPPED_COLUMNS, LISTING_SPEC
from autoscope.sources.io import EXTRA_CITIES
from autoscope.sources.testdata import RAW_LISTING_COLUMNS, raw_cities_sql, raw_listings_sql

RULE_SQL = {
    "lower": "lower({c})",
    "double": "try_cast({c} AS DOUBLE)",
    "int": r"try_cast(regexp_extract(trim({c}), '^([+-]?\d+)(\.\d*)?$', 1) AS INTEGER)",
    "flag": "CASE WHEN upper({c}) = 'TRUE' THEN 1 WHEN upper({c}) = 'FALSE' THEN 0 END",
    "date": "CAST(try_strptime({c}, '%Y-%m-%d') AS DATE)",
    "number_before_space": "try_cast(split_part({c}, ' ', 1) AS DOUBLE)",
    "engine_cylinders": "try_cast(regexp_replace({c}, '[a-zA-Z]', '', 'g') AS INTEGER)",
    "engine_family": "lower(regexp_replace({c}, '[0-9]', '', 'g'))",
    "city": ("regexp_replace(regexp_replace(regexp_replace(lower({c}), '^fort ', 'ft '), "
             "'^saint ', 'st '), '[^a-zA-Z]', '', 'g')"),
    "model": "regexp_replace(lower({c}), '[^a-z0-9]', '', 'g')",
}


def rule(name: str, col: str) -> str:
    return RULE_SQL[name].format(c=col)


def _clean_select() -> str:
    kept = [n for n, _ in RAW_LISTING_COLUMNS if n not in DROPPED_COLUMNS]
    parts = []
    for n in kept:
        parts.append(f"{rule(LISTING_SPEC[n], n)} AS {n}" if n in LISTING_SPEC else n)
    return ", ".join(parts)


def _extra_cities_values() -> str:
    rows = ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in r) + ")"
                     for r in EXTRA_CITIES)
    return f"(VALUES {rows}) AS t(city, city_ascii, state_id, state_name)"


def ctes() -> str:
    """WITH-list defining raw, clean, cities and listings."""
    return (
        f"raw AS ({raw_listings_sql()}), "
        f"clean AS (SELECT {_clean_select()} FROM raw), "
        f"raw_cities AS ({raw_cities_sql()}), "
        f"cities AS (SELECT {rule('city', 'city_ascii')} AS us_city, state_id, state_name FROM raw_cities "
        f"UNION ALL SELECT {rule('city', 'city_ascii')} AS us_city, state_id, state_name "
        f"FROM {_extra_cities_values()}), "
        "listings AS (SELECT clean.*, cities.us_city, cities.state_id, cities.state_name "
        "FROM clean LEFT JOIN cities ON clean.city = cities.us_city)"
    )


def with_listings(select: str, extra_ctes: str = "") -> str:
    """Full SQL: the listings CTEs, optional extra CTEs, then ``select``."""
    more = f", {extra_ctes}" if extra_ctes else ""
    return f"WITH {ctes()}{more} {select}"
