"""Cleaning functions for curated columns.

All are built-in Spark expressions, so they stay inside whole-stage codegen
and compose into a single projection."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nullif(c, value) -> Column:
    """NULL where the column equals ``value``; NULL stays NULL.

    The comparison happens in the column's own type, so ``'0'`` against a
    decimal(9,6) column matches 0.000000."""
    c = _col(c)
    return F.when(c != F.lit(value), c)


def prefix_map(c, rules) -> Column:
    """First rule whose prefix starts the value wins; no match is NULL
    (there is deliberately no ``otherwise``). ``rules`` is an ordered list of
    ``(prefix, label)``."""
    c = _col(c)
    expr = None
    for prefix, label in rules:
        expr = (F.when if expr is None else expr.when)(c.startswith(prefix), F.lit(label))
    return expr if expr is not None else F.lit(None).cast(T.StringType())


def pad_code(c, width: int, fill: str = "0") -> Column:
    """Left pad to ``width``. Like ``lpad`` everywhere, longer input is
    truncated to ``width`` and ``''`` becomes all fill characters."""
    return F.lpad(_col(c), width, fill)


def area_code(a, a_width: int, b, b_width: int) -> Column:
    """Two padded codes concatenated; NULL when either part is NULL."""
    return F.concat(pad_code(a, a_width), pad_code(b, b_width))


def strip_srid(c, srid: int = 4326) -> Column:
    """Remove every ``SRID=<srid>;`` marker; other SRIDs stay."""
    return F.regexp_replace(_col(c), f"SRID={int(srid)};", "")


# --- fixed values: the boundaries product's file-name prefixes ---------------
GEO_TYPE_RULES = [
    ("neighborhoods-1m", "neighborhood_lev_m"),
    ("neighborhoods-2n", "neighborhood_lev_n"),
    ("neighborhoods-3b", "neighborhood_lev_b"),
    ("neighborhoods-4s", "neighborhood_lev_s"),
]
NEIGHBORHOOD_TYPE_RULES = [
    ("neighborhoods-1m", "Neighborhood Level 1"),
    ("neighborhoods-2n", "Neighborhood Level 2"),
    ("neighborhoods-3b", "Neighborhood Level 3"),
    ("neighborhoods-4s", "Neighborhood Level 4"),
]
# Columns whose empty text means "unknown".
EMPTY_AS_NULL = ["geo_id", "name", "state_abbr", "metro", "incorporated_place", "county"]
# Coordinates whose zero means "unknown".
ZERO_AS_NULL = ["longitude", "latitude"]
# (column, width) of the zero-padded area codes.
PADDED_CODES = [("state_fips_code", 2), ("county_fips_code", 3)]
# -----------------------------------------------------------------------------
