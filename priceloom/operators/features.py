"""Derived features. A feature is added only when all its inputs are there;
one that already exists is recomputed in place and listed once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priceloom.functions import log_target, product, ratio_or_zero, square

# Feature names and the columns they are made from.
SQUARED = ("living_area", "bedrooms", "bathrooms", "total_rooms", "land_area")
RATIOS = {
    "living_land_ratio": ("living_area", "land_area"),
    "bed_bath_ratio": ("bedrooms", "bathrooms"),
    "area_per_bedroom": ("living_area", "bedrooms"),
}
INTERACTIONS = (
    ("living_area", "bathrooms"),
    ("bedrooms", "bathrooms"),
    ("living_area", "land_area"),
)
LOGS = {"log_living_area": "living_area", "log_land_area": "land_area"}
ROOM_RATIOS = {"bath_per_room": ("bathrooms", "total_rooms")}
ROOM_PRODUCTS = {
    "bed_bath": ("bedrooms", "bathrooms"),
    "bed_living": ("bedrooms", "living_area"),
    "bath_living": ("bathrooms", "living_area"),
}


def _present(names: Sequence[str], available: Sequence[str]) -> bool:
    return set(names) <= set(available)


def squared_columns(available: Sequence[str]) -> dict[str, Column]:
    return {f"{c}_squared": square(c) for c in SQUARED if c in available}


def ratio_columns(available: Sequence[str], ratios: dict[str, tuple[str, str]] = RATIOS) -> dict[str, Column]:
    return {name: ratio_or_zero(*pair) for name, pair in ratios.items() if _present(pair, available)}


def interaction_columns(available: Sequence[str]) -> dict[str, Column]:
    return {f"{a}_x_{b}": product(a, b) for a, b in INTERACTIONS if _present((a, b), available)}


def log_columns(available: Sequence[str]) -> dict[str, Column]:
    return {name: log_target(source) for name, source in LOGS.items() if source in available}


def room_columns(available: Sequence[str]) -> dict[str, Column]:
    products = {n: product(*p) for n, p in ROOM_PRODUCTS.items() if _present(p, available)}
    return ratio_columns(available, ROOM_RATIOS) | products


def derived_columns(available: Sequence[str]) -> dict[str, Column]:
    """Squares, ratios and interactions, in that order."""
    return squared_columns(available) | ratio_columns(available) | interaction_columns(available)


def add_columns(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """All new columns in one projection."""
    return df.withColumns(columns) if columns else df


def derive(df: DataFrame, features: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Add the derived features and return the extended feature list."""
    columns = derived_columns(features)
    return add_columns(df, columns), list(dict.fromkeys([*features, *columns]))


def amenity_count(flags: Sequence[str]) -> Column:
    """How many of the 0/1 flags are set; a null flag counts as not set."""
    return sum((F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in flags), F.lit(0))


def amenity_columns(tiers: dict[str, Sequence[str]]) -> dict[str, Column]:
    """One count per tier plus ``amenity_count`` over all tiers. ``tiers`` maps
    an output column, for example ``luxury_amenities``, to its flag columns."""
    every = list(dict.fromkeys(flag for flags in tiers.values() for flag in flags))
    return {name: amenity_count(flags) for name, flags in tiers.items()} | {"amenity_count": amenity_count(every)}
