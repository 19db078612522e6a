"""Scores of places as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Division subtype -> containment level; fixed values.
LEVELS = {
    "country": 10,
    "dependency": 15,
    "region": 25,
    "county": 35,
    "localadmin": 45,
    "locality": 50,
    "borough": 55,
    "macrohood": 60,
    "neighborhood": 65,
    "microhood": 70,
}


def positive(name: str, value: float) -> float:
    if not value > 0:
        raise ValueError(f"{name} must be above 0, not {value}")
    return value


def level(subtype: Column) -> Column:
    """Containment level; null for an unknown subtype, which importers refuse."""
    return F.create_map(*[F.lit(x) for pair in LEVELS.items() for x in pair])[subtype]


def share(score: Column, norm: float) -> Column:
    return F.least(F.coalesce(score, F.lit(0.0)) / F.lit(float(norm)), F.lit(1.0))


def place_importance(density: Column, idf: Column, density_norm: float = 10, idf_norm: float = 18) -> Column:
    """0 to 100: 60 for density, 40 for the rarity of the category; missing scores are 0."""
    positive("density_norm", density_norm), positive("idf_norm", idf_norm)
    return F.round(60 * share(density, density_norm) + 40 * share(idf, idf_norm)).cast("int")


def population(value: Column) -> Column:
    return F.greatest(F.coalesce(value, F.lit(0)), F.lit(0))


def division_importance(subtype: Column, density: Column, people: Column, density_norm: float = 10, pop_norm: float = 20) -> Column:
    """Localities score by density and population, every other division by population alone."""
    positive("density_norm", density_norm), positive("pop_norm", pop_norm)
    by_people = 40 * F.least(F.log(1 + people) / F.lit(float(pop_norm)), F.lit(1.0))
    local = F.round(60 * share(density, density_norm) + by_people)
    return F.when(subtype == "locality", local).otherwise(F.round(by_people)).cast("int")
