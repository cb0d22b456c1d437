"""Region rules: which location texts name the target region."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacantia.functions.text import col

# Fixed patterns: names match in any letter case, codes only as written.
REGION_NAMES = (
    r"costa\s+rica",
    r"latam",
    r"latin\s+america",
    r"alajuela",
    r"heredia",
    r"cartago",
    r"guanacaste",
    r"puntarenas",
)
REGION_CODES = ("CR", "CRI")
FILTER_TOKENS = ("Costa Rica", "CR", "LATAM", "Latin America")


def word_bounded(patterns, ignore_case: bool) -> str:
    """One pattern that matches any of *patterns* as whole words of any script."""
    flags = "(?iu)" if ignore_case else ""
    return flags + r"(?<![\p{L}\p{N}_])(?:" + "|".join(patterns) + r")(?![\p{L}\p{N}_])"


def in_region(
    location: Column | str, names=REGION_NAMES, codes=REGION_CODES
) -> Column:
    """Whether a location text names the region; null and empty texts do not."""
    location = col(location)
    hit = F.lit(False)
    for patterns, ignore_case in ((names, True), (codes, False)):
        if patterns:
            hit = hit | location.rlike(word_bounded(patterns, ignore_case))
    return F.coalesce(hit, F.lit(False))


def joined_place(country: Column, city: Column) -> Column:
    return F.trim(
        F.concat(F.coalesce(country, F.lit("")), F.lit(" "), F.coalesce(city, F.lit("")))
    )


def record_in_region(country: Column, city: Column, places: Column) -> Column:
    """Primary country and city, or any entry of ``array<struct<country,city,location>>``."""
    return in_region(joined_place(country, city)) | F.coalesce(
        F.exists(
            places,
            lambda p: in_region(
                F.coalesce(
                    F.nullif(joined_place(p["country"], p["city"]), F.lit("")), F.trim(p["location"])
                )
            ),
        ),
        F.lit(False),
    )


def country_or_city_in_region(country: Column, cities: Column) -> Column:
    """Country alone, any city alone, or country and city together."""
    return in_region(country) | F.coalesce(
        F.exists(cities, lambda c: in_region(c) | in_region(joined_place(country, c))),
        F.lit(False),
    )
