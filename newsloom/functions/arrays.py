"""Tags, coordinates, headers and access tags as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def full_tags(c: Column) -> Column:
    """Tags without null and empty ones; null gives an empty array."""
    return F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda t: t != "")


def plain_tags(c: Column) -> Column:
    """Tags that say nothing of a place."""
    return F.filter(full_tags(c), lambda t: ~t.rlike("^(city|country|region|geo):"))


def tag_map(c: Column) -> Column:
    """Tags with one colon as a map; of a repeated key the last value stays."""
    pairs = F.filter(full_tags(c), lambda t: F.size(F.split(t, ":")) == 2)
    keys = F.transform(pairs, lambda t: F.split_part(t, F.lit(":"), F.lit(1)))
    distinct = F.array_distinct(keys)
    value = F.transform(distinct, lambda k: F.split_part(F.element_at(F.filter(pairs, lambda t: F.split_part(t, F.lit(":"), F.lit(1)) == k), -1), F.lit(":"), F.lit(2)))
    return F.map_from_arrays(distinct, value)


def points(c: Column) -> Column:
    """'lat lon;lat lon' as an array of points; pieces that aren't a pair of numbers are left out."""
    def point(p: Column) -> Column:
        xs = F.split(F.trim(p), r"\s+")
        number = lambda k: F.when(F.size(xs) == 2, F.try_element_at(xs, F.lit(k)).try_cast("double"))
        return F.struct(number(1).alias("lat"), number(2).alias("lon"))

    return F.filter(F.transform(F.split(c, ";"), point), lambda p: p["lat"].isNotNull() & p["lon"].isNotNull())


def header_map(c: Column) -> Column:
    """Header lines as a map of lower-cased names and values; lines without a colon are skipped, the last of a name stays."""
    lines = F.filter(F.split(c, r"\r?\n"), lambda x: F.contains(x, F.lit(":")))
    names = F.transform(lines, lambda x: F.lower(F.trim(F.split_part(x, F.lit(":"), F.lit(1)))))
    distinct = F.array_distinct(names)
    last = F.transform(distinct, lambda k: F.element_at(F.filter(lines, lambda x: F.lower(F.trim(F.split_part(x, F.lit(":"), F.lit(1)))) == k), -1))
    return F.map_from_arrays(distinct, F.transform(last, lambda x: F.lower(F.trim(F.regexp_replace(x, r"^[^:]*:", "")))))


def access_tags(c: Column, lang: Column) -> Column:
    """Access tags, 'public' where none are set; English articles may be rendered as well."""
    own = F.when(c.isNull() | (F.size(c) == 0), F.array(F.lit("public"))).otherwise(c)
    return F.when((lang == "eng") & ~F.array_contains(own, "render"), F.array_append(own, F.lit("render"))).otherwise(own)
