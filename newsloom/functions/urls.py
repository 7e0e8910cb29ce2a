"""URL functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Suffixes of media files that are never pages. Fixed values.
MEDIA = [
    "asx", "dts", "gxf", "m2v", "m3u", "m4v", "mpeg1", "mpeg2", "mts", "mxf", "ogm", "pls", "bup", "a52", "aac", "b4s", "cue",
    "divx", "dv", "flv", "m1v", "m2ts", "mkv", "mov", "mpeg4", "oma", "spx", "ts", "vlc", "mp4", "mp3", "zip",
]


def authority(c: Column) -> Column:
    """Host with user and port, of http and https URLs without blanks; null for others."""
    a = F.try_parse_url(c, F.lit("AUTHORITY"))
    return F.when(F.lower(c).rlike("^https?://") & ~F.contains(c, F.lit(" ")) & (F.length(a) >= 5), a)


def host_part(c: Column) -> Column:
    """The third piece between slashes, empty where there is none."""
    return F.split_part(F.concat(c, F.lit("/-/-/")), F.lit("/"), F.lit(3))


def is_media(c: Column) -> Column:
    return F.lower(c).rlike(r"\.(" + "|".join(MEDIA) + ")$")


def acceptable(c: Column, trust: Column) -> Column:
    """A web URL of some length, not an mp3, from a feed trusted below 3."""
    return (F.lower(F.left(c, F.lit(4))) == "http") & (F.lower(F.right(c, F.lit(4))) != ".mp3") & (trust < 3) & (F.length(c) <= 4095)


def percent_decode(c: Column) -> Column:
    """Escapes decoded, plus signs kept; the URL itself where an escape is malformed."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def rewritten(c: Column, pattern: Column, decode: Column) -> Column:
    """The first group of a feed's pattern at the URL's start, else the URL; decoded where the feed asks."""
    got = F.call_function("regexp_extract", c, F.concat(F.lit("^(?:"), pattern, F.lit(")")), F.lit(1))
    out = F.when(pattern.isNotNull() & (got != ""), got).otherwise(c)
    return F.when(decode, percent_decode(out)).otherwise(out)


def percent_encode(c: Column) -> Column:
    return F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))
