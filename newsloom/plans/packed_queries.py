"""Queries on values packed in one field."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsloom.operators.packed import split_packed
from newsloom.runtime import table


def _geo(spark, d, brackets=False):
    meta = table(spark, d, "feed_article_meta").where("geo is not null").select("id", "geo").distinct()
    return split_packed(meta, F.col("id"), F.col("geo"), "geo", pairs=True, brackets=brackets)


def _tags(spark, d, brackets=False):
    return split_packed(table(spark, d, "site").select("id", "tags").distinct(), F.col("id"), F.col("tags"), "site_tags", brackets=brackets)


def p7_found(spark, d):
    return _geo(spark, d).unionByName(_tags(spark, d)).select("field", "row_id", "pos", "val")


def p7_method(spark, d):
    """All three alternatives of the grammar over the whole tables, bracketed values too, with the error flags."""
    return _geo(spark, d, True).unionByName(_tags(spark, d, True))


def p7_flags(spark, d):
    """How many values of each field were read with each flag."""
    return _geo(spark, d).unionByName(_tags(spark, d)).groupBy("field", "flag").agg(F.count("*").alias("values"))


QUERIES = {f.__name__: f for f in (p7_method, p7_found, p7_flags)}
ORACLE: dict[str, str] = {}
