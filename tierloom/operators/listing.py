"""Files offered by listing pages, and how they compare with the files already landed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.functions.columns import source_name
from tierloom.functions.urls import base_name, hrefs, resolve


def discover_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Distinct (file_name, file_url) of all anchors that do not point to a directory."""
    found = pages.select(F.col(url).alias("page"), F.explode(hrefs(html)).alias("href"))
    named = found.filter(~F.col("href").endswith("/")).withColumn("file_name", base_name("href"))
    return (
        named.filter(F.col("file_name") != "")
        .select("file_name", resolve("page", "href").alias("file_url"))
        .distinct()
    )


def reconcile(landed: DataFrame, listed: DataFrame, landed_name: str, listed_name: str) -> DataFrame:
    """(name, status) per source file: present on both sides, stale (no longer listed) or missing (not landed).

    Landed names lose only their extraction stamp before the comparison. Nothing is deleted.
    """
    ours = landed.select(source_name(landed_name).alias("name"), F.lit(1).alias("ours"), F.lit(0).alias("theirs"))
    theirs = listed.select(F.col(listed_name).alias("name"), F.lit(0).alias("ours"), F.lit(1).alias("theirs"))
    sides = ours.unionByName(theirs).groupBy("name").agg(F.max("ours").alias("o"), F.max("theirs").alias("t"))
    status = F.when(F.col("t") == 0, "stale").when(F.col("o") == 0, "missing").otherwise("present")
    return sides.select("name", status.alias("status"))
