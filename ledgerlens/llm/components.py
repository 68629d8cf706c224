"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``(v, c)`` for every vertex of ``links (a long, b long)``: ``c`` is the
    smallest vertex it reaches. Alternating large and small stars; every round
    is written, so its lineage stays short, and hubs are joined rows that AQE
    can split. No link or component comes to the driver."""
    edges = stored(links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
                   .filter("hi <> lo").distinct(), "links")
    mark = _mark(edges)
    while True:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("w")).union(edges.select("lo", "hi"))
        low = stored(both.groupBy("u").agg(F.least(F.min("w"), F.first("u")).alias("m")), "low")
        large = both.join(low, "u").filter("w > u").select(F.col("w").alias("hi"), F.col("m").alias("lo")).distinct()
        large = stored(large.filter("hi <> lo"), "large")
        low = stored(large.groupBy("hi").agg(F.min("lo").alias("m")), "low")
        joined = large.join(low, "hi")
        small = joined.select(F.col("lo").alias("hi"), F.col("m").alias("lo")).union(joined.select("hi", "m"))
        edges = stored(small.filter("hi <> lo").distinct(), "small")
        found = _mark(edges)
        if found == mark:
            break
        mark = found
    own = edges.select(F.col("hi").alias("v"), F.col("lo").alias("c"))
    return own.union(edges.select("lo", "lo")).distinct()
