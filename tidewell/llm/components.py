"""Connected components of an edge table by alternating large and small stars, in rounds over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import stash


def _lowest(edges: DataFrame) -> DataFrame:
    """Each vertex's smallest neighbour, itself included; summed before the shuffle, so a hub is a row per task."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def connected_components(edges: DataFrame, a: str, b: str, files: int | None = None) -> DataFrame:
    """(vertex, component) for every vertex of ``edges``: component is the smallest vertex that it reaches.

    Loops, repeats and rows with nulls don't matter; no edges give no rows.  The number of rounds grows with the logarithm
    of the vertices.  Every round is written to the shared scratch folder, in ``files`` files about.
    """
    x, y = F.col(a), F.col(b)
    pairs = stash(edges.where(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(), "cc-edges", files=files)
    state = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_lowest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # now u > v: a small star hangs a vertex and its smaller neighbours below the smallest of these
        low = _lowest(large)
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        pairs = stash(small.select("e.u", "e.v").where("u <> v").distinct(), "cc-round", files=files)
        seen = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    return pairs.select(F.col("u").alias("vertex"), F.col("v").alias("component")).unionByName(
        pairs.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
    )
