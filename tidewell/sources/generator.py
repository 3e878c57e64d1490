"""A seeded mix of inserts, updates and deletes, as a change log; for tests and load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def change_mix(spark: SparkSession, rows: int, keys: int, seed: int = 1, inserts: float = 0.6, updates: float = 0.2, first_offset: int = 0) -> DataFrame:
    """``rows`` changes (offset, id, op, amount, note) over ``keys`` existing keys; inserts take keys of their own.

    The same arguments give the same rows, whatever the partitioning.
    """
    draw = lambda salt: F.pmod(F.xxhash64("offset", F.lit(seed), F.lit(salt)), F.lit(1_000_000)) / F.lit(1_000_000.0)
    kind = draw("kind")
    op = F.when(kind < inserts, "c").when(kind < inserts + updates, "u").otherwise("d")
    old = F.pmod(F.xxhash64("offset", F.lit(seed), F.lit("key")), F.lit(max(keys, 1)))
    base = spark.range(first_offset, first_offset + rows).withColumnRenamed("id", "offset").withColumn("op", op)
    return base.select(
        "offset",
        F.when(F.col("op") == "c", F.col("offset") + F.lit(keys)).otherwise(old).alias("id"),
        "op",
        F.round(draw("amount") * 1000, 2).alias("amount"),
        F.concat(F.lit("n"), F.col("offset").cast("string")).alias("note"),
    )
