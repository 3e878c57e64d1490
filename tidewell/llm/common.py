"""Helpers that the training-data operators share: byte-level tokenising and 64-bit hashing in numpy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.scratch import scratch_path, stash  # noqa: F401  operators take them from here

#: Bytes of text that a Python worker holds tokenised at once.
SLICE_BYTES = 8 << 20

_U = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, limit: str = "8m") -> None:
    """Bound the Arrow batches by which texts go to Python, where the session has Spark's default: buffers of this size
    are native memory, several for each task, that executors keep."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == "67108864b":
        spark.conf.set(key, limit)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each value, null as empty."""
    return pc.fill_null(column.cast(pa.binary()), b"").to_pylist()


def slices(lengths: list[int], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges whose lengths sum to about ``limit``; a longer value is a range of its own."""
    start, held = 0, 0
    for i, n in enumerate(lengths):
        if held and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(lengths):
        yield start, len(lengths)


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    """:func:`slices` of a column of texts, with their UTF-8 bytes (null as empty); only one slice's are held."""
    data = pc.fill_null(column.cast(pa.binary()), b"")
    for lo, hi in slices(pc.binary_length(data).to_pylist(), limit):
        yield lo, hi, data.slice(lo, hi - lo).to_pylist()


def lowered_words(data: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; the whitespace of ``bytes.split`` is exactly that class."""
    return data.lower().split()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64 (constants: splitmix64)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def doc_fold(doc_id: str, modulus: int):
    """crc32 of the id's text modulo ``modulus``; a null id counts as empty text (remainder 0)."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def running_sums(cells: DataFrame, order: Sequence[Column], amount: str) -> DataFrame:
    """``cells`` with ``before``: the sum of ``amount`` over all cells that come earlier in ``order``, which has no ties.

    Two steps, so no task holds all cells: sums within ranges of the order, then over the ranges, of which there are as
    many as the range partitioner makes.
    """
    parts = max(1, cells.sparkSession.sparkContext.defaultParallelism)
    ranged = stash(cells.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    sums = {r[0]: r[1] for r in ranged.groupBy("_range").agg(F.sum(amount)).collect()}
    base, at = {}, 0
    for k in sorted(sums):
        base[k], at = at, at + sums[k]
    start = F.element_at(F.create_map(*[F.lit(x) for k, v in base.items() for x in (k, v)]), F.col("_range")) if base else F.lit(0)
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return ranged.withColumn("before", start + F.coalesce(F.sum(amount).over(within), F.lit(0))).drop("_range")
