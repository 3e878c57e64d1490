"""Approximate nearest neighbours by a hash-prefix forest.

Every run of rows (an Arrow batch) gets a forest of its own: per tree, random hyperplanes give each vector a long bit
string, and the strings are kept as a sorted array.  A query descends to the rows that share the longest prefix with it,
which is a range of the sorted array, and ascends in all trees at once to shorter prefixes until it has enough
candidates.  How deep each query ends up is decided over all runs together, so a result doesn't depend on how rows are
dealt; candidates are then scored exactly.

How many candidates are enough is measured, not guessed: over a bounded sample of queries, drawn by hash from all of them, with exact neighbours,
the number is chosen so that their neighbours are found at least at the wanted rate.

Queries go to the workers in blocks of a fixed size; rows stay where they are read and nothing is joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Queries in one broadcast block.
QUERY_BLOCK = 16_384
#: Rows of one forest.
FOREST_ROWS = 16_384
#: Queries, at most, that the candidate number is fitted on.
SAMPLE = 256


class Planes:
    """The forest's hyperplanes: ``trees`` times ``bits`` normals, from a seed."""

    def __init__(self, dims: int, trees: int, bits: int, seed: int) -> None:
        self.dims, self.trees, self.bits = dims, trees, bits
        self.normals = np.random.default_rng(seed).standard_normal((dims, trees * bits))
        self.weights = np.int64(1) << np.arange(bits - 1, -1, -1, dtype=np.int64)

    def strings(self, unit: np.ndarray) -> np.ndarray:
        """Bit strings as integers, the first bit highest: trees x rows."""
        above = (unit @ self.normals > 0).reshape(len(unit), self.trees, self.bits)
        return np.ascontiguousarray((above @ self.weights).T)


class Forest:
    """Sorted hash strings of some rows, by tree."""

    def __init__(self, planes: Planes, unit: np.ndarray) -> None:
        self.planes, self.strings = planes, planes.strings(unit)
        self.order = np.argsort(self.strings, axis=1, kind="stable")
        self.sorted = np.take_along_axis(self.strings, self.order, axis=1)

    def ranges(self, strings: np.ndarray, depth: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
        """Ends of the ranges that share a prefix of ``depth`` bits (one for all, or by query): trees x queries each."""
        shift = self.planes.bits - np.asarray(depth, np.int64)
        low = (strings >> shift) << shift
        high = low + (np.int64(1) << shift)
        ends = [(np.searchsorted(a, x), np.searchsorted(a, y)) for a, x, y in zip(self.sorted, np.broadcast_to(low, strings.shape), high, strict=True)]
        return np.stack([e[0] for e in ends]), np.stack([e[1] for e in ends])

    def counts(self, strings: np.ndarray) -> np.ndarray:
        """Matches over all trees by prefix length 0..bits: queries x (bits + 1)."""
        out = np.zeros((strings.shape[1], self.planes.bits + 1), np.int64)
        for depth in range(self.planes.bits + 1):
            low, high = self.ranges(strings, depth)
            out[:, depth] = (high - low).sum(axis=0)
            if not out[:, depth].any():
                break
        return out


def _vectors(column: pa.Array, ids: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors in double precision that take part."""
    lists = column.to_pylist()
    names = ids.to_pylist()
    good = [i for i, v in enumerate(lists) if v is not None and len(v) == dims and names[i] is not None and None not in v]
    x = np.array([lists[i] for i in good], np.float64).reshape(len(good), dims)
    keep = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
    return np.array([names[i] for i in good], np.int64)[keep], x[keep]


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two (so nothing is rounded) that keep squares from overflowing or vanishing."""
    return x / np.exp2(np.frexp(np.abs(x).max(axis=-1, keepdims=True))[1] - 1.0)


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def exact_cosines(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosines of rows with one vector, each computed in the same order, so equal rows have equal values."""
    x, q = _scaled(x), _scaled(q)
    return (x * q).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((q * q).sum()))


def _best(ids: np.ndarray, x: np.ndarray, unit: np.ndarray, q: np.ndarray, q_unit: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest of ``rows``: a quick product finds who may be among them, exact cosines decide."""
    rough = unit[rows] @ q_unit
    if len(rows) > k:
        least = np.partition(rough, len(rows) - k)[len(rows) - k] - 1e-9
        rows = rows[rough >= least]
    found = exact_cosines(x[rows], q)
    order = np.lexsort((ids[rows], -found))[:k]
    return ids[rows[order]], found[order]


def _runs(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, FOREST_ROWS):
            part = batch.slice(at, FOREST_ROWS)
            ids, x = _vectors(part.column(1), part.column(0), dims)
            if len(ids):
                yield ids, x


FOUND = "query_id long, query_row long, vec_id long, score double"


def _batch(columns: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


RESULT = "query_id long, rank int, vec_id long, score double"


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 5, trees: int = 32, bits: int = 24, recall: float = 0.98, seed: int = 29
) -> DataFrame:
    """The ``k`` nearest rows of ``vectors(vec_id, embedding, ...)`` to each row of ``queries`` (alike), by cosine.

    Returns query_id, rank (from 1), vec_id, score (the cosine of the original vectors in double precision), nearest
    first, ties to the smaller vec_id.  A row is no candidate for queries of its own vec_id.  Rows with a null id, or with
    a vector that is null, zero or holds null or non-finite components take no part.  A cosine is of vectors of one length:
    queries of each length that occurs have a search of their own among the vectors of that length.  Queries that repeat an id are each answered; candidates that repeat an id are each one.  Without vectors or
    queries the result is empty.  Every query has at least ``k`` candidates, or all
    there are: it ascends until then, in the end to prefixes of no bits.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    asked = queries.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id is not null")
    usable = asked.where("exists(embedding, x -> x <> 0) and not exists(embedding, x -> x is null)")
    lengths = sorted(r[0] for r in usable.select(F.size("embedding")).distinct().collect())
    of = lambda df, n: df.where(F.size("embedding") == n)
    found = [_search_of(of(rows, n), of(asked, n), Planes(n, trees, bits, seed), k, recall, seed) for n in lengths]
    return reduce(DataFrame.unionAll, found, spark.createDataFrame([], RESULT))


def _search_of(rows: DataFrame, asked: DataFrame, planes: Planes, k: int, recall: float, seed: int) -> DataFrame:
    """:func:`search` of vectors of one length."""
    spark = rows.sparkSession
    context = spark.sparkContext
    dims, trees, bits = planes.dims, planes.trees, planes.bits

    def blocks() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        names, held = [], []
        for r in asked.toLocalIterator():
            names.append(r[0])
            held.append(r[1])
            if len(held) == QUERY_BLOCK:
                yield _vectors(pa.array(held, pa.list_(pa.float64())), pa.array(names), dims)
                names, held = [], []
        if held:
            yield _vectors(pa.array(held, pa.list_(pa.float64())), pa.array(names), dims)

    def depth_counts(names: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Matches of each query by prefix length, over all runs, without rows of its own vec_id."""
        sent = context.broadcast((names, planes.strings(_unit(q))))

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for ids, x in _runs(batches, dims):
                names, strings = sent.value
                forest = Forest(planes, _unit(x))
                found = forest.counts(strings)
                by_name = np.argsort(names, kind="stable")
                for j in np.flatnonzero(np.isin(ids, names)):
                    for i in by_name[np.searchsorted(names[by_name], ids[j]) : np.searchsorted(names[by_name], ids[j], side="right")]:
                        for v in (forest.strings[:, j] ^ strings[:, i]).tolist():
                            found[i, : bits - v.bit_length() + 1] -= 1
                total = found if total is None else total + found
            if total is not None:
                yield _batch([np.arange(len(total)), list(total)], ["q", "counts"])

        parts = rows.mapInArrow(count, "q long, counts array<long>").select("q", *[F.col("counts")[d].alias(f"c{d}") for d in range(bits + 1)])
        out = np.zeros((len(q), bits + 1), np.int64)
        for r in parts.groupBy("q").agg(*[F.sum(f"c{d}") for d in range(bits + 1)]).collect():  # a row for each query of the block
            out[r[0]] = r[1:]
        return out

    def nearest(names: np.ndarray, q: np.ndarray, depth: np.ndarray) -> DataFrame:
        """Each run's k nearest candidates of every query; depth 0 is all rows."""
        sent = context.broadcast((names, q, _unit(q), planes.strings(_unit(q)), depth))

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for ids, x in _runs(batches, dims):
                names, q, q_unit, strings, depth = sent.value
                unit = _unit(x)
                forest = Forest(planes, unit)
                low, high = forest.ranges(strings, depth)
                out: list[list[np.ndarray]] = [[], [], [], []]
                for i in range(len(names)):
                    mask = np.zeros(len(ids), bool)
                    for t in range(trees):
                        mask[forest.order[t, low[t, i] : high[t, i]]] = True
                    mask &= ids != names[i]
                    near, cosine = _best(ids, x, unit, q[i], q_unit[i], np.flatnonzero(mask), k)
                    for column, values in zip(out, (np.full(len(near), names[i]), np.full(len(near), i), near, cosine), strict=True):
                        column.append(values)
                yield _batch([np.concatenate(c) for c in out], [c.split()[0] for c in FOUND.split(", ")])

        return rows.mapInArrow(score, FOUND)

    def top(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id", "query_row").orderBy(F.col("score").desc(), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    def enough(names: np.ndarray, q: np.ndarray) -> int:
        """Candidates, counted over all trees, at which the sample finds its true neighbours at the wanted rate."""
        if not len(q):
            return k
        exact = top(nearest(names, q, np.zeros(len(q), np.int64))).select("query_row", "vec_id").collect()  # at most SAMPLE * k rows
        ids = {r[1] for r in exact}
        held = {r[0]: r[1] for r in rows.where(F.col("vec_id").isin(*ids)).collect()} if ids else {}
        counts, strings = depth_counts(names, q), planes.strings(_unit(q))
        need = []
        for i, name in exact:
            other = planes.strings(_unit(np.array([held[name]], np.float64)))[:, 0] ^ strings[:, i]
            shared = int(max(bits - int(v).bit_length() for v in other))
            need.append(int(counts[i, shared + 1]) + 1 if shared < bits else 1)
        return int(np.quantile(need, recall, method="higher")) if need else k

    def sample() -> tuple[np.ndarray, np.ndarray]:
        """At most SAMPLE queries that take part, by hash over all blocks."""
        used = (F.size("embedding") == dims) & F.expr("exists(embedding, x -> x <> 0)") & F.expr("forall(embedding, x -> x is not null and abs(x) < double('infinity'))")
        drawn = asked.where(used).orderBy(F.xxhash64("vec_id", "embedding", F.lit(seed)), "vec_id").limit(SAMPLE).collect()
        return _vectors(pa.array([r[1] for r in drawn], pa.list_(pa.float64())), pa.array([r[0] for r in drawn], pa.int64()), dims)

    parts, wanted = [], enough(*sample())
    for names, q in blocks():
        if not len(names):
            continue
        reached = depth_counts(names, q) >= max(wanted, trees * k)  # a row counts at most once a tree: at least k rows
        depth = np.where(reached.any(axis=1), bits - np.argmax(reached[:, ::-1], axis=1), 0)
        parts.append(nearest(names, q, depth))
    if not parts:
        return spark.createDataFrame([], RESULT)
    found = top(reduce(DataFrame.unionAll, parts))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
