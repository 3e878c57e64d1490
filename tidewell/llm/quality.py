"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Statistics are taken in one narrow pass.  The class moments (count, sum, sum of products) are summed per task over every
labelled training row, so the driver sees a fixed number of numbers.  Scores are differences of Gaussian log densities,
with Mahalanobis distances by Cholesky factors that are computed once and shipped with the model.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import bounded_batches, doc_fold, stash, text_bytes

_TABLE_ALPHA = bytes(c for c in range(256) if not (65 <= c <= 90 or 97 <= c <= 122 or c >= 128))
_NOT_UPPER = bytes(c for c in range(256) if not 65 <= c <= 90)
_NOT_DIGIT = bytes(c for c in range(256) if not 48 <= c <= 57)
_NOT_STOP = bytes(c for c in range(256) if c not in b".,;:!?'\"-()")
_NOT_MARK = bytes(c for c in range(256) if c not in b"#%&*$@|^~<>{}[]=_+\\/`")

STATISTICS = (
    "words", "word_length", "distinct_words", "commonest_word", "repeated_next", "single_letters", "long_words", "upper", "digits",
    "stops", "marks", "marked_words", "letters", "words_a_line", "repeated_lines", "word_entropy", "short_lines", "length_spread",
)


def _share(part: float, whole: float) -> float:
    """Log odds of a share, drawn towards even ones by half a count."""
    return math.log((part + 0.5) / (whole - part + 0.5)) if whole >= part else math.log((part + 0.5) / 0.5)


def statistics(data: bytes) -> list[float]:
    """The transformed statistics of one whole text: logarithms of sizes, log odds of shares."""
    words = data.split()
    n, size = len(words), len(data)
    counts = Counter(words)
    lengths = [len(w) for w in words]
    total = sum(lengths)
    lines = [x for x in data.split(b"\n") if x.strip()]
    heads = sum(v * math.log(v) for v in counts.values() if v > 1)
    mean = total / n if n else 0.0
    spread = math.sqrt(sum((x - mean) ** 2 for x in lengths) / n) if n else 0.0
    marks = len(data.translate(None, _NOT_MARK))
    return [
        math.log1p(n),
        math.log1p(mean),
        _share(len(counts), n),
        _share(max(counts.values(), default=0), n),
        _share(sum(map(bytes.__eq__, words, words[1:])), max(n - 1, 0)),
        _share(lengths.count(1), n),
        _share(sum(x > 20 for x in lengths), n),
        _share(len(data.translate(None, _NOT_UPPER)), size),
        _share(len(data.translate(None, _NOT_DIGIT)), size),
        _share(len(data.translate(None, _NOT_STOP)), size),
        _share(marks, size),
        _share(sum(1 for w, c in counts.items() for _ in range(c) if len(w.translate(None, _NOT_MARK)) > 0) if marks else 0, n),
        _share(len(data.translate(None, _TABLE_ALPHA)), size),
        math.log1p(n / len(lines)) if lines else 0.0,
        _share(len(lines) - len(set(lines)), len(lines)),
        (math.log(n) - heads / n) / max(1.0, math.log(n)) if n else 0.0,
        _share(sum(x.count(b" ") < 4 for x in lines), len(lines)),
        math.log1p(spread),
    ]


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and log determinants of two Gaussians, and the log prior odds of class 1."""

    centre: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, np.ndarray]
    factors: tuple[np.ndarray, np.ndarray]
    log_dets: tuple[float, float]
    odds: float
    temper: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row."""
        z = (x - self.centre) / self.scale
        density = [-0.5 * (((z - m) @ f.T) ** 2).sum(axis=1) - 0.5 * d for m, f, d in zip(self.means, self.factors, self.log_dets, strict=True)]
        return 1.0 / (1.0 + np.exp(-np.clip(self.temper * (density[1] - density[0]) + self.odds, -500, 500)))


def discriminant(moments: dict[int, tuple[float, np.ndarray, np.ndarray]], pooled: float, ridge: float, temper: float) -> Discriminant | None:
    """The model of class moments (n, sum, sum of outer products); None without any row.

    A class covariance is shrunk towards the pooled one by ``pooled`` and then towards its mean variance by ``ridge``.
    A class of no rows takes the other's mean and the prior that half a row gives.
    """
    d = len(STATISTICS)
    n = {c: moments[c][0] if c in moments else 0.0 for c in (0, 1)}
    if not n[0] + n[1]:
        return None
    total = n[0] + n[1]
    centre = sum(moments[c][1] for c in moments) / total
    second = sum(moments[c][2] for c in moments) / total - np.outer(centre, centre)
    scale = np.sqrt(np.maximum(np.diag(second), 1e-8))
    means, scatters = {}, {}
    for c in (0, 1):
        mean = moments[c][1] / n[c] if n[c] else centre
        means[c] = (mean - centre) / scale
        scatters[c] = (moments[c][2] - n[c] * np.outer(mean, mean)) / np.outer(scale, scale) if n[c] else np.zeros((d, d))
    within = (scatters[0] + scatters[1]) / total
    factors, dets = {}, {}
    for c in (0, 1):
        own = scatters[c] / n[c] if n[c] else within
        cov = (1 - pooled) * own + pooled * within
        cov = (1 - ridge) * cov + ridge * max(np.trace(cov) / d, 1e-3) * np.eye(d)
        lower = np.linalg.cholesky((cov + cov.T) / 2)
        factors[c] = np.linalg.inv(lower)
        dets[c] = 2 * np.log(np.diag(lower)).sum()
    odds = math.log((n[1] + 0.5) / (n[0] + 0.5))
    return Discriminant(centre, scale, (means[0], means[1]), (factors[0], factors[1]), (dets[0], dets[1]), odds, temper)


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the packed statistics of every row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.array(statistics(x)).tobytes() for x in text_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["doc_id", "stats"])

    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(scan, "doc_id long, stats binary")


def fit(stats: DataFrame, labels: DataFrame, folds: int = 5, pooled: float = 0.5, ridge: float = 0.1, temper: float = 0.5) -> Discriminant | None:
    """Fit on the labelled rows whose crc32(doc_id as text) mod ``folds`` isn't 0.

    ``labels(doc_id, quality)``: null ids and labels are passed over; a doc_id with several labels counts with each.
    """
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("quality in (0, 1)").dropDuplicates()
    rows = stats.where(doc_fold("doc_id", folds) != 0).join(marks, "doc_id").select("quality", "stats")
    d = len(STATISTICS)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {c: [0.0, np.zeros(d), np.zeros((d, d))] for c in (0, 1)}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.frombuffer(b"".join(batch.column(1).to_pylist())).reshape(-1, d)
            y = batch.column(0).to_numpy(zero_copy_only=False)
            for c, h in held.items():
                own = x[y == c]
                h[0] += len(own)
                h[1] += own.sum(axis=0)
                h[2] += own.T @ own
        yield pa.RecordBatch.from_arrays(
            [pa.array([0, 1], pa.int32()), pa.array([np.concatenate([[h[0]], h[1], h[2].ravel()]).tolist() for h in held.values()], pa.list_(pa.float64()))],
            ["quality", "sums"],
        )

    parts = rows.mapInArrow(moments, "quality int, sums array<double>")
    width = 1 + d + d * d
    summed = (
        parts.select("quality", F.posexplode("sums"))
        .groupBy("quality", "pos")
        .agg(F.sum("col").alias("x"))
        .collect()  # 2 * width numbers
    )
    flat = {c: np.zeros(width) for c in (0, 1)}
    for r in summed:
        flat[r.quality][r.pos] = r.x
    return discriminant({c: (v[0], v[1 : 1 + d], v[1 + d :].reshape(d, d)) for c, v in flat.items() if v[0]}, pooled, ridge, temper)


def score_quality(docs: DataFrame, labels: DataFrame, folds: int = 5, threshold: float = 0.3) -> DataFrame:
    """Quality of every row of ``docs(doc_id, text, ...)``: doc_id, held_out, score, predicted.

    ``score`` is the probability of label 1 from the whole text alone; ``predicted`` is 1 from ``threshold`` on.  Null
    texts score as empty ones, a null doc_id is held out (its remainder is 0), repeated rows count each.  Without labelled
    training rows every score is 0.5.  An empty table gives an empty result.
    """
    stats = stash(document_statistics(docs), "quality-stats")
    model = fit(stats, labels, folds)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(1).to_pylist())).reshape(-1, len(STATISTICS))
            found = np.full(len(x), 0.5) if model is None else model.scores(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "score"])

    scored = stats.mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", (doc_fold("doc_id", folds) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, folds: int = 5, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text scores at least ``threshold``; a narrow pass after the fit."""
    model = fit(stash(document_statistics(docs), "quality-stats"), labels, folds)
    if model is None:
        return docs
    names = docs.columns
    at = names.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.array([statistics(t) for t in text_bytes(batch.column(at))])
                yield batch.filter(pa.array(model.scores(x) >= threshold))

    return docs.mapInArrow(keep, docs.schema)
