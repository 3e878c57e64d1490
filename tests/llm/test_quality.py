import math
from zlib import crc32

import numpy as np
import pytest

from tests.llm.helpers import docs
from tidewell.llm import queries, quality


def brute_force(x, y, fresh, pooled=0.5, ridge=0.1, temper=0.5):
    """Log-density differences by plain inverses and determinants."""
    mu, sd = x.mean(axis=0), x.std(axis=0)
    sd = np.sqrt(np.maximum(sd**2, 1e-8))
    z, f = (x - mu) / sd, (fresh - mu) / sd
    d = z.shape[1]
    scatter = {c: np.cov(z[y == c].T, bias=True) for c in (0, 1)}
    within = sum(scatter[c] * (y == c).sum() for c in (0, 1)) / len(y)
    log_density = {}
    for c in (0, 1):
        cov = (1 - pooled) * scatter[c] + pooled * within
        cov = (1 - ridge) * cov + ridge * np.trace(cov) / d * np.eye(d)
        diff = f - z[y == c].mean(axis=0)
        log_density[c] = -0.5 * np.einsum("ij,jk,ik->i", diff, np.linalg.inv(cov), diff) - 0.5 * np.linalg.slogdet(cov)[1]
    odds = math.log(((y == 1).sum() + 0.5) / ((y == 0).sum() + 0.5))
    return 1 / (1 + np.exp(-np.clip(temper * (log_density[1] - log_density[0]) + odds, -500, 500)))


def test_scores_are_those_of_the_formula(spark):
    rng = np.random.default_rng(1)
    words = ["w%d" % i for i in range(50)]
    rows, marks = [], []
    for i in range(300):
        good = i % 3 > 0
        text = " ".join(rng.choice(words, 30)) + "." if good else "x " * int(rng.integers(5, 40)) + "###" * int(rng.integers(1, 5))
        rows.append((i, text))
        marks.append((i, int(good)))
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.score_quality(docs(spark, rows), labels).collect()}
    fold = {i: crc32(str(i).encode()) % 5 for i, _ in rows}
    x = np.array([quality.statistics(t.encode()) for _, t in rows])
    y = np.array([q for _, q in marks])
    train = np.array([fold[i] != 0 for i, _ in rows])
    want = brute_force(x[train], y[train], x)
    assert np.allclose([got[i].score for i, _ in rows], want, rtol=1e-6, atol=1e-12)
    assert all(got[i].held_out == (fold[i] == 0) and got[i].predicted == int(got[i].score >= 0.3) for i, _ in rows)
    held = [i for i, _ in rows if fold[i] == 0]
    assert all(got[i].predicted == marks[i][1] for i in held)
    kept = {r.doc_id for r in quality.good_documents(docs(spark, rows), labels).collect()}
    assert kept == {i for i, _ in rows if got[i].score >= 0.3}


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 1), (10, 0), (12, 1), (12, 1), (99, 0)], "doc_id long, quality int")
    got = quality.score_quality(docs(spark), labels).collect()
    assert len(got) == 15 and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in got if r.doc_id in (4, 5)} == {got[3].score}
    assert quality.good_documents(docs(spark), labels).columns == docs(spark).columns


@pytest.mark.parametrize("marks", [[], [(1, 1)], [(12, 0)]])
def test_missing_classes(spark, marks):
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    got = quality.score_quality(docs(spark), labels).collect()
    assert len(got) == 15 and all(0 <= r.score <= 1 for r in got)


def test_empty_table(spark):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert quality.score_quality(docs(spark, []), labels).collect() == []


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.QUERIES["op1_quality"](spark, folder)
    held = got.where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    assert held.count() > 30 and held.where("predicted = quality").count() >= 0.97 * held.count()
