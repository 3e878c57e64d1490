import math

import numpy as np
import pytest

from tidewell.llm import neighbours as nb
from tidewell.llm import queries

VECTORS = "vec_id long, embedding array<float>, label int, score string, query_id int, rank string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "s", 1, "r") for i, v in rows], VECTORS)


def brute_force(rows, asked, k=5):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v is not None and None not in v and all(map(math.isfinite, v)) and any(v)]
    out = []
    for q, x in good:
        if q in asked:
            near = sorted(((-float(nb.exact_cosines(y[None], x)[0]), j) for j, y in good if j != q), key=lambda t: (t[0], t[1]))[:k]
            out += [(q, r + 1, j, -s) for r, (s, j) in enumerate(near)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_small_tables_are_answered_in_full(spark):
    rows = [
        (0, [1.0, 0.0, 0.0]), (50, [0.5, 0.5, 0.0]), (1, [1.0, 0.1, 0.0]), (2, [2.0, 0.2, 0.0]), (3, [2.0, 0.2, 0.0]), (4, [-1.0, 0.0, 1e-30]), (5, None), (6, [0.0, 0.0, 0.0]),
        (7, [1.0, None, 0.0]), (8, [float("nan"), 1.0, 1.0]), (9, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (10, [1.0]), (11, []), (12, [3e38, 3e38, 0.0]), (100, None),
    ]
    df = frame(spark, rows)
    got = rows_of(nb.search(df, df.where("vec_id % 50 = 0")))
    want = brute_force([r for r in rows if r[1] is None or len(r[1]) == 3], {0, 50, 100})
    assert [r[:3] for r in got] == [r[:3] for r in want] and np.allclose([r[3] for r in got], [r[3] for r in want], rtol=1e-12)


def test_vectors_of_each_length_are_searched_among_their_own(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(2 + i % 3).tolist()) for i in range(160)]
    df = frame(spark, rows).repartition(3)
    got = rows_of(nb.search(df, df.where("vec_id % 20 = 0"), recall=1.0))
    want = [r for n in (2, 3, 4) for r in brute_force([x for x in rows if len(x[1]) == n], set(range(0, 160, 20)))]
    assert [r[:2] for r in got] == [r[:2] for r in sorted(want)] and len({r[0:3:2] for r in got} & {r[0:3:2] for r in want}) >= 0.9 * len(want)


def test_fewer_candidates_than_asked_and_nothing_at_all(spark):
    df = frame(spark, [(0, [1.0, 0.0]), (1, [1.0, 1.0])])
    assert [r[:3] for r in rows_of(nb.search(df, df.where("vec_id = 0")))] == [(0, 1, 1)]
    none = frame(spark, [])
    assert nb.search(df, none).collect() == [] and nb.search(none, df).collect() == [] and nb.search(none, none).collect() == []


def test_ties_and_copies(spark):
    rows = [(i, [0.3, 0.7, -0.2, 0.1]) for i in range(200)] + [(1000 + i, np.random.default_rng(i).standard_normal(4).tolist()) for i in range(100)]
    df = frame(spark, rows)
    got = rows_of(nb.search(df, df.where("vec_id in (0, 50)")))
    assert [r[2] for r in got] == [1, 2, 3, 4, 5, 0, 1, 2, 3, 4]


@pytest.mark.parametrize("clustered", [True, False])
def test_recall(spark, clustered):
    rng = np.random.default_rng(7)
    x = rng.standard_normal((1500, 24))
    if clustered:
        x = x[:100].repeat(15, axis=0) + 0.3 * rng.standard_normal((1500, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = frame(spark, rows)
    got = rows_of(nb.search(df.repartition(5), df.where("vec_id % 20 = 0")))
    want = brute_force(rows, set(range(0, 1500, 20)))
    true = {r[0:3:2] for r in want}
    assert len(got) == len(want) and len(true & {r[0:3:2] for r in got}) >= 0.93 * len(true)


def test_query_blocks_do_not_matter(spark, monkeypatch):
    df = frame(spark, [(i, v.tolist()) for i, v in enumerate(np.random.default_rng(1).standard_normal((300, 8)))])
    once = rows_of(nb.search(df, df.where("vec_id % 20 = 0"), recall=1.0))
    monkeypatch.setattr(nb, "QUERY_BLOCK", 4)
    assert [r[:2] for r in rows_of(nb.search(df, df.where("vec_id % 20 = 0"), recall=1.0))] == [r[:2] for r in once]


def test_candidate_number_holds_for_later_blocks(spark, monkeypatch):
    rng = np.random.default_rng(5)
    dense = rng.standard_normal((40, 32)).repeat(10, axis=0) + 0.02 * rng.standard_normal((400, 32))
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([dense, rng.standard_normal((1600, 32))]))]
    monkeypatch.setattr(nb, "QUERY_BLOCK", 20)  # the first block lies in the dense part
    df = frame(spark, rows).coalesce(1)
    got = rows_of(nb.search(df, df.where("vec_id % 20 = 0")))
    loose = {r[0:3:2] for r in brute_force(rows, set(range(400, 2000, 20)))}
    assert len(loose & {r[0:3:2] for r in got}) >= 0.93 * len(loose)


def test_recall_of_the_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    want = brute_force(rows, {i for i, _ in rows if i % 50 == 0})
    got = rows_of(queries.op10_neighbours(spark, folder))
    assert len(got) == len(want) and len({r[0:3:2] for r in want} & {r[0:3:2] for r in got}) >= 0.9 * len(want)


def test_forest_ranges_are_prefix_matches():
    rng = np.random.default_rng(2)
    unit = rng.standard_normal((400, 6))
    planes = nb.Planes(6, 3, 10, 1)
    forest, asked = nb.Forest(planes, unit), planes.strings(rng.standard_normal((20, 6)))
    counts = forest.counts(asked)
    for depth in range(11):
        low, high = forest.ranges(asked, depth)
        for t in range(3):
            for q in range(20):
                same = set(np.flatnonzero((forest.strings[t] >> (10 - depth)) == (asked[t, q] >> (10 - depth))))
                assert set(forest.order[t, low[t, q] : high[t, q]]) == same
        assert (counts[:, depth] == (high - low).sum(axis=0)).all()
