import random

import numpy as np
import pytest

from tests.llm.helpers import AWKWARD, docs
from tidewell.llm import near_duplicates as nd
from tidewell.llm.components import connected_components


def sets_of(rows):
    out = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        out.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def brute_force(rows):
    sets = sets_of(rows)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, len(sets[i]), low.get(find(i))) for i, (d, _) in enumerate(rows)), key=repr)


def got(df):
    return sorted((tuple(r) for r in nd.components(df).collect()), key=repr)


def variants(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows, at = [], 0
    for _ in range(n):
        base = [rng.choice(words) for _ in range(rng.randint(1, 120))]
        for _ in range(rng.choice((1, 1, 2, 6, 30))):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            if rng.random() < 0.3:
                copy += [rng.choice(words) for _ in range(rng.randint(1, 30))]
            rows.append((at, " ".join(copy) if rng.random() < 0.8 else " ".join(copy).upper()))
            at += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_against_brute_force(spark, seed):
    rows = variants(40, seed)
    assert got(docs(spark, rows)) == brute_force(rows)


def test_buckets_partitions_and_tile_sizes_do_not_matter(spark, monkeypatch):
    rows = variants(30, 5)
    monkeypatch.setattr(nd, "BUCKET_ENTRIES", 300)
    monkeypatch.setattr(nd, "SMALL_TILE", 2)
    monkeypatch.setattr(nd, "SIEVE_BITS", (3, 5))  # nearly all texts pass
    monkeypatch.setattr(nd, "PAIRS", 50)
    assert got(docs(spark, rows).repartition(6)) == brute_force(rows)


def test_awkward_rows(spark):
    assert got(docs(spark)) == brute_force(AWKWARD)
    kept = nd.one_of_each_class(docs(spark))
    assert kept.columns == docs(spark).columns
    assert sorted((r.doc_id is None, r.doc_id or 0, (r.text or "")[:9]) for r in kept.collect()) == sorted(
        [(False, 1, "The quick"), (False, 4, ""), (False, 5, ""), (False, 6, " \t\n "), (False, 7, "one"), (False, 9, "two words"), (True, 0, ""), (False, 10, "word word"), (False, 11, "a" * 9), (False, 12, "completel")]
    )


def test_empty_table(spark):
    assert got(docs(spark, [])) == [] and nd.one_of_each_class(docs(spark, [])).count() == 0


def test_thresholds_are_exact(spark):
    words = [f"t{i}" for i in range(200)]
    base = words[:94]  # 90 shingles
    # k new words at the end: 90 of 90 + k shingles are common; links while 90 >= 0.8 (90 + k)
    rows = [(0, " ".join(base))] + [(k, " ".join(base + words[100 : 100 + k])) for k in (22, 23)]
    assert got(docs(spark, rows[:2])) == [(0, 90, 0), (22, 112, 0)]
    assert got(docs(spark, [rows[0], rows[2]])) == [(0, 90, 0), (23, 113, 23)]


def test_bounds_are_upper_bounds():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 2000, int(n)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for n in rng.integers(1, 600, 60)]
    n = np.array([len(s) for s in sets])
    signs = [np.frombuffer(nd.bitmap(s), np.uint64)[None] for s in sets]
    for i in range(60):
        for j in range(60):
            bound = nd.overlap_bounds(signs[i], n[i : i + 1], signs[j], n[j : j + 1])[0]
            assert bound >= len(np.intersect1d(sets[i], sets[j]))


def test_prefix_length_is_exact():
    for n in range(1, 500):
        assert nd.prefix_length(n) == n - -(-8 * n // 10) + 1


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 100), (201, 200), (202, 200), (203, 202), (203, 201), (None, 5)]
    got = {r.vertex: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**dict.fromkeys(range(1, 41), 1), 200: 200, 201: 200, 202: 200, 203: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0
