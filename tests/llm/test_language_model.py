import math
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from tests.llm.helpers import docs
from tidewell.llm import language_model as lm

END = b"\n"


def brute_force(rows):
    """The same model by plain counting and an EM over single tokens."""
    texts = [(i, (t or "").encode().lower().split() + [END]) for i, t in rows]
    fold = [crc32(("" if i is None else str(i)).encode()) % 10 for i, _ in rows]
    uni, pair = {p: Counter() for p in (1, 2)}, {p: Counter() for p in (1, 2)}
    for (_, words), f in zip(texts, fold, strict=True):
        if f:
            p = 1 if f == 1 else 2
            uni[p].update(words)
            pair[p].update(zip([END, *words], words, strict=False))
    all_uni, all_pair = uni[1] + uni[2], pair[1] + pair[2]
    n, v = sum(all_uni.values()), len(all_uni)
    n2, uniform = sum(uni[2].values()), 1 / (v + 1)
    bucket = lambda c: 0 if c == 0 else int(math.floor(math.log2(c))) + 1
    held = [(bucket(uni[2][a]), h, pair[2][a, b] / uni[2][a] if uni[2][a] else 0.0, uni[2][b] / n2 if n2 else 0.0) for (a, b), h in pair[1].items()]
    w = {b: np.array([1 / 3] * 3) for b in range(64)}
    w[0] = np.array([0, 0.5, 0.5])
    for _ in range(60):
        for b in {x[0] for x in held}:
            share, total = np.zeros(3), 0.0
            for _, h, p2, p1 in (x for x in held if x[0] == b):
                part = w[b] * np.array([p2, p1, uniform])
                share, total = share + h * part / part.sum(), total + h
            new = np.maximum(share / total, 1e-6)
            new[0] = 0 if b == 0 else new[0]
            w[b] = new / new.sum()
    seen = sorted({x[0] for x in held} - {0})
    for b in range(1, 64):
        if b not in seen and seen:
            w[b] = w[max((s for s in seen if s < b), default=seen[0])]
    out = []
    for (i, words), f in zip(texts, fold, strict=True):
        base = sum(math.log10((all_uni[t] + 0.1) / (n + 0.1 * (v + 1))) for t in words)
        score = 0.0
        for a, b in zip([END, *words], words, strict=False):
            c = all_uni[a]
            score += math.log10(w[bucket(c)] @ np.array([all_pair[a, b] / c if c else 0.0, all_uni[b] / max(n, 1), uniform]))
        out.append((i, f == 0, len(words), sum(all_uni[t] > 0 for t in words), n, base, score))
    return out


def same(got, want):
    key = lambda r: (repr(r[0]), r[2], r[5])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)
    assert np.allclose([r[6] for r in got], [r[6] for r in want], rtol=1e-6)


def test_scores_against_brute_force(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(40)]
    p = 1 / np.arange(1, 41)
    rows = [(i, " ".join(rng.choice(vocabulary, int(rng.integers(0, 30)), p=p / p.sum()))) for i in range(200)]
    same(lm.score_documents(docs(spark, rows)).collect(), brute_force(rows))


def test_awkward_rows(spark):
    from tests.llm.helpers import AWKWARD

    same(lm.score_documents(docs(spark)).collect(), brute_force(AWKWARD))


def test_many_chunks_and_buckets_give_the_same(spark, monkeypatch):
    rows = [(i, f"a b c{i % 7} d{i % 3} the end") for i in range(120)]
    once = sorted(map(tuple, lm.score_documents(docs(spark, rows)).collect()))
    monkeypatch.setattr(lm, "BUCKET_ENTRIES", 40)
    many = sorted(map(tuple, lm.score_documents(docs(spark, rows).repartition(7)).collect()))
    assert [r[:5] for r in once] == [r[:5] for r in many] and np.allclose([r[5:] for r in once], [r[5:] for r in many])


def test_rounds_over_a_table_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.5, int(rng.integers(0, 30))) % 50)) for i in range(150)]
    monkeypatch.setattr(lm, "EM_ROWS", 5)
    monkeypatch.setattr(lm, "TASK_ENTRIES", 300)
    same(lm.score_documents(docs(spark, rows)).collect(), brute_force(rows))


def test_empty_table_and_no_deleted_part(spark):
    assert lm.score_documents(docs(spark, [])).collect() == []
    rows = [(i, "x y") for i in range(50) if crc32(str(i).encode()) % 10 != 1]
    assert len(lm.score_documents(docs(spark, rows)).collect()) == len(rows)


def test_em_finds_the_mixture():
    rng = np.random.default_rng(0)
    p = np.array([0.5, 0.02, 0.001])
    kind = rng.choice(3, 20000, p=[0.6, 0.3, 0.1])
    bigram, unigram = np.where(kind == 0, p[0], 0.0), np.where(kind == 1, p[1], 1e-9)
    w = lm.expectation_maximisation(np.full(20000, 4), np.ones(20000), bigram, unigram, 1e-6)
    assert w[4] == pytest.approx([0.6, 0.3, 0.1], abs=0.02) and (w[9] == w[4]).all() and w.sum(axis=1) == pytest.approx(1)
