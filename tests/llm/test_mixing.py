import random

import pytest

from tests.llm.helpers import AWKWARD, docs
from tidewell.llm import mixing


def test_sainte_lague_against_highest_quotients():
    rng = random.Random(0)
    for _ in range(200):
        shares = [rng.choice((0, rng.random() * 10, rng.randint(1, 5))) for _ in range(rng.randint(1, 8))]
        seats = rng.randint(0, 60)
        limits = [rng.randint(0, 40) for _ in shares] if rng.random() < 0.5 else None
        held = [0] * len(shares)
        for _ in range(seats):
            open_ = [i for i, s in enumerate(shares) if s > 0 and (limits is None or held[i] < limits[i])]
            if not open_:
                break
            held[max(open_, key=lambda i: (shares[i] / (2 * held[i] + 1), -i))] += 1
        assert mixing.sainte_lague(shares, seats, limits) == held
    assert sum(mixing.sainte_lague([3.0, 1.0, 2.5], 10**9)) == 10**9


def test_water_filling():
    got = mixing.water_filled([100, 10, 1000], [1, 2, 3], 3)
    assert got[1] == 30 and sum(got) == pytest.approx(1110) and got[0] == pytest.approx(270) and got[2] == pytest.approx(810)
    assert mixing.water_filled([0, 0], [1, 2], 3) == [0.0, 0.0] and mixing.water_filled([], [], 3) == []


def test_awkward_rows(spark):
    got = mixing.mix_sources(docs(spark)).collect()
    assert len(got) == 15
    words = lambda t: len((t or "").encode().split())
    assert sorted(r.size for r in got) == sorted(words(t) for _, t in AWKWARD)
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    by = {r.source: r for r in got}
    sizes = {s: sum(r.size for r in got if r.source == s) for s in by}
    want = dict(zip(["a", None], mixing.water_filled([sizes["a"], sizes[None]], [1, 2], 3), strict=True))
    for s, r in by.items():
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert abs(sum(x.taken for x in got if x.source == s) - r.target) <= 8
    assert mixing.mix_sources(docs(spark, [])).collect() == [] and mixing.mixed_documents(docs(spark, [])).count() == 0


def test_sources_come_near_their_targets_and_reruns_agree(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(0, 80), rng.choice(["x", "x", "x", "B", "Ａ", "\U0001f600", None, "b"])) for i in range(3000)]
    table = docs(spark, rows)
    got = mixing.mix_sources(table, rows_per_shard=200).collect()
    again = mixing.mix_sources(table.repartition(5), rows_per_shard=200).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)
    taken, target = {}, {}
    for r in got:
        assert r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    # code points, null last: B b x A (full width) emoji null with weights 1 2 3 1 2 3
    assert all(abs(taken[s] - target[s]) <= 0.01 * target[s] for s in target)
    assert target["b"] == pytest.approx(2 * target["B"]) or target["b"] == pytest.approx(3 * sum(r.size for r in got if r.source == "b"))
    copies = mixing.mixed_documents(table, rows_per_shard=200).groupBy("doc_id").count().collect()
    want = {r.doc_id: int(r.taken / r.size + 0.5) for r in got if r.size and r.taken / r.size >= 0.5}
    assert {r.doc_id: r["count"] for r in copies} == want


def test_blocks_are_whole_when_one_source_is_alone(spark):
    got = mixing.mix_sources(docs(spark, [(i, "a b c", "s") for i in range(10)])).collect()
    assert abs(sum(r.taken for r in got) - 30) <= 4 and {r.target for r in got} == {30.0}  # half a block


def test_long_documents_are_drawn_at_their_rate(spark):
    # shards hold some ten rows, one long: its run is a quarter of the words, so less than half of the long row
    rows = [(i, "w " * (2000 if i % 10 == 0 else 20), "hot") for i in range(3000)] + [(i, "w " * 60, s) for i in range(3000, 9000) for s in [f"z{i % 5}"]]
    table = docs(spark, rows)
    got = [r for r in mixing.mix_sources(table, rows_per_shard=30).collect() if r.source == "hot"]
    rate = sum(r.taken for r in got) / sum(r.size for r in got)
    assert 0.1 < rate < 0.5
    kept = [r.doc_id for r in mixing.drawn_documents(table, rows_per_shard=30).where("source = 'hot'").select("doc_id").collect()]
    words = sum(2000 if i % 10 == 0 else 20 for i in kept)
    assert abs(sum(i % 10 == 0 for i in kept) - 300 * rate) <= 0.25 * 300 * rate and abs(words - rate * sum(r.size for r in got)) <= 0.25 * rate * sum(r.size for r in got)


def test_thin_sources_reach_their_targets(spark):
    # 40 sources whose targets are less than half a block a shard
    rows = [(i, "a b c", f"s{i % 40:02}") for i in range(6000)]
    taken, target = {}, {}
    for r in mixing.mix_sources(docs(spark, rows), rows_per_shard=20).collect():
        taken[r.source], target[r.source] = taken.get(r.source, 0) + r.taken, r.target
    assert len(target) == 40 and all(abs(taken[s] - target[s]) <= 8 for s in target)


def test_sources_kept_as_a_table_get_the_same(spark, monkeypatch):
    rng = random.Random(11)
    names = [f"s{i}" for i in range(60)] + ["Ａ", "\U0001f600", "ü", None]
    rows = [(i, "w " * rng.choice([0, 1, 7, 30]), names[int(len(names) * rng.random() ** 3)]) for i in range(4000)]
    once = sorted(map(tuple, mixing.mix_sources(docs(spark, rows), rows_per_shard=100).collect()), key=repr)
    monkeypatch.setattr(mixing, "MAX_SOURCES", 10)
    table = sorted(map(tuple, mixing.mix_sources(docs(spark, rows), rows_per_shard=100).collect()), key=repr)
    assert [r[:4] for r in table] == [r[:4] for r in once] and [r[4] for r in table] == pytest.approx([r[4] for r in once])
    taken = lambda got: {s: sum(r[5] for r in got if r[1] == s) for s in {r[1] for r in got}}
    assert taken(table) == taken(once)


@pytest.mark.parametrize(("n_sources", "per_source"), [(3000, 20), (100, 3)])
def test_every_source_is_within_a_block_of_its_target(spark, n_sources, per_source):
    rows = [(i, "a b c d e f g h i j", f"s{i % n_sources:05}") for i in range(n_sources * per_source)] + [(10**6 + i, "rare", "zz") for i in range(80)]
    got = mixing.mix_sources(docs(spark, rows)).groupBy("source", "target", "source_size").sum("taken").collect()
    want = mixing.water_filled([10 * per_source] * n_sources + [80], [1 + i % 3 for i in range(n_sources + 1)], 3)
    assert sorted(r.target for r in got) == pytest.approx(sorted(want))
    assert all(abs(r["sum(taken)"] - r.target) <= 8 for r in got)
