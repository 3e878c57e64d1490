import random
from zlib import crc32

import pytest

from tests.llm.helpers import AWKWARD, docs
from tidewell.llm import shards


def check(rows, n_shards=16):
    text = {i: [] for i in range(n_shards)}
    for r in rows:
        text[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in text.values())


def test_awkward_rows(spark):
    got = shards.pack_shards(docs(spark)).collect()
    check(got)
    want = sorted(((d, len((t or "").encode()) + 1, crc32((t or "").encode())) for d, t in AWKWARD), key=repr)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=repr) == want
    assert len({r.shard for r in got if r.text_crc32 == crc32(b"one")}) == 1 and {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    assert shards.pack_shards(docs(spark, [])).collect() == []


def test_sizes_are_near_equal_and_groups_stay_together(spark):
    rng = random.Random(2)
    texts = ["x" * rng.randint(1, 300) + str(i) for i in range(1500)] + ["same"] * 700
    got = shards.pack_shards(docs(spark, list(enumerate(texts))), rows_per_cell=50).collect()
    check(got)
    sizes = [sum(r.size for r in got if r.shard == s) for s in range(16)]
    assert max(sizes) - min(sizes) <= 10
    where = {}
    for r in got:
        where.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert all(len(s) == 1 for s in where.values())


def test_a_group_above_the_fair_share_has_its_own_shard(spark):
    got = shards.pack_shards(docs(spark, [(i, "hot text") for i in range(100)] + [(100 + i, f"t{i}") for i in range(60)])).collect()
    hot = {r.shard for r in got if r.doc_id < 100}
    assert len(hot) == 1 and not {r.shard for r in got if r.doc_id >= 100} & hot


def sizes_by_shard(got):
    out = {}
    for r in got:
        out[r.shard] = out.get(r.shard, 0) + r.size
    return out


def grouped(rows):
    out = {}
    for d, t in rows:
        out[t or ""] = out.get(t or "", 0) + len((t or "").encode()) + 1
    return out


def test_the_query_equals_packing_every_group_by_a_plain_search(spark):
    """All groups are large ones here, so shard sizes must be those of best fit decreasing over all of them."""
    rng = random.Random(9)
    rows = [(i, rng.choice("abc") * rng.randint(0, 400)) for i in range(400)] + [(None, "x"), (7, "x"), (7, "x"), (8, None)]
    got = shards.pack_shards(docs(spark, rows).repartition(3)).collect()
    check(got)
    items = sorted(grouped(rows).values(), reverse=True)
    plain = [0] * 16
    left = sum(items)
    own = 0
    while items[own] * (16 - own) > left:
        plain[own], left, own = items[own], left - items[own], own + 1
    share = -(-left // (16 - own))
    for size in items[own:]:
        fit = [(share - plain[b], b) for b in range(own, 16) if share - plain[b] >= size]
        b = min(fit)[1] if fit else max((share - plain[b], b) for b in range(own, 16))[1]
        plain[b] += size
    assert sorted(sizes_by_shard(got).values()) == sorted(x for x in plain if x)


@pytest.mark.parametrize("capacity", [None, 4000, 600])
def test_small_groups_are_packed_one_by_one(spark, capacity):
    rng = random.Random(5)
    rows = [(i, f"{i} " + "é" * rng.randint(0, 40)) for i in range(4000)] + [(4000 + i, "same") for i in range(300)] + [(5000, "z" * 3000)]
    got = shards.pack_shards(docs(spark, rows).repartition(5), shards=None if capacity else 16, capacity=capacity, head_per_shard=1, rows_per_cell=40).collect()
    check(got, 1 + max(r.shard for r in got))
    text = dict(rows)
    where = {}
    for r in got:
        where.setdefault(text[r.doc_id], set()).add(r.shard)
    assert len(got) == len(rows) and all(len(s) == 1 for s in where.values())
    sizes, groups = sizes_by_shard(got), grouped(rows)
    if capacity:
        large = {s for t, (s,) in ((t, tuple(s)) for t, s in where.items()) if groups[t] > capacity}
        assert all(v <= capacity for s, v in sizes.items() if s not in large)
        plain = shards.best_fit_decreasing(groups.items(), capacity=capacity)
        assert len(sizes) <= len(set(plain.values())) + 1
    else:
        rest = [v for s, v in sizes.items() if s not in {next(iter(where["z" * 3000])), next(iter(where["same"]))}]
        assert len(sizes) == 16 and max(rest) - min(rest) <= 2 * 90


def test_best_fit_decreasing_against_a_plain_search():
    rng = random.Random(4)
    for _ in range(50):
        items = [(f"i{k}", rng.randint(1, 60)) for k in range(rng.randint(0, 80))]
        left, plain = [], {}
        for name, size in sorted(items, key=lambda x: (-x[1], x[0])):
            fit = [(c, b) for b, c in enumerate(left) if c >= size]
            if fit:
                b = min(fit)[1]
            else:
                b = len(left)
                left.append(max(60, size))
            left[b] -= size
            plain[name] = b
        assert shards.best_fit_decreasing(items, capacity=60) == plain
    with pytest.raises(ValueError, match="capacity"):
        shards.best_fit_decreasing([("a", 1)])


def test_capacity_tree_against_a_list():
    rng = random.Random(1)
    tree, held = shards.CapacityTree(), set()
    for _ in range(3000):
        if held and rng.random() < 0.45:
            key = rng.choice(sorted(held))
            tree.remove(key)
            held.remove(key)
        else:
            key = (rng.randint(0, 500), rng.randint(0, 10**6))
            if key not in held:
                tree.add(key)
                held.add(key)
        size = rng.randint(0, 600)
        assert tree.tightest(size) == min((k for k in held if k[0] >= size), default=None)
        if held:
            assert tree.roomiest() == max(held)
