import hashlib
import random
import re
from collections import Counter

from tests.llm.helpers import docs
from tidewell.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute_force(rows, items, window=13):
    words = lambda t: WORD.findall((t or "").translate(LOWER))
    out = []
    for d, text in rows:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            i = words(t)
            for k in range(max(1, len(i) - window + 1) if i else 0):
                p = i[k : k + window]
                for s in range(len(w) - len(p) + 1):
                    if w[s : s + len(p)] == p:
                        hit |= set(range(s, s + len(p)))
                        found.add("null" if item is None else item)
        sha = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def proximity(rows, items, window=13, slack=dc.SLACK):
    """Ids of items that match by proximity, for each row in order."""
    words = lambda t: WORD.findall((t or "").translate(LOWER))
    texts = [words(t) for _, t in rows]
    often = Counter(w for t in texts for w in t)
    out = [set() for _ in rows]
    for item, t in items:
        i = words(t)
        for k in range(max(1, len(i) - window + 1) if i else 0):
            p = i[k : k + window]
            if any(not often[w] for w in p):
                continue
            rarest, reach = min(p, key=lambda w: often[w]), len(p) + slack - 1
            for found, text in zip(out, texts, strict=True):
                for at in (x for x, w in enumerate(text) if w == rarest):
                    if set(p) <= set(text[max(0, at - reach) : at + reach + 1]):
                        found.add(item)
    return out


def rows_of(df):
    return sorted((tuple(r)[:6] for r in df.collect()), key=repr)


def made(seed):
    rng = random.Random(seed)
    words = ["Ab", "c", "été", "x1", "日本", "q", "zz"]
    text = lambda n: rng.choice(" ,\n").join(rng.choice(words) for _ in range(n))
    items = [(i % 9, text(rng.randint(0, 20))) for i in range(20)] + [(3, None), (5, "--"), (None, text(16))]
    rows = []
    for i in range(60):
        t = text(rng.randint(0, 40))
        if rng.random() < 0.6:
            t += " " + (rng.choice(items)[1] or "").upper().replace("É", "é") + " " + text(rng.randint(0, 300))
        rows.append((i, t))
    return rows, items


def test_contamination_against_brute_force(spark, monkeypatch):
    for seed, part, size in ((1, dc.BLOCK_WINDOWS, dc.SLICE), (2, 20, 700)):  # many small blocks and slices must not matter
        monkeypatch.setattr(dc, "BLOCK_WINDOWS", part)
        monkeypatch.setattr(dc, "SLICE", size)
        rows, items = made(seed)
        tests = spark.createDataFrame(items, "item_id long, text string")
        want = brute_force(rows, items)
        assert rows_of(dc.contamination(docs(spark, rows).repartition(3), tests)) == want
        clean = {r.doc_id for r in dc.clean_documents(docs(spark, rows), tests).collect()}
        assert clean == {r[0] for r in want if not r[5]} and any(r[5] for r in want)
        whole = {r.doc_id for r in dc.clean_documents(docs(spark, rows), tests, share=None).collect()}
        assert whole == {r[0] for r in want if not r[2]} and whole < clean  # short passages, too


def test_awkward_rows(spark):
    from tests.llm.helpers import AWKWARD

    items = [(1, "The quick, brown"), (2, ""), (3, None), (4, "one"), (4, "one"), (10, "äpfel"), (11, "word " * 20)]
    tests = spark.createDataFrame(items, "item_id long, text string")
    assert rows_of(dc.contamination(docs(spark), tests)) == brute_force(AWKWARD, items)
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in dc.contamination(docs(spark), none).collect()} == {0}
    assert dc.contamination(docs(spark, []), tests).collect() == []
    assert dc.clean_documents(docs(spark), tests).columns == docs(spark).columns


def test_proximity(spark):
    tests = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    rows = [(1, "alpha x beta y gamma"), (2, "gamma beta alpha"), (3, "alpha " + "x " * 9 + "beta gamma"), (4, "alpha beta"), (5, "gamma"), (6, "Alpha, Beta; gamma!")]
    got = {r.doc_id: (r["items"], r.near) for r in dc.find_matches(docs(spark, rows).coalesce(1), tests, slack=2).collect()}
    assert got == {1: ([], [1]), 2: ([], [1]), 3: ([], []), 4: ([], []), 5: ([], []), 6: ([1], [1])}


def test_proximity_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(dc, "SLICE", 900)
    for seed in (4, 5):
        rows, items = made(seed)
        rng = random.Random(seed)
        rows = [(i, " ".join(w for w in re.split("[ ,\n]", t) for w in ([w, f"n{rng.randint(0, 30)}"] if rng.random() < 0.3 else [w]))) for i, t in rows]
        tests = spark.createDataFrame(items, "item_id long, text string")
        got = {r.doc_id: set(r.near) for r in dc.find_matches(docs(spark, rows), tests).collect()}
        want = dict(zip([i for i, _ in rows], proximity(rows, items), strict=True))
        assert got == want and 0 < sum(map(bool, want.values()))
