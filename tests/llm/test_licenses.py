import textwrap

import pytest

from tests.llm.helpers import docs
from tests.oracle import assert_same
from tidewell.llm import licenses, queries


def test_query_equals_its_twin(spark, data):
    assert assert_same(queries.op9_licenses(spark, data), queries.ORACLE_SQL["op9_licenses"], data) > 0


(MIT_NOTICE,) = (t for n, t in licenses.TEMPLATES if n == "MIT" and t.startswith("Permission"))


def brute_force(text, threshold=0.8):
    lines = [x for x in (text or "").translate(str.maketrans(licenses.UPPER, licenses.LOWER)).split("\n") if x]
    units = lines + ["\n".join((text or "").translate(str.maketrans(licenses.UPPER, licenses.LOWER)).split("\n"))] if len(lines) > 1 else lines
    found = []
    for u in units:
        a = set(licenses.template_bigrams(u))
        near = []
        for name, t in licenses.TEMPLATES:
            b = set(licenses.template_bigrams(t))
            if a and 2 * len(a & b) / (len(a) + len(b)) >= threshold:
                near.append((-2 * len(a & b) / (len(a) + len(b)), name))
        found += [min(near)] if near else []
    best = min(found, default=(None, None))
    return len(units), best[1], None if best[0] is None else -best[0], ",".join(sorted({n for _, n in found}))


def test_texts(spark):
    full = MIT_NOTICE
    texts = [
        None, "", "\n\n", "x", "Released under the MIT license!", "code\nreleased under THE mit license\nmore code", "Licensed under CC BY 4.0.", "Licensed under CC BY-NC 4.0",
        full, full.replace(", ", ",\n"), full[:300], "This work is licensed under the GNU General Public Licence, version 3", "the the the the the the", "Released under the MIT License.\nLicensed under CC BY-NC 4.0.",
        "Released under the MIT License. " * 500,
    ]
    got = {r.doc_id: tuple(r)[1:] for r in licenses.scan_licenses(docs(spark, list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        want = brute_force(t)
        assert got[i][0] == want[0] and got[i][1] == want[1] and got[i][3] == want[3], (i, got[i], want)
        assert got[i][2] == pytest.approx(want[2]) if want[2] is not None else got[i][2] is None
    assert got[4][1] == "MIT" and got[6][1] is None and got[13][3] == "CC-BY-NC-4.0,MIT"


def test_awkward_and_empty_tables_and_the_plan(spark):
    df = licenses.scan_licenses(docs(spark))
    assert df.count() == 15 and licenses.scan_licenses(docs(spark, [])).collect() == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Join" not in plan
    with pytest.raises(ValueError, match="two words"):
        licenses.scan_licenses(docs(spark), [("X", "word")])


def test_bounds_let_every_match_pass():
    for n in range(1, 200):
        low, high = licenses.size_bounds(n, 0.8)
        for m in range(1, 300):
            assert (low <= m <= high) == (2 * min(n, m) >= 0.8 * (n + m) - 1e-9)


def test_notices_between_other_text(spark):
    code = "\n".join(f"value_{i} = compute(argument_{i}, other_{i})  # step {i}" for i in range(30))
    wrapped = "\n".join("# " + x for x in textwrap.wrap(MIT_NOTICE, 76))
    mit = "MIT License\n\nCopyright (c) 2020 Somebody Else\n\n" + textwrap.fill(MIT_NOTICE, 78) + (
        "\n\nThe above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY.\n'
    )
    inside = "All the files in this folder and below it are ours. Licensed under the Apache License, Version 2.0. Other text comes after it, as everywhere."
    loose = textwrap.fill(MIT_NOTICE.replace("to any person", "to really any one person or company"), 70)
    bsd = {n: "Copyright (c) 2021, Somebody\n\n" + textwrap.fill(t, 70) + "\n\n" + code for n, t in licenses.FULL_TEXTS}
    texts = [wrapped + "\n" + code, code + "\n" + wrapped, mit, inside, f"{loose}\n \n{code}", *bsd.values(), code, "no word of the license, version 2.0, under the terms of it\n" + code]
    got = {r.doc_id: r for r in licenses.scan_licenses(docs(spark, list(enumerate(texts)))).collect()}
    assert [got[i].license for i in range(len(texts))] == ["MIT", "MIT", "MIT", "Apache-2.0", "MIT", *bsd, None, None]
    assert [got[i].dice for i in (0, 1, 2, 3)] == [1.0] * 4 and 0.8 <= got[4].dice < 1 and {got[i].dice for i in range(5, 5 + len(bsd))} == {1.0}
    assert got[0].n_units == len(texts[0].split("\n")) + 1  # lines and the whole text, as before
    assert got[3].licenses == "Apache-2.0" and got[5 + len(bsd)].licenses == ""


def test_licences_that_differ_in_a_word_are_told_apart(spark):
    notices = [(n, t) for n, t in licenses.TEMPLATES if "free software" in t]
    assert len(notices) == 5
    code = "\n".join(f"value_{i} = compute(argument_{i}, other_{i})  # step {i}" for i in range(30))
    texts = [t for _, t in notices] + [f"{code}\n# " + "\n# ".join(textwrap.wrap(t, 70)) + "\n" + code for _, t in notices] + ["x\n" + textwrap.fill(t, 60) + "\n" + code for _, t in licenses.FULL_TEXTS]
    got = {r.doc_id: r for r in licenses.scan_licenses(docs(spark, list(enumerate(texts)))).collect()}
    names = [n for n, _ in notices] * 2 + [n for n, _ in licenses.FULL_TEXTS]
    assert [got[i].license for i in range(len(texts))] == names
    assert [got[i].licenses for i in range(10)] == names[:10]
