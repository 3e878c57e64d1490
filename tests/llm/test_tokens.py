import random

import pytest

from tests.llm.helpers import AWKWARD, docs
from tidewell.llm import queries, tokens

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def path():
    return queries.tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library(path):
    return sentencepiece.SentencePieceProcessor(model_file=path)


def counted(model, text):
    parts, extra = model.pretokens(text)
    return int(model.count(parts).sum()) + extra


def test_counts_equal_the_library(path, library):
    model = tokens.piece_model(path)
    rng = random.Random(0)
    pool = ["the", " ", "  ", "\n", "é", "漢", "😀", "ing", "\t", "=", "01", "▁", "ß", "!!", "<s>", "</s>", "<0x0A>", "\x00", "　", "aaaa", "ﬁ"]
    cases = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    cases += [" " * n for n in range(150)] + [" " * n + "word" for n in range(60)] + ["ab" * n for n in range(60)]
    cases += ["".join(chr(rng.choice((rng.randint(1, 127), rng.randint(128, 0x2FFF), rng.randint(0x1F300, 0x1F6FF)))) for _ in range(30)) for _ in range(1000)]
    assert [c for c in cases if counted(model, c) != len(library.encode(c))] == []


def test_awkward_rows(spark, path, library):
    want = sorted(((d, len((t or "").encode()), len(library.encode(t or "")), len(library.encode(t or "")) > 4096) for d, t in AWKWARD), key=repr)
    assert sorted((tuple(r) for r in tokens.over_limit(docs(spark), path).collect()), key=repr) == want
    assert tokens.over_limit(docs(spark, []), path).collect() == []


def test_a_small_memo_and_small_batches_do_not_matter(spark, path, library, data, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO", 50)
    monkeypatch.setattr(tokens, "BATCH_CHARS", 400)
    table = spark.read.parquet(f"{data}/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in tokens.count_tokens(table, path).collect()}
    assert got == {r.doc_id: len(library.encode(r.text)) for r in table.collect()}
