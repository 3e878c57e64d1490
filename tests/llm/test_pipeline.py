import corpus_pipeline as cp
from tests.llm.helpers import docs
from tests.llm.test_decontaminate import brute_force as contaminated
from tests.llm.test_near_duplicates import brute_force as classes
from tidewell.llm import mixing, quality


def test_stages_against_brute_force(spark, data):
    table = spark.read.parquet(f"{data}/documents.parquet")
    labels = spark.read.parquet(f"{data}/labels.parquet")
    names = table.columns
    at = {}
    for name, stage in cp.STAGES:
        before, table = table, stage(spark, table, data)
        path = f"{spark.conf.get('spark.checkpoint.dir')}/pipeline-test-{name}"
        table.write.mode("overwrite").parquet(path)
        table = spark.read.parquet(path)
        at[name] = (before, table)
        assert name == "sharding" or table.columns == names
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    before, after = at["quality"]
    good = quality.score_quality(before, labels).where("score >= 0.3")
    assert ids(after) == ids(good) and len(ids(after)) < before.count()
    before, after = at["near_duplicates"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert ids(after) == sorted({c if n else d for d, n, c in classes(rows)}) and len(ids(after)) < len(rows)
    before, after = at["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert ids(after) == sorted(r[0] for r in contaminated(rows, items) if not r[2])  # no row with a hit stays
    before, after = at["mixing"]
    copies = {r.doc_id: int(r.taken / r.size + 0.5) if r.size else 0 for r in mixing.mix_sources(before).collect()}
    assert ids(after) == sorted(d for d, n in copies.items() for _ in range(n))
    before, after = at["sharding"]
    assert ids(after) == ids(before)


def test_run_gives_the_rows_of_the_stages(spark, data):
    got = cp.run(spark, data)
    assert got.count() > 0 and {r.shard for r in got.collect()} <= set(range(16))


def test_stages_take_awkward_rows(spark, data):
    table = docs(spark)
    for _, stage in cp.STAGES:
        stage(spark, table, data).collect()
        stage(spark, docs(spark, []), data).collect()
