import pytest

from tests.oracle import assert_same
from tidewell.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_twin(spark, name):
    folder = "/root/testdata/sf0.01"
    assert assert_same(queries.QUERIES[name](spark, folder), queries.ORACLE_SQL[name], folder) > 0


#: Columns that a contract names for each query.
CONTRACTS = {
    "op1_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op2_lm_scores": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op3_near_duplicates": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op4_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op5_decontamination": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    "op6_warc": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op7_token_counts": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op8_mix_sources": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op10_neighbours": "query_id bigint, rank int, vec_id bigint, score double",
}


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_results_have_the_columns_asked_for(spark, data, name):
    held = dict(queries.QUERIES[name](spark, data).dtypes)
    for column in CONTRACTS[name].split(", "):
        c, kind = column.split(" ")
        assert held[c] == kind
