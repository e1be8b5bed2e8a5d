"""Every query with SQL beside that SQL, all rows and types, on the smallest tables."""

import pytest

from stopgrid.llm.queries import ORACLES, QUERIES
from tests.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert compare(spark, connect(SF_DIR), QUERIES[name], ORACLES[name], SF_DIR) is None


def test_one_query_per_operator():
    assert sorted(int(n.removeprefix("op").split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_registered():
    import __spark_entry__ as entry

    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


def test_contract_columns(spark):
    expected = {
        "op1_simhash_near_dedup": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
        "op2_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
        "op3_bpe_round_trip": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
        "op11_context_mixing": {
            "doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint",
            "base_score": "double", "score": "double", "n_bytes": "bigint", "bits_per_byte": "double",
        },
        "op12_periodic_runs": {
            "doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint",
            "exponent_milli": "bigint", "runs_sha256": "string", "collapsed_sha256": "string",
        },
        "op13_lexical_search": {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"},
    }
    for name, columns in expected.items():
        assert dict(QUERIES[name](spark, SF_DIR).dtypes) == columns
