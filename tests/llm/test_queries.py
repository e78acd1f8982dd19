"""Registered queries against their SQL, and the shapes the contracts fix."""

import pytest

from divtide.llm.registry import ORACLES, QUERIES
from tests.compare import assert_same, connect

SF_DIR = "/root/testdata/sf0.001"
CONTRACTS = {
    "op1": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op2": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op4": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op5": {
        "doc_id": "bigint",
        "held_out": "boolean",
        "n_tokens": "bigint",
        "n_known": "bigint",
        "train_tokens": "bigint",
        "base_score": "double",
        "score": "double",
    },
    "op9": {
        **{c: "bigint" for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")},
        "base_failed": "boolean",
        "kept": "boolean",
    },
    "op11": {
        "doc_id": "bigint",
        "n_chars": "bigint",
        **{c: "string" for c in ("edited_sha256", "fingerprint", "edited_fingerprint")},
        **{c: "double" for c in ("near_edited", "near_next")},
    },
    "op12": {
        "vec_id": "bigint",
        "cluster": "int",
        **{c: "bigint" for c in ("distance", "cluster_inertia", "inertia")},
        "centroid_sha256": "string",
    },
    "op13": {
        **{c: "bigint" for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")},
        "groups_sha256": "string",
    },
    "op10": {c: "bigint" for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")},
}


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    result = QUERIES[name](spark, SF_DIR)
    assert_same(result, connect(SF_DIR), ORACLES[name])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_shape(spark, name):
    result = QUERIES[name](spark, SF_DIR)
    types = dict(result.dtypes)
    for column, kind in CONTRACTS.get(name.split("_")[0], {}).items():
        assert types[column] == kind
    assert result.count() > 0


@pytest.mark.parametrize("name", ["op2_external_shuffle", "op9_rule_ledger"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for operator in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan
