"""Every training-data query has SQL or a brute-force test that is named here."""

import pytest

import __spark_entry__ as entry_mod
from lagframe.llm import queries
from tests.oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"
BRUTE_FORCE = {
    "op1_packing": "test_operators.test_packing_places_every_id_once",
    "op2_topk": "test_operators.test_top_k_matches_brute_force",
    "op4_language_id": "test_langid.test_predictions_equal_a_plain_model",
    "op5_warc": "test_operators.test_warc_round_trip",
    "op6_quality_rules": "test_operators.test_quality_counts_match_brute_force",
    "op7_chat": "test_operators.test_chat_repair_is_least_cost_and_legal",
    "op8_minhash": "test_near_duplicates.test_every_link_of_a_whole_table_is_found",
    "op9_token_files": "test_operators.test_token_files_round_trip",
    "op10_mixing": "test_operators.test_mixing_reaches_its_targets",
    "op12_periodic_runs": "test_periodic_runs.test_query_equals_all_periods_on_whole_table",
    "op13_best_fit": "test_best_fit.test_packs_all_awkward_rows",
}


def test_every_query_has_sql_or_a_brute_force_test():
    assert set(queries.QUERIES) == set(queries.ORACLES) | set(BRUTE_FORCE)
    assert set(queries.QUERIES) <= set(entry_mod.queries()) and "pipeline" in entry_mod.queries()
    for place in BRUTE_FORCE.values():
        module, name = place.split(".")
        assert hasattr(__import__(f"tests.llm.{module}", fromlist=[name]), name), place


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    r = compare(spark, name, queries.QUERIES[name], queries.ORACLES[name], SF, duck(SF))
    assert r["ok"], r
