"""Every query with SQL gives what another engine gives."""

import pytest
from helpers import connection, have_data, same

from kindred.plans.registry import ORACLE_SQL, QUERIES

QUICK = ["norm_name", "norm_leet", "norm_dba", "addr_numbers", "key_name_dba_alias", "block_cap", "pair_provenance", "topk_candidates", "candidate_pairs_wide", "feat_all_labelled", "f05_macro", "blocking_metrics", "threshold_sweep", "roc_auc", "average_precision", "feature_audit", "split_md5", "loss_attribution", "false_negatives", "validate_violations"]


@pytest.mark.skipif(not have_data(), reason="no test tables")
@pytest.mark.parametrize("name", QUICK)
def test_query(spark, sf, name):
    same(QUERIES[name](spark, sf), connection(sf), ORACLE_SQL[name])


def test_all_queries_are_named_once():
    assert set(ORACLE_SQL) <= set(QUERIES) and len(QUERIES) > 75


@pytest.mark.skipif(not have_data(), reason="no test tables")
def test_result_does_not_depend_on_partitioning(spark, sf):
    before = sorted(map(tuple, QUERIES["topk_candidates"](spark, sf).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert sorted(map(tuple, QUERIES["topk_candidates"](spark, sf).collect())) == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
