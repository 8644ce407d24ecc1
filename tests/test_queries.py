"""Registered queries against their SQL.

A cross-section runs by default; set ALL_QUERIES=1 for every query, SF_DIR for other data.
"""

import os

import oracle
import pytest

import __spark_entry__ as entry_module

QUERIES, SQL = entry_module.queries(), entry_module.oracle_sql()
DEFAULT = """title_normalize title_variants token_dedup genre_split date_cascade best_rating
route_rows route_rows_adaptive long_union year_cluster group_provenance unify_by_signature
merge_sources superscore_adaptive superscore_capped end_to_end outlier_cap validate_report
validate_schema rating_stats rating_histogram source_coverage match_summary root_cause_fn
paired_compare stage_loss""".split()
CHOSEN = list(QUERIES) if os.environ.get("ALL_QUERIES") else DEFAULT


@pytest.fixture(scope="module")
def tables(sf_dir):
    return oracle.connect(os.environ.get("SF_DIR", sf_dir))


@pytest.mark.parametrize("name", CHOSEN)
def test_query(spark, tables, sf_dir, name):
    df = QUERIES[name](spark, os.environ.get("SF_DIR", sf_dir))
    if name in SQL:
        assert oracle.differences(df, tables, SQL[name]) == []
    else:
        assert df.count() > 0


@pytest.mark.parametrize("name", ["lost_examples_all", "mismatch_examples_all", "delta_histogram_all", "canonicalize_columns_all",
    "reject_rows_all"])
def test_examples_of_all_sources_and_fields(spark, tables, sf_dir, name):
    df = QUERIES[name](spark, os.environ.get("SF_DIR", sf_dir))
    assert oracle.differences(df, tables, SQL[name]) == []


@pytest.mark.parametrize("name", ["ambiguous_films_both", "films_without_column", "entity_key_printed",
    "year_fallback"])
def test_cases_that_the_sources_lack(spark, tables, sf_dir, name):
    df = QUERIES[name](spark, os.environ.get("SF_DIR", sf_dir))
    assert df.count() > 0 and oracle.differences(df, tables, SQL[name]) == []


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
