"""Every catalog query against DuckDB."""

import compare
import oracle_catalog
import pytest
import query_catalog


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


def test_every_oracle_has_a_query():
    queries, oracles = query_catalog.all_queries(), oracle_catalog.all_sql()
    assert set(oracles) <= set(queries)
    assert set(query_catalog.all_queries()) <= set(oracles)


@pytest.mark.parametrize("name", sorted(oracle_catalog.all_sql()))
def test_query(spark, sf_dir, duck, name):
    columns, rows = compare.spark_side(query_catalog.all_queries()[name](spark, sf_dir))
    expected_columns, expected = compare.duck_side(duck, oracle_catalog.all_sql()[name])
    assert columns == expected_columns
    assert rows == expected


def test_bounded_dedup_finds_only_landed_keys(spark, sf_dir):
    queries = query_catalog.all_queries()
    bounded = queries["stream_dedup_bounded"](spark, sf_dir).distinct()
    exact = queries["stream_dedup_exact"](spark, sf_dir)
    assert bounded.count() > 0
    assert bounded.subtract(exact).isEmpty()


@pytest.mark.parametrize("sf, currencies, transactions, months", [("sf0.001", 261, 310, 92)])
def test_known_sizes(spark, sf, currencies, transactions, months):
    """Sizes worked out beforehand with another engine."""
    queries, folder = query_catalog.all_queries(), f"/root/testdata/{sf}"
    assert queries["dedup_currencies"](spark, folder).count() == currencies
    assert queries["dedup_transactions"](spark, folder).count() == transactions
    assert queries["global_metrics_month"](spark, folder).count() == months
