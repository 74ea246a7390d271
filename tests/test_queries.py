"""Every registered query against its checking SQL on the given tables."""

import pytest
from compare import difference

from trackloom.catalog.checks import CHECKS, oracle
from trackloom.catalog.queries import QUERIES


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query(spark, con, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), con, oracle(name)) is None


def test_every_query_is_checked():
    assert set(QUERIES) == set(CHECKS)


def test_samples_have_their_fraction(spark, sf_dir):
    total = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    kept = QUERIES["sample_rows"](spark, sf_dir).count()
    assert abs(kept - total / 2) < 5 * (total / 4) ** 0.5
