"""The inputs of the registered queries are whole tables."""

import os

import pytest
from pyspark.sql import functions as F

from gleaner.plans import queries
from gleaner.plans.inputs import TABLES, spark_table

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", sorted(TABLES))
def test_every_row_is_read(spark, name):
    assert spark_table(spark, DATA, name).count() == spark.read.parquet(f"{DATA}/{TABLES[name][0]}.parquet").count()


def test_pairs_grow_with_the_orders(spark):
    e = spark_table(spark, "/root/testdata/sf0.1", "enriched")
    assert e.select("url", F.lower("doi")).distinct().count() > 0.5 * e.count()


def test_promotions_have_all_cases(spark):
    found = {r.skip_reason for r in queries.QUERIES["promote_first_wins"](spark, DATA).select("skip_reason").distinct().collect()}
    assert found == {None, "url_already_promoted", "no_paper_record", "no_promotion_data", "not_found"}


def test_classifier_sees_all_authors(spark):
    assert queries.QUERIES["classifier_input"](spark, DATA).count() == queries.QUERIES["author_pairs"](spark, DATA).count()
