import pytest
from pyspark.sql import functions as F

from townlens.operators import routes
from townlens.plans import staffing
from townlens.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["profile_links", "department_links"])
def test_references_are_resolved_once(spark, name):
    once = plan(routes.anchors(staffing.linked_pages(spark, SF))).count("nntp")
    assert 0 < plan(QUERIES[name](spark, SF)).count("nntp") <= once


def test_linked_pages_are_dealt_over_tasks(spark):
    pages = staffing.linked_pages(spark, SF).filter("page_id >= 0")
    assert pages.select(F.spark_partition_id().alias("p")).distinct().count() >= 4
