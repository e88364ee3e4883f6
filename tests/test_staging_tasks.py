import pytest
from pyspark.sql import functions as F

from townlens.plans import staffing
from townlens.sources.staging import spark_table

SF = "/root/testdata/sf0.001"


def tasks(df):
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


@pytest.mark.parametrize("name", ["contacts", "service_links", "contact_pages", "staff_pages"])
def test_one_row_group_feeds_several_tasks(spark, name):
    assert tasks(spark_table(spark, SF, name)) >= 4


def test_pages_made_of_customers_are_dealt_over_tasks(spark):
    for pages in (staffing.whole_pages, staffing.staff_pages):
        assert tasks(pages(spark, SF).filter("page_id >= 0")) >= 4
