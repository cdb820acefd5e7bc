"""The same questions asked in SQL on the published views give the same rows as the functions."""

import os

import pytest

from tamarind.plans import exploration, loyalty
from tamarind.sources.views import Tables

FOLDER = os.environ.get("TAMARIND_TEST_TABLES", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are missing")


@pytest.fixture(scope="module")
def t(spark):
    tables = Tables(spark, FOLDER)
    for name in tables.publish():
        assert spark.table(name).columns
    return tables


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_sum_over_a_left_join(spark, t):
    asked = spark.sql("""
        select customer_id, sum(price) as total_spent
        from sales left join menu using (product_id) group by customer_id""")
    same(asked, loyalty.total_spent(t.sales(), t.menu()))


def test_rank_over_a_count_in_one_block(spark, t):
    asked = spark.sql("""
        select customer_id, product_name, total_orders from (
            select customer_id, product_name, count(*) as total_orders,
                   dense_rank() over (partition by customer_id order by count(*) desc) as place
            from sales left join menu using (product_id) group by customer_id, product_name)
        where place = 1""")
    same(asked, loyalty.favourite_item(t.sales(), t.menu()))


def test_joined_text_of_the_first_day(spark, t):
    asked = spark.sql("""
        select customer_id, string_agg(distinct product_name, ', ') within group (order by product_name) as product_name
        from (select customer_id, product_name, dense_rank() over (partition by customer_id order by order_date) as place
              from sales left join menu using (product_id))
        where place = 1 group by customer_id""")
    same(asked, loyalty.first_item(t.sales(), t.menu()))


def test_scalar_subquery_and_filter(spark, t):
    asked = spark.sql("select booster_version from launch where payload_mass = (select max(payload_mass) from launch)")
    same(asked, exploration.heaviest(t.launch()))
