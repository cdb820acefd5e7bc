"""Loyalty programme: purchases, first and last items, points and membership flags.

``sales``: customer_id, order_date, product_id. ``menu``: product_id, product_name, price. ``members``: customer_id,
join_date. All three may be large. A menu that is small enough is broadcast by Spark, so the purchases are shuffled once
at most before they are grouped; a larger one is joined by shuffle, where a hot product or customer is split at run time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarind.operators.rank import best_per_group


def _with_menu(sales: DataFrame, menu: DataFrame) -> DataFrame:
    return sales.join(menu, "product_id", "left")


def _per_product(sales: DataFrame) -> DataFrame:
    """Purchases reduced to (customer, product) with their number ``n`` and first and last day.

    The menu is joined to these few rows, not to the sales, so a product that everybody buys is no hot key there.
    """
    return sales.groupBy("customer_id", "product_id").agg(
        F.count(F.lit(1)).cast("int").alias("n"), F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day")
    )


def _as_member(sales: DataFrame, members: DataFrame, when: Column) -> DataFrame:
    """Purchases of members for which a condition on order_date and join_date holds."""
    return sales.join(members, "customer_id").filter(when)


def _since_joining() -> Column:
    return F.col("order_date") >= F.col("join_date")


def _before_joining() -> Column:
    return F.col("order_date") < F.col("join_date")


def total_spent(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Amount per customer, highest first."""
    return (
        _with_menu(_per_product(sales), menu)
        .groupBy("customer_id")
        .agg(F.sum(F.col("price") * F.col("n")).alias("total_spent"))
        .orderBy(F.desc("total_spent"), "customer_id")
    )


def visit_days(sales: DataFrame) -> DataFrame:
    """Distinct purchase days per customer."""
    return sales.groupBy("customer_id").agg(F.count_distinct("order_date").alias("total_days"))


def visit_day_partials(sales: DataFrame) -> DataFrame:
    """Purchase days as bitmaps that can be stored and merged: ``customer_id, month, bucket, days``.

    A day is one bit of a bitmap of 32,768 days, so repeated purchases and repeated rows set the same bit, and partial
    results that overlap may be merged. One row for each customer and month; months are added by appending.
    """
    day = F.unix_date("order_date")
    return (
        sales.filter(F.col("order_date").isNotNull())
        .groupBy("customer_id", F.date_trunc("month", "order_date").cast("date").alias("month"),
                 F.bitmap_bucket_number(day).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(day)).alias("days"))
    )


def visit_days_of(partials: DataFrame) -> DataFrame:
    """Distinct purchase days per customer out of stored partial results of any months."""
    merged = partials.groupBy("customer_id", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("days")).alias("_days"))
    return merged.groupBy("customer_id").agg(F.sum("_days").alias("total_days"))


def _items_of_edge_day(purchases: DataFrame, menu: DataFrame, last: bool) -> DataFrame:
    """Distinct items of each customer's first (last) purchase day, sorted and joined, with that day.

    An item was bought on the first day exactly when its own first day is the customer's first day. So one row per
    (customer, item) is enough, which a hot customer spreads over all tasks and every task combines beforehand.
    """
    edge, day = (F.max, "last_day") if last else (F.min, "first_day")
    per_item = (
        _with_menu(_per_product(purchases), menu)
        .groupBy("customer_id", "product_name")
        .agg(edge(day).alias("order_date"))
    )
    order = F.desc_nulls_last("order_date") if last else F.asc_nulls_last("order_date")
    return (
        best_per_group(per_item, ["customer_id"], order)
        .groupBy("customer_id", "order_date")
        .agg(F.array_join(F.sort_array(F.collect_list("product_name")), ", ").alias("product_name"))
    )


def first_item(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Items of each customer's first visit."""
    return _items_of_edge_day(sales, menu, last=False).select("customer_id", "product_name")


def top_item(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Best-selling item and how often it was sold. Sales are counted per product before the menu is joined."""
    counted = sales.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    return (
        _with_menu(counted, menu)
        .groupBy("product_name")
        .agg(F.sum("n").alias("total_orders"))
        .orderBy(F.desc("total_orders"), "product_name")
        .limit(1)
    )


def favourite_item(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Most bought item(s) of each customer."""
    per_item = (
        _with_menu(_per_product(sales), menu).groupBy("customer_id", "product_name").agg(F.sum("n").alias("total_orders"))
    )
    return best_per_group(per_item, ["customer_id"], F.desc("total_orders"))


def _member_days(sales: DataFrame, members: DataFrame) -> DataFrame:
    """Distinct purchase days of members since joining: few rows per customer, however much was bought."""
    days = sales.select("customer_id", "order_date").distinct()
    return _as_member(days, members, _since_joining()).select("customer_id", "order_date")


def first_after_join(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """Every purchase of the first day on or after joining. Repeated purchases stay separate rows.

    Membership is settled on the distinct days, so purchases meet only (customer, first day).
    """
    first_day = _member_days(sales, members).groupBy("customer_id").agg(F.min("order_date").alias("order_date"))
    return _with_menu(sales.join(first_day, ["customer_id", "order_date"]), menu).select(
        "customer_id", "product_name", "order_date"
    )


def before_join(sales: DataFrame, menu: DataFrame, members: DataFrame, last: bool = True) -> DataFrame:
    """Items of the last purchase day before joining; ``last=False`` gives the first day instead."""
    return _items_of_edge_day(_as_member(sales, members, _before_joining()), menu, last).select(
        "customer_id", "product_name", "order_date"
    )


def pre_member_totals(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """Number of items and amount before joining."""
    return (
        _with_menu(_per_product(_as_member(sales, members, _before_joining())), menu)
        .groupBy("customer_id")
        .agg(F.sum("n").alias("total_items"), F.sum(F.col("price") * F.col("n")).alias("amount_spent"))
        .orderBy("customer_id")
    )


def _points(double: Column) -> Column:
    """Ten points per unit of price, twenty where ``double`` holds."""
    return F.col("price") * F.when(double, 20).otherwise(10)


def points(sales: DataFrame, menu: DataFrame, double_product: str) -> DataFrame:
    """Points per customer with one product counting twice."""
    earned = _points(F.col("product_name") == double_product)
    return (
        _with_menu(_per_product(sales), menu)
        .groupBy("customer_id")
        .agg(F.sum(earned * F.col("n")).alias("customer_points"))
        .orderBy("customer_id")
    )


def member_month_sales(sales: DataFrame, menu: DataFrame, members: DataFrame, month: int) -> DataFrame:
    """Purchases of members since joining, in one month of any year."""
    return _with_menu(_as_member(sales, members, _since_joining() & (F.month("order_date") == month)), menu).select(
        "customer_id", "order_date", "product_id", "product_name", "price", "join_date"
    )


def points_first_week(
    sales: DataFrame, menu: DataFrame, members: DataFrame, double_product: str, until: dt.date
) -> DataFrame:
    """Points since joining and up to a day: everything counts twice in the first week, one product always does."""
    in_first_week = F.col("order_date").between(F.col("join_date"), F.date_add("join_date", 6))
    bought = _as_member(sales.filter(F.col("order_date") <= F.lit(until)), members, _since_joining())
    earned = _points(in_first_week | (F.col("product_name") == double_product))
    return (
        _with_menu(bought, menu)
        .groupBy("customer_id")
        .agg(F.sum(earned).alias("customer_points"))
        .orderBy("customer_id")
    )


def member_flag(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """Every purchase with item, price and whether the customer was a member on that day."""
    return _with_menu(sales.join(members, "customer_id", "left"), menu).select(
        "customer_id",
        "order_date",
        "product_name",
        "price",
        F.when(_since_joining(), "Y").otherwise("N").alias("member"),
    )


def member_ranking(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """The same table with a dense rank by date over the purchases made as a member, null for the others.

    The rank depends on the distinct days only. They are ranked on their own and joined to the purchases by customer and
    day, so no window ever holds all purchases of a customer; a day that finds a rank is a day as a member.
    """
    by_day = Window.partitionBy("customer_id").orderBy("order_date")
    ranks = _member_days(sales, members).withColumn("ranking", F.dense_rank().over(by_day))
    return _with_menu(sales.join(ranks, ["customer_id", "order_date"], "left"), menu).select(
        "customer_id",
        "order_date",
        "product_name",
        "price",
        F.when(F.col("ranking").isNotNull(), "Y").otherwise("N").alias("member"),
        "ranking",
    )
