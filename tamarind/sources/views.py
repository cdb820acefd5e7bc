"""Frames that the reports expect, derived row by row from the order, part, event and page tables.

Every view is lazy and names the columns it needs, so the parquet scans below it stay narrow. None of them repartitions
or hints a broadcast: how a dimension is joined is left to its measured size.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarind.sources.files import publish
from tamarind.sources.tables import read_table

LAUNCH_JSON = (
    "flight_number bigint, date_utc string, rocket string, launchpad bigint, payloads array<string>, "
    "cores array<struct<core:string,flight:int,gridfins:boolean,legs:boolean,reused:boolean,"
    "landing_success:boolean,landing_type:string,landpad:string>>"
)


@dataclass(frozen=True)
class Tables:
    """Raw tables of one folder and the views on them."""

    spark: SparkSession
    folder: str

    def raw(self, name: str, *columns: str) -> DataFrame:
        df = read_table(self.spark, self.folder, name)
        return df.select(*columns) if columns else df

    def publish(self) -> list[str]:
        """Make the domain views known to SQL under their names."""
        views = {
            "customer_transaction": self.customer_transaction(),
            "customer_registered": self.customer_registered(),
            "sales": self.sales(),
            "menu": self.menu(),
            "members": self.members(),
            "employee_statement": self.employee_statement(),
            "launch": self.launch(),
            "basket_lines": self.basket_lines(),
            "site_geo": self.site_geo(),
            "poi_geo": self.poi_geo(),
            "price_series": self.price_series(),
        }
        for name, view in views.items():
            publish(view, name)
        return list(views)

    # --- customer value -------------------------------------------------------------------------------------------
    def customer_transaction(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("purchase_date"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("gmv"),
        )

    def customer_registered(self) -> DataFrame:
        start = F.lit(dt.date(1996, 1, 1))
        key = F.col("c_custkey")
        return (
            self.raw("customer")
            .filter(F.col("c_mktsegment") != "MACHINERY")
            .select(
                key.alias("customer_id"),
                F.date_add(start, (key * 7 % 2050).cast("int")).alias("created_date"),
                F.when(F.col("c_acctbal") < 0, F.date_add(start, (key * 7 % 2050 + 900).cast("int"))).alias("stop_date"),
            )
        )

    # --- loyalty programme ----------------------------------------------------------------------------------------
    def sales(self) -> DataFrame:
        lines = self.raw("lineitem", "l_orderkey", "l_partkey")
        orders = self.raw("orders", "o_orderkey", "o_custkey", "o_orderdate")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("l_partkey").alias("product_id"),
        )

    def menu(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_retailprice").cast("decimal(18,2)").alias("price"),
        )

    def members(self) -> DataFrame:
        key = F.col("c_custkey")
        return (
            self.raw("customer", "c_custkey", "c_acctbal")
            .filter(F.col("c_acctbal") >= 1000)
            .select(
                key.alias("customer_id"),
                F.date_add(F.lit(dt.date(1997, 1, 1)), (key % 1000).cast("int")).alias("join_date"),
            )
        )

    # --- workforce ------------------------------------------------------------------------------------------------
    def statement(self) -> DataFrame:
        """Contract statements on their own; reports that ask neither for place nor for title need no join."""
        key, cust = F.col("o_orderkey"), F.col("o_custkey")
        signed, status = F.col("o_orderdate").cast("date"), F.col("o_orderstatus")
        return self.raw("orders").select(
            key.alias("statement_id"),
            F.when(status == "F", "TERMINATED").when(status == "O", "HIRED").otherwise("OTHER").alias("statement_type"),
            F.col("o_orderpriority").alias("statement_name"),
            signed.alias("statement_valid_date"),
            F.when(key % 97 != 0, F.date_sub(signed, (key % 3000 - 100).cast("int"))).alias("employee_work_date"),
            F.when(cust % 7 != 0, F.concat(F.lit("L"), (cust % 40).cast("string"))).alias("leader_code"),
            cust.alias("employee_id"),
        )

    def employee_statement(self) -> DataFrame:
        """Statements with the place and the title of the employee."""
        segment = F.col("c_mktsegment")
        return (
            self.statement()
            .join(self.raw("customer"), F.col("employee_id") == F.col("c_custkey"), "left")
            .join(self.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(
                "statement_id",
                "statement_type",
                "statement_name",
                "statement_valid_date",
                "employee_work_date",
                F.col("n_name").alias("work_location"),
                F.when(segment == "BUILDING", "Senior Specialist")
                .when(segment == "MACHINERY", "Head of Unit")
                .when(segment == "HOUSEHOLD", "Collaborator (part time)")
                .when(segment == "AUTOMOBILE", "Managing Director")
                .alias("job_title"),
                "leader_code",
            )
        )

    def employee_statement_text(self) -> DataFrame:
        """The same statements as they come from an export: dates as text, open ends, unused and empty columns."""
        def text(day):
            return F.date_format(day, "MM/dd/yyyy")

        key = F.col("statement_id")
        return self.employee_statement().select(
            "statement_id",
            "statement_type",
            text(F.col("statement_valid_date")).alias("statement_valid_date"),
            F.when(key % 5 == 0, F.lit("12/31/9999"))
            .otherwise(text(F.date_add("statement_valid_date", 365)))
            .alias("statement_expired_date"),
            text(F.col("employee_work_date")).alias("employee_work_date"),
            "work_location",
            "job_title",
            F.col("leader_code").alias("KH200"),
            F.concat(F.lit("E"), key.cast("string")).alias("employee_code"),
            F.when(key < 0, key).alias("HAM"),
        )

    # --- launches -------------------------------------------------------------------------------------------------
    def launch(self, *columns: str) -> DataFrame:
        """Launch records. With ``columns``, only these, and only the dimensions they need are joined.

        Orbit and version come from the part, the site from the supplier, the customer from the order; without any of
        them the fact table is read on its own. Records whose dimension is missing stay, so all widths have the same rows.
        """
        flag, status = F.col("l_returnflag"), F.col("l_linestatus")
        known = {
            "launch_id": F.col("l_orderkey"),
            "launch_seq": F.col("l_linenumber"),
            "part_key": F.col("l_partkey"),
            "supp_key": F.col("l_suppkey"),
            "launch_date": F.col("l_shipdate").cast("date"),
            "payload_mass": F.when(F.col("l_partkey") % 20 != 0, F.col("l_quantity")),
            "orbit": F.col("p_type"),
            "booster_version": F.col("p_brand"),
            "launch_site": F.concat(F.lit("SITE_"), (F.col("s_nationkey") % 4).cast("string")),
            "outcome": F.concat_ws(" ", flag, status),
            "class": F.when(F.concat(flag, status).isin("RF", "NF"), 0).otherwise(1),
            "customer": F.concat(F.lit("CUST_"), (F.col("o_custkey") % 50).cast("string")),
        }
        wanted = columns or [c for c in known if c != "customer"]
        rows = self.raw("lineitem")
        if {"orbit", "booster_version"} & set(wanted):
            parts = self.raw("part", "p_partkey", "p_type", "p_brand")
            rows = rows.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        if "launch_site" in wanted:
            suppliers = self.raw("supplier", "s_suppkey", "s_nationkey")
            rows = rows.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        if "customer" in wanted:
            orders = self.raw("orders", "o_orderkey", "o_custkey")
            rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        return rows.select(*[known[c].alias(c) for c in wanted])

    def launch_ids(self) -> DataFrame:
        """Launch records that hold only ids; every fifth core id is missing and some pads do not exist."""
        line = F.col("l_linenumber")
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("launch_id"),
            line.alias("launch_seq"),
            F.col("l_partkey").alias("rocket_id"),
            F.when(F.col("l_suppkey") % 11 == 0, -1).otherwise(F.col("l_suppkey")).alias("launchpad_id"),
            F.col("l_orderkey").alias("payload_id"),
            F.when((F.col("l_partkey") + line) % 5 != 0, F.col("l_suppkey") * 3).alias("core_id"),
        )

    def rockets(self) -> DataFrame:
        return self.raw("part").select(F.col("p_partkey").alias("rocket_id"), F.col("p_brand").alias("booster_version"))

    def payloads(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("payload_id"),
            F.col("o_totalprice").alias("payload_mass"),
            F.col("o_orderpriority").alias("orbit"),
        )

    def launchpads(self) -> DataFrame:
        return self.site_geo().select(
            F.col("site_id").alias("launchpad_id"),
            F.col("site_name").alias("launch_site"),
            F.col("lon").alias("longitude"),
            F.col("lat").alias("latitude"),
        )

    def cores(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.raw("customer").select(
            key.alias("core_id"),
            (key % 5 + 1).cast("double").alias("block"),
            (key % 7).cast("int").alias("reuse_count"),
            F.col("c_name").alias("serial"),
        )

    def launch_documents(self) -> DataFrame:
        """One JSON text per order, with arrays of zero, one or two cores and payloads."""
        key, cust = F.col("o_orderkey"), F.col("o_custkey")
        status = F.col("o_orderstatus")
        core = F.struct(
            F.concat(F.lit("B"), cust.cast("string")).alias("core"),
            (key % 9 + 1).cast("int").alias("flight"),
            (key % 2 == 0).alias("gridfins"),
            (key % 4 != 0).alias("legs"),
            (key % 3 == 0).alias("reused"),
            F.when(status == "F", True).when(status == "O", False).alias("landing_success"),
            F.when(status != "P", F.when(cust % 2 == 0, "ASDS").otherwise("RTLS")).alias("landing_type"),
            F.when(cust % 4 == 0, F.concat(F.lit("pad"), (cust % 5).cast("string"))).alias("landpad"),
        )
        payload = F.concat(F.lit("P"), key.cast("string"))
        record = F.struct(
            key.alias("flight_number"),
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date_utc"),
            F.concat(F.lit("R"), (cust % 4).cast("string")).alias("rocket"),
            (cust % 25).alias("launchpad"),
            F.array_repeat(payload, (key % 3).cast("int")).alias("payloads"),
            F.array_repeat(core, (cust % 3).cast("int")).alias("cores"),
        )
        return self.raw("orders").select(F.to_json(record).alias("launch"))

    # --- baskets, maps, series ------------------------------------------------------------------------------------
    def basket_lines(self) -> DataFrame:
        """One row per line, repeated items included; the basket operators remove repeats themselves."""
        parts = self.raw("part", "p_partkey", "p_name")
        return (
            self.raw("lineitem", "l_orderkey", "l_partkey")
            .join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .select(F.col("l_orderkey").alias("transaction_id"), F.col("p_name").alias("item"))
        )

    def site_geo(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.raw("supplier").select(
            key.alias("site_id"),
            F.col("s_name").alias("site_name"),
            ((key * 37 % 1800).cast("double") / 10 - 90).alias("lat"),
            ((key * 73 % 3600).cast("double") / 10 - 180).alias("lon"),
        )

    def poi_geo(self) -> DataFrame:
        key = F.col("n_nationkey").cast("bigint")
        return self.raw("nation").select(
            key.alias("poi_id"),
            F.col("n_name").alias("poi_name"),
            ((key * 211 % 1800).cast("double") / 10 - 90).alias("lat"),
            ((key * 389 % 3600).cast("double") / 10 - 180).alias("lon"),
        )

    def launch_points(self) -> DataFrame:
        """Launch records with the coordinates of their site."""
        records = self.launch("launch_id", "launch_seq", "part_key", "supp_key", "class")
        return records.join(self.site_geo(), F.col("supp_key") == F.col("site_id")).select(
            "launch_id", "launch_seq", "part_key", "supp_key", "site_name", "lat", "lon", "class"
        )

    def price_series(self) -> DataFrame:
        return (
            self.raw("events", "ts", "event_type", "value")
            .filter(F.col("event_type") == "purchase")
            .groupBy(F.col("ts").cast("date").alias("d"))
            .agg(F.max("value").alias("close"))
        )

    def revenue_text(self) -> DataFrame:
        """Amounts as they stand on a page: currency sign, thousands separators, some empty."""
        key = F.col("o_orderkey")
        return self.raw("orders").select(
            key.alias("row_id"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_text"),
            F.when(key % 11 == 0, F.lit(""))
            .when(key % 13 == 0, F.lit(None).cast("string"))
            .when(key % 17 == 0, F.lit("$"))
            .otherwise(F.concat(F.lit("$"), F.format_number(F.floor("o_totalprice"), 0)))
            .alias("revenue_text"),
        )

    def scraped(self) -> DataFrame:
        """Launch rows as they stand in a scraped table."""
        key, quantity = F.col("l_partkey"), F.col("l_quantity").cast("int")
        mass = F.format_number(quantity * 137, 0)
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("flight_no"),
            F.col("l_linenumber").alias("line_no"),
            F.col("l_partkey").alias("part_key"),
            F.col("l_suppkey").alias("supp_key"),
            F.when(key % 7 == 0, F.lit("C"))
            .when(key % 7 == 1, F.lit("0"))
            .when(key % 7 == 2, F.concat(F.lit("~"), mass, F.lit(" kg")))
            .when(key % 7 == 3, F.concat(mass, F.lit("–"), F.format_number(quantity * 137 + 1000, 0), F.lit(" kg")))
            .otherwise(F.concat(mass, F.lit(" kg")))
            .alias("payload_mass"),
            F.concat(F.col("l_returnflag"), F.lit("\n")).alias("launch_outcome"),
            F.date_format("l_shipdate", "d MMMM yyyy").alias("date_text"),
        )
