"""Adapter views: the reporting schema expressed over the driver's tables.

The reports read a project / invoice / cost / time-log schema. The test data is
a TPC-H-like star schema, so each source table of the reports is defined here
as a lazy DataFrame over it (same expressions as the SQL oracle in
``plans/oracle.py``). Every view is derived from the given tables, so its size
grows with them; the only literal tables are the tiny translation lists a real
source database also keeps as a handful of rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F

from .tables import Tables

# Iso code of currency id n is element (n % 17) of this list.
CURRENCY_CODES = ["TRY", "CLP", "USD", "EUR", "GBP", "PLN", "KRW", "SEK", "NZD",
                  "ARS", "DOP", "JPY", "signup", "error", "click", "view", "purchase"]

# Small translation tables of the source schema.
PROJECT_STATUSES = [(1, "New"), (2, "On hold"), (3, "In progress"), (4, "Completed"),
                    (5, "Cancelled")]
INVOICE_STATUSES = [(1, 3, "Draft"), (2, 1, "Sent"), (3, 2, "Paid")]
BILLING_ATTRIBUTES = [(1, "omnibus_order_item_id"), (2, "other")]
DEMO_COMPANY_ID = 10  # the customer that plays "Demo Company"
# The currency codes of the test rates, in the file's column order.
RATE_CODES = ["click", "error", "purchase", "signup", "view"]
FX_START = "2024-01-01"
FX_DAYS = 40


def cents(c: Column) -> Column:
    """Exact cents of a double amount that holds whole cents."""
    return F.round(c * 100).cast("bigint")


def fx_date(k: Column) -> Column:
    """A date inside the FX series: FX_START + (k % FX_DAYS) days, as timestamp."""
    return F.date_add(F.lit(FX_START).cast("date"), (k % FX_DAYS).cast("int")).cast("timestamp_ntz")


def _div(c: Column, n: int) -> Column:
    """Whole division: key ranges that grow with the table, ``n`` rows a key."""
    return F.floor(c / n).cast("bigint")


def _null_unless(cond: Column, value: Column) -> Column:
    return F.when(cond, value)


class Adapters:
    """Lazily built source views; each property is a DataFrame."""

    def __init__(self, tables: Tables):
        self.t = tables
        self.spark = tables.spark

    # ---- project side -------------------------------------------------
    @cached_property
    def project(self) -> DataFrame:
        o = self.t["orders"]
        pid = F.col("o_orderkey")
        return o.select(
            pid.alias("id"),
            (pid % 5 + 1).alias("project_status_id"),
            F.col("o_custkey").alias("company_id"),
            F.concat(F.lit("P"), pid.cast("string")).alias("name"),
            F.concat(F.col("o_orderpriority"), F.lit("-"), pid.cast("string")).alias("project_code"),
            F.col("o_orderdate").alias("created_at"),
            _null_unless(F.col("o_orderstatus") == "F",
                         F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("closed_at"),
            _null_unless(pid % 17 == 0, F.col("o_orderdate")).alias("archived_at"),
            _null_unless(pid % 23 == 0, F.col("o_orderdate")).alias("deleted_at"),
        )

    @cached_property
    def project_status(self) -> DataFrame:
        return self.spark.createDataFrame(PROJECT_STATUSES, "id long, name string")

    @cached_property
    def wave(self) -> DataFrame:
        """project_product_group: one wave per distinct (order, line number)."""
        li = self.t["lineitem"]
        return li.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            F.col("l_orderkey").alias("project_id"),
        ).distinct()

    @cached_property
    def project_account_view(self) -> DataFrame:
        return self.t["orders"].select(F.col("o_orderkey").alias("project_id"),
                                       F.col("o_custkey").alias("company_id"))

    @cached_property
    def project_account(self) -> DataFrame:
        company = F.col("o_custkey")
        return self.t["orders"].select(F.col("o_orderkey").alias("project_id"), F.explode(
            F.when(F.col("o_orderkey") % 3 == 0, F.array(company, company.bitwiseXOR(F.lit(1))))
            .otherwise(F.array(company))).alias("company_id"))

    @cached_property
    def company(self) -> DataFrame:
        c = self.t["customer"]
        cid = F.col("c_custkey")
        return c.select(
            cid.alias("id"),
            F.when(cid == DEMO_COMPANY_ID, F.lit("Demo Company"))
             .otherwise(F.concat(F.col("c_name"), F.lit(" "), F.col("c_mktsegment"))).alias("name"),
            F.col("c_mktsegment").alias("segment"),
            F.nullif(_div(cid, 50), F.lit(0)).alias("account_of"),
            F.nullif(_div(cid, 7), F.lit(0)).alias("invoiced_by"),
            _div(cid, 15).alias("responsible_account_manager_id"),
            F.col("c_nationkey").cast("bigint").alias("country_id"),
            _null_unless(cid % 41 == 0, F.lit("2024-01-01").cast("timestamp_ntz")).alias("deleted_at"),
        )

    @cached_property
    def country(self) -> DataFrame:
        n = self.t["nation"]
        return n.select(F.col("n_nationkey").cast("bigint").alias("id"),
                        F.col("n_name").alias("english_name"))

    @cached_property
    def user(self) -> DataFrame:
        s = self.t["supplier"]
        sid = F.col("s_suppkey")
        return s.select(sid.alias("id"), F.col("s_name").alias("first_name"),
                        _null_unless(sid % 10 != 0, F.concat(F.lit("L"), sid.cast("string")))
                        .alias("last_name"))

    @cached_property
    def currency(self) -> DataFrame:
        codes = F.array(*[F.lit(c) for c in CURRENCY_CODES])
        ids = self.t["part"].select(F.col("p_size").cast("bigint").alias("id")).distinct()
        return ids.select(
            "id",
            F.element_at(codes, (F.col("id") % len(CURRENCY_CODES) + 1).cast("int")).alias("iso_code"),
            F.when(F.col("id") == 3, F.lit("Euro"))
             .otherwise(F.concat(F.lit("C"), F.col("id").cast("string"))).alias("name"),
        )

    # ---- sales, cost, time --------------------------------------------
    def _lines_with_part(self) -> DataFrame:
        li = self.t["lineitem"]
        p = self.t["part"].select("p_partkey", "p_size")
        return li.join(p, li["l_partkey"] == p["p_partkey"], "inner")

    @cached_property
    def sales_line(self) -> DataFrame:
        """project_sales_product."""
        lp = self._lines_with_part()
        key = F.col("l_orderkey") * 10 + F.col("l_linenumber")
        return lp.select(
            key.alias("id"),
            F.col("l_orderkey").alias("project_id"),
            key.alias("project_product_group_id"),
            F.col("l_partkey").alias("sales_product_id"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            cents(F.col("l_extendedprice")).alias("unit_price"),
            F.col("p_size").cast("bigint").alias("currency_id"),
            (F.col("l_suppkey") % 25).alias("country_id"),
            fx_date(F.col("l_orderkey") + F.col("l_linenumber")).alias("created_at"),
            F.col("l_shipdate").alias("updated_at"),
        )

    @cached_property
    def product(self) -> DataFrame:
        """sales_product_translation."""
        p = self.t["part"]
        return p.select(
            (F.col("p_partkey") + 1).alias("id"),
            F.col("p_partkey").alias("translatable_id"),
            F.concat(F.col("p_type"), F.lit("-"), F.col("p_brand"), F.lit(" - "),
                     F.col("p_name")).alias("name"),
        )

    @cached_property
    def cost_line(self) -> DataFrame:
        """project_cost."""
        lp = self._lines_with_part().where(F.col("l_returnflag") == "R")
        key = F.col("l_orderkey") * 10 + F.col("l_linenumber")
        return lp.select(
            key.alias("id"),
            F.col("l_orderkey").alias("project_id"),
            key.alias("project_product_group_id"),
            cents(F.col("l_extendedprice")).alias("amount"),
            F.col("p_size").cast("bigint").alias("currency_id"),
            F.col("l_linenumber").cast("bigint").alias("cost_type_id"),
            F.col("l_linestatus").alias("comment"),
            F.col("l_suppkey").alias("created_by_user_id"),
            F.col("l_shipdate").alias("created_at"),
        )

    @cached_property
    def cost_type_translation(self) -> DataFrame:
        return (self.spark.range(1, 8).select(F.col("id").alias("translatable_id"),
                                              F.concat(F.lit("Cost type "), F.col("id").cast("string")).alias("name")))

    @cached_property
    def time_log(self) -> DataFrame:
        """project_time_log."""
        e = self.t["events"]
        return e.select(
            F.col("event_id").alias("id"),
            F.col("user_id").alias("project_id"),
            (F.col("user_id") * 10 + F.col("event_id") % 7 + 1).alias("project_product_group_id"),
            F.nullif(F.hour("ts") % 5, F.lit(0)).cast("bigint").alias("hours"),
            (F.minute("ts") - F.minute("ts") % 15).cast("bigint").alias("minutes"),
            _div(F.col("user_id"), 10).alias("user_id"),
            F.col("ts").alias("created_at"),
            _null_unless(F.col("event_id") % 19 == 0, F.col("ts")).alias("deleted_at"),
        )

    # ---- invoices -----------------------------------------------------
    @cached_property
    def invoice(self) -> DataFrame:
        o = self.t["orders"].where(F.col("o_orderkey") % 2 == 0)
        iid = F.col("o_orderkey")
        return o.select(
            iid.alias("id"),
            F.concat(F.lit("INV"), iid.cast("string")).alias("number"),
            (iid % 3 + 1).alias("invoice_status_id"),
            fx_date(iid).alias("submit_date"),
            cents(F.col("o_totalprice")).alias("total"),
            cents(F.col("o_totalprice")).alias("grand_total"),
            (F.col("o_custkey") % 50 + 1).alias("currency_id"),
            F.col("o_custkey").alias("buyer_company_id"),
        )

    @cached_property
    def project_invoice(self) -> DataFrame:
        iid = F.col("id")
        return self.invoice.select(F.explode(F.when(iid % 6 == 0, F.array(iid, iid + 1)).otherwise(F.array(iid)))
                                   .alias("project_id"), iid.alias("invoice_id"))

    @cached_property
    def invoice_product(self) -> DataFrame:
        li = self.t["lineitem"].where(F.col("l_returnflag") == "A")
        return li.select(
            F.col("l_orderkey").alias("invoice_id"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("project_sales_product_id"),
            _div(F.col("l_partkey"), 2).alias("invoice_product_code_id"),
            F.col("l_partkey").alias("sales_product_id"),
            cents(F.col("l_extendedprice")).alias("total"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            cents(F.col("l_extendedprice")).alias("unit_price"),
            (F.col("l_partkey") % 50 + 1).alias("currency_id"),
            (F.col("l_orderkey") % 100).cast("string").alias("project_code"),
            _null_unless((F.col("l_linenumber") == 7) & (F.col("l_linestatus") == "O"),
                         F.col("l_shipdate")).alias("deleted_at"),
        )

    @cached_property
    def invoice_product_code(self) -> DataFrame:
        ids = self.t["part"].select(_div(F.col("p_partkey"), 2).alias("id")).distinct()
        return ids.select("id", F.concat(F.lit("C"), F.col("id").cast("string")).alias("code"),
                          F.concat(F.lit("Code "), F.col("id").cast("string")).alias("description"))

    @cached_property
    def invoice_status_translation(self) -> DataFrame:
        return self.spark.createDataFrame(INVOICE_STATUSES, "id long, translatable_id long, name string")

    @cached_property
    def sales_product_invoice_product_code(self) -> DataFrame:
        return self.t["part"].select(_div(F.col("p_partkey"), 2).alias("invoice_product_code_id"),
                                     F.col("p_partkey").alias("sales_product_id"))

    # ---- omnibus orders -----------------------------------------------
    @cached_property
    def omnibus_order(self) -> DataFrame:
        ids = self.t["events"].select(F.col("user_id").alias("id")).distinct()
        return ids.select(
            "id",
            F.concat(F.lit("O"), F.col("id").cast("string")).alias("name"),
            F.col("id").alias("company_id"),
            _div(F.col("id"), 10).alias("managing_company_id"),
            _null_unless(F.col("id") % 17 == 0, F.lit("2024-01-01").cast("timestamp_ntz")).alias("archived_at"),
        )

    @cached_property
    def omnibus_order_cost(self) -> DataFrame:
        e = self.t["events"].where(F.col("event_type") == "purchase")
        return e.select(
            F.col("user_id").alias("omnibus_order_id"),
            cents(F.col("value")).alias("amount"),
            (F.col("event_id") % 50 + 1).alias("currency_id"),
            (F.col("event_id") % 7 + 1).alias("cost_type_id"),
            F.col("event_type").alias("comment"),
        )

    @cached_property
    def omnibus_order_time_log(self) -> DataFrame:
        e = self.t["events"].where(F.col("event_type") == "view")
        return e.select(F.col("user_id").alias("omnibus_order_id"),
                        (F.hour("ts") % 5).cast("bigint").alias("hours"),
                        F.minute("ts").cast("bigint").alias("minutes"))

    @cached_property
    def omnibus_order_item(self) -> DataFrame:
        return self.t["customer"].select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("omnibus_order_id"))

    @cached_property
    def billing_item(self) -> DataFrame:
        e = self.t["events"].where(F.col("event_type") == "signup")
        return e.select(F.col("event_id").alias("id"), (F.col("event_id") * 2).alias("invoice_id"))

    @cached_property
    def billing_item_attribute(self) -> DataFrame:
        return self.spark.createDataFrame(BILLING_ATTRIBUTES, "id long, name string")

    @cached_property
    def billing_item_attribute_value(self) -> DataFrame:
        e = self.t["events"].where(F.col("event_type") == "signup")
        return e.select(
            F.col("event_id").alias("billing_item_id"),
            (F.col("event_id") % 2 + 1).alias("billing_item_attribute_id"),
            F.when(F.col("event_id") % 10 == 0, F.lit("x"))
             .otherwise(F.get_json_object("props", "$.k")).alias("value"),
        )

    # ---- currency rates -----------------------------------------------
    @cached_property
    def fx_long(self) -> DataFrame:
        """One rate observation per event: (date, currency code, rate)."""
        e = self.t["events"]
        return e.select(F.to_date("ts").alias("date"),
                        F.col("event_type").alias("currency"),
                        cents(F.col("value")).alias("rate_cents"))

    @cached_property
    def fx_daily(self) -> DataFrame:
        """One rate per date and currency: (date, currency, exchange_rate).

        A rate is the day's mean (exact mean of cents rounded half-up to 4
        decimals of a cent); it is missing when day-of-month % 7 == 0 for the
        'error' and 'signup' columns.
        """
        daily = (self.fx_long.groupBy("date", "currency")
                 .agg((F.avg(F.col("rate_cents").cast("decimal(18,0)")) / 100).cast("double").alias("rate")))
        missing = (F.dayofmonth("date") % 7 == 0) & F.col("currency").isin("error", "signup")
        return daily.select("date", "currency", _null_unless(~missing, F.col("rate")).alias("exchange_rate"))

    @cached_property
    def fx_codes(self) -> list[str]:
        """The currency codes in the data: the columns of the rate file."""
        return [r.currency for r in self.fx_long.select("currency").distinct().orderBy("currency").collect()]

    @cached_property
    def fx_wide(self) -> DataFrame:
        """The wide daily rate file: Date, then one rate column per code."""
        wide = self.fx_daily.groupBy("date").pivot("currency", self.fx_codes).agg(F.first("exchange_rate"))
        return wide.select(F.date_format("date", "yyyy-MM-dd").alias("Date"), *self.fx_codes)
