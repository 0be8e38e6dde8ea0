"""Driver queries: each operator and report run over the test tables.

Every entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
adapter views of ``sources.adapters``. Column names and types match the SQL
in ``plans/oracle.py`` (money as double, ids as bigint, dates as date).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import keys, money, scalars
from ..operators import aggs, joins, reshape
from ..sources.adapters import Adapters
from ..sources.tables import DRIVER_TABLES, load_tables
from . import fx, parts, reports

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Parameters of the driver runs (fixed values of this test set-up).
CLIENT_NOT_LIKE = "%MACHINERY%"
FX_CUTOFF = "2024-01-03"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _src(spark: SparkSession, sf_dir: str) -> Adapters:
    return Adapters(load_tables(spark, sf_dir))


def _t(spark, sf_dir):
    return load_tables(spark, sf_dir)


# ------------------------------------------------------------ sources, projection, filters
def _checksum(field) -> Column:
    """A whole number from a value: numbers as hundredths, texts and instants
    (their microseconds) by the first 32 bits of their MD5, arrays by their size."""
    c = F.col(field.name)
    kind = field.dataType.simpleString()
    if kind in ("int", "bigint"):
        return c.cast("bigint")
    if kind == "double":
        return F.round(c * 100).cast("bigint")
    if kind in ("timestamp_ntz", "string"):
        text = c if kind == "string" else F.unix_micros(c.cast("timestamp")).cast("string")
        return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return F.size(c).cast("bigint")


@query
def scan_tables(spark, sf_dir):
    """Rows of every table and a checksum over all its columns."""
    t = _t(spark, sf_dir)
    return reshape.union_all_by_name(*[
        t[name].agg(F.count(F.lit(1)).alias("n_rows"),
                    sum((F.coalesce(F.sum(_checksum(f)), F.lit(0)) for f in t[name].schema), F.lit(0)).alias("checksum"))
        .select(F.lit(name).alias("table_name"), "n_rows", "checksum") for name in DRIVER_TABLES])


@query
def project_alias(spark, sf_dir):
    o = _t(spark, sf_dir)["orders"]
    return o.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority").toDF(
        "project_id", "company_id", "created_at", "priority")


@query
def filter_status_in(spark, sf_dir):
    src = _src(spark, sf_dir)
    return parts.projects_with_status(src).select(F.col("id").alias("project_id"), "project_status")


@query
def filter_not_like(spark, sf_dir):
    c = _t(spark, sf_dir)["customer"]
    return (c.where(~F.col("c_mktsegment").like(CLIENT_NOT_LIKE) & (F.col("c_name") != "Customer#000000001"))
            .select("c_custkey", "c_name", "c_mktsegment"))


@query
def filter_nulls_active(spark, sf_dir):
    p = _src(spark, sf_dir).project
    return (p.where(F.col("archived_at").isNull() & F.col("deleted_at").isNull() & F.col("closed_at").isNotNull())
            .select(F.col("id").alias("project_id"), "created_at", "closed_at"))


@query
def mask_by_status(spark, sf_dir):
    """Published documents show heading, author and whole text; others only a
    heading with a suffix."""
    t = _t(spark, sf_dir)
    d = t["documents"].select("doc_id", "text", "source")
    lab = t["labels"].select(F.col("doc_id").alias("_l_doc"), "quality")
    rows = d.join(lab, F.col("doc_id") == F.col("_l_doc"), "left")
    published = F.col("quality") == 1
    title = F.concat(F.lit("Document "), F.col("doc_id").cast("string"))
    return rows.select(
        "doc_id",
        F.when(published, F.lit("published")).otherwise(F.lit("unpublished")).alias("status"),
        F.when(published, title).otherwise(F.concat(title, F.lit(" - Publishing temporarily disabled")))
         .alias("heading"),
        F.when(published, F.col("source")).alias("author"),
        F.when(published, F.col("text")).alias("body"))


# ------------------------------------------------------------ joins
@query
def join_left_dim(spark, sf_dir):
    t = _t(spark, sf_dir)
    n = t["nation"].select("n_nationkey", "n_name", "n_regionkey")
    r = t["region"].select("r_regionkey", "r_name")
    return (t["customer"].join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .select("c_custkey", "c_name", "n_name", "r_name"))


@query
def join_left_null_reject(spark, sf_dir):
    t = _t(spark, sf_dir)
    li = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    return (t["orders"].join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .where(F.col("l_returnflag") == "R")
            .select("o_orderkey", "o_orderdate", "l_linenumber", "l_partkey"))


@query
def join_left_multi_key(spark, sf_dir):
    src = _src(spark, sf_dir)
    w = src.wave.select(F.col("id").alias("wave_found"), F.col("project_id").alias("_w_pid"))
    tl = src.time_log.select("id", "project_id", "project_product_group_id")
    return tl.join(w, (F.col("project_id") == F.col("_w_pid"))
                   & (F.col("project_product_group_id") == F.col("wave_found")), "left").drop("_w_pid")


@query
def wave_key_join(spark, sf_dir):
    src = _src(spark, sf_dir)
    s = (src.sales_line.groupBy(F.col("project_id").alias("_s_pid"), F.col("project_product_group_id").alias("_s_wid"))
         .agg(F.count(F.lit(1)).alias("n_lines")))
    w = src.wave
    return (w.join(s, (F.col("project_id") == F.col("_s_pid")) & (F.col("id") == F.col("_s_wid")), "left")
            .select(keys.wave_key(F.col("project_id"), F.col("id")).alias("project_wave_id"), "n_lines"))


@query
def join_preagg(spark, sf_dir):
    src = _src(spark, sf_dir)
    s = (src.sales_line.groupBy(F.col("project_id").alias("_s_pid"))
         .agg(F.sum(F.col("quantity") * F.col("unit_price")).alias("_c"), F.count(F.lit(1)).alias("n_lines")))
    return (src.project.join(s, F.col("id") == F.col("_s_pid"), "left")
            .select(F.col("id").alias("project_id"), "project_status_id",
                    money.as_money(money.to_units(F.col("_c"))).alias("revenue"), "n_lines"))


@query
def join_dim_roles(spark, sf_dir):
    t = _t(spark, sf_dir)
    cn = joins.role(t["nation"], "cust", ["n_nationkey", "n_name"])
    sn = joins.role(t["nation"], "supp", ["n_nationkey", "n_name"])
    c = t["customer"].select("c_custkey", "c_nationkey")
    s = t["supplier"].select("s_suppkey", "s_nationkey")
    o = t["orders"].select("o_orderkey", "o_custkey")
    li = t["lineitem"].select("l_orderkey", "l_suppkey")
    rows = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(c, F.col("o_custkey") == F.col("c_custkey"))
            .join(s, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(cn, F.col("c_nationkey") == F.col("cust_n_nationkey"), "left")
            .join(sn, F.col("s_nationkey") == F.col("supp_n_nationkey"), "left"))
    return (rows.groupBy(F.col("cust_n_name").alias("customer_nation"), F.col("supp_n_name").alias("supplier_nation"))
            .agg(F.count(F.lit(1)).alias("n_lines")))


@query
def hier_parent(spark, sf_dir):
    h = joins.company_hierarchy(_src(spark, sf_dir).company)
    return h.select("company_id", F.col("parent_name").alias("client_managing_company"))


@query
def hier_invoiced_by(spark, sf_dir):
    h = joins.company_hierarchy(_src(spark, sf_dir).company)
    return h.select("company_id", F.col("invoicer_name").alias("managing_office"))


@query
def eav_link(spark, sf_dir):
    src = _src(spark, sf_dir)
    link = joins.eav_link(src.omnibus_order, src.omnibus_order_item, src.billing_item,
                          src.billing_item_attribute, src.billing_item_attribute_value)
    return link.select("order_id", F.col("id").alias("billing_item_id"), "invoice_id")


@query
def join_many_to_many(spark, sf_dir):
    src = _src(spark, sf_dir)
    s = src.sales_line.select(F.col("project_id").alias("_s_pid"), F.col("id").alias("sales_line_id"),
                              "sales_product_id")
    w = src.wave.select(F.col("project_id"), F.col("id").alias("wave_id"))
    return joins.left_join_many(w, s, ["project_id"], ["_s_pid"]).drop("_s_pid")


@query
def join_chained_left(spark, sf_dir):
    src = _src(spark, sf_dir)
    s = src.sales_line.select(F.col("project_id").alias("_s_pid"), F.col("project_product_group_id").alias("_s_wid"),
                              F.col("sales_product_id").alias("product"))
    ip = src.invoice_product.select(F.col("invoice_id"), F.col("sales_product_id").alias("_ip_sp"), "total")
    w = src.wave.select(F.col("project_id"), F.col("id").alias("wave_id"))
    # lines of one invoice and product are added up before they meet the waves
    ip = ip.groupBy("invoice_id", "_ip_sp").agg(F.sum("total").alias("total"), F.count(F.lit(1)).alias("_n"))
    rows = w.join(joins.spread(s, "_s_wid", "_s_pid"),
                  (F.col("project_id") == F.col("_s_pid")) & (F.col("wave_id") == F.col("_s_wid")), "left")
    rows = joins.spread(rows, "project_id", "product").join(
        ip, (F.col("invoice_id") == F.col("project_id")) & (F.col("_ip_sp") == F.col("product")), "left")
    return (rows.groupBy("project_id", "wave_id", "product")
            .agg(money.as_money(money.to_units(F.sum("total"))).alias("invoice_total"),
                 F.coalesce(F.sum("_n"), F.lit(0)).alias("n_invoice_lines")))


# ------------------------------------------------------------ aggregation
@query
def distinct_rows(spark, sf_dir):
    return _t(spark, sf_dir)["lineitem"].select("l_orderkey", "l_linenumber").distinct()


@query
def sum_amounts(spark, sf_dir):
    s = _src(spark, sf_dir).sales_line
    return (s.groupBy("project_id")
            .agg(F.sum("quantity").alias("quantity"),
                 money.as_money(money.to_units(F.sum(F.col("quantity") * F.col("unit_price")))).alias("revenue")))


@query
def cost_eur_row_round(spark, sf_dir):
    c = _src(spark, sf_dir).cost_line
    eur = money.to_eur_cents(F.col("amount"), F.col("currency_id"), money.RATES_BY_ID_COST)
    return c.groupBy("project_id").agg(money.as_money(money.to_units(F.sum(eur))).alias("cost_amount_eur"))


@query
def sales_eur_sum_round(spark, sf_dir):
    s = parts.sales_by_wave_currency(_src(spark, sf_dir))
    return s.select("project_id", "wave_id", "currency_id", money.as_money(F.col("revenue")).alias("revenue"),
                    money.as_money(F.col("sales_amount_eur")).alias("sales_amount_eur"))


@query
def last_activity(spark, sf_dir):
    li = _t(spark, sf_dir)["lineitem"]
    return li.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_shipdate"))


@query
def group_concat_distinct(spark, sf_dir):
    t = _t(spark, sf_dir)
    rows = t["lineitem"].join(t["part"].select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.groupBy("l_orderkey").agg(aggs.group_concat_distinct(F.col("p_brand")).alias("brands"))


@query
def pick_one_row(spark, sf_dir):
    li = _t(spark, sf_dir)["lineitem"]
    return aggs.pick_one_row(li, ["l_orderkey"], ["l_partkey", "l_quantity", "l_shipdate"],
                             [F.count(F.lit(1)).alias("n_lines")])


@query
def time_rollup(spark, sf_dir):
    tl = _src(spark, sf_dir).time_log
    return aggs.time_rollup(tl, ["project_id"]).select("project_id", money.as_money(F.col("time_log")).alias("time_log"))


@query
def time_rollup_strict(spark, sf_dir):
    tl = _src(spark, sf_dir).omnibus_order_time_log
    return (aggs.time_rollup(tl, ["omnibus_order_id"], strict=True)
            .select("omnibus_order_id", money.as_money(F.col("time_log")).alias("time_log")))


@query
def duplicate_keys(spark, sf_dir):
    li = _t(spark, sf_dir)["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return aggs.duplicate_keys(li, ["l_orderkey", "l_linenumber"])


@query
def fanout_sum(spark, sf_dir):
    """Cost per project summed after a left join to its time logs: every cost
    counts once per time log (at least once), as the source queries do."""
    src = _src(spark, sf_dir)
    cost = src.cost_line.groupBy(F.col("project_id")).agg(F.sum("amount").alias("_amt"))
    tl = src.time_log.groupBy(F.col("project_id").alias("_t_pid")).agg(F.count(F.lit(1)).alias("_n"))
    rows = cost.join(tl, F.col("project_id") == F.col("_t_pid"), "left")
    return rows.select("project_id", money.as_money(
        money.to_units(F.col("_amt") * F.coalesce(F.col("_n"), F.lit(1)))).alias("cost_amount"))


@query
def sort_by_first(spark, sf_dir):
    i = _src(spark, sf_dir).invoice
    return (i.select(F.col("id").alias("invoice_id"), F.col("number").alias("invoice_number"),
                     money.as_money(money.to_units(F.col("total"))).alias("invoice_amount"))
            .orderBy(F.col("invoice_id").asc_nulls_first()))


@query
def cost_dump_union(spark, sf_dir):
    src = _src(spark, sf_dir)
    a = src.cost_line.select(F.col("project_id").alias("source_id"), F.lit("Project").alias("cost_center"),
                             money.as_money(money.to_units(F.col("amount"))).alias("cost_amount"))
    b = src.omnibus_order_cost.select(F.col("omnibus_order_id").alias("source_id"),
                                      F.lit("Answers").alias("cost_center"),
                                      money.as_money(money.to_units(F.col("amount"))).alias("cost_amount"))
    return reshape.union_all_by_name(a, b)


# ------------------------------------------------------------ FX
@query
def fx_unpivot(spark, sf_dir):
    return fx.long_rates(_src(spark, sf_dir).fx_wide)


def _weekly_on_rows(src) -> DataFrame:
    return fx.with_weekly_mean(src.fx_long.select(
        "date", "currency", money.to_units(F.col("rate_cents")).cast("double").alias("exchange_rate")))


@query
def fx_weekly_avg(spark, sf_dir):
    return _weekly_on_rows(_src(spark, sf_dir)).select("date", "currency", "exchange_rate", "week_nr", "weekly_avg")


@query
def fx_currency_name(spark, sf_dir):
    src = _src(spark, sf_dir)
    days = src.fx_long.select("date", "currency").distinct()
    names = src.currency.select(F.col("iso_code"), F.col("name").alias("currency_name"))
    return days.join(names, F.col("currency") == F.col("iso_code"), "inner").drop("iso_code")


@query
def fx_weekly_rates_since(spark, sf_dir):
    return fx.rates_since(_weekly_on_rows(_src(spark, sf_dir)), FX_CUTOFF)


@query
def fx_case_by_code(spark, sf_dir):
    src = _src(spark, sf_dir)
    cur = src.currency.select(F.col("id").alias("_cid"), "iso_code")
    s = src.sales_line.join(cur, F.col("currency_id") == F.col("_cid"), "left")
    amount = money.to_units(F.col("quantity") * F.col("unit_price"))
    return s.select("id", "iso_code", money.as_money(
        money.to_eur(amount, F.col("iso_code"), money.RATES_BY_CODE_SALES, digits=None)).alias("amount_eur"))


@query
def fx_case_by_id(spark, sf_dir):
    s = _src(spark, sf_dir).sales_line
    amount = money.to_units(F.col("quantity") * F.col("unit_price"))
    return s.select("id", "currency_id", money.as_money(
        money.to_eur(amount, F.col("currency_id"), money.RATES_BY_ID)).alias("amount_eur"))


@query
def fx_passthrough(spark, sf_dir):
    c = _src(spark, sf_dir).cost_line
    amount = money.to_units(F.col("amount"))
    return c.select("id", "currency_id", money.as_money(
        money.to_eur(amount, F.col("currency_id"), money.RATES_BY_ID_COST, on_unknown="passthrough"))
        .alias("amount_eur"))


def _fx_x2(src) -> DataFrame:
    return fx.weekly_average_table(src.fx_daily, src.currency)


@query
def fx_convert_sales(spark, sf_dir):
    """Sales per (week, currency) divided by that week's average rate."""
    src = _src(spark, sf_dir)
    cur = src.currency.select(F.col("id").alias("_cid"), F.col("iso_code").alias("currency_code"),
                              F.col("name").alias("sales_currency"))
    s = (src.sales_line.join(cur, F.col("currency_id") == F.col("_cid"), "left")
         .groupBy(keys.week_key(F.col("created_at")).alias("sales_week_nr"), "currency_code", "sales_currency")
         .agg(money.as_money(money.to_units(F.sum(F.col("quantity") * F.col("unit_price")))).alias("revenue")))
    rates = fx.rates_since(_fx_x2(src), FX_CUTOFF)
    r = rates.select(F.col("currency_code").alias("_rc"), F.col("week_nr").alias("_rw"), "rate_avg")
    out = s.join(r, (F.col("sales_week_nr") == F.col("_rw")) & (F.col("currency_code") == F.col("_rc")), "left")
    out = out.withColumn("rate_avg", F.when(F.col("sales_currency") == "Euro", F.lit(1.0)).otherwise(F.col("rate_avg")))
    return out.select("sales_week_nr", "currency_code", "sales_currency", "revenue", "rate_avg",
                      F.try_divide(F.col("revenue"), F.col("rate_avg")).alias("dc_sales_amount"))


@query
def fx_convert_two_roles(spark, sf_dir):
    """Invoice lines with both the sales and the invoice rate (two roles of
    one rate table)."""
    src = _src(spark, sf_dir)
    c1 = src.currency.select(F.col("id").alias("_c1"), F.col("iso_code").alias("currency_code"),
                             F.col("name").alias("sales_currency"))
    c2 = src.currency.select(F.col("id").alias("_c2"), F.col("iso_code").alias("invoice_currency_code"),
                             F.col("name").alias("invoice_currency"))
    s = src.sales_line.select(F.col("id").alias("_sl_id"), F.col("currency_id").alias("_s_cur"),
                              F.col("created_at").alias("_s_created"))
    ip = src.invoice_product.select("invoice_id", "project_sales_product_id", "total")
    i = src.invoice.select(F.col("id").alias("_i_id"), F.col("currency_id").alias("_i_cur"), "submit_date")
    rows = (ip.join(i, F.col("invoice_id") == F.col("_i_id"), "inner")
            .join(s, F.col("project_sales_product_id") == F.col("_sl_id"), "inner")
            .join(c1, F.col("_s_cur") == F.col("_c1"), "left")
            .join(c2, F.col("_i_cur") == F.col("_c2"), "left"))
    rows = (rows.groupBy("invoice_id", "project_sales_product_id", "currency_code", "sales_currency",
                         "invoice_currency_code", "invoice_currency",
                         keys.week_key(F.col("_s_created")).alias("sales_week_nr"),
                         keys.week_key(F.col("submit_date")).alias("invoice_week_nr"))
            .agg(money.as_money(money.to_units(F.sum("total"))).alias("invoice_amount")))
    rows = rows.withColumn("revenue", F.col("invoice_amount"))
    rates = fx.rates_since(_fx_x2(src), FX_CUTOFF)
    return reports.convert_two_roles(rows, rates)


# ------------------------------------------------------------ scalars
@query
def time_quarter_hours(spark, sf_dir):
    tl = _src(spark, sf_dir).time_log
    part = scalars.quarter_hours(F.col("minutes"))
    return tl.select("id", "minutes", part.alias("hour_part"),
                     (F.coalesce(F.col("hours").cast("double"), F.lit(0.0)) + F.coalesce(part, F.lit(0.0)))
                     .alias("total_time"))


@query
def account_manager_default(spark, sf_dir):
    src = _src(spark, sf_dir)
    u = src.user.select(F.col("id").alias("_uid"), "first_name", "last_name")
    return (src.company.join(u, F.col("responsible_account_manager_id") == F.col("_uid"), "left")
            .select(F.col("id").alias("company_id"),
                    scalars.account_manager(F.col("first_name"), F.col("last_name")).alias("account_manager")))


@query
def project_date_coalesce(spark, sf_dir):
    src = _src(spark, sf_dir)
    s = src.sales_line.groupBy(F.col("project_id").alias("_s_pid")).agg(F.max("created_at").alias("last_sales_date"))
    i = (src.project_invoice.join(src.invoice.select(F.col("id").alias("_iid"), "submit_date"),
                                  F.col("invoice_id") == F.col("_iid"))
         .groupBy(F.col("project_id").alias("_i_pid")).agg(F.min("submit_date").alias("submit_date")))
    p = src.project
    rows = (p.join(s, F.col("id") == F.col("_s_pid"), "left").join(i, F.col("id") == F.col("_i_pid"), "left"))
    return rows.select(F.col("id").alias("project_id"),
                       F.to_date(F.coalesce("submit_date", "last_sales_date", "closed_at", "created_at"))
                       .alias("project_date"))


@query
def fill_numeric_nulls(spark, sf_dir):
    tl = _src(spark, sf_dir).time_log.select("id", "hours", "minutes", "deleted_at")
    return scalars.fill_numeric_nulls(tl)


@query
def cast_numeric(spark, sf_dir):
    li = _t(spark, sf_dir)["lineitem"]
    return li.select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("quantity"),
                     scalars.to_double(F.col("l_linenumber")).alias("line_as_double"),
                     scalars.to_double(F.col("l_tax")).alias("tax"))


@query
def cast_dates(spark, sf_dir):
    o = _t(spark, sf_dir)["orders"]
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    bad = F.concat(F.lit("x"), text)
    return o.select("o_orderkey", scalars.to_day(F.col("o_orderdate")).alias("order_day"),
                    scalars.parse_timestamp(text).alias("parsed"),
                    scalars.parse_timestamp(bad).alias("parsed_bad"))


@query
def split_category(spark, sf_dir):
    p = _src(spark, sf_dir).product
    return p.select("id", scalars.product_category(F.col("name")).alias("product_category"),
                    scalars.product_sub_category(F.col("name")).alias("product_sub_category"))


@query
def time_text(spark, sf_dir):
    tl = _src(spark, sf_dir).time_log
    return tl.select("id", scalars.time_text(F.col("hours"), F.col("minutes")).alias("time_log"))


@query
def week_key(spark, sf_dir):
    o = _t(spark, sf_dir)["orders"]
    return o.select("o_orderkey", keys.week_key(F.col("o_orderdate")).alias("week_nr"))


# ------------------------------------------------------------ reports
@query
def report_project_master(spark, sf_dir):
    return reports.project_master(_src(spark, sf_dir))


@query
def report_sold_products(spark, sf_dir):
    return reports.sold_products(_src(spark, sf_dir), not_like=CLIENT_NOT_LIKE)


@query
def report_cost(spark, sf_dir):
    return reports.project_cost(_src(spark, sf_dir))


@query
def report_time(spark, sf_dir):
    return reports.project_time(_src(spark, sf_dir))


@query
def report_invoice_lines(spark, sf_dir):
    return reports.invoice_lines(_src(spark, sf_dir))


@query
def report_data_export(spark, sf_dir):
    return reports.data_export(_src(spark, sf_dir), not_like=CLIENT_NOT_LIKE)


@query
def report_project_summary(spark, sf_dir):
    return reports.project_summary(_src(spark, sf_dir))


@query
def report_cost_dump(spark, sf_dir):
    return reports.cost_dump(_src(spark, sf_dir))


@query
def report_accounting_dump(spark, sf_dir):
    return reports.accounting_dump(_src(spark, sf_dir))


@query
def report_extended_fx(spark, sf_dir):
    src = _src(spark, sf_dir)
    return reports.extended_export(src, _fx_x2(src), cutoff=FX_CUTOFF)


@query
def fx_table_wide(spark, sf_dir):
    return fx.wide_table(_src(spark, sf_dir).fx_wide)


@query
def fx_table_long(spark, sf_dir):
    return _fx_x2(_src(spark, sf_dir))
