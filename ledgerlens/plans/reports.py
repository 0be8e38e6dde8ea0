"""The reports R1-R11 as DataFrame functions of the source views.

``src`` is any object whose attributes are the source DataFrames (project,
company, sales_line, ...): ``sources.adapters.Adapters`` over the test tables,
or the real tables read through ``sources.tables.read_jdbc_table``.

Where the source database would return an arbitrary row for a non-grouped
column, the reports take the first row in ascending order of the picked
columns (NULLs first), all columns from that one row. Where several facts
of a project fan out against each other, each fact is reduced at its own
grain first and the fan-out is carried as a row count, so no group ever
materialises all its pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import keys, money, scalars
from ..operators import aggs
from ..operators.joins import company_hierarchy, join_codes, join_dim, left_join_many, spread
from . import parts
from .parts import ACTIVE_STATUSES

DEMO = "Demo Company"
TESTING = "%Testing%"


def _pick(df: DataFrame, group: list[str], picked: list[str], extra=()) -> DataFrame:
    return aggs.pick_one_row(df, group, picked, extra)


def _client_filter(name: Column, not_like: str, demo_name: str, case_insensitive: bool = False) -> Column:
    """``name NOT LIKE pattern AND name <> demo``; NULL names fail both tests.

    ``case_insensitive`` compares under the UTF8_LCASE collation, as a source
    database with a case-insensitive collation would.
    """
    if case_insensitive:
        name = F.collate(name, "UTF8_LCASE")
    return (~name.like(not_like)) & (name != F.lit(demo_name))


# ---------------------------------------------------------------- R1
def project_master(src, statuses=ACTIVE_STATUSES, demo_name: str = DEMO) -> DataFrame:
    """Project master data: one row per project wave and client company."""
    p = (parts.projects_with_status(src, statuses).where(F.col("archived_at").isNull())
         .select(F.col("id").alias("project_id"), "project_status", "created_at", "closed_at",
                 "archived_at"))
    sold = src.sales_line.where(F.col("sales_product_id").isNotNull()).select(
        F.col("project_id").alias("_sp_pid"))
    p = p.join(sold, F.col("project_id") == F.col("_sp_pid"), "left_semi")

    c = src.company.select(F.col("id").alias("_cid"), F.col("name").alias("client_company"),
                           F.col("deleted_at").alias("_c_deleted"),
                           F.col("responsible_account_manager_id").alias("_ram"),
                           F.col("country_id").alias("_ccountry"))
    h = company_hierarchy(src.company, demo_name).select(
        F.col("company_id").alias("_hid"), F.col("parent_name").alias("client_managing_company"),
        F.col("invoicer_name").alias("managing_office"))
    u = src.user.select(F.col("id").alias("_uid"), "first_name", "last_name")
    cou = src.country.select(F.col("id").alias("_couid"), F.col("english_name").alias("client_country"))
    # the lookups of a client are made per company, not per project
    clients = join_codes(c.join(h, F.col("_cid") == F.col("_hid"), "left")
                         .join(u, F.col("_ram") == F.col("_uid"), "left"),
                         cou, F.col("_ccountry") == F.col("_couid"), "left")
    accounts = (src.project_account_view.select(F.col("project_id").alias("_pa_pid"), "company_id")
                .join(clients, F.col("company_id") == F.col("_cid"), "left"))
    rows = (left_join_many(p, accounts, ["project_id"], ["_pa_pid"], parts.project_ids(src))
            .where(F.col("_c_deleted").isNull())
            .select("project_id", "project_status", "client_company", "client_managing_company", "managing_office",
                    "client_country",
                    scalars.account_manager(F.col("first_name"), F.col("last_name")).alias("account_manager"),
                    "created_at", "closed_at", "archived_at"))
    # one row of each kind: rows and waves are made distinct before they meet,
    # since a project's wide rows are fewer than their copies for every wave
    rows = rows.distinct().join(parts.distinct_waves_or_none(src), F.col("project_id") == F.col("_w_pid"), "inner")
    return rows.select(
        "project_id",
        keys.wave_key(F.col("project_id"), F.col("wave_id")).alias("project_wave_id"),
        "project_status", "client_company", "client_managing_company", "managing_office",
        "client_country", "account_manager", "created_at", "closed_at", "archived_at")


def project_master_duplicate_waves(master: DataFrame) -> DataFrame:
    """Post-check of the master report: rows whose wave key occurs more than
    once (several client companies on one wave), every copy kept."""
    return aggs.duplicate_keys(master, ["project_wave_id"])


# ---------------------------------------------------------------- R2
def sold_products(src, statuses=ACTIVE_STATUSES, not_like: str = TESTING,
                  demo_name: str = DEMO, case_insensitive: bool = False) -> DataFrame:
    """Sold products: one row per project wave x sales line x translation."""
    p = parts.projects_with_status(src, statuses).select(F.col("id").alias("project_id"),
                                                         F.col("company_id").alias("_pcomp"))
    ccc = src.company.select(F.col("id").alias("_ccc_id"), F.col("name").alias("_ccc_name"))
    p = (p.join(ccc, F.col("_pcomp") == F.col("_ccc_id"), "inner")
         .where(_client_filter(F.col("_ccc_name"), not_like, demo_name, case_insensitive))
         .select("project_id"))
    spt = src.product.select(F.col("translatable_id").alias("_spt_tid"), F.col("name").alias("product"))
    cur = src.currency.select(F.col("id").alias("_cur_id"), F.col("iso_code").alias("currency"))
    cc = src.country.select(F.col("id").alias("_cc_id"), F.col("english_name").alias("target_country"))
    sp = (src.sales_line.where(F.col("sales_product_id").isNotNull())
          .select(F.col("project_id").alias("_sp_pid"), "sales_product_id", "quantity", "unit_price",
                  "currency_id", "country_id", "created_at", "updated_at")
          .join(spt, F.col("sales_product_id") == F.col("_spt_tid"), "left")
          .join(cur, F.col("currency_id") == F.col("_cur_id"), "left")
          .join(cc, F.col("country_id") == F.col("_cc_id"), "left"))
    # everything that depends on the sales line only is computed once per
    # line, before the line is repeated for every wave of its project
    amount = money.to_units(F.col("quantity") * F.col("unit_price"))
    sp = sp.select(
        "_sp_pid", "sales_product_id", "product",
        scalars.product_category(F.col("product")).alias("product_category"),
        scalars.product_sub_category(F.col("product")).alias("product_sub_category"),
        money.as_money(money.to_units(F.col("unit_price"))).alias("unit_price"),
        "currency",
        money.as_money(money.to_eur(amount, F.col("currency"), money.RATES_BY_CODE_SALES,
                                    digits=None)).alias("product_amount_eur"),
        money.as_money(amount).alias("original_product_amount"),
        "target_country", "created_at", "updated_at")
    rows = parts.with_waves(p.join(sp, F.col("project_id") == F.col("_sp_pid"), "inner"), src)
    return rows.select(
        "project_id",
        keys.wave_key(F.col("project_id"), F.col("wave_id")).alias("project_wave_id"),
        "sales_product_id", "product", "product_category", "product_sub_category", "unit_price", "currency",
        "product_amount_eur", "original_product_amount", "target_country", "created_at", "updated_at",
    )


# ---------------------------------------------------------------- R3
def project_cost(src) -> DataFrame:
    """One row per project cost (and cost-type translation)."""
    cur = src.currency.select(F.col("id").alias("_cur_id"), "iso_code")
    ctt = src.cost_type_translation.select(F.col("translatable_id").alias("_ct_id"),
                                           F.col("name").alias("cost_type"))
    u = src.user.select(F.col("id").alias("_uid"), "first_name", "last_name")
    rows = (src.cost_line.join(cur, F.col("currency_id") == F.col("_cur_id"), "left")
            .join(ctt, F.col("cost_type_id") == F.col("_ct_id"), "left")
            .join(u, F.col("created_by_user_id") == F.col("_uid"), "left"))
    amount = money.to_units(F.col("amount"))
    return rows.select(
        "id", "project_id", "cost_type", "iso_code",
        money.as_money(amount).alias("original_amount"),
        money.as_money(money.to_eur(amount, F.col("iso_code"), money.RATES_BY_CODE_COST,
                                    digits=None)).alias("cost_amount_eur"),
        scalars.full_name(F.col("first_name"), F.col("last_name")).alias("created_by_user"),
        "created_at", F.col("cost_type_id").alias("project_cost_type_id"),
    )


# ---------------------------------------------------------------- R4
def project_time(src) -> DataFrame:
    """One row per time log (deleted ones included); NULL hours count as 0."""
    u = src.user.select(F.col("id").alias("_uid"), "first_name", "last_name")
    rows = src.time_log.join(u, F.col("user_id") == F.col("_uid"), "left")
    hours = F.coalesce(F.col("hours").cast("double"), F.lit(0.0))
    part = F.coalesce(scalars.quarter_hours(F.col("minutes")), F.lit(0.0))
    return rows.select(
        "id", "project_id", hours.alias("hours"), part.alias("hour_part"), "created_at", "deleted_at",
        scalars.full_name(F.col("first_name"), F.col("last_name")).alias("created_by_user"),
        (hours + part).alias("total_time"),
    )


# ---------------------------------------------------------------- R5
def invoice_lines(src, sort: bool = False) -> DataFrame:
    """Invoice lines per project; status joined on the translation row id.

    ``sort``: order by project id (for a human-facing file; a table has no
    row order, and a global sort costs a sampling pass plus a range shuffle).
    """
    p = src.project.select(F.col("id").alias("project_id"), "project_code")
    pi = src.project_invoice.select(F.col("project_id").alias("_pi_pid"), F.col("invoice_id").alias("_pi_iid"))
    i = src.invoice.select(F.col("id").alias("invoice_id"), F.col("number").alias("invoice_number"),
                           "invoice_status_id")
    ip = (src.invoice_product.where(F.col("total").isNotNull())
          .select(F.col("invoice_id").alias("_ip_iid"), F.col("total").alias("_ip_total"),
                  "quantity", F.col("unit_price").alias("_ip_price"),
                  F.col("invoice_product_code_id").alias("_code_id")))
    ipc = src.invoice_product_code.select(F.col("id").alias("_ipc_id"), "code", "description")
    ist = src.invoice_status_translation.select(F.col("id").alias("_ist_id"),
                                                F.col("name").alias("invoice_status"))
    bridge = src.sales_product_invoice_product_code.select(
        F.col("invoice_product_code_id").alias("_br_code"), F.col("sales_product_id").alias("_br_sp"))
    spt = src.product.select(F.col("translatable_id").alias("_spt_tid"),
                             F.col("name").alias("sales_product_name"))
    rows = (p.join(pi, F.col("project_id") == F.col("_pi_pid"), "inner")
            .join(i, F.col("_pi_iid") == F.col("invoice_id"), "inner")
            .join(ip, F.col("invoice_id") == F.col("_ip_iid"), "inner")
            .join(ipc, F.col("_code_id") == F.col("_ipc_id"), "left"))
    rows = join_dim(rows, ist, F.col("invoice_status_id") == F.col("_ist_id"), "left")
    rows = (rows.join(bridge, F.col("_code_id") == F.col("_br_code"), "left")
            .join(spt, F.col("_br_sp") == F.col("_spt_tid"), "left"))
    rows = rows.select(
        "project_id", "project_code", "invoice_id", "invoice_number", "invoice_status",
        money.to_units(F.col("_ip_total")).alias("invoice_amount"), "quantity",
        money.to_units(F.col("_ip_price")).alias("unit_price"), "sales_product_name", "code",
        "description")
    group = ["project_id", "project_code", "invoice_id", "invoice_number", "invoice_status",
             "invoice_amount", "quantity", "unit_price", "sales_product_name", "code"]
    out = _pick(rows, group, ["description"])
    out = out.select(
        "project_id", "project_code", "invoice_id", "invoice_number", "invoice_status",
        F.coalesce(money.as_money(F.col("invoice_amount")), F.lit(0.0)).alias("invoice_amount"),
        F.coalesce(F.col("quantity").cast("double"), F.lit(0.0)).alias("quantity"),
        F.coalesce(money.as_money(F.col("unit_price")), F.lit(0.0)).alias("unit_price"),
        "sales_product_name", "code", "description")
    return out.orderBy(F.col("project_id").asc_nulls_first()) if sort else out


# ---------------------------------------------------------------- R6
def data_export(src, statuses=ACTIVE_STATUSES, not_like: str = TESTING,
                demo_name: str = DEMO, case_insensitive: bool = False) -> DataFrame:
    """Sales against invoices per project, wave, client, invoice and product."""
    p = parts.projects_with_status(src, statuses).select(F.col("id").alias("project_id"),
                                                         F.col("name").alias("project_name"))
    # client companies that pass the name filters
    c2 = src.company.select(F.col("id").alias("_c2_id"), F.col("name").alias("client_name"))
    clients = (src.project_account.join(c2, F.col("company_id") == F.col("_c2_id"), "inner")
               .where(_client_filter(F.col("client_name"), not_like, demo_name, case_insensitive))
               .select(F.col("project_id").alias("_cl_pid"), "client_name").distinct())
    # invoices of the project with number, status (by row id) and date
    i = src.invoice.select(F.col("id").alias("_i_id"), F.col("number").alias("invoice_number"),
                           "submit_date", "invoice_status_id")
    ist = src.invoice_status_translation.select(F.col("id").alias("_ist_id"),
                                                F.col("name").alias("invoice_status"))
    invs = (src.project_invoice.select(F.col("project_id").alias("_pi_pid"), "invoice_id")
            .join(i, F.col("invoice_id") == F.col("_i_id"), "left"))
    invs = join_dim(invs, ist, F.col("invoice_status_id") == F.col("_ist_id"), "left")
    invs = invs.select("_pi_pid", "invoice_id", "invoice_number", "invoice_status", "submit_date").distinct()
    # invoice lines per (invoice, project code, product); currency 12 converted
    ipl = src.invoice_product.select(
        F.col("invoice_id").alias("_ip_iid"), "project_code", F.col("sales_product_id").alias("_ip_sp"),
        F.col("currency_id").alias("invoice_currency"), F.col("deleted_at").alias("_ip_deleted"),
        F.col("total"))
    ipa = _pick(ipl, ["_ip_iid", "project_code", "_ip_sp"], ["invoice_currency", "_ip_deleted"],
                [F.sum("total").alias("_ip_sum")])
    ip_units = money.to_units(F.col("_ip_sum"))
    ipa = ipa.select("_ip_iid", "project_code", "_ip_sp", "invoice_currency", "_ip_deleted",
                     F.when(F.col("invoice_currency") == 12,
                            F.round(ip_units * money.rate_of(F.lit(12), money.RATES_BY_ID), 2))
                     .otherwise(ip_units).alias("invoice_amount"))
    # sales per (project, sold product), converted after summing: the products
    # of a project and their amounts come from one read of the sales lines
    ta = (src.sales_line.where(F.col("sales_product_id").isNotNull())
          .groupBy(F.col("project_id").alias("_ta_pid"), "sales_product_id")
          .agg(aggs.first_null_first(F.col("currency_id")).alias("currency_id"),
               F.sum(F.col("quantity") * F.col("unit_price")).alias("_ta_sum")))
    ta = ta.select("_ta_pid", "sales_product_id", F.col("currency_id").alias("sales_currency"),
                   money.to_eur(money.to_units(F.col("_ta_sum")), F.col("currency_id"),
                                money.RATES_BY_ID).alias("sales_amount"))
    spt = src.product.select(F.col("translatable_id").alias("_spt_tid"), F.col("name").alias("product")).distinct()
    # the first time-log text of each wave
    tl = src.time_log.select(F.col("project_id").alias("_tl_pid"),
                             F.col("project_product_group_id").alias("_tl_wid"),
                             scalars.time_text(F.col("hours"), F.col("minutes")).alias("time_log"))
    tl = _pick(tl, ["_tl_pid", "_tl_wid"], ["time_log"])
    wv = parts.waves_or_none(src).join(tl, (F.col("_w_pid") == F.col("_tl_pid")) & (F.col("wave_id") == F.col("_tl_wid")),
                                       "left").select("_w_pid", "wave_id", "time_log")

    # invoice x product lines of the project, then the per-line lookups
    lines = p.join(ta, F.col("project_id") == F.col("_ta_pid"), "inner")
    lines = (left_join_many(lines, invs, ["project_id"], ["_pi_pid"], parts.project_ids(src))
             .join(ipa, (F.col("invoice_id") == F.col("_ip_iid")) & (F.col("sales_product_id") == F.col("_ip_sp")),
                   "left")
             .where(F.col("_ip_deleted").isNull())
             .join(spt, F.col("sales_product_id") == F.col("_spt_tid"), "left"))
    rows = (lines.join(clients, F.col("project_id") == F.col("_cl_pid"), "inner")
            .join(wv, F.col("project_id") == F.col("_w_pid"), "inner"))
    rows = rows.select("project_id", keys.wave_key(F.col("project_id"), F.col("wave_id")).alias("project_wave_id"),
                       "project_name", "client_name", "invoice_id", "invoice_number", "invoice_status",
                       "submit_date", "project_code", "sales_product_id", "product", "invoice_currency",
                       "sales_amount", "invoice_amount", "sales_currency", "time_log")
    # Every input above is distinct on its join keys (products, clients,
    # invoices, translations de-duplicated; invoice lines, sales and time logs
    # reduced per key), so the rows are already one per group of the report's
    # twelve keys and the picked columns need no further aggregation.
    group = ["project_id", "project_wave_id", "project_name", "client_name", "invoice_id", "invoice_number",
             "invoice_status", "submit_date", "project_code", "sales_product_id", "product", "invoice_currency"]
    out = rows
    return out.select(*group[:7], F.to_date("submit_date").alias("submit_date"), *group[8:],
                      money.as_money(F.col("sales_amount")).alias("sales_amount"),
                      money.as_money(F.col("invoice_amount")).alias("invoice_amount"),
                      "sales_currency", "time_log")


# ---------------------------------------------------------------- R7
SUMMARY_COLUMNS = [
    "project_id", "project_wave_id", "client_managing_company", "managing_office", "managing_company",
    "account_manager", "project_name", "client", "revenue", "sales_amount_eur", "sales_currency",
    "invoice_amount", "invoice_amount_eur", "invoice_currency", "cost_amount", "cost_amount_eur",
    "cost_currency", "time_log", "invoice_status", "invoice_number", "submit_date",
    "project_close_date", "last_sales_date", "project_date", "project_status",
]


def _live_projects(src) -> DataFrame:
    """Projects neither archived nor deleted, with owner company, its account
    manager and the status name."""
    st = src.project_status.select(F.col("id").alias("_st_id"), F.col("name").alias("project_status"))
    c1 = src.company.select(F.col("id").alias("_c1_id"), F.col("name").alias("managing_company"),
                            F.col("responsible_account_manager_id").alias("_ram"))
    u = src.user.select(F.col("id").alias("_uid"), "first_name", "last_name")
    p = (src.project.where(F.col("archived_at").isNull() & F.col("deleted_at").isNull())
         .select(F.col("id").alias("project_id"), F.col("name").alias("project_name"), "project_code",
                 "company_id", "project_status_id", "created_at", F.col("closed_at").alias("project_close_date")))
    p = join_codes(p, st, F.col("project_status_id") == F.col("_st_id"), "left")
    # the manager is looked up per company, not per project
    owner = c1.join(u, F.col("_ram") == F.col("_uid"), "left")
    return (p.join(owner, F.col("company_id") == F.col("_c1_id"), "left")
            .withColumn("account_manager", scalars.account_manager(F.col("first_name"), F.col("last_name"))))


def _on_wave(left: DataFrame, right: DataFrame, rp: str, rw: str) -> Column:
    return (left["project_id"] == right[rp]) & (left["wave_id"] == right[rw])


def project_summary(src, demo_name: str = DEMO) -> DataFrame:
    """One line per project wave, client hierarchy and sales currency."""
    p = _live_projects(src)
    cg = parts.client_groups(src, demo_name).withColumnRenamed("project_id", "_cg_pid").drop("n_accounts")
    # sales rows of a wave that agree on (revenue, EUR value, currency name)
    # form one report line; its picked last sale date is the earliest
    sales = (parts.sales_by_wave_currency(src)
             .groupBy(F.col("project_id").alias("_s_pid"), F.col("wave_id").alias("_s_wid"), "revenue",
                      "sales_amount_eur", "sales_currency")
             .agg(aggs.first_null_first(F.col("last_sales_date")).alias("last_sales_date")))
    ad = parts.invoice_headers_by_wave(src, with_eur=True)
    ad = _pick(ad.select(F.col("project_id").alias("_a_pid"), F.col("wave_id").alias("_a_wid"),
                         "invoice_amount", "invoice_amount_eur", "invoice_currency", "invoice_status",
                         "invoice_number", "submit_date"),
               ["_a_pid", "_a_wid"],
               ["invoice_amount", "invoice_amount_eur", "invoice_currency", "invoice_status",
                "invoice_number", "submit_date"])
    pc = parts.cost_by_wave(src).withColumnsRenamed({"project_id": "_c_pid", "wave_id": "_c_wid"})
    ptl = parts.time_by_wave(src).withColumnsRenamed({"project_id": "_t_pid", "wave_id": "_t_wid"})

    # project-level spine (projects, client groups) expanded to waves once;
    # every wave-grain piece then joins on the same (project_id, wave_id) key
    # set, so the spine keeps its partitioning from one join to the next
    spine = parts.with_waves(p.join(cg, F.col("project_id") == F.col("_cg_pid"), "left"), src)
    rows = parts.join_on_wave(spine, [(sales, "_s_pid", "_s_wid"), (ad, "_a_pid", "_a_wid"),
                                      (pc, "_c_pid", "_c_wid"), (ptl, "_t_pid", "_t_wid")])
    rows = rows.select(
        "project_id", "wave_id", keys.wave_key(F.col("project_id"), F.col("wave_id")).alias("project_wave_id"),
        "client_managing_company", "managing_office", "managing_company", "account_manager",
        "project_name", "client", "revenue", "sales_amount_eur", "sales_currency",
        "invoice_amount", "invoice_amount_eur", "invoice_currency", "cost_amount", "cost_amount_eur",
        "cost_currency", "time_log", "invoice_status", "invoice_number", "submit_date",
        "project_close_date", "last_sales_date",
        F.coalesce("submit_date", "last_sales_date", "project_close_date", "created_at").alias("project_date"),
        "project_status")
    # one row per project, client group, wave and sales line already: every
    # joined piece is unique on its keys, so no final aggregation is needed
    out = rows
    money_cols = {"revenue", "sales_amount_eur", "invoice_amount", "invoice_amount_eur", "cost_amount",
                  "cost_amount_eur", "time_log"}
    date_cols = {"submit_date", "project_date", "last_sales_date", "project_close_date"}
    return out.select(*[money.as_money(F.col(c)).alias(c) if c in money_cols
                        else F.to_date(c).alias(c) if c in date_cols else F.col(c)
                        for c in SUMMARY_COLUMNS])


# ---------------------------------------------------------------- R8 / R9
DUMP_COLUMNS = [
    "project_id", "project_cost_id", "cost_center", "managing_company", "project_name", "project_code",
    "client", "invoiced_company", "invoice_date", "invoice_number", "invoice_status", "invoice_amount",
    "cost_amount", "cost_currency", "cost_amount_eur", "cost_comment", "cost_type", "time_log",
]


def _invoice_groups(src) -> DataFrame:
    """Invoice headers per wave (distinct on number, date, buyer, amount,
    project code), one status code each, plus the buyer company's name; R8 and
    R10 read them."""
    return parts.shared(src, "invoice_groups", lambda: _build_invoice_groups(src))


def _build_invoice_groups(src) -> DataFrame:
    rows = parts.invoice_header_rows(src)
    rows = rows.select("project_id", "wave_id", "invoice_number", "submit_date", "buyer_company_id",
                       money.to_units(F.col("total")).alias("invoice_amount"), "project_code",
                       "status_code")
    ad = _pick(rows, ["project_id", "wave_id", "invoice_number", "submit_date", "buyer_company_id",
                      "invoice_amount", "project_code"], ["status_code"])
    c2 = parts.company_names(src, "invoiced_company")
    return ad.join(c2, F.col("buyer_company_id") == F.col("_invoiced_company_id"), "left")


def project_cost_dump(src) -> DataFrame:
    """Cost dump of projects (R8). Amounts are summed over the report's join
    fan-out (accounts x costs x invoices), as the source query does; the
    fan-out is carried as counts instead of materialised rows."""
    p = _live_projects_all(src)
    cl = parts.clients_per_project(src)
    ctt = src.cost_type_translation.select(F.col("translatable_id").alias("_ct_id"),
                                           F.col("name").alias("cost_type"))
    cur = src.currency.select(F.col("id").alias("_cur_id"), F.col("name").alias("cost_currency"))
    pc = (src.cost_line.join(cur, F.col("currency_id") == F.col("_cur_id"), "left")
          .join(ctt, F.col("cost_type_id") == F.col("_ct_id"), "left")
          .select(F.col("project_id").alias("_pc_pid"), F.col("project_product_group_id").alias("_pc_wid"),
                  "amount", "cost_currency", "currency_id", F.col("comment").alias("cost_comment"),
                  "cost_type"))
    pcg = _pick(pc, ["_pc_pid", "_pc_wid", "amount", "cost_currency"], ["cost_comment", "cost_type"],
                [F.count(F.lit(1)).alias("n_pc"), F.min("currency_id").alias("_rate_cur")])
    ad = _invoice_groups(src)
    adg = _pick(ad.select(F.col("project_id").alias("_a_pid"), F.col("wave_id").alias("_a_wid"),
                          "invoiced_company", "submit_date", "invoice_number", "invoice_amount",
                          "status_code"),
                ["_a_pid", "_a_wid", "invoiced_company", "submit_date", "invoice_number", "invoice_amount"],
                ["status_code"], [F.count(F.lit(1)).alias("n_ad")])
    adg = parts.with_status_name(adg, src)
    ptl = parts.time_by_wave(src).withColumnsRenamed({"project_id": "_t_pid", "wave_id": "_t_wid"})

    spine = parts.with_waves(p.join(cl, F.col("project_id") == F.col("_cl_pid"), "left"), src)
    rows = parts.join_on_wave(spine, [(pcg, "_pc_pid", "_pc_wid"), (adg, "_a_pid", "_a_wid"),
                                      (ptl, "_t_pid", "_t_wid")])
    mult = [F.coalesce(F.col(n), F.lit(1)) for n in ("n_accounts", "n_pc", "n_ad")]
    eur = money.product_eur(F.col("amount"), mult, F.col("_rate_cur"), money.RATES_BY_ID_COST)
    out = rows.select(
        "project_id", keys.wave_key(F.col("project_id"), F.col("wave_id")).alias("project_cost_id"),
        F.lit("Project").alias("cost_center"), "managing_company", "project_name", "project_code", "client",
        "invoiced_company", F.to_date("submit_date").alias("invoice_date"), "invoice_number",
        "invoice_status", money.as_money(F.col("invoice_amount")).alias("invoice_amount"),
        money.as_money(money.to_units(F.col("amount"))).alias("cost_amount"), "cost_currency",
        money.as_money(eur).alias("cost_amount_eur"), "cost_comment", "cost_type",
        money.as_money(F.col("time_log")).alias("time_log"))
    return out


def _live_projects_all(src) -> DataFrame:
    """Every project with its owner company name (no status or archive filter)."""
    c1 = src.company.select(F.col("id").alias("_c1_id"), F.col("name").alias("managing_company"))
    p = src.project.select(F.col("id").alias("project_id"), F.col("name").alias("project_name"),
                           "project_code", "company_id")
    return p.join(c1, F.col("company_id") == F.col("_c1_id"), "left")


def omnibus_cost_dump(src) -> DataFrame:
    """Cost dump of omnibus orders (R9), same columns as R8.

    Cost and hours are summed over the join fan-out (costs x billing links x
    time logs) as the source query does, carried as counts. Currencies
    outside the rate table (EUR included) keep the unconverted single amount.
    """
    from ..operators.joins import eav_link

    c = parts.company_names(src, "managing_company")
    cc = parts.company_names(src, "client")
    oo = (src.omnibus_order.where(F.col("archived_at").isNull())
          .select(F.col("id").alias("project_id"), F.col("name").alias("project_name"),
                  "managing_company_id", "company_id")
          .join(c, F.col("managing_company_id") == F.col("_managing_company_id"), "left")
          .join(cc, F.col("company_id") == F.col("_client_id"), "left"))
    cur = src.currency.select(F.col("id").alias("_cur_id"), F.col("name").alias("cost_currency"))
    ctt = src.cost_type_translation.select(F.col("translatable_id").alias("_ct_id"),
                                           F.col("name").alias("cost_type"))
    ooc = (src.omnibus_order_cost.join(cur, F.col("currency_id") == F.col("_cur_id"), "left")
           .join(ctt, F.col("cost_type_id") == F.col("_ct_id"), "left")
           .select(F.col("omnibus_order_id").alias("_oc_oid"), "amount", "currency_id", "cost_currency",
                   F.col("comment").alias("cost_comment"), "cost_type"))
    oocg = _pick(ooc, ["_oc_oid", "amount", "cost_comment", "cost_type"], ["cost_currency", "currency_id"],
                 [F.count(F.lit(1)).alias("n_oc")])
    link = eav_link(src.omnibus_order, src.omnibus_order_item, src.billing_item,
                    src.billing_item_attribute, src.billing_item_attribute_value)
    i = src.invoice.select(F.col("id").alias("_i_id"), "submit_date", F.col("number").alias("invoice_number"),
                           "invoice_status_id", "grand_total", "buyer_company_id")
    ist = src.invoice_status_translation.select(F.col("translatable_id").alias("_ist_id"),
                                                F.col("name").alias("invoice_status"))
    c4 = parts.company_names(src, "invoiced_company")
    inv = (link.select(F.col("order_id").alias("_l_oid"), "invoice_id")
           .join(i, F.col("invoice_id") == F.col("_i_id"), "left"))
    inv = join_dim(inv, ist, F.col("invoice_status_id") == F.col("_ist_id"), "left")
    inv = inv.join(c4, F.col("buyer_company_id") == F.col("_invoiced_company_id"), "left")
    invg = (inv.groupBy("_l_oid", "invoiced_company", "submit_date", "invoice_number", "invoice_status",
                        "grand_total").agg(F.count(F.lit(1)).alias("n_link")))
    tl = (src.omnibus_order_time_log.groupBy(F.col("omnibus_order_id").alias("_tl_oid"))
          .agg(F.count(F.lit(1)).alias("n_tl"), F.sum("hours").alias("_h"), F.sum("minutes").alias("_m")))

    orders = src.omnibus_order.select("id")
    rows = left_join_many(oo, oocg, ["project_id"], ["_oc_oid"], orders)
    rows = (left_join_many(rows, invg, ["project_id"], ["_l_oid"], orders)
            .join(tl, F.col("project_id") == F.col("_tl_oid"), "left"))
    n_oc = F.coalesce(F.col("n_oc"), F.lit(1))
    n_link = F.coalesce(F.col("n_link"), F.lit(1))
    n_tl = F.coalesce(F.col("n_tl"), F.lit(1))
    amount = money.to_units(F.col("amount"))
    rates = {k: v for k, v in money.RATES_BY_ID_COST.items() if k != money.EUR_ID}
    eur = money.product_eur(F.col("amount"), [n_oc, n_link, n_tl], F.col("currency_id"), rates)
    eur = F.when(F.array_contains(F.array(*[F.lit(k) for k in rates]), F.col("currency_id")), eur).otherwise(amount)
    hours = aggs.hours_from_sums(money.product(F.col("_h"), [n_oc, n_link]), money.product(F.col("_m"), [n_oc, n_link]),
                                 strict=True)
    return rows.select(
        "project_id", F.lit(None).cast("string").alias("project_cost_id"), F.lit("Answers").alias("cost_center"),
        "managing_company", "project_name",
        F.concat(F.lit("A"), F.col("project_id").cast("string")).alias("project_code"), "client",
        "invoiced_company", F.to_date("submit_date").alias("invoice_date"), "invoice_number", "invoice_status",
        money.as_money(money.to_units(F.col("grand_total"))).alias("invoice_amount"),
        money.as_money(amount).alias("cost_amount"), "cost_currency", money.as_money(eur).alias("cost_amount_eur"),
        "cost_comment", "cost_type", money.as_money(hours).alias("time_log"))


def cost_dump(src, sort: bool = False) -> DataFrame:
    """Project and omnibus cost dumps in one table (R8 ∪ R9)."""
    r8 = project_cost_dump(src)
    if sort:
        r8 = r8.orderBy(F.col("project_id").asc_nulls_first())
    return r8.unionByName(omnibus_cost_dump(src))


# ---------------------------------------------------------------- R10
ACCOUNTING_COLUMNS = [
    "project_id", "project_cost_id", "managing_company", "project_name", "client", "invoiced_company",
    "quantity", "unit_price", "total_sales", "product_name", "submit_date", "invoice_number",
    "invoice_status", "invoice_amount", "cost_amount", "cost_comment", "cost_type", "time_log",
]


def accounting_dump(src, sort: bool = False) -> DataFrame:
    """Accounting cost dump: per wave, cost line, sold product and invoice."""
    p = _live_projects_all(src)
    cl = parts.clients_per_project(src).drop("n_accounts")
    ctt = src.cost_type_translation.select(F.col("translatable_id").alias("_ct_id"),
                                           F.col("name").alias("cost_type"))
    pc = (src.cost_line.join(ctt, F.col("cost_type_id") == F.col("_ct_id"), "left")
          .select(F.col("project_id").alias("_pc_pid"), F.col("project_product_group_id").alias("_pc_wid"),
                  money.to_units(F.col("amount")).alias("cost_amount"),
                  F.col("comment").alias("cost_comment"), "cost_type").distinct())
    spt = src.product.select(F.col("translatable_id").alias("_spt_tid"), F.col("name").alias("product_name"))
    psp = (src.sales_line.join(spt, F.col("sales_product_id") == F.col("_spt_tid"), "left")
           .select(F.col("project_id").alias("_s_pid"), F.col("project_product_group_id").alias("_s_wid"),
                   "product_name", "quantity", "unit_price",
                   (F.col("quantity") * F.col("unit_price")).alias("_line")))
    psp2 = (psp.groupBy("_s_pid", "_s_wid", "product_name")
            .agg(aggs.first_null_first(F.col("unit_price")).alias("_price"), F.sum("quantity").alias("quantity"),
                 F.sum("_line").alias("_sales"))
            .select("_s_pid", "_s_wid", "product_name", "quantity",
                    money.to_units(F.col("_price")).alias("unit_price"),
                    money.to_units(F.col("_sales")).alias("total_sales")))
    ad = _invoice_groups(src)
    adg = _pick(ad.select(F.col("project_id").alias("_a_pid"), F.col("wave_id").alias("_a_wid"),
                          "invoiced_company", "submit_date", "invoice_number", "status_code",
                          "invoice_amount"),
                ["_a_pid", "_a_wid", "invoiced_company", "submit_date", "invoice_number", "status_code"],
                ["invoice_amount"])
    adg = parts.with_status_name(adg, src)
    ptl = parts.time_by_wave(src).withColumnsRenamed({"project_id": "_t_pid", "wave_id": "_t_wid"})
    spine = parts.with_waves(p.join(cl, F.col("project_id") == F.col("_cl_pid"), "left"), src)
    rows = parts.join_on_wave(spine, [(pc, "_pc_pid", "_pc_wid"), (psp2, "_s_pid", "_s_wid"),
                                      (adg, "_a_pid", "_a_wid"), (ptl, "_t_pid", "_t_wid")])
    out = rows.select(
        "project_id", keys.wave_key(F.col("project_id"), F.col("wave_id")).alias("project_cost_id"),
        "managing_company", "project_name", "client", "invoiced_company",
        F.col("quantity").cast("double").alias("quantity"), money.as_money(F.col("unit_price")).alias("unit_price"),
        money.as_money(F.col("total_sales")).alias("total_sales"), "product_name",
        F.to_date("submit_date").alias("submit_date"), "invoice_number", "invoice_status",
        money.as_money(F.col("invoice_amount")).alias("invoice_amount"),
        money.as_money(F.col("cost_amount")).alias("cost_amount"), "cost_comment", "cost_type",
        money.as_money(F.col("time_log")).alias("time_log"))
    return out.orderBy(F.col("project_id").asc_nulls_first()) if sort else out


# ---------------------------------------------------------------- R11
EXTENDED_COLUMNS = [
    "project_id", "project_wave_id", "client_managing_company", "managing_office", "managing_company",
    "project_name", "client", "product", "revenue", "sales_amount_eur", "sales_currency", "currency_code",
    "invoice_amount", "invoice_amount_eur", "invoice_currency", "invoice_currency_code", "cost_amount",
    "cost_amount_eur", "cost_currency", "time_log", "invoice_status", "invoice_number", "submit_date",
    "project_close_date", "last_sales_date", "project_date",
]


def _beside(left: DataFrame, left_keys: list[str], right: DataFrame, right_keys: list[str]) -> DataFrame:
    """``left`` with the columns of the one row that ``right`` has at most for
    its keys: a left join as a union and a window.

    A join by all keys would deal both sides anew; these stay where they are
    if they are dealt by some of the keys.
    """
    cols = [c for c in right.columns if c not in right_keys]
    beside = F.struct(*[F.col(c) for c in cols])
    found = right.dropna(subset=right_keys).select(
        *[F.col(r).alias(k) for r, k in zip(right_keys, left_keys)],
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in left.schema if f.name not in left_keys],
        beside.alias("_beside"), F.lit(False).alias("_left"))
    kind = found.schema["_beside"].dataType
    both = left.withColumns({"_beside": F.lit(None).cast(kind), "_left": F.lit(True)}).unionByName(found)
    both = both.withColumn("_beside", F.max("_beside").over(Window.partitionBy(*left_keys))).where("_left")
    return both.select(*left.columns, *[F.col(f"_beside.{c}").alias(c) for c in cols])


def extended_export_base(src, demo_name: str = DEMO) -> DataFrame:
    """The 26 columns of the extended export, per wave, client hierarchy,
    product and sales currency (before FX conversion)."""
    p = _live_projects(src)
    cg = parts.client_groups(src, demo_name).withColumnRenamed("project_id", "_cg_pid").drop("n_accounts")
    cur = src.currency.select(F.col("id").alias("_cur_id"), F.col("name").alias("sales_currency"),
                              F.col("iso_code").alias("currency_code"))
    spt = src.product.select(F.col("translatable_id").alias("_spt_tid"), F.col("name").alias("product"))
    s = (src.sales_line.join(spt, F.col("sales_product_id") == F.col("_spt_tid"), "left")
         .where(F.col("project_id").isNotNull() & F.col("project_product_group_id").isNotNull())
         .select(F.col("project_id").alias("_s_pid"), F.col("project_product_group_id").alias("_s_wid"),
                 "product", "currency_id", (F.col("quantity") * F.col("unit_price")).alias("_c"), "created_at"))
    # dealt by wave once, as the invoice lines below: both groupings, their meeting
    # by product and the join with the spine find their rows in place
    s = (spread(s, "_s_pid", "_s_wid").groupBy("_s_pid", "_s_wid", "product", "currency_id")
         .agg(F.sum("_c").alias("_sum"), F.max("created_at").alias("last_sales_date")))
    s = join_codes(s, cur, F.col("currency_id") == F.col("_cur_id"), "left")
    total = money.to_units(F.col("_sum"))
    s = s.select("_s_pid", "_s_wid", "product", "sales_currency", "currency_code", "last_sales_date",
                 total.alias("revenue"),
                 money.to_eur(total, F.col("currency_id"), money.RATES_BY_ID).alias("sales_amount_eur"))
    s = _pick(s, ["_s_pid", "_s_wid", "product", "sales_currency", "currency_code"],
              ["revenue", "sales_amount_eur", "last_sales_date"])

    # invoice amounts per wave and product (sum of line totals), one row picked
    rows = parts.invoice_header_rows(src)
    spt2 = src.product.select(F.col("translatable_id").alias("_spt2_tid"), F.col("name").alias("_a_product"))
    c4 = src.currency.select(F.col("id").alias("_c4_id"), F.col("name").alias("invoice_currency"),
                             F.col("iso_code").alias("invoice_currency_code"))
    rows = rows.join(spt2, F.col("sales_product_id") == F.col("_spt2_tid"), "left")
    rows = join_codes(rows, c4, F.col("currency_id") == F.col("_c4_id"), "left")
    rows = spread(rows, "project_id", "wave_id")
    ad = (rows.groupBy("invoice_number", "submit_date", "buyer_company_id", "project_code", "project_id", "wave_id",
                       "_a_product", "invoice_status", "invoice_currency", "invoice_currency_code", "currency_id")
          .agg(F.sum("_ip_total").alias("_ip_sum")))
    inv_units = money.to_units(F.col("_ip_sum"))
    ad = ad.select(F.col("project_id").alias("_a_pid"), F.col("wave_id").alias("_a_wid"), "_a_product",
                   inv_units.alias("invoice_amount"),
                   money.to_eur(inv_units, F.col("currency_id"), money.RATES_BY_ID).alias("invoice_amount_eur"),
                   "invoice_currency", "invoice_currency_code", "invoice_status", "invoice_number", "submit_date")
    ad = _pick(ad, ["_a_pid", "_a_wid", "_a_product"],
               ["invoice_amount", "invoice_amount_eur", "invoice_currency", "invoice_currency_code",
                "invoice_status", "invoice_number", "submit_date"])
    pc = parts.cost_by_wave(src).withColumnsRenamed({"project_id": "_c_pid", "wave_id": "_c_wid"})
    ptl = parts.time_by_wave(src).withColumnsRenamed({"project_id": "_t_pid", "wave_id": "_t_wid"})

    # sales and invoices meet per (wave, product) before the spine; NULL products do not meet
    sa = _beside(s, ["_s_pid", "_s_wid", "product"], ad, ["_a_pid", "_a_wid", "_a_product"])
    spine = parts.with_waves(p.join(cg, F.col("project_id") == F.col("_cg_pid"), "left"), src)
    rows = parts.join_on_wave(spine, [(sa, "_s_pid", "_s_wid"), (pc, "_c_pid", "_c_wid"),
                                      (ptl, "_t_pid", "_t_wid")])
    return rows.select(
        "project_id", keys.wave_key(F.col("project_id"), F.col("wave_id")).alias("project_wave_id"),
        "client_managing_company", "managing_office", "managing_company", "project_name", "client", "product",
        "revenue", "sales_amount_eur", "sales_currency", "currency_code", "invoice_amount",
        "invoice_amount_eur", "invoice_currency", "invoice_currency_code", "cost_amount", "cost_amount_eur",
        "cost_currency", "time_log", "invoice_status", "invoice_number", "submit_date", "project_close_date",
        "last_sales_date",
        F.coalesce("submit_date", "last_sales_date", "project_close_date", "created_at").alias("project_date"))


def extended_export(src, weekly_rates: DataFrame, cutoff: str = "2018-01-01",
                    demo_name: str = DEMO) -> DataFrame:
    """R11: extended export with sales and invoice amounts at weekly FX rates.

    ``weekly_rates`` is the long FX table (date, currency, weekly_avg, ...)
    written by ``plans.fx.weekly_average_table``.
    """
    from .fx import rates_since

    base = extended_export_base(src, demo_name)
    zero = ["revenue", "sales_amount_eur", "invoice_amount", "invoice_amount_eur", "cost_amount",
            "cost_amount_eur", "time_log"]
    dates = ["submit_date", "project_date", "last_sales_date", "project_close_date"]
    df = base.select(*[F.coalesce(money.as_money(F.col(c)), F.lit(0.0)).alias(c) if c in zero
                       else F.col(c).cast("timestamp_ntz").alias(c) if c in dates else F.col(c)
                       for c in EXTENDED_COLUMNS])
    df = df.select("*",
                   keys.week_key(F.col("last_sales_date")).alias("sales_week_nr"),
                   keys.week_key(F.col("submit_date")).alias("invoice_week_nr"),
                   keys.week_key(F.col("project_close_date")).alias("project_close_week_nr"),
                   keys.week_key(F.col("project_date")).alias("project_week_nr"))
    rates = rates_since(weekly_rates, cutoff)
    return convert_two_roles(df, rates)


def convert_two_roles(df: DataFrame, rates: DataFrame) -> DataFrame:
    """Join the weekly rate twice (sales week/code, invoice week/code); EUR
    rows get rate 1; amounts are divided by the rate (NULL when unknown)."""
    r1 = rates.select(F.col("currency_code").alias("_r1_code"), F.col("week_nr").alias("_r1_week"),
                      F.col("rate_avg").alias("_r1_rate"))
    r2 = rates.select(F.col("currency_code").alias("_r2_code"), F.col("week_nr").alias("_r2_week"),
                      F.col("rate_avg").alias("_r2_rate"))
    out = join_codes(df, r1, (F.col("sales_week_nr") == F.col("_r1_week"))
                     & (F.col("currency_code") == F.col("_r1_code")), "left")
    out = out.withColumn("rate_avg", F.when(F.col("sales_currency") == "Euro", F.lit(1.0))
                         .otherwise(F.col("_r1_rate")))
    out = out.withColumn("dc_sales_amount", F.try_divide(F.col("revenue"), F.col("rate_avg")))
    out = join_codes(out, r2, (F.col("invoice_week_nr") == F.col("_r2_week"))
                     & (F.col("invoice_currency_code") == F.col("_r2_code")), "left")
    out = out.withColumn("rate_avg_inv", F.when(F.col("invoice_currency") == "Euro", F.lit(1.0))
                         .otherwise(F.col("_r2_rate")))
    out = out.withColumn("dc_invoice_amount", F.try_divide(F.col("invoice_amount"), F.col("rate_avg_inv")))
    return out.drop("_r1_code", "_r1_week", "_r1_rate", "_r2_code", "_r2_week", "_r2_rate")
