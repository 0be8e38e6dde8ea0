"""Report semantics on hand-written fixtures (edge rows of FIXTURES.md)."""

import datetime as dt

from pyspark.sql import functions as F

from fixtures import CURRENCIES, STATUSES, T, Source
from ledgerlens.plans import reports
from conftest import rows

D = T(2021, 1, 1)


def _companies():
    # 1 owner; 2 and 3 clients of project 1 under parent 4 (invoiced by 5);
    # 6 deleted; 7 parent is the demo company
    return [(1, "Owner", None, None, 1, 1, None), (2, "Client B", 4, None, None, 1, None),
            (3, "Client A", 4, None, None, 1, None), (4, "Parent", None, 5, None, 1, None),
            (5, "Invoicer", None, None, None, 1, None), (6, "Gone", None, None, None, 1, T(2020, 1, 1)),
            (7, "UnderDemo", 8, None, None, 1, None), (8, "Demo Company", None, 5, None, 1, None),
            (9, "Acme Testing Ltd", None, None, None, 1, None)]


def test_project_master_filters_and_hierarchy(spark):
    src = Source(
        spark, project_status=STATUSES, company=_companies(),
        user=[(1, "Ann", "Lee")], country=[(1, "Lithuania")],
        project=[(10, 1, 1, "P10", "C-10", D, None, None, None),
                 (11, 1, 1, "P11", "C-11", D, None, None, None),     # only company deleted -> gone
                 (12, 5, 1, "P12", "C-12", D, None, None, None),     # cancelled
                 (13, 1, 1, "P13", "C-13", D, None, None, None)],    # nothing sold
        wave=[(100, 10), (101, 10), (110, 11)],
        project_account_view=[(10, 2), (10, 7), (11, 6), (12, 2)],
        sales_line=[(1, 10, 100, 5, 1, 100, 3, 1, D, D), (2, 11, 110, 5, 1, 100, 3, 1, D, D),
                    (3, 12, None, 5, 1, 100, 3, 1, D, D)])
    out = rows(reports.project_master(src).select("project_id", "project_wave_id", "client_company",
                                                  "client_managing_company", "managing_office",
                                                  "account_manager"))
    assert out == [(10, "10/100", "Client B", "Parent", "Invoicer", "No Account Manager"),
                   (10, "10/100", "UnderDemo", None, "Invoicer", "No Account Manager"),
                   (10, "10/101", "Client B", "Parent", "Invoicer", "No Account Manager"),
                   (10, "10/101", "UnderDemo", None, "Invoicer", "No Account Manager")]


def test_master_duplicate_waves(spark):
    src = Source(
        spark, project_status=STATUSES, company=_companies(),
        project=[(10, 1, 1, "P10", "C-10", D, None, None, None), (14, 1, 1, "P14", "C-14", D, None, None, None)],
        wave=[(100, 10), (140, 14)], project_account_view=[(10, 2), (10, 3), (14, 2)],
        sales_line=[(1, 10, 100, 5, 1, 100, 3, 1, D, D), (2, 14, 140, 5, 1, 100, 3, 1, D, D)])
    dup = reports.project_master_duplicate_waves(reports.project_master(src))
    assert sorted(r.client_company for r in dup.collect()) == ["Client A", "Client B"]


def test_sold_products_filters_client_names(spark):
    src = Source(
        spark, project_status=STATUSES, company=_companies(), currency=CURRENCIES,
        project=[(10, 1, 1, "P10", "C", D, None, None, None), (11, 1, 9, "P11", "C", D, None, None, None),
                 (12, 1, 8, "P12", "C", D, None, None, None)],
        wave=[(100, 10), (101, 10)],
        product=[(6, 5, "SMALL-Brand#1 - red bolt")],
        sales_line=[(1, 10, 100, 5, 3, 1001, 12, None, D, D), (2, 11, None, 5, 1, 100, 3, None, D, D),
                    (3, 12, None, 5, 1, 100, 3, None, D, D), (4, 10, 101, None, 1, 100, 3, None, D, D)])
    out = rows(reports.sold_products(src).select("project_wave_id", "product_category", "product_sub_category",
                                                 "currency", "original_product_amount", "product_amount_eur"))
    # one sales line x two waves; testing and demo clients, NULL product dropped; USD at 0.85, unrounded
    assert out == [("10/100", "SMALL", "red bolt", "USD", 30.03, 25.5255),
                   ("10/101", "SMALL", "red bolt", "USD", 30.03, 25.5255)]


def test_client_filter_case_insensitive_option(spark):
    comps = _companies() + [(10, "acme TESTING ltd", None, None, None, 1, None)]
    src = Source(
        spark, project_status=STATUSES, company=comps, currency=CURRENCIES,
        project=[(10, 1, 10, "P10", "C", D, None, None, None)], wave=[(100, 10)],
        product=[(6, 5, "SMALL-Brand#1 - red bolt")],
        sales_line=[(1, 10, 100, 5, 1, 100, 3, None, D, D)])
    assert reports.sold_products(src).count() == 1
    assert reports.sold_products(src, case_insensitive=True).count() == 0


def _dump_source(spark):
    return Source(
        spark, project_status=STATUSES, company=_companies(), currency=CURRENCIES, user=[(1, "Ann", None)],
        cost_type_translation=[(1, "Travel")],
        invoice_status_translation=[(1, 3, "Draft"), (2, 1, "Sent")],
        project=[(10, 1, 1, "P10", "C-10", D, None, None, None)],
        wave=[(100, 10)],
        project_account=[(10, 2), (10, 3)],
        sales_line=[(1000, 10, 100, 5, 2, 250, 12, None, T(2021, 1, 5), D)],
        # two identical costs of 5 cents in USD on the wave
        cost_line=[(1, 10, 100, 5, 12, 1, "x", 1, D), (2, 10, 100, 5, 12, 1, "y", 1, D)],
        time_log=[(1, 10, 100, None, 30, 1, D, None), (2, 10, 100, None, 15, 1, D, None)],
        invoice=[(7, "INV7", 1, T(2021, 2, 1), 1000, 1000, 3, 2), (8, "INV8", 2, T(2021, 2, 2), 500, 500, 12, 3)],
        invoice_product=[(7, 1000, 1, 5, 1000, 2, 500, 3, "A", None), (8, 1000, 1, 5, 500, 1, 500, 12, "A", None)],
        project_invoice=[(10, 7), (10, 8)],
        product=[(6, 5, "SMALL-Brand#1 - red bolt")])


def test_project_cost_dump_fanout_and_picks(spark):
    src = _dump_source(spark)
    out = rows(reports.project_cost_dump(src).select(
        "project_cost_id", "client", "invoice_number", "invoice_status", "cost_amount", "cost_amount_eur",
        "cost_comment", "time_log"))
    # per invoice group: 2 accounts x 2 equal costs x 1 invoice row = 4 rows of 5 cents
    # -> round(0.20 * 0.85, 2) = 0.17; comment is the first of (x, y); the status is
    # matched on the translation's translatable_id, which has no row for status 2
    assert out == [("10/100", "Client A/Client B", "INV7", "Sent", 0.05, 0.17, "x", 0.75),
                   ("10/100", "Client A/Client B", "INV8", None, 0.05, 0.17, "x", 0.75)]


def test_project_summary_picks_first_invoice(spark):
    src = _dump_source(spark)
    out = reports.project_summary(src).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.client, r.revenue, r.sales_amount_eur, r.sales_currency) == ("Client A/Client B", 5.0, 4.25, "US Dollar")
    # two invoices on the wave: the smaller invoice amount comes first
    assert (r.invoice_number, r.invoice_amount, r.invoice_amount_eur) == ("INV8", 5.0, 4.25)
    # costs converted per row: 2 x round(0.05 * 0.85, 2) = 0.08
    assert (r.cost_amount, r.cost_amount_eur, r.time_log) == (0.1, 0.08, 0.75)
    assert r.project_date == dt.date(2021, 2, 2) and r.managing_company == "Owner"
    assert r.client_managing_company == "Parent" and r.managing_office == "Invoicer"


def test_omnibus_dump_passthrough_and_fanout(spark):
    src = Source(
        spark, company=_companies(), currency=CURRENCIES, cost_type_translation=[(1, "Travel")],
        invoice_status_translation=[(4, 1, "Draft")],
        omnibus_order=[(1, "O1", 2, 1, None), (2, "O2", 2, 1, T(2020, 1, 1))],
        omnibus_order_cost=[(1, 1000, 12, 1, "c"), (1, 1000, 3, 1, "e"), (1, 700, 40, 1, "u")],
        omnibus_order_time_log=[(1, 1, 30), (1, 2, 0)],
        omnibus_order_item=[(55, 1)], billing_item=[(900, 7)],
        billing_item_attribute=[(1, "omnibus_order_item_id")],
        billing_item_attribute_value=[(900, 1, "55")],
        invoice=[(7, "INV7", 1, D, 100, 12345, 3, 9)])
    out = rows(reports.omnibus_cost_dump(src).select("project_id", "project_code", "cost_comment",
                                                     "cost_amount", "cost_amount_eur", "invoice_amount",
                                                     "invoice_status", "time_log"))
    # USD: sum over 2 time-log rows = 20.00 -> 17.00; EUR and unknown keep the single amount;
    # time: (3 h * 60 + 30) / 60 per cost row = 3.5
    assert out == [(1, "A1", "c", 10.0, 17.0, 123.45, "Draft", 3.5),
                   (1, "A1", "e", 10.0, 10.0, 123.45, "Draft", 3.5),
                   (1, "A1", "u", 7.0, 7.0, 123.45, "Draft", 3.5)]


def test_time_report_quarter_hours_and_deleted_logs(spark):
    src = Source(spark, user=[(1, "Ann", "Lee")],
                 time_log=[(1, 10, 100, None, 45, 1, D, None), (2, 10, 100, 2, 20, 1, D, D),
                           (3, 10, 100, 1, None, 2, D, None)])
    out = rows(reports.project_time(src).select("id", "hours", "hour_part", "total_time", "created_by_user"))
    assert out == [(1, 0.0, 0.75, 0.75, "Ann Lee"), (2, 2.0, 20.0, 22.0, "Ann Lee"), (3, 1.0, 0.0, 1.0, None)]


def test_extended_export_rates(spark):
    src = _dump_source(spark)
    weekly = spark.createDataFrame([
        (dt.date(2021, 1, 4), "USD", "202101", 0.5), (dt.date(2021, 1, 5), "USD", "202101", 0.5)],
        "date date, currency string, week_nr string, weekly_avg double")
    out = reports.extended_export(src, weekly, cutoff="2018-01-01").collect()
    assert len(out) == 1
    r = out[0]
    assert (r.sales_week_nr, r.rate_avg, r.dc_sales_amount) == ("202101", 0.5, 10.0)
    assert r.invoice_week_nr is not None and r.rate_avg_inv is None and r.dc_invoice_amount is None
    assert r.revenue == 5.0 and r.currency_code == "USD"


def test_cost_dump_union_has_both_centers(spark):
    src = _dump_source(spark)
    centers = {r[0] for r in reports.cost_dump(src).select("cost_center").distinct().collect()}
    assert centers == {"Project"}
    assert reports.cost_dump(src).columns == reports.DUMP_COLUMNS
    assert F is not None
