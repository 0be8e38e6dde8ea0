"""What the reports shuffle: the exchanges of their plans, on rows of any number."""

import re

from fixtures import CURRENCIES, STATUSES, T, Source
from ledgerlens.plans import reports
from ledgerlens.plans.registry import QUERIES
from conftest import rows

D = T(2021, 1, 1)


def _source(spark):
    return Source(
        spark, project_status=STATUSES, currency=CURRENCIES, invoice_status_translation=[(1, 3, "Draft")],
        company=[(c, f"Company {c}", None, None, 1, 1, None) for c in (1, 2)], user=[(1, "Ann", "Lee")],
        country=[(1, "Lithuania")],
        project=[(1, 1, 1, "P1", "C-1", D, None, None, None), (2, 1, 2, "P2", "C-2", D, None, None, None)],
        project_account=[(1, 2)], project_account_view=[(1, 2), (1, 2), (2, 1)],
        wave=[(10, 1), (10, 1), (11, 1)],
        sales_line=[(1, 1, 10, 5, 1, 100, 12, 1, D, D), (2, 2, None, 5, 1, 100, 3, 1, D, D)],
        product=[(6, 5, "TYPE-Brand#1 - part")])


def _dealt_by(df):
    """The keys of each exchange, without their numbers."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"#\d+L?", "", keys) for keys in re.findall(r"Exchange hashpartitioning\((.*), \d+\),", plan)]


def test_extended_export_is_not_dealt_by_week_or_code(spark):
    weekly = spark.createDataFrame([("2021-01-01", "USD", "202100", 1.5)],
                                   "date string, currency string, week_nr string, weekly_avg double")
    df = reports.extended_export(_source(spark), weekly)
    dealt = _dealt_by(df)
    assert dealt and not [k for k in dealt if re.search(r"sales_week_nr|invoice_week_nr|^currency_id$|_status_id", k)]
    out = rows(df.select("project_id", "project_wave_id", "revenue", "rate_avg", "dc_sales_amount"))
    assert out == [(1, "1/10", 1.0, 1.5, 1 / 1.5), (1, "1/10", 1.0, 1.5, 1 / 1.5), (1, "1/11", 0.0, None, None),
                   (2, None, 0.0, None, None)]


def test_chained_join_uses_every_shuffle_partition(spark):
    """Merged partitions would hold more rows a task the larger the tables are."""
    execution = QUERIES["join_chained_left"](spark, "/root/testdata/sf0.001")._jdf.queryExecution()
    assert execution.toRdd().getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_project_master_is_distinct_before_its_waves(spark):
    df = reports.project_master(_source(spark))
    top = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert "Join Inner" in next(line for line in top if "Join" in line or "Aggregate" in line)
    assert rows(df.select("project_id", "project_wave_id", "client_company", "account_manager")) == [
        (1, "1/10", "Company 2", "Ann Lee"), (1, "1/11", "Company 2", "Ann Lee"), (2, None, "Company 1", "Ann Lee")]


def test_sales_of_the_summary_are_dealt_by_wave_once(spark):
    df = reports.project_summary(_source(spark))
    dealt = _dealt_by(df)
    assert not [k for k in dealt if re.search(r"revenue|currency_id|status_id", k)]
    out = rows(df.select("project_id", "project_wave_id", "revenue", "sales_currency", "account_manager"))
    assert out == [(1, "1/10", 1.0, "US Dollar", "Ann Lee"), (1, "1/10", 1.0, "US Dollar", "Ann Lee"),
                   (1, "1/11", None, None, "Ann Lee"), (2, None, None, None, "Ann Lee")]


def test_sales_and_invoices_of_the_extended_export_are_dealt_by_wave_once(spark):
    weekly = spark.createDataFrame([], "date string, currency string, week_nr string, weekly_avg double")
    dealt = _dealt_by(reports.extended_export(_source(spark), weekly))
    assert dealt and not [k for k in dealt if re.search(r"(^|, )(_a_)?product(,|$)", k)]


def test_beside_is_a_left_join(spark):
    """Copies stay, keys that are NULL or not there have no row beside them."""
    left = spark.createDataFrame([(1, 10, "a", 1), (1, 10, "a", 1), (1, 10, "a", 2), (1, 10, None, 3), (1, 11, "a", 4),
                                  (None, 10, "a", 5)], "p long, w long, product string, v long")
    right = spark.createDataFrame([(1, 10, "a", None, "x"), (1, 10, None, 7, "y"), (None, 10, "a", 8, "z"), (3, 30, "c", 9, "n")],
                                  "q long, u long, other string, n long, t string")
    got = reports._beside(left, ["p", "w", "product"], right, ["q", "u", "other"])
    assert got.columns == ["p", "w", "product", "v", "n", "t"]
    found = sorted((tuple(r) for r in got.collect()), key=lambda r: r[3])
    assert found == [(1, 10, "a", 1, None, "x")] * 2 + [(1, 10, "a", 2, None, "x"), (1, 10, None, 3, None, None),
                                                       (1, 11, "a", 4, None, None), (None, 10, "a", 5, None, None)]
