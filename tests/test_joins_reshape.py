
from ledgerlens.operators import joins, reshape
from conftest import rows


def _companies(spark):
    return spark.createDataFrame([
        (1, "Root", None, 3), (2, "Child", 1, None), (3, "Invoicer", None, None),
        (4, "Demo Company", None, 3), (5, "UnderDemo", 4, None), (6, "Orphan", 99, None),
        (7, "NoInvoicer", 3, None)],
        "id long, name string, account_of long, invoiced_by long")


def test_company_hierarchy(spark):
    h = rows(joins.company_hierarchy(_companies(spark)))
    assert h == [(1, None, None), (2, "Root", "Invoicer"), (3, None, None), (4, None, None),
                 (5, None, "Invoicer"), (6, None, None), (7, "Invoicer", None)]


def test_eav_link_try_cast(spark):
    order = spark.createDataFrame([(10,), (11,)], "id long")
    item = spark.createDataFrame([(12, 10), (13, 11)], "id long, omnibus_order_id long")
    bi = spark.createDataFrame([(100, 7), (101, 8), (102, 9), (103, 10)], "id long, invoice_id long")
    attr = spark.createDataFrame([(1, "omnibus_order_item_id"), (2, "other")], "id long, name string")
    val = spark.createDataFrame([(100, 1, "12"), (101, 1, "x"), (102, 1, None), (103, 2, "13")],
                                "billing_item_id long, billing_item_attribute_id long, value string")
    out = joins.eav_link(order, item, bi, attr, val).select("order_id", "id", "invoice_id")
    assert rows(out) == [(10, 100, 7)]


def test_role_prefixes(spark):
    d = spark.createDataFrame([(1, "x")], "id long, name string")
    assert joins.role(d, "buyer", ["id", "name"]).columns == ["buyer_id", "buyer_name"]


def test_unpivot_drops_missing_cells(spark):
    wide = spark.createDataFrame([("2024-01-01", 1.5, None), ("2024-01-02", 2.0, 3.0)],
                                 "Date string, USD double, GBP double")
    long = reshape.unpivot_present(wide, ["Date"], None, "currency", "rate")
    assert long.count() == 3
    assert rows(long) == [("2024-01-01", "USD", 1.5), ("2024-01-02", "GBP", 3.0), ("2024-01-02", "USD", 2.0)]


def test_union_by_name_keeps_duplicates(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "id long, v string")
    b = spark.createDataFrame([("x", 1)], "v string, id long")
    assert reshape.union_all_by_name(a, b).count() == 3
