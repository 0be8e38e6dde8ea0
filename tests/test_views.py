"""The adapter views grow with the tables they are made from."""

from ledgerlens.sources.adapters import Adapters
from ledgerlens.sources.tables import load_tables

GROWING = ["project", "wave", "project_account", "company", "user", "sales_line", "product", "cost_line", "time_log",
           "invoice", "project_invoice", "invoice_product", "invoice_product_code", "sales_product_invoice_product_code",
           "omnibus_order", "omnibus_order_cost", "omnibus_order_time_log", "omnibus_order_item", "billing_item",
           "billing_item_attribute_value", "fx_long"]


def test_views_grow(spark):
    small, large = (Adapters(load_tables(spark, f"/root/testdata/{sf}")) for sf in ("sf0.001", "sf0.01"))
    for view in GROWING:
        assert getattr(large, view).count() > 4 * getattr(small, view).count(), view
    for view, key in (("company", "account_of"), ("company", "responsible_account_manager_id"),
                      ("billing_item", "invoice_id"), ("invoice_product", "invoice_product_code_id")):
        counts = [getattr(src, view).select(key).distinct().count() for src in (small, large)]
        assert counts[1] > 4 * counts[0], (view, key)
