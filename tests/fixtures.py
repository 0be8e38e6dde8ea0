"""Hand-written source tables for report tests (schemas as in FIXTURES.md)."""

from __future__ import annotations

import datetime as dt

SCHEMAS = {
    "project": "id long, project_status_id long, company_id long, name string, project_code string, "
               "created_at timestamp_ntz, closed_at timestamp_ntz, archived_at timestamp_ntz, "
               "deleted_at timestamp_ntz",
    "project_status": "id long, name string",
    "wave": "id long, project_id long",
    "project_account_view": "project_id long, company_id long",
    "project_account": "project_id long, company_id long",
    "company": "id long, name string, account_of long, invoiced_by long, responsible_account_manager_id long, "
               "country_id long, deleted_at timestamp_ntz",
    "country": "id long, english_name string",
    "user": "id long, first_name string, last_name string",
    "currency": "id long, iso_code string, name string",
    "sales_line": "id long, project_id long, project_product_group_id long, sales_product_id long, quantity long, "
                  "unit_price long, currency_id long, country_id long, created_at timestamp_ntz, "
                  "updated_at timestamp_ntz",
    "product": "id long, translatable_id long, name string",
    "cost_line": "id long, project_id long, project_product_group_id long, amount long, currency_id long, "
                 "cost_type_id long, comment string, created_by_user_id long, created_at timestamp_ntz",
    "cost_type_translation": "translatable_id long, name string",
    "time_log": "id long, project_id long, project_product_group_id long, hours long, minutes long, user_id long, "
                "created_at timestamp_ntz, deleted_at timestamp_ntz",
    "invoice": "id long, number string, invoice_status_id long, submit_date timestamp_ntz, total long, "
               "grand_total long, currency_id long, buyer_company_id long",
    "project_invoice": "project_id long, invoice_id long",
    "invoice_product": "invoice_id long, project_sales_product_id long, invoice_product_code_id long, "
                       "sales_product_id long, total long, quantity long, unit_price long, currency_id long, "
                       "project_code string, deleted_at timestamp_ntz",
    "invoice_product_code": "id long, code string, description string",
    "invoice_status_translation": "id long, translatable_id long, name string",
    "sales_product_invoice_product_code": "invoice_product_code_id long, sales_product_id long",
    "omnibus_order": "id long, name string, company_id long, managing_company_id long, archived_at timestamp_ntz",
    "omnibus_order_cost": "omnibus_order_id long, amount long, currency_id long, cost_type_id long, comment string",
    "omnibus_order_time_log": "omnibus_order_id long, hours long, minutes long",
    "omnibus_order_item": "id long, omnibus_order_id long",
    "billing_item": "id long, invoice_id long",
    "billing_item_attribute": "id long, name string",
    "billing_item_attribute_value": "billing_item_id long, billing_item_attribute_id long, value string",
}

T = dt.datetime


class Source:
    """Attribute access to small DataFrames; tables not given are empty."""

    def __init__(self, spark, **tables):
        self._spark = spark
        self._tables = tables

    def __getattr__(self, name):
        if name.startswith("_"):
            raise AttributeError(name)
        rows = self._tables.get(name, [])
        return self._spark.createDataFrame(rows, SCHEMAS[name])


STATUSES = [(1, "New"), (2, "On hold"), (3, "In progress"), (4, "Completed"), (5, "Cancelled")]
CURRENCIES = [(3, "EUR", "Euro"), (12, "USD", "US Dollar"), (26, "DOP", "Peso"), (40, "XXX", "Unknown")]
