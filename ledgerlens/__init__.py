"""ledgerlens: project reporting (sales, invoices, costs, time, FX) as Spark jobs.

Every report is a pure function from named DataFrames to a DataFrame; nothing
is collected to the driver. See README.md for the layout.
"""

__all__ = ["session", "sources", "functions", "operators", "plans"]
