"""Landed FX rate files.

The daily rate history arrives as a zip archive whose first member is a CSV
(Date, then one column per currency; 'N/A' for a missing rate). Every archive
holds the full history, so landed archives overlap: a date is taken whole from
the newest archive that has it, newest by path name. Each archive is a
file-level task that emits one row per cell, missing cells included, so no date
and no column is lost and nothing passes through the driver.
"""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

CELLS = "source string, Date string, place int, currency string, exchange_rate double"


def _cells(batches):
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            with zipfile.ZipFile(io.BytesIO(content)) as zf, zf.open(zf.namelist()[0]) as fh:
                wide = pd.read_csv(fh, na_values=["N/A"], dtype={"Date": str})
            names = [c for c in wide.columns if c != "Date" and not str(c).startswith("Unnamed")]
            for place, name in enumerate(names):
                yield pd.DataFrame({"source": path, "Date": wide["Date"], "place": place, "currency": str(name),
                                    "exchange_rate": wide[name].astype("float64")})


def read_zipped_cells(spark: SparkSession, path_glob: str) -> DataFrame:
    """Cells (source, Date, place, currency, exchange_rate) of the landed
    archives; a missing rate is null."""
    files = spark.read.format("binaryFile").load(path_glob).select("path", "content")
    return files.mapInPandas(_cells, CELLS)


def newest_cells(cells: DataFrame) -> DataFrame:
    """For each date all cells of the newest archive that has it."""
    newest = cells.groupBy(F.col("Date").alias("_date")).agg(F.max("source").alias("_newest"))
    return cells.join(newest, (F.col("Date") == F.col("_date")) & (F.col("source") == F.col("_newest")),
                      "inner").drop("_date", "_newest")


def cells_to_long(cells: DataFrame) -> DataFrame:
    """(date, currency, exchange_rate) of the cells that hold a rate."""
    return cells.where(F.col("exchange_rate").isNotNull() & ~F.isnan("exchange_rate")).select(
        F.to_date("Date").alias("date"), "currency", "exchange_rate")


def cells_to_wide(cells: DataFrame) -> DataFrame:
    """The file's layout: one row per date, columns in the newest file's order,
    columns that only older files have after them.

    The list of columns, one per currency, is all that reaches the driver.
    """
    order = (cells.groupBy("currency").agg(F.max(F.struct("source", (-F.col("place")).alias("place"))).alias("_at"))
             .orderBy(F.desc("_at"), "currency").collect())
    names = [r.currency for r in order]
    rate = F.when(~F.isnan("exchange_rate"), F.col("exchange_rate"))
    # newest_cells leaves one cell for each date and currency
    return cells.groupBy("Date").pivot("currency", names).agg(F.max(rate)) if names else cells.select("Date").distinct()


def read_rates_csv(spark: SparkSession, path: str) -> DataFrame:
    """A plain (unzipped) wide rate CSV; 'N/A' cells read as NULL, rates as
    doubles also where a column holds none."""
    wide = spark.read.option("header", True).option("nullValue", "N/A").csv(path)
    return wide.select(*[F.col(f"`{c}`") if c == "Date" else F.col(f"`{c}`").cast("double").alias(c)
                         for c in wide.columns])
