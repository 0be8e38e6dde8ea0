"""Reshaping: wide-to-long and union by column name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def unpivot_present(df: DataFrame, ids: Sequence[str], values: Sequence[str] | None,
                    variable: str, value: str) -> DataFrame:
    """Wide -> long, dropping missing cells (``stack()`` semantics).

    ``DataFrame.unpivot`` keeps NULL cells, so they are filtered right after;
    the filter runs in the same stage, no shuffle.
    """
    values = list(values) if values is not None else [c for c in df.columns if c not in ids]
    return (df.unpivot(list(ids), values, variable, value)
            .where(F.col(value).isNotNull()))


def union_all_by_name(*dfs: DataFrame) -> DataFrame:
    """Concatenate frames by column name, keeping duplicates."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out
