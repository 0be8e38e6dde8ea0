"""Join operators: dimensions, hierarchies, roles and the attribute-value link."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def join_dim(fact: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """Join a fact to a dimension.

    No hint: adaptive execution broadcasts the dimension while its measured
    size stays under ``spark.sql.autoBroadcastJoinThreshold`` and joins by
    shuffle beyond that.
    """
    return fact.join(dim, on, how)


def join_codes(fact: DataFrame, codes: DataFrame, on, how: str = "left") -> DataFrame:
    """Join a fact to a code table: statuses, currencies, weekly rates.

    Such a table has few rows by nature, so every task gets it whole and the
    fact stays where it is. Without the hint, adaptive execution finds the
    table small only after it has written a shuffle of the fact, dealt by a
    handful of codes.
    """
    return fact.join(F.broadcast(codes), on, how)


def with_missing_keys(right: DataFrame, right_keys: Sequence[str], every_key: DataFrame) -> DataFrame:
    """``right``, and a row of NULLs for each of ``every_key`` that it lacks.

    The join keys come first, as ``_key_0``, ``_key_1``, ...; in the added rows
    they alone have a value. An inner join with the result is a left join.
    """
    names = [f"_key_{i}" for i in range(len(right_keys))]
    found = right.select(*[F.col(k).alias(n) for k, n in zip(right_keys, names)], "*")
    # distinct per task before the shuffle, so a key of very many rows is one row there
    there = right.select(*[F.col(k).alias(f"{n}_there") for k, n in zip(right_keys, names)]).distinct()
    wanted = every_key.toDF(*names).distinct()
    lacking = wanted.join(there, [F.col(n) == F.col(f"{n}_there") for n in names], "left_anti")
    return found.unionByName(lacking.select(
        *names, *[F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema]))


def left_join_many(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str],
                   every_key: DataFrame | None = None) -> DataFrame:
    """Left join to a side that may hold very many rows of one key.

    Adaptive execution splits a hot right side under an inner join, not under a
    left one. So the right side gets a row of NULLs for each key that it lacks
    (``with_missing_keys``), and the join is an inner one that reads ``left``
    once. ``every_key`` are the keys to look for, at least those of ``left``,
    and says that none of them is NULL; without it they are read off ``left``,
    and left rows with a NULL key stay, without a match.
    """
    keys = left.select(*left_keys) if every_key is None else every_key
    full = with_missing_keys(right.dropna(subset=list(right_keys)) if every_key is None else right, right_keys, keys)
    names = [f"_key_{i}" for i in range(len(left_keys))]
    on = [F.col(k).eqNullSafe(F.col(n)) if every_key is None else F.col(k) == F.col(n)
          for k, n in zip(left_keys, names)]
    return left.join(full, on, "inner").drop(*names)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` over all of ``spark.sql.shuffle.partitions``.

    Adaptive execution merges the partitions of its own shuffles into about one
    a core, so that the sorts and hash maps of a task grow with the tables. A
    join or grouping by ``keys`` takes over these partitions, which stay.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def role(dim: DataFrame, prefix: str, cols: Sequence[str]) -> DataFrame:
    """One dimension in a named role: its columns renamed ``<prefix>_<col>``."""
    return dim.select(*[F.col(c).alias(f"{prefix}_{c}") for c in cols])


def company_hierarchy(company: DataFrame, demo_name: str = "Demo Company") -> DataFrame:
    """Per company: the account-of parent's name and the parent's invoicing company.

    ``parent_name``    name of ``account_of`` unless that parent is the demo company.
    ``invoicer_name``  name of the company that invoices for the parent; NULL
                       when the parent row does not exist.
    Two self left joins replace the nested correlated subqueries.
    """
    parent = company.select(F.col("id").alias("_pid"), F.col("name").alias("_pname"),
                            F.col("invoiced_by").alias("_pinv"))
    invoicer = company.select(F.col("id").alias("_iid"), F.col("name").alias("invoicer_name"))
    out = (company.select("id", "account_of")
           .join(parent, F.col("account_of") == F.col("_pid"), "left")
           .join(invoicer, F.col("_pinv") == F.col("_iid"), "left"))
    parent_name = F.when(F.col("_pname") != F.lit(demo_name), F.col("_pname"))
    return out.select(F.col("id").alias("company_id"), parent_name.alias("parent_name"),
                      "invoicer_name")


def eav_link(order: DataFrame, order_item: DataFrame, billing_item: DataFrame,
             attribute: DataFrame, attribute_value: DataFrame,
             attribute_name: str = "omnibus_order_item_id") -> DataFrame:
    """Billing items linked to orders through an attribute-value row.

    The attribute value is text that holds an order-item id; text that is not
    an integer links nothing (``try_cast``). Inner joins throughout.
    """
    attr = attribute.where(F.col("name") == attribute_name).select(F.col("id").alias("_aid"))
    val = (attribute_value
           .select("billing_item_id", "billing_item_attribute_id",
                   F.expr("try_cast(value as bigint)").alias("_item_id"))
           .join(attr, F.col("billing_item_attribute_id") == F.col("_aid"), "inner"))
    items = order_item.select(F.col("id").alias("_ooi_id"), F.col("omnibus_order_id").alias("order_id"))
    orders = order.select(F.col("id").alias("_oo_id"))
    linked = (val.join(items, F.col("_item_id") == F.col("_ooi_id"), "inner")
              .join(orders, F.col("order_id") == F.col("_oo_id"), "inner")
              .join(billing_item, F.col("billing_item_id") == billing_item["id"], "inner"))
    return linked.select("order_id", *[billing_item[c] for c in billing_item.columns])

