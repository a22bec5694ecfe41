"""Relabelling from small mappings: literal map (no join) or dimension join."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A mapping given as Python values is compiled into a literal map (stays inside
# whole-stage codegen); one held in a DataFrame, of any size, goes through left_lookup.


def relabel(value: Column, mapping: Mapping[str, str]) -> Column:
    """``mapping[value]`` when present, else ``value``. Applied once (no chaining)."""
    if not mapping:
        return value
    pairs = [x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), value)


def lookup(value: Column, mapping: Mapping[str, str]) -> Column:
    """``mapping[value]`` or NULL (a left join to a literal table)."""
    if not mapping:
        return F.lit(None).cast("string")
    pairs = [x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))]
    return F.try_element_at(F.create_map(*pairs), value)


def left_lookup(df: DataFrame, dim: DataFrame, left_key: Column, dim_key: str, value: str, alias: str) -> DataFrame:
    """Left join a (small) dimension on an expression key and add one column.

    No broadcast hint: Spark broadcasts by its size estimate, AQE re-checks the
    real size at run time and keeps a shuffle join when it is large. The
    dimension key must be unique (see ``quality.unique_check``).
    """
    d = dim.select(F.col(dim_key).alias("_dim_key"), F.col(value).alias(alias))
    return df.join(d, left_key == F.col("_dim_key"), "left").drop("_dim_key")
