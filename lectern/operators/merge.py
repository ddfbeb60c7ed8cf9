"""Reducers and set operators: how partial states are put together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def list_merge(a: Column, b: Column) -> Column:
    """Both lists one after the other; a null counts as empty."""
    return F.concat(F.coalesce(a, F.array()), F.coalesce(b, F.array()))


def dict_merge(a: Column, b: Column) -> Column:
    """Both maps; where both have a key, the right one's value holds. A null map counts as empty."""
    only = F.map_filter(a, lambda k, _: ~F.array_contains(F.map_keys(b), k))
    return F.when(a.isNull(), F.coalesce(b, F.create_map().cast("map<string,string>"))).when(b.isNull(), a).otherwise(F.map_concat(only, b))


def first_value(a: Column, b: Column) -> Column:  # noqa: ARG001
    """The left value, even if it is null."""
    return a


def union_chunks(a: DataFrame, b: DataFrame) -> DataFrame:
    """All rows of both, duplicates kept, columns matched by name."""
    return a.unionByName(b, allowMissingColumns=True)


def union_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).union(b.select(key)).distinct()


def full_outer_counts(a: DataFrame, b: DataFrame, key: str, left: str, right: str) -> DataFrame:
    """(key, left, right): counts of both sides, 0 where one lacks the key; null keys of either side don't match each other."""
    return a.select(key, left).join(b.select(key, right), key, "full_outer").select(key, F.coalesce(left, F.lit(0)).alias(left), F.coalesce(right, F.lit(0)).alias(right))
