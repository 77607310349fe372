"""Groups whose key may be null: joins that match nulls, and totals that stay apart from them."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# The name of the one subset of a dataset without subset folders.
NO_SUBSET = "unnamed"


def join_null_safe(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """An equi-join on columns of equal names in which nulls match; the keys stay once."""
    names = {k: f"_right_{k}" for k in keys}
    same = functools.reduce(
        Column.__and__, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()], F.lit(True)
    )
    return left.join(right.withColumnsRenamed(names), same, how).drop(*names.values())


def named(df: DataFrame, by: Sequence[str]) -> list[Column]:
    """The group columns with a name in place of null, so that null can stand for the total."""
    kinds = dict(df.dtypes)
    return [
        F.coalesce(F.col(c), F.lit(NO_SUBSET)).alias(c) if kinds[c] == "string" else F.col(c)
        for c in by
    ]


def rollup_sums(df: DataFrame, by: Sequence[str], counters: Mapping[str, Column]) -> DataFrame:
    """Counters per group, then subtotals (null) of that small result."""
    per_group = df.groupBy(*named(df, by)).agg(*[c.alias(n) for n, c in counters.items()])
    return per_group.rollup(*by).agg(
        *[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in counters]
    )
