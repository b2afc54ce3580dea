"""Joins to lookup tables and ranking inside groups, safe for hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 32


def lookup_join(facts: DataFrame, lookup: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """Join facts to a table with few rows per key (``how`` keeps the fact side: inner, left, left_semi, left_anti).

    Spark broadcasts the lookup if its size, from statistics or measured after a shuffle, is below the session's limit.
    Otherwise both sides are shuffled by key and adaptive execution splits the partitions of hot keys.
    """
    return facts.join(lookup, [on] if isinstance(on, str) else list(on), how)


def top_per_group(
    df: DataFrame,
    group: Sequence[str | Column],
    order: Sequence[Column],
    n: int,
    rank: str | None = None,
    spread_by: Sequence[str] | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """The first ``n`` rows of each group; ``order`` must end in a unique column.

    The plain ``row_number <= n`` predicate lets every map task cut its groups to ``n`` rows before the shuffle. With
    ``spread_by`` a hot group is first cut over ``salts`` partitions, which pays off for a large ``n``.
    """
    position = rank or "_position"
    if spread_by:
        salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
        inner = Window.partitionBy(*group, salt).orderBy(*order)
        df = df.withColumn("_inner", F.row_number().over(inner)).filter(F.col("_inner") <= n).drop("_inner")
    window = Window.partitionBy(*group).orderBy(*order)
    out = df.withColumn(position, F.row_number().over(window)).filter(F.col(position) <= n)
    return out if rank else out.drop(position)


def dense_index(df: DataFrame, key: str, name: str, buckets: int = 4096) -> DataFrame:
    """Number the rows 0, 1, 2, ... by (bucket of the key's md5, key), without a single-task sort.

    Rows are numbered inside each of ``buckets`` evenly filled buckets; only the bucket counts are summed up in order.
    """
    bucket = F.pmod(F.conv(F.substring(F.md5(F.col(key)), 1, 8), 16, 10).cast("long"), F.lit(buckets))
    rows = df.withColumn("_bucket", bucket)
    counts = rows.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    local = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        rows.withColumn("_local", local)
        .join(F.broadcast(starts), "_bucket")  # one row per bucket, so at most ``buckets`` rows
        .withColumn(name, F.col("_start") + F.col("_local") - 1)
        .drop("_bucket", "_local", "_start")
    )
