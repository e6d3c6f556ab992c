"""Runs of adjacent rows and consecutive batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merge_repeats(rows: DataFrame, keys: list[str], position: str, value: str) -> DataFrame:
    """Adjacent rows of equal value as one: the first start, the last row's end, numbered from 0.

    rows has start and end; a run's end is that of its last row, not the largest.
    """
    w = Window.partitionBy(*keys).orderBy(position)
    new = (~F.col(value).eqNullSafe(F.lag(value).over(w)) | (F.row_number().over(w) == 1)).cast("long")
    marked = rows.withColumn("new_run", new).withColumn("run", F.sum("new_run").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    found = marked.groupBy(*keys, "run").agg(F.min_by("start", position).alias("start"), F.max_by("end", position).alias("end"), F.first(value).alias(value))
    return found.select(*keys, (F.col("run") - 1).alias("seg_no"), "start", "end", value)


def batches(rows: DataFrame, position: str, size: int) -> DataFrame:
    """Add `batch`, the number of the fixed-size batch a row's position (from 0) falls in."""
    return rows.withColumn("batch", F.floor(F.col(position) / size))


def carried_state(rows: DataFrame, keys: list[str], position: str, items: str) -> DataFrame:
    """Add `carried`: the items (arrays) of all earlier rows of the keys, in order."""
    before = Window.partitionBy(*keys).orderBy(position).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("carried", F.flatten(F.collect_list(F.coalesce(items, F.array().cast("array<string>"))).over(before)))


def last_wins(rows: DataFrame, keys: list[str], position: str) -> DataFrame:
    """The last row by position of each key."""
    w = Window.partitionBy(*keys).orderBy(F.col(position).desc())
    return rows.withColumn("rank_", F.row_number().over(w)).where("rank_ = 1").drop("rank_")
