"""Places of rows in a total order, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from strata.operators.staging import stage

#: Bits of a staged place that count rows within a partition.
IN_PARTITION = 33


def stage_in_order(rows: DataFrame, order: list[Column], name: str, place: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` range-shuffled and sorted by ``order``, staged with the column ``place``; and the rows of each partition.

    ``place`` rises with the order and tells the partition (``place >> 33``).
    The second frame has ``part, n``, a row per partition that has rows.  A range shuffle
    splits a group of rows that share the first keys wherever later keys differ.
    """
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    staged = stage(ordered.withColumn(place, F.monotonically_increasing_id()), name)
    return staged, staged.groupBy(part_of(place).alias("part")).agg(F.count("*").alias("n"))


def part_of(place: str) -> Column:
    return F.shiftright(F.col(place), IN_PARTITION)


def in_part(place: str) -> Column:
    return F.col(place).bitwiseAND(F.lit((1 << IN_PARTITION) - 1))


def row_numbers(rows: DataFrame, order: list[Column], name: str, number: str) -> DataFrame:
    """``rows`` with their number in the order, from 0, in ``number``; the counts that are summed are one per partition."""
    place = f"{number}_place"
    staged, parts = stage_in_order(rows, order, name, place)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    numbered = staged.join(starts, part_of(place) == F.col("part"))
    return numbered.withColumn(number, F.col("before") + in_part(place)).drop(place, "part", "before")
