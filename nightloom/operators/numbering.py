"""Places of rows in an order, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .graph import cut_lineage


def numbered(df: DataFrame, order: list[str | Column], column: str) -> DataFrame:
    """``df`` with ``column``: each row's place (from 1) in ``order``, which must tell all rows apart.

    Rows are range-partitioned, each range numbered on its own, and the sizes of the ranges before it added. The ranged rows are
    written first: ranges come from a sample, so a second evaluation could cut them elsewhere.
    """
    ranged = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()))
    ranged = ranged.withColumn("_range", F.shiftright("_id", 33))
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("_range", "_before")  # a row a range
    place = F.col("_id") - F.shiftleft(F.col("_range"), 33) + 1
    return ranged.join(F.broadcast(before), "_range").withColumn(column, F.col("_before") + place).select(*df.columns, column)
