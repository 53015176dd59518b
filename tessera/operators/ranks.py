"""Dense indexes, exact order statistics and group-wise top-k of tables of any size.

No window spans the whole table: rows are range partitioned and sorted once,
each row's place in its partition comes from the row order itself, and the row
counts of the partitions (one number each) turn places into positions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import stored


def positioned(df: DataFrame, order: Sequence[str], name: str = "ranks") -> DataFrame:
    """``df`` range-sorted by ``order`` and stored, with each row's partition
    ``_pid`` and its 0-based place ``_pos`` there."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return stored(ranged.select("*", F.spark_partition_id().alias("_pid"), place.alias("_pos")), name)


def _partition_starts(rows: DataFrame) -> list[tuple[int, int, int]]:
    """(pid, start, n) of the partitions that hold rows: one entry each."""
    out, at = [], 0
    for r in rows.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).orderBy("_pid").collect():
        out.append((r["_pid"], at, r["n"]))
        at += r["n"]
    return out


def dense_index(df: DataFrame, order: Sequence[str], group: Sequence[str] = (), name: str = "idx") -> DataFrame:
    """``df`` with the 0-based position ``name`` of each row by ``order``, inside
    each ``group`` if given (the order must be unique there)."""
    rows = positioned(df, [*group, *order])
    if not group:
        starts = _partition_starts(rows)
        table = df.sparkSession.createDataFrame([(p, s) for p, s, _ in starts], "_pid int, _start long")
        return (rows.join(F.broadcast(table), "_pid")  # one row for each partition
                .withColumn(name, F.col("_pos") + F.col("_start")).drop("_pid", "_pos", "_start"))
    # A group meets the partitions it spans: shift by its rows in earlier ones.
    cells = rows.groupBy(*group, "_pid").agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    shift = cells.select(*group, "_pid", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return (rows.join(shift, [*group, "_pid"])
            .withColumn(name, F.col("_pos") - F.col("_first") + F.col("_before"))
            .drop("_pid", "_pos", "_first", "_before"))


def exact_percentile(df: DataFrame, value: Column, q: float) -> float | None:
    """The q-quantile of the non-null values, linear between neighbours.

    The counts of the range partitions say which ones hold the two ranks asked
    for; only those rows are fetched.  None if there is no value.
    """
    rows = positioned(df.select(value.alias("v")).where(F.col("v").isNotNull()), ["v"])
    starts = _partition_starts(rows)
    if not starts:
        return None
    h = q * (starts[-1][1] + starts[-1][2] - 1)
    at = {}
    for rank in {math.floor(h), math.ceil(h)}:
        pid, start, _ = next(x for x in reversed(starts) if x[1] <= rank)
        at[rank] = rows.where((F.col("_pid") == pid) & (F.col("_pos") == rank - start)).first()["v"]
    low, high = at[math.floor(h)], at[math.ceil(h)]
    return low + (h - math.floor(h)) * (high - low)


def group_top(df: DataFrame, group: Sequence[str], order: Sequence[Column], limit: int) -> DataFrame:
    """The first ``limit`` rows of each group by ``order``, with their 1-based
    ``_rn``.  Rows are cut in every task, then in about sqrt(partitions) parts of
    a group, then in the group, so no task reads a limit's worth from every task."""
    parts = max(1, math.isqrt(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    rows = df.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(parts)))
    some = F.row_number().over(Window.partitionBy(*group, "_part").orderBy(*order))
    rows = rows.withColumn("_rn", some).where(F.col("_rn") <= limit).drop("_rn", "_part")
    return (rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
            .where(F.col("_rn") <= limit))
