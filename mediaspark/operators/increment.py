"""What an increment of events changes in the stored table.

Copies of an event are looked for in a stated number of days around it, so an increment costs its own rows, the ids
of those days, and the days that really change; the rest of the table is not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mediaspark.operators.silver import event_order

ADDED, REMOVED = "added", "removed"


def near_days(days: Sequence, look_back: int) -> list:
    """The given days and those up to ``look_back`` before and after."""
    from datetime import date, timedelta

    reach = [timedelta(n) for n in range(-look_back, look_back + 1)]
    ends = (date.min + timedelta(look_back), date.max - timedelta(look_back))
    return sorted({day + step for day in days for step in reach if ends[0] <= day <= ends[1]} | set(days))


def changes(new: DataFrame, stored: DataFrame, look_back: int) -> DataFrame:
    """Rows to add and rows to remove (``change``), both with all columns.

    ``new`` has one row for each id. A stored copy within ``look_back`` days competes under the order of the full
    rebuild; of equal rows the stored one stays. Events without an id compete at any distance.
    """
    ids = new.select(F.col("event_id").alias("_id"), F.col("event_date").alias("_day"))
    near = F.abs(F.date_diff("event_date", "_day")) <= look_back
    copies = stored.join(ids, F.col("event_id").eqNullSafe(F.col("_id")) & (near | F.col("event_id").isNull()), "left_semi")
    both = new.withColumn("_stored", F.lit(False)).unionByName(copies.withColumn("_stored", F.lit(True)))
    place = F.row_number().over(Window.partitionBy("event_id").orderBy(*event_order(), F.desc("_stored")))
    change = F.when((place == 1) & ~F.col("_stored"), ADDED).when((place > 1) & F.col("_stored"), REMOVED)
    return both.withColumn("change", change).filter(F.col("change").isNotNull()).drop("_stored")


def rewritten(stored: DataFrame, changed: DataFrame) -> DataFrame:
    """The stored rows of the touched days after the changes."""
    gone = changed.filter(F.col("change") == REMOVED).select(F.col("event_id").alias("_id"), F.col("event_date").alias("_day"))
    same = F.col("event_id").eqNullSafe(F.col("_id")) & (F.col("event_date") == F.col("_day"))
    kept = stored.join(gone, same, "left_anti")
    return kept.unionByName(changed.filter(F.col("change") == ADDED).drop("change"))
