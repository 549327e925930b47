"""Exact stratified split."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from notewright.operators.sampling import seeded_rank, shuffle_key
from notewright.sources.scratch import table

#: With at most so many strata their cuts are broadcast.
MAX_STRATA = 100_000
#: Hex digits of the hash that the histogram counts by: 65,536 cells a stratum at most.
_DIGITS = 4


def _small(rows: DataFrame, most: int = MAX_STRATA) -> DataFrame:
    """Marked for broadcast if it has few rows; else left to the optimiser."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


def cuts(keyed: DataFrame, stratum: str, share: float) -> DataFrame:
    """(stratum, cut, take, tied): of each stratum of ``keyed`` (stratum, _mark) the mark of the row that ends the
    first floor(n * share) in order of marks, and how many of the ``tied`` rows with that mark belong to them.

    A histogram by the first digits finds the cell that holds the cut; only that cell's marks are counted one by one.
    """
    cell = F.substring("_mark", 1, _DIGITS)
    counted = keyed.groupBy(stratum, cell.alias("_cell")).agg(F.count("*").alias("n"))
    whole = Window.partitionBy(stratum)
    running = whole.orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)  # over cells
    counted = counted.select("*", F.floor(F.sum("n").over(whole) * F.lit(share)).alias("k"), (F.sum("n").over(running) - F.col("n")).alias("before"))
    found = table(counted.where((F.col("before") < F.col("k")) & (F.col("k") <= F.col("before") + F.col("n"))).select(F.col(stratum).alias("_s"), F.col("_cell").alias("_c"), (F.col("k") - F.col("before")).alias("need")), "cells")
    inside = keyed.join(_small(found), F.col(stratum).eqNullSafe(F.col("_s")) & (cell == F.col("_c")))
    marks = inside.groupBy(stratum, "_mark").agg(F.count("*").alias("tied"), F.first("need").alias("need"))
    order = Window.partitionBy(stratum).orderBy("_mark").rowsBetween(Window.unboundedPreceding, 0)  # over the marks of one cell
    marks = marks.withColumn("before", F.sum("tied").over(order) - F.col("tied")).where((F.col("before") < F.col("need")) & (F.col("need") <= F.col("before") + F.col("tied")))
    return table(marks.select(F.col(stratum).alias("_s"), F.col("_mark").alias("cut"), (F.col("need") - F.col("before")).alias("take"), "tied"), "cuts")


def stratified_split(samples: DataFrame, stratum: str, key: str, validation_ratio: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds split: of each stratum of n rows, the first floor(n * (1 - ratio)) in seeded order train, the others validate.

    A null stratum is one of its own.  Rows with one ``key`` are in no order among themselves.

    The samples are computed once and written to a scratch table.  What is shuffled are counts; the samples themselves are
    only compared with their stratum's cut.
    """
    staged = table(samples.select("*", shuffle_key(seed, F.col(key)).alias("_mark"), F.monotonically_increasing_id().alias("_row")), "samples")
    keyed = staged.select(stratum, "_mark", "_row")
    found = cuts(keyed, stratum, 1.0 - validation_ratio)
    joined = staged.join(_small(found), F.col(stratum).eqNullSafe(F.col("_s")), "left")
    before = (F.col("_mark") < F.col("cut")) | ((F.col("_mark") == F.col("cut")) & (F.col("take") == F.col("tied")))
    torn = found.where("take < tied")
    if torn.head(1):  # a key that repeats lies across its stratum's cut
        tied = keyed.join(_small(torn), F.col(stratum).eqNullSafe(F.col("_s")) & (F.col("_mark") == F.col("cut"))).select(stratum, "_row", "take")
        first = seeded_rank(tied, shuffle_key(seed, F.col("_row")), [stratum], ["_row"]).where(F.col("rank") <= F.col("take")).select("_row", F.lit(True).alias("_first"))
        joined = joined.join(first, "_row", "left")
        before |= F.col("_first").isNotNull()
    return joined.select(*samples.columns, F.when(F.coalesce(before, F.lit(False)), "train").otherwise("validation").alias("split"))
