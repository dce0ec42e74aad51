"""The first k rows of every group, also when one group holds much of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPREAD = 256
LIMITED_BEFORE_SHUFFLE = 1000  # Spark's default of spark.sql.optimizer.windowGroupLimitThreshold
ROWS_OF_A_TASK = 250_000
MOST_PARTITIONS = 1 << 20


def _limited(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column | str], k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") <= k).drop("_place")


def first_k_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], k: int, rank: str | None = None
) -> DataFrame:
    """Keep the first ``k`` rows of each group under a total ``order``; ``rank`` names a 1-based rank column.

    Up to k = 1000 Spark itself limits a group in every task before a shuffle. A group is then cut into
    ``SPREAD`` parts by the input partition a row came from, and the last round sees ``SPREAD * k`` rows of
    it at most.

    A larger k is limited in rounds. The first part of a group is what one input partition holds of it. Each
    round leaves k rows of a part and joins as many parts as make ``ROWS_OF_A_TASK`` rows, so that no task
    ever holds more of a group than that, or two times k.
    """
    out, part = df, F.spark_partition_id()
    if k <= LIMITED_BEFORE_SHUFFLE:
        out = _limited(df.withColumn("_part", part % SPREAD), [*keys, "_part"], order, k).drop("_part")
    else:
        together, parts = max(2, ROWS_OF_A_TASK // k), MOST_PARTITIONS
        out = df.withColumn("_part", part)
        while parts > 1:
            out = _limited(out, [*keys, "_part"], order, k).withColumn("_part", F.floor(F.col("_part") / together))
            parts = -(-parts // together)
        out = out.drop("_part")
    if rank is None:
        return _limited(out, keys, order, k)
    return out.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(rank) <= k)
