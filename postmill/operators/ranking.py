"""Keep-first and top-N per group.

Spark plans ``row_number() <= n`` with a group limit before the shuffle, so a map task sends
at most ``n`` rows per group however large the group is.
"""

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Largest n for which the optimizer plans the limit; 1000 unless set.
LIMIT_SETTING = "spark.sql.optimizer.windowGroupLimitThreshold"


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``."""
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).filter("_position = 1").drop("_position")


def top_n_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank: str = "rank",
    fan_in: int | None = None,
) -> DataFrame:
    """The first ``n`` rows of each group, numbered from 1 in column ``rank``.

    With few groups and very many map tasks a single round would send ``tasks * n`` rows of a
    group to one task. A first round ranks within the group and a slice of the map tasks, which
    divides that share by ``fan_in``, and the second sees at most ``fan_in * n`` rows of a
    group. Any row among the first n of its group is among the first n of its slice, so the
    result is exact. ``fan_in`` is the square root of the shuffle width unless given; 1 ranks
    in a single round, as narrow shuffles do.

    For a large ``n`` the session's threshold for the limit before the shuffle is raised.
    """
    _plan_limits_up_to(df.sparkSession, n)
    if fan_in is None:
        fan_in = _square_root_of_width(df.sparkSession)
    if fan_in > 1:
        slices = df.withColumn("_slice", F.spark_partition_id() % fan_in)
        within_slice = F.row_number().over(Window.partitionBy(*group, "_slice").orderBy(*order))
        df = slices.withColumn("_position", within_slice).filter(F.col("_position") <= n).drop("_position", "_slice")
    overall = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn(rank, overall).filter(F.col(rank) <= n)


def _square_root_of_width(spark: SparkSession) -> int:
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return math.isqrt(width) if width >= 64 else 1


def _plan_limits_up_to(spark: SparkSession, n: int) -> None:
    threshold = int(spark.conf.get(LIMIT_SETTING, "1000"))
    if -1 < threshold <= n:
        spark.conf.set(LIMIT_SETTING, str(n + 1))
