"""Top-N per group of a stored table without ranking its wide columns."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.operators.ranking import top_n_per_group
from postmill.sources.tables import staged


def rows_near_top(table: DataFrame, group: str, score: str, n: int) -> DataFrame:
    """A subset of ``table`` that holds the ``n`` best rows of each group by ``score`` descending.

    The two narrow columns are ranked first, and each group's n-th score is written out: one row
    a group, whose file size tells the optimizer whether it can be broadcast. The wide columns
    are then scanned with ``score`` at least the lowest cutoff of all, which skips row groups by
    their statistics, and each row meets the cutoff of its group. Ties at the cutoff are all
    kept, as are all rows of a group with fewer than ``n`` scores; the caller ranks the rest.
    """
    best = top_n_per_group(table.select(group, score), [group], [F.desc_nulls_last(score)], n)
    # count() leaves out null scores, so a group with fewer than n scores needs those, too.
    cutoffs = staged(
        best.groupBy(F.col(group).alias("_group")).agg(
            F.min(score).alias("_cutoff"), (F.count(score) < n).alias("_nulls")
        ),
        "cutoffs",
    )
    lowest = cutoffs.agg(F.min("_cutoff")).scalar()
    possible = table.filter((F.col(score) >= lowest) | F.col(score).isNull())
    near = (F.col(score) >= F.col("_cutoff")) | (F.col(score).isNull() & F.col("_nulls"))
    return possible.join(cutoffs, F.col(group).eqNullSafe(F.col("_group")) & near).select(*table.columns)
