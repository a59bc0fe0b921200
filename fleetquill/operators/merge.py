"""Insert-only merge: rows of a batch that the table does not hold yet.

Plain equality decides, so a row with a null key never matches and is inserted on
every load. Both sides are reduced to distinct rows map-side before the one shuffle
each needs, which keeps a row repeated millions of times from landing on one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COPIES = "_copies"
# A repeated row is cut into runs of RUN copies; INNER_RUNS of them per outer block.
RUN = 64
INNER_RUNS = 1024


def _any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def count_copies(
    updates: DataFrame, keys: Sequence[str], file_order: str | None = None
) -> DataFrame:
    """Distinct rows of a batch and how often each is to be inserted.

    With ``file_order`` the batch stands for files merged one after the other: a row
    is taken as often as the first file holds it, since later files then find it in
    the table. Rows with a null key are never found and are taken from every file.
    """
    columns = [c for c in updates.columns if c != file_order]
    if file_order is None:
        return updates.groupBy(*columns).agg(F.count(F.lit(1)).alias(COPIES))
    per_file = updates.groupBy(*columns, file_order).agg(
        F.count(F.lit(1)).alias("_in_file")
    )
    return (
        per_file.groupBy(*columns)
        .agg(
            F.min_by("_in_file", file_order).alias("_first"),
            F.sum("_in_file").alias("_all"),
        )
        .select(
            *columns,
            F.when(_any_null(keys), F.col("_all"))
            .otherwise(F.col("_first"))
            .alias(COPIES),
        )
    )


def _distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys, hash-partitioned by the keys in the given order.

    ``distinct()`` may reorder its columns; the join would then shuffle them again.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).select(*keys)


def absent_from(
    updates: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
) -> DataFrame:
    """Update rows whose key the target lacks."""
    known = target.select(*keys)
    if not null_safe:
        known = _distinct_keys(known.na.drop(), keys)
        return updates.join(known, list(keys), "left_anti")
    known = _distinct_keys(known, keys).alias("known")
    same = reduce(
        lambda a, b: a & b,
        [updates[k].eqNullSafe(F.col(f"known.`{k}`")) for k in keys],
    )
    return updates.join(known, same, "left_anti")


def _runs(total: Column, size: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.floor((total - 1) / size))


def _run_length(total: Column, index: Column, size: int) -> Column:
    return F.least(total - index * size, F.lit(size).cast("long"))


def _copied(counted: DataFrame, columns: Sequence[str]) -> DataFrame:
    copies = F.sequence(F.lit(1).cast("long"), F.col(COPIES))
    return counted.withColumn("_copy", F.explode(copies)).select(*columns)


def repeat_copies(counted: DataFrame) -> DataFrame:
    """Write every counted row out again as often as its count says.

    Up to ``RUN`` copies are written where the row is. A larger count has no upper bound,
    so its row is cut into runs, the runs are spread over the cluster, and at most ``RUN``
    copies come from any one of them. A batch without such counts is not shuffled for it:
    what is to be spread turns out empty once the batch has been counted.
    """
    columns = [c for c in counted.columns if c != COPIES]
    few = _copied(counted.where(F.col(COPIES) <= RUN), columns)
    block = RUN * INNER_RUNS
    outer = counted.where(F.col(COPIES) > RUN).withColumn(
        "_block", F.explode(_runs(F.col(COPIES), block))
    )
    outer = outer.withColumn(
        COPIES, _run_length(F.col(COPIES), F.col("_block"), block)
    )
    inner = outer.withColumn("_run", F.explode(_runs(F.col(COPIES), RUN)))
    inner = inner.withColumn(COPIES, _run_length(F.col(COPIES), F.col("_run"), RUN))
    spread = inner.repartition(*columns, "_block", "_run")
    return few.unionByName(_copied(spread, columns))


def new_rows(
    updates: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    *,
    constants: Mapping[str, Column] | None = None,
    file_order: str | None = None,
    unique: bool = False,
    null_safe: bool = False,
) -> DataFrame:
    """Rows an insert-only merge appends.

    ``constants`` are columns with one value for the whole batch, such as its load
    date; ``updates`` comes without them. Those that are keys restrict the target to
    what can match, which prunes its partitions, and stay out of the shuffles: the
    aggregates and the join then share one hash partitioning by the other keys.
    ``unique`` says the batch holds each row once (it is the result of a distinct).
    """
    constants = dict(constants or {})
    known = target
    for name in set(constants).intersection(keys):
        known = known.where(F.col(name) == constants[name])
    varying = [k for k in keys if k not in constants]
    if unique:
        rows = absent_from(updates, known, varying, null_safe)
    else:
        counted = count_copies(updates, varying, file_order)
        rows = repeat_copies(absent_from(counted, known, varying, null_safe))
    return rows.withColumns(constants) if constants else rows


def merged(updates: DataFrame, target: DataFrame, keys: Sequence[str], **how) -> DataFrame:
    """The table after the merge, as a view: what it holds and what is new."""
    return target.unionByName(
        new_rows(updates, target, keys, **how).select(*target.columns)
    )
