"""Running aggregates in a global order without moving all rows into one task.

``Window.orderBy(...)`` with no partition key sends every row to one task.
For the global orders this library needs (ABC cumulative revenue, exact
medians) we instead, at every size alike:

1. range-partition by the full order key: Spark samples split points, and a value
   shared by a third of all rows is still cut by the tie-breaking columns;
2. tag each row with its partition's number and write the tagged rows to the shared
   checkpoint folder, so the numbers can't change when a lost task runs again;
3. total each partition (combined map-side) and turn the totals into offsets with a
   window over that table of one row per partition;
4. finish with a window inside each partition and add the offsets.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.operators.joins import bounded_broadcast
from shelfcast.session import checkpoint_root

OrderKey = tuple[str, bool]        # (column, ascending)

_AGG = {"sum": F.sum, "min": F.min, "max": F.max}


def _combine(kind: str, offset: Column, within: Column) -> Column:
    if kind == "sum":
        return offset + F.coalesce(within, F.lit(0))
    # least / greatest skip nulls: an empty side does not hide the other
    return F.least(offset, within) if kind == "min" else F.greatest(offset, within)


def running(df: DataFrame, order: Sequence[OrderKey], specs: dict[str, tuple[str, str]],
            parts: int | None = None, exclusive: bool = False, with_total: bool = False) -> DataFrame:
    """Running aggregates in a global total order.

    ``specs`` maps output -> (kind, column) with kind in sum / min / max.  The
    frame is every row up to and including this one, or strictly before it
    when ``exclusive``.  ``with_total`` adds ``<out>_total`` over all rows.
    ``order`` must identify a row uniquely and hold no nulls.  ``parts`` sets the
    number of ranges; by default the session's shuffle partitions, which adaptive
    execution may join.
    """
    sort_cols = [F.col(c).asc() if a else F.col(c).desc() for c, a in order]
    last = -1 if exclusive else Window.currentRow
    ranged = df.repartitionByRange(parts, *sort_cols) if parts else df.repartitionByRange(*sort_cols)
    checkpoint_root(df.sparkSession)
    tagged = ranged.withColumn("_part", F.spark_partition_id()).checkpoint(eager=True)
    totals = tagged.groupBy("_part").agg(*[_AGG[k](c).alias(f"_tot_{o}") for o, (k, c) in specs.items()])
    # one row per partition: windows over it are small
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offs = []
    for o, (k, _c) in specs.items():
        prev = _AGG[k](f"_tot_{o}").over(before)
        offs.append((F.coalesce(prev, F.lit(0)) if k == "sum" else prev).alias(f"_off_{o}"))
    offsets = totals.select("_part", *offs,
                            *[_AGG[k](f"_tot_{o}").over(every).alias(f"{o}_total") for o, (k, _c) in specs.items()])
    within = Window.partitionBy("_part").orderBy(*sort_cols).rowsBetween(Window.unboundedPreceding, last)
    summed = tagged.select("*", *[_AGG[k](c).over(within).alias(f"_in_{o}") for o, (k, c) in specs.items()])
    return summed.join(bounded_broadcast(offsets), "_part").select(
        *[F.col(c) for c in df.columns],
        *[_combine(k, F.col(f"_off_{o}"), F.col(f"_in_{o}")).alias(o) for o, (k, _c) in specs.items()],
        *([F.col(f"{o}_total") for o in specs] if with_total else []),
    )


def running_sums(df: DataFrame, order: Sequence[OrderKey], sums: dict[str, str],
                 parts: int | None = None, with_total: bool = False) -> DataFrame:
    """Inclusive running sums (see ``running``)."""
    return running(df, order, {o: ("sum", c) for o, c in sums.items()}, parts=parts, with_total=with_total)


def exact_median(df: DataFrame, value: str, group_cols: Sequence[str] = (),
                 out: str = "median", parts: int | None = None) -> DataFrame:
    """Exact median (linear interpolation between the two middle values, as
    numpy and SQL ``quantile_cont``) per group, nulls ignored.  Groups with no
    value give no row.

    Rows are first collapsed to (group, value, count) - combined map-side, so
    a hot group or a repeated value costs one row - and positions come from
    ``running_sums`` over that table; no group is ever gathered in one task.
    """
    groups = list(group_cols)
    counts = (df.where(F.col(value).isNotNull()).groupBy(*groups, value)
              .agg(F.count(F.lit(1)).alias("_c")))
    pos = running_sums(counts, [(g, True) for g in groups] + [(value, True)],
                       {"_run": "_c"}, parts=parts, with_total=not groups)
    pos = pos.withColumn("_first", F.col("_run") - F.col("_c"))
    if groups:
        # one row per group, broadcast if its count allows: a hot group then needs no shuffle
        sizes = pos.groupBy(*groups).agg(F.sum("_c").alias("_n"), F.min("_first").alias("_start"))
        pos = pos.join(bounded_broadcast(sizes), groups)
    else:
        pos = pos.withColumn("_n", F.col("_run_total")).withColumn("_start", F.lit(0))
    lo = F.floor((F.col("_n") - 1) / 2)
    hi = F.ceil((F.col("_n") - 1) / 2)
    first = F.col("_first") - F.col("_start")
    last = first + F.col("_c") - 1
    covers_lo = (first <= lo) & (lo <= last)
    covers_hi = (first <= hi) & (hi <= last)
    picked = pos.where(covers_lo | covers_hi).groupBy(*groups).agg(
        F.min(F.when(covers_lo, F.col(value))).cast("double").alias("_lo"),
        F.max(F.when(covers_hi, F.col(value))).cast("double").alias("_hi"),
    )
    return picked.select(*groups, (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * 0.5).alias(out))
