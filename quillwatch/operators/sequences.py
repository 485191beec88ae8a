"""Values of the preceding edit, and running quantities along an ordered column.

There is one way for tables of every size. Rows are sorted over the whole cluster: ranges of the
order, cut by sampling so that they are about equally long, are written with the number of their
range. A window then spans one range, and what a range needs to know of earlier ones is a row or a
sum for each of them. A giant article, a bulk import stamped with one moment, or a third of all
scores close to zero are cut like anything else, since the cuts follow the full order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillwatch.session import materialize

_RANGE = "_range"


def ranges(rows: DataFrame, order: list[Column], tasks: int | None = None) -> DataFrame:
    """``rows`` with ``_range``: consecutive ranges of ``order`` carry rising numbers. The
    table is written, so that all its readers see the same cuts."""
    dealt = rows.repartitionByRange(tasks, *order) if tasks else rows.repartitionByRange(*order)
    return materialize(dealt.withColumn(_RANGE, F.spark_partition_id()), "ranges")


def _earlier() -> Window:
    """All ranges before this one. There are as many rows as ranges."""
    return Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)


def _in_time(key: str, time: str, tie: str) -> list[Column]:
    return [F.asc_nulls_first(key), F.asc_nulls_first(time), F.asc_nulls_first(tie)]


def with_previous(
    rows: DataFrame,
    values: dict[str, str],
    key: str = "article_title",
    time: str = "edit_timestamp",
    tie: str = "revid",
    tasks: int | None = None,
) -> DataFrame:
    """Add, for each ``{new: source}``, the source value of the preceding row of the same key
    in (time, tie) order, nulls first. The first row of a range takes it from the last row
    before that range."""
    order = _in_time(key, time, tie)
    cut = ranges(rows, order, tasks)
    packed = F.struct(F.col(key).alias("_key"), *[F.col(source).alias(new) for new, source in values.items()])
    last = cut.groupBy(_RANGE).agg(F.max_by(packed, F.struct(key, time, tie)).alias("_last"))
    carried = last.select(_RANGE, F.lag("_last").over(Window.orderBy(_RANGE)).alias("_carried"))
    in_range = F.lag(packed).over(Window.partitionBy(_RANGE).orderBy(*order))
    stepped = cut.withColumn("_before", in_range).join(carried, _RANGE, "left")
    before = F.coalesce("_before", "_carried")
    same = before["_key"].eqNullSafe(F.col(key))
    return stepped.select(*rows.columns, *[F.when(same, before[new]).alias(new) for new in values])


def first_of_each(
    rows: DataFrame,
    n: int,
    key: str = "article_title",
    time: str = "edit_timestamp",
    tie: str = "revid",
    tasks: int | None = None,
) -> DataFrame:
    """The first ``n`` rows of every key in (time, tie) order. Ranges before which a key already
    has ``n`` rows are not ordered again."""
    order = _in_time(key, time, tie)
    cut = ranges(rows, order, tasks)
    per_range = cut.groupBy(key, _RANGE).agg(F.count(F.lit(1)).alias("_n"))
    sofar = F.sum("_n").over(Window.partitionBy(key).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1))
    open_ranges = per_range.select(
        F.col(key).alias("_key"), F.col(_RANGE).alias("_at"), F.coalesce(sofar, F.lit(0)).alias("_sofar")
    ).filter(F.col("_sofar") < n)
    here = F.col(_RANGE) == F.col("_at")
    rank = F.row_number().over(Window.partitionBy(_RANGE, key).orderBy(*order))
    return (
        cut.join(open_ranges, here & F.col(key).eqNullSafe(F.col("_key")))
        .withColumn("_rank", rank + F.col("_sofar"))
        .filter(F.col("_rank") <= n)
        .select(*rows.columns)
    )


def with_position(rows: DataFrame, key: str, order: str, name: str = "position", tasks: int | None = None) -> DataFrame:
    """Add the place of each row among those of its key, from 0 on, in the order of another column, nulls first."""
    in_order = [F.asc_nulls_first(key), F.asc_nulls_first(order)]
    cut = ranges(rows, in_order, tasks)
    before = F.sum("_n").over(Window.partitionBy(key).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1))
    earlier = cut.groupBy(key, _RANGE).agg(F.count(F.lit(1)).alias("_n")).select(
        F.col(key).alias("_key"), F.col(_RANGE).alias("_at"), F.coalesce(before, F.lit(0)).alias("_sofar")
    )
    here = (F.col(_RANGE) == F.col("_at")) & F.col(key).eqNullSafe(F.col("_key"))
    rank = F.row_number().over(Window.partitionBy(_RANGE, key).orderBy(F.asc_nulls_first(order)))
    # The place is taken within a range before what came earlier is looked up.
    return cut.withColumn("_rank", rank).join(earlier, here).select(*rows.columns, (F.col("_rank") - 1 + F.col("_sofar")).alias(name))


def length_change(revisions: DataFrame, **split) -> DataFrame:
    """Bytes each edit adds or removes. The first edit of an article counts its whole size,
    and so does an edit whose predecessor has no known size."""
    return with_previous(revisions, {"prev_length": "content_length"}, **split).withColumn(
        "length_change", F.col("content_length") - F.coalesce("prev_length", F.lit(0))
    )


def running_totals(values: DataFrame, unit: str, sums: list[str], tasks: int | None = None) -> DataFrame:
    """Add ``below_<s>``, the total of ``s`` over all rows with a smaller ``unit``, and
    ``all_<s>``, its total over the whole table. ``unit`` holds distinct values. The source is
    read once."""
    cut = ranges(values, [F.asc(unit)], tasks)
    per_range = cut.groupBy(_RANGE).agg(*[F.sum(s).alias(s) for s in sums])
    everything = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = per_range.select(
        _RANGE,
        *[F.coalesce(F.sum(s).over(_earlier()), F.lit(0)).alias(f"_before_{s}") for s in sums],
        *[F.sum(s).over(everything).alias(f"all_{s}") for s in sums],
    )
    in_range = Window.partitionBy(_RANGE).orderBy(unit).rowsBetween(Window.unboundedPreceding, -1)
    below = {s: F.coalesce(F.sum(s).over(in_range), F.lit(0)) for s in sums}
    return (
        cut.withColumns({f"_in_{s}": total for s, total in below.items()})
        .join(before, _RANGE)
        .select(
            *values.columns,
            *[(F.col(f"_before_{s}") + F.col(f"_in_{s}")).alias(f"below_{s}") for s in sums],
            *[f"all_{s}" for s in sums],
        )
    )


def median_of(values: DataFrame, unit: str) -> DataFrame:
    """One row, one column ``median``: the exact interpolated median of ``unit``."""
    counts = (
        values.filter(F.col(unit).isNotNull())
        .groupBy(F.col(unit).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    # Values that hold either of the two middle positions: positions are 0-based, and a value
    # covers positions below .. below + n - 1.
    low, high = F.floor((F.col("all__n") - 1) / 2), F.floor(F.col("all__n") / 2)
    covers = lambda p: (F.col("below__n") <= p) & (p < F.col("below__n") + F.col("_n"))
    return running_totals(counts, "_v", ["_n"]).agg(
        ((F.max(F.when(covers(low), F.col("_v"))) + F.max(F.when(covers(high), F.col("_v")))) / 2).alias("median")
    )
