"""Running figures over rows in one order, dealt over tasks: ranges, parts, carries.

A window over a whole group orders the group in one task.  Here rows are dealt by ranges of the whole order (group, keys, ties), so that
a group of any size lies in many parts, and equal keys may too.  A running figure is taken within a part and shifted by what the parts
before it hold; those carries are one row a group and part.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from psmlake.operators import lineage

#: The group as one value that is never null, its part of the order, and the place within the part.
GROUP, PART, PLACE = "__group", "__part", "__place"


def beside(rows: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """`rows` with the columns of `small`, joined on keys that may be null on both sides."""
    keys = list(keys)
    small = small.select(*[F.col(f"`{k}`").alias(f"__k_{k}") for k in keys], *[F.col(f"`{c}`") for c in small.columns if c not in keys])
    cond = F.lit(True)
    for k in keys:
        cond &= F.col(f"`{k}`").eqNullSafe(F.col(f"`__k_{k}`"))
    return rows.join(small, cond, how).drop(*[f"__k_{k}" for k in keys])


def laid_out(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], parts: int | None = None) -> DataFrame:
    """`df` with its part and its place in the order, written: parts are ranges of `by` and `order`, as many as the session's shuffles have, or more for larger files.

    Rows that are equal in everything share a part; end `order` in something that tells rows apart where one value may be common.
    """
    keys = [*[F.col(f"`{c}`").asc_nulls_first() for c in by], *order]
    parts = parts or lineage.parts_for(df)
    ranged = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    # within a part, ids rise with the order
    group = F.struct(*[F.col(f"`{c}`") for c in by]) if by else F.lit(0)
    return lineage.cut(ranged.withColumns({GROUP: group, PART: F.spark_partition_id(), PLACE: F.monotonically_increasing_id()}))


def within_part(backwards: bool = False) -> WindowSpec:
    """From the first row of the group in this part to the current one; backwards, from the last."""
    own = Window.partitionBy(GROUP, PART).orderBy(F.col(PLACE).desc() if backwards else F.col(PLACE))
    return own.rowsBetween(Window.unboundedPreceding, 0)


def carried(rows: DataFrame, figures: dict[str, Column], fold: Callable[[Column | str], Column] = F.sum, backwards: bool = False) -> DataFrame:
    """(group, part, figures): `fold` of each figure over the group's parts before this one, or after it; null where there are none."""
    totals = rows.groupBy(GROUP, PART).agg(*[fold(c).alias(to) for to, c in figures.items()])
    others = Window.partitionBy(GROUP).orderBy(F.col(PART).desc() if backwards else F.col(PART)).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(GROUP, PART, *[fold(F.col(to)).over(others).alias(to) for to in figures])


def running_sums(rows: DataFrame, sums: dict[str, Column], backwards: bool = False) -> DataFrame:
    """`rows` (laid out) with running sums of whole numbers, own row included."""
    carries = carried(rows, {f"__before_{to}": c for to, c in sums.items()}, backwards=backwards)
    own = within_part(backwards)
    out = lineage.dealt(rows, GROUP, PART).join(carries, [GROUP, PART])  # the join deals rows as the window wants them
    return out.withColumns({to: F.sum(c).over(own) + F.coalesce(f"__before_{to}", F.lit(0)) for to, c in sums.items()}).drop(*[f"__before_{to}" for to in sums])


def least_from_here(rows: DataFrame, value: str, to: str) -> DataFrame:
    """`rows` (laid out) with the smallest `value` of this row and all after it."""
    carries = carried(rows, {"__after": F.col(value)}, F.min, backwards=True)
    out = rows.join(carries, [GROUP, PART])
    return out.withColumn(to, F.least(F.min(value).over(within_part(backwards=True)), F.col("__after"))).drop("__after")


def value_ranks(df: DataFrame, by: Sequence[str], value: Column) -> DataFrame:
    """(by, value, n, upto, dense, of): for each distinct value, not null, its rows, the rows at or below it, its dense rank, the rows of its group.

    Rows are counted by value before any order is made, so a common value costs one row; the smallest rank of a
    value is upto - n + 1, its average rank upto - (n - 1) / 2, its percentage rank that over `of`.
    """
    return ranks_of(df.select(*by, value.alias("value")).where("value IS NOT NULL").groupBy(*by, "value").agg(F.count("*").alias("n")), by)


def ranks_of(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """value_ranks() of values (by, value, n) that are counted already, each once; one with n = 0 only asks."""
    rows = laid_out(counts, by, [F.col("value")])
    ranks = running_sums(rows, {"upto": F.col("n"), "dense": F.lit(1).cast("long")})
    return ranks.join(rows.groupBy(GROUP).agg(F.sum("n").alias("of")), GROUP).drop(GROUP, PART, PLACE)


def ranked(df: DataFrame, by: Sequence[str], value: Column, ranks: dict[str, Callable[[Column, Column, Column, Column], Column]]) -> DataFrame:
    """`df` with ranks of `value` in its group: each a function of n, upto, dense and of; null values have none."""
    told = value_ranks(df, by, value).withColumnsRenamed({c: f"__{c}" for c in ("value", "n", "upto", "dense", "of")})
    out = beside(df.withColumn("__value", value), told, [*by, "__value"], "left")
    args = [F.col(f"__{c}") for c in ("n", "upto", "dense", "of")]
    return out.withColumns({to: f(*args) for to, f in ranks.items()}).drop("__value", "__n", "__upto", "__dense", "__of")
