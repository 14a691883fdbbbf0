"""Operators that depend on the order of rows, made to work when one key is hot.

A plain ``Window.partitionBy(room).orderBy(ts)`` sends all rows of a room to one task.
Here the rows are first cut into *slices*: consecutive stretches of the total order
``order_by``, whatever the keys. A slice is a span of the first order column (a day, say);
a span that is too full is cut further, by borders on all order columns, so that a busy
hour, or even one instant with a third of all rows, is spread as well. Inside ``(keys, slice)``
a normal window does the work; what a slice must know about earlier ones (the last row, the
totals so far) is joined to it, as one row per key and slice.

There is one plan for every size. Rows are shuffled once, by key and slice, and that one
exchange serves the windows and the summaries of the slices.

Borders come from one pass over the order columns, as a small table in the shared folder with one row
for each span that is too full. It is written before the query runs, so a task that is run again
after an executor loss puts every row in the same slice as before. The pass looks at a sample of
about ``SAMPLES_PER_SLICE`` positions per slice, which only places borders: slices have about
``rows_per_slice`` rows at most, give or take a third.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F, types as T

from thermoflow.functions.time import as_micros, duration_micros
from thermoflow.session import working_path

ROWS_PER_SLICE = 1_000_000
SAMPLES_PER_SLICE = 10
#: Spans of the first order column: of times, and of whole numbers.
TIME_SPAN, NUMBER_SPAN = "1 day", 1 << 16
#: Up to so many borders (of 16 bytes or so each) are sent to every executor; more are joined by a shuffle.
MOST_SENT = 4_000_000

_SLICE = "_slice"
_GROUP = "_group"
_LEAST = -(2**63)


@dataclass(frozen=True)
class Slices:
    """How a total order is cut. ``borders`` has the first position of each slice but the first of a span."""

    order_by: tuple[str, ...]
    span: int
    borders: DataFrame | None = field(default=None, repr=False)
    longest: int = 0
    count: int = 0

    def add_to(self, df: DataFrame, name: str) -> DataFrame:
        """Add the slice of each row, as a struct that orders like the rows do.

        Its second field is how many borders of its span are at or before the row: a binary search.
        """
        at = [f"_at_{i}" for i in range(len(self.order_by))]
        df = df.withColumns(dict(zip(at, _positions(df, self.order_by))))
        df = df.withColumns({"_span": F.call_function("div", F.col(at[0]), F.lit(self.span)), "_cut": F.lit(0)})
        if self.longest:
            table = F.broadcast(self.borders) if self.count <= MOST_SENT else self.borders
            df = df.join(table, F.col("_span") == F.col("_of_span"), "left")
            # One expression for any number of borders: a plan with a column per halving takes ever longer to optimise.
            halvings = F.array(*[F.lit(1 << bit) for bit in reversed(range(self.longest.bit_length()))])

            def halve(cut: Column, step: Column) -> Column:
                border = F.get("_borders", cut + step - 1)
                return F.when(_not_after([border[c] for c in at], [F.col(c) for c in at]), cut + step).otherwise(cut)

            df = df.withColumn("_cut", F.aggregate(halvings, F.lit(0), halve))
            df = df.drop("_of_span", "_borders")
        return df.withColumn(name, F.struct("_span", "_cut")).drop("_span", "_cut", *at)


def _not_after(border: list[Column], position: list[Column]) -> Column:
    """Whether a border is at or before a position, column by column."""
    last = border[-1] <= position[-1]
    for b, p in zip(reversed(border[:-1]), reversed(position[:-1])):
        last = (b < p) | ((b == p) & last)
    return last


def _positions(df: DataFrame, order_by: Sequence[str]) -> list[Column]:
    """The order columns as whole numbers with the same order, NULL as the least."""
    out = []
    for name in order_by:
        kind = df.schema[name].dataType
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            number = as_micros(F.col(name))
        elif isinstance(kind, T.IntegralType):
            number = F.col(name).cast("bigint")
        else:
            raise TypeError(f"order by times and whole numbers, not by {name} of type {kind.simpleString()}")
        out.append(F.coalesce(number, F.lit(_LEAST).cast("bigint")))
    return out


def plan_slices(
    df: DataFrame,
    order_by: Sequence[str],
    rows_per_slice: int = ROWS_PER_SLICE,
    span: str | int | None = None,
) -> Slices:
    """Choose the slices of a table, in one pass over its order columns.

    ``span`` is a duration for times and a number for whole numbers. Nothing but the number
    of borders reaches the driver.
    """
    order_by = tuple(order_by)
    if span is None:
        span = NUMBER_SPAN if isinstance(df.schema[order_by[0]].dataType, T.IntegralType) else TIME_SPAN
    width = duration_micros(span) if isinstance(span, str) else span
    fraction = min(1.0, SAMPLES_PER_SLICE / rows_per_slice)
    step = max(1, round(rows_per_slice * fraction))
    at = [f"_at_{i}" for i in range(len(order_by))]
    positions = df.select(*[p.alias(c) for c, p in zip(at, _positions(df, order_by))])
    sampled = positions.sample(fraction=fraction, seed=17) if fraction < 1 else positions
    borders = (
        sampled.groupBy(F.call_function("div", F.col(at[0]), F.lit(width)).alias("_of_span"))
        .agg(F.sort_array(F.collect_list(F.struct(*at))).alias("_borders"))
        .withColumn("_borders", F.array_distinct(F.filter("_borders", lambda _, i: (i > 0) & (i % step == 0))))
        .where(F.size("_borders") > 0)
    )
    path, found = working_path(df.sparkSession, "slices"), Observation()
    size = F.size("_borders")
    borders.observe(found, F.max(size).alias("longest"), F.sum(size).alias("count")).write.parquet(path)
    stored = df.sparkSession.read.schema(borders.schema).parquet(path)
    return Slices(order_by, width, stored, found.get["longest"] or 0, found.get["count"] or 0)


def _checked(df: DataFrame, order_by: Sequence[str], slices: Slices | None, rows_per_slice: int) -> Slices:
    if slices is None:
        return plan_slices(df, order_by, rows_per_slice)
    if slices.order_by != tuple(order_by):
        raise ValueError(f"slices of {slices.order_by} cannot serve an order by {tuple(order_by)}")
    return slices


def _dealt(sliced: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows shuffled by key and slice. NULL keys are keys like others, as fields of a struct."""
    group = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
    return sliced.withColumn(_GROUP, group).repartition(F.col(_GROUP), F.col(_SLICE))


def _per_slice(dealt: DataFrame, *aggregates: Column) -> DataFrame:
    # The hash makes this use of the exchange need the same columns as the other, so that there is one.
    all_columns = F.max(F.xxhash64(*dealt.columns)).alias("_all")
    return dealt.groupBy(_GROUP, _SLICE).agg(*aggregates, all_columns).where("_all IS NOT NULL").drop("_all")


def previous_row(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    fields: Sequence[str],
    slices: Slices | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add ``prev_<field>``: the value in the row just before, per key in the given order.

    Pass the ``slices`` of a larger table to reuse them for rows filtered out of it: a
    slice can only get smaller by that.
    """
    order_by = tuple(order_by)
    slices = _checked(df, order_by, slices, rows_per_slice)
    dealt = _dealt(slices.add_to(df, _SLICE), keys)
    last = _per_slice(dealt, F.max_by(F.struct(*fields), F.struct(*order_by)).alias("_last"))
    openings = last.select(
        _GROUP, _SLICE, F.lag("_last").over(Window.partitionBy(_GROUP).orderBy(_SLICE)).alias("_opening")
    )
    before = F.lag(F.struct(*fields)).over(Window.partitionBy(_GROUP, _SLICE).orderBy(*order_by))
    return (
        dealt.withColumn("_before", before).join(openings, [_GROUP, _SLICE], "left")
        .withColumn("_before", F.coalesce("_before", "_opening"))
        .select(*df.columns, *[F.col("_before")[name].alias(f"prev_{name}") for name in fields])
    )


def previous_rows(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    fields: Sequence[str],
    count: int,
    into: str = "previous",
    slices: Slices | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add an array of the up to ``count`` rows just before, per key in the given order, oldest first.

    A slice is summed up by its last ``count`` rows. Summaries of neighbouring slices are joined end to end and
    cut to the last ``count`` rows again, so it does not matter how few rows of a key a slice has.
    """
    order_by = tuple(order_by)
    slices = _checked(df, order_by, slices, rows_per_slice)
    dealt = _dealt(slices.add_to(df, _SLICE), keys)
    last = lambda rows: F.slice(rows, F.greatest(F.size(rows) - count, F.lit(0)) + 1, count)
    inside = Window.partitionBy(_GROUP, _SLICE).orderBy(*order_by).rowsBetween(-count, -1)
    seen = dealt.withColumn("_inside", F.collect_list(F.struct(*fields)).over(inside))
    tails = seen.groupBy(_GROUP, _SLICE).agg(
        F.max_by(last(F.concat("_inside", F.array(F.struct(*fields)))), F.struct(*order_by)).alias("_tail")
    )
    earlier = Window.partitionBy(_GROUP).orderBy(_SLICE).rowsBetween(-count, -1)
    openings = tails.select(_GROUP, _SLICE, F.flatten(F.collect_list("_tail").over(earlier)).alias("_opening"))
    both = F.concat(F.coalesce("_opening", F.array()), F.col("_inside"))
    return (
        seen.join(openings.withColumn("_opening", last(F.col("_opening"))), [_GROUP, _SLICE], "left")
        .select(*df.columns, last(both).alias(into))
    )


def running_max(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    maxima: Mapping[str, Column],
    with_row: bool = True,
    slices: Slices | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add running maxima, per key in the given order; with ``with_row=False`` those of earlier rows only.

    Like running sums: a slice is summed up by its maxima, which earlier slices hand on.
    """
    order_by = tuple(order_by)
    kept = [c for c in df.columns if c not in maxima]
    sliced = _checked(df, order_by, slices, rows_per_slice).add_to(df, _SLICE)
    added = [value.alias(f"_new_{name}") for name, value in maxima.items()]
    dealt = _dealt(sliced.select(*dict.fromkeys([*kept, *keys, *order_by]), _SLICE, *added), keys)
    tops = _per_slice(dealt, *[F.max(f"_new_{name}").alias(f"_open_{name}") for name in maxima])
    before = Window.partitionBy(_GROUP).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    openings = tops.select(_GROUP, _SLICE, *[F.max(f"_open_{name}").over(before).alias(f"_open_{name}") for name in maxima])
    inside = Window.partitionBy(_GROUP, _SLICE).orderBy(*order_by).rowsBetween(
        Window.unboundedPreceding, Window.currentRow if with_row else -1
    )
    return (
        dealt.withColumns({name: F.max(f"_new_{name}").over(inside) for name in maxima})
        .join(openings, [_GROUP, _SLICE], "left")
        .select(*kept, *[F.greatest(name, f"_open_{name}").alias(name) for name in maxima])
    )


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    totals: Mapping[str, Column],
    slices: Slices | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
    slice_by: Column | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add running sums, per key in the given order, the row itself included.

    ``keep`` names the columns wanted beside the sums (all, if not given); others are not shuffled. ``slice_by`` may give a slice number that never falls along the order (such as the
    day of a time bucket); then no planning pass is made.
    """
    return _running(df, keys, order_by, totals, slices, rows_per_slice, slice_by, keep).drop(_GROUP, _SLICE)


def _running(df, keys, order_by, totals, slices=None, rows_per_slice=ROWS_PER_SLICE, slice_by=None, keep=None):
    order_by = tuple(order_by)
    keep = [c for c in (df.columns if keep is None else keep) if c not in totals]
    if slice_by is None:
        sliced = _checked(df, order_by, slices, rows_per_slice).add_to(df, _SLICE)
    else:
        sliced = df.withColumn(_SLICE, slice_by)
    added = [value.alias(f"_add_{name}") for name, value in totals.items()]
    dealt = _dealt(sliced.select(*dict.fromkeys([*keep, *keys, *order_by]), _SLICE, *added), keys)
    sums = _per_slice(dealt, *[F.sum(f"_add_{name}").alias(f"_open_{name}") for name in totals])
    before = Window.partitionBy(_GROUP).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    openings = sums.select(_GROUP, _SLICE, *[F.sum(f"_open_{name}").over(before).alias(f"_open_{name}") for name in totals])
    inside = Window.partitionBy(_GROUP, _SLICE).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        dealt.withColumns({name: F.sum(f"_add_{name}").over(inside) for name in totals})
        .join(openings, [_GROUP, _SLICE], "left")
        .withColumns({name: F.coalesce(F.col(name) + F.col(f"_open_{name}"), name, f"_open_{name}") for name in totals})
        .select(*keep, *totals, _GROUP, _SLICE)
    )


PART_ROWS = 100_000
PART_BYTES = 64 * 1024 * 1024


def ordered_parts(
    df: DataFrame,
    groups: Sequence[str],
    order_by: Sequence[str],
    value: Column,
    part_rows: int = PART_ROWS,
    slices: Slices | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
    sums: Mapping[str, Column] | None = None,
    firsts: Mapping[str, Column] | None = None,
    size: Column | None = None,
) -> DataFrame:
    """All values of each group as ordered arrays: ``groups, part, n, items``.

    ``sums`` and ``firsts`` add totals and first values of each part. ``size`` gives the
    bytes of a value where these may be long: a value counts as several rows if it takes
    more than its share of ``PART_BYTES``, so that long texts make parts shorter.

    A group of up to ``part_rows`` rows gives one row with ``part`` 0. A larger one gives
    one row per ``part_rows`` rows, with rising ``part``, so that nothing is lost and no
    task or cell has to hold a whole hot group.
    """
    order_by = tuple(order_by)
    sums, firsts = dict(sums or {}), dict(firsts or {})
    weight = F.lit(1)
    if size is not None:
        share = max(1, PART_BYTES // part_rows)
        weight = F.greatest(F.lit(1), F.ceil(F.coalesce(size, F.lit(0)) / share)).cast("bigint")
    ranked = _running(
        df.select(*dict.fromkeys([*groups, *order_by]), value.alias("_value"), weight.alias("_weight"),
                  *[column.alias(f"_in_{name}") for name, column in (sums | firsts).items()]),
        groups, order_by, {"_until": F.col("_weight")}, slices, rows_per_slice,
    )
    before = F.col("_until") - F.col("_weight")
    parted = ranked.withColumn("part", F.call_function("div", before, F.lit(part_rows)))
    position = F.struct(*order_by)
    pieces = parted.groupBy(_GROUP, _SLICE, *groups, "part").agg(
        F.count(F.lit(1)).alias("n"),
        F.sort_array(F.collect_list(F.struct(*order_by, F.col("_value")))).alias("_piece"),
        *[F.sum(f"_in_{name}").alias(f"_in_{name}") for name in sums],
        *[F.min_by(f"_in_{name}", position).alias(f"_in_{name}") for name in firsts],
    ).withColumn("_piece", F.transform("_piece", lambda item: item["_value"]))
    # The pieces of one part come from neighbouring slices; the second grouping only joins them.
    return pieces.groupBy(*groups, "part").agg(
        F.sum("n").alias("n"),
        F.flatten(F.transform(
            F.sort_array(F.collect_list(F.struct(_SLICE, "_piece"))), lambda item: item["_piece"]
        )).alias("items"),
        *[F.sum(f"_in_{name}").alias(name) for name in sums],
        *[F.min_by(f"_in_{name}", _SLICE).alias(name) for name in firsts],
    )
