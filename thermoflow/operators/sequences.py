"""Patterns over neighbouring rows: any number of steps, conditions that look back, a time limit.

A pattern is a list of steps. It matches rows that follow each other without a gap (per key,
in the given order), one row per step, or ``times`` rows for a step that is repeated. A condition gets the row it
judges and the rows that earlier steps took, so it may compare them. Every match counts, also those that
overlap. ``within`` is strict: the last row comes less than that after the first.

What a match must know of its past is the rows before it, one fewer than the pattern has. This is
what slices hand on (``ordered.previous_rows``), so a match may span any number of them and a hot key is spread
like any other. Conditions are column expressions over that array: no Python runs on rows.

A run is the other kind of repetition: as many rows as follow each other, each joined to the one before it by a condition.

Rows that a condition is NULL for don't match. Ties in the order are up to its last column, which should be unique. NULL keys are keys like others.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from thermoflow.functions.time import closer_than
from thermoflow.model import READING_ORDER
from thermoflow.operators.ordered import ROWS_PER_SLICE, Slices, previous_row, previous_rows, running_totals

#: A row of a match: its fields by name.
Event = Column
#: Rows taken so far, by the name of their step.
Taken = Mapping[str, Sequence[Event]]


@dataclass(frozen=True)
class Step:
    name: str
    where: Callable[[Event, Taken], Column] | None = None
    times: int = 1


@dataclass(frozen=True)
class Pattern:
    """``Pattern().begin("first", ...).next("second", ...).within("5 seconds")``"""

    steps: tuple[Step, ...] = ()
    limit: str | None = None

    def begin(self, name: str, where: Callable[[Event, Taken], Column] | None = None, times: int = 1) -> Pattern:
        if self.steps:
            raise ValueError("a pattern begins once")
        return self._with(Step(name, where, times))

    def next(self, name: str, where: Callable[[Event, Taken], Column] | None = None, times: int = 1) -> Pattern:
        """The row just behind the last one taken."""
        if not self.steps:
            raise ValueError("a pattern starts with begin()")
        return self._with(Step(name, where, times))

    def within(self, limit: str) -> Pattern:
        return replace(self, limit=limit)

    def _with(self, step: Step) -> Pattern:
        if step.times < 1:
            raise ValueError(f"step {step.name} needs one row at least")
        if any(step.name == other.name for other in self.steps):
            raise ValueError(f"two steps are named {step.name}")
        return replace(self, steps=(*self.steps, step))

    @property
    def length(self) -> int:
        return sum(step.times for step in self.steps)


def matches(
    df: DataFrame,
    pattern: Pattern,
    keys: Sequence[str] = ("room_id", "source"),
    order_by: Sequence[str] = READING_ORDER,
    fields: Sequence[str] | None = None,
    slices: Slices | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """A row per match: the keys, and for each step its row (a struct) or rows (an array, if it is repeated).

    ``fields`` names what is kept of rows and seen by conditions, all columns by default; the order columns always are.
    """
    if not pattern.steps:
        raise ValueError("a pattern needs a step")
    order_by = tuple(order_by)
    fields = list(dict.fromkeys([*(df.columns if fields is None else fields), *order_by]))
    rows = df.select(*dict.fromkeys([*keys, *fields]))
    own = F.array(F.struct(*fields))
    if pattern.length > 1:
        before = previous_rows(rows, keys, order_by, fields, pattern.length - 1, "_before", slices, rows_per_slice)
        taken = before.withColumn("_rows", F.concat("_before", own)).where(F.size("_rows") == pattern.length)
    else:
        taken = rows.withColumn("_rows", own)
    at, so_far, holds, out = 0, {}, F.lit(True), []
    for step in pattern.steps:
        so_far[step.name] = []
        for _ in range(step.times):
            event = F.get("_rows", F.lit(at))
            if step.where is not None:
                holds = holds & step.where(event, so_far)
            so_far[step.name].append(event)
            at += 1
        events = so_far[step.name]
        out.append((events[0] if step.times == 1 else F.array(*events)).alias(step.name))
    if pattern.limit is not None:
        time = order_by[0]
        holds = holds & closer_than(F.get("_rows", F.lit(0))[time], F.get("_rows", F.lit(at - 1))[time], pattern.limit)
    return taken.where(holds).select(*[F.col(k) for k in keys if k not in so_far], *out)


def select(found: DataFrame, *results: Column) -> DataFrame:
    """One result per match, from columns such as ``F.col("second.ts")``."""
    return found.select(*results)


def flat_select(found: DataFrame, results: Column) -> DataFrame:
    """Any number of results per match: an array of structs, whose fields become columns."""
    return found.select(F.inline(results))


def runs(
    df: DataFrame,
    joined: Callable[[Event, Event], Column],
    measures: Mapping[str, Column],
    keys: Sequence[str] = ("room_id", "source"),
    order_by: Sequence[str] = READING_ORDER,
    at_least: int = 1,
    slices: Slices | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """A row per longest run: the keys, ``run`` (its number), ``first`` and ``last`` row, ``n`` rows and the measures.

    ``joined(before, row)`` tells whether a row goes on with the run of the one before it. A run of any
    length is one row per task and key before it is shuffled for its measures.
    """
    order_by = tuple(order_by)
    fields = df.columns
    pairs = previous_row(df.withColumn("_there", F.lit(True)), keys, order_by, [*fields, "_there"], slices, rows_per_slice)
    before = F.struct(*[F.col(f"prev_{c}").alias(c) for c in fields])
    goes_on = F.col("prev__there").isNotNull() & joined(before, F.struct(*fields))
    numbered = running_totals(
        pairs.select(*fields, F.when(goes_on, 0).otherwise(1).alias("_opens")), keys, order_by, {"run": F.col("_opens")},
        slices, rows_per_slice, keep=fields,
    )
    row, place = F.struct(*fields), F.struct(*order_by)
    found = numbered.groupBy(*keys, "run").agg(
        F.min_by(row, place).alias("first"), F.max_by(row, place).alias("last"), F.count(F.lit(1)).alias("n"),
        *[column.alias(name) for name, column in measures.items()],
    )
    return found.where(F.col("n") >= at_least)
