"""A calendar of named, consecutive periods and the columns derived from it."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmetrics import fixed
from flowmetrics.functions.timeparts import iso_date, ordinal_in


def _text(label: str) -> str:
    """A label as a SQL string literal."""
    escaped = label.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _day(day: date | None) -> str:
    return "CAST(NULL AS date)" if day is None else f"DATE'{day}'"


@dataclass(frozen=True)
class PeriodCalendar:
    """Closed periods as (label, last day inclusive) in time order, then one open-ended label.

    Each closed period starts the day after the one before it; the first has no lower bound.
    A day after the last boundary, and a NULL day, get the open label.
    """

    closed: tuple[tuple[str, date], ...]
    open_label: str

    @staticmethod
    def of(closed: Iterable[tuple[str, str | date]], open_label: str) -> PeriodCalendar:
        return PeriodCalendar(tuple((n, iso_date(d)) for n, d in closed), open_label)

    def __post_init__(self) -> None:
        days = [d for _, d in self.closed]
        if any(a >= b for a, b in zip(days, days[1:])):
            raise ValueError("period boundaries must be in ascending order")
        if len(set(self.labels)) != len(self.labels):
            raise ValueError("period labels must be unique")

    @property
    def labels(self) -> list[str]:
        """All labels in time order."""
        return [n for n, _ in self.closed] + [self.open_label]

    @property
    def inner_days(self) -> int:
        """Number of days between the first and the last boundary."""
        return (self.closed[-1][1] - self.closed[0][1]).days if self.closed else 0

    def label(self, day: str) -> Column:
        """Label of the period a day falls in; ``day`` is a column name or an expression."""
        return self._case(day, "<=", [f"DATE'{last}'" for _, last in self.closed])

    def label_at(self, ts: str) -> Column:
        """Label of the period a wall-clock time falls in, without deriving its day first."""
        starts = [last + timedelta(days=1) for _, last in self.closed]
        return self._case(ts, "<", [f"TIMESTAMP_NTZ'{day} 00:00:00'" for day in starts])

    def _case(self, c: str, compare: str, ends: list[str]) -> Column:
        """Nested choices that halve the calendar: about log2(n) comparisons for n periods.

        A NULL time fails every comparison and gets the open label. Parsed as a whole, since a
        calendar may hold many periods.
        """
        names = [_text(name) for name in self.labels]

        def among(first: int, last: int) -> str:
            if first == last:
                return names[first]
            middle = (first + last) // 2
            earlier, later = among(first, middle), among(middle + 1, last)
            return f"CASE WHEN {c} {compare} {ends[middle]} THEN {earlier} ELSE {later} END"

        return F.expr(among(0, len(names) - 1))

    def ordinal(self, label: Column) -> Column:
        """1-based place of a label in time order, NULL for a label not in the calendar."""
        return ordinal_in(label, self.labels)

    def ordinal_of(self, name: str) -> Column:
        """:meth:`ordinal` of the column of this name."""
        whens = " ".join(f"WHEN {_text(x)} THEN {i}" for i, x in enumerate(self.labels, start=1))
        return F.expr(f"CASE `{name}` {whens} END")

    def frame(self, spark: SparkSession, label: str = "label") -> DataFrame:
        """One row per period: ordinal, label, first day, last day (NULL = unbounded)."""
        ends = [last for _, last in self.closed]
        starts = [None, *[last + timedelta(days=1) for last in ends]]
        rows = ", ".join(
            f"({i}, {_text(name)}, {_day(first)}, {_day(last)})"
            for i, (name, first, last) in enumerate(zip(self.labels, starts, [*ends, None]), start=1)
        )
        return spark.sql(f"VALUES {rows}").toDF("ordinal", label, "first_day", "last_day")

    def day_frame(self, spark: SparkSession, day: str, label: str) -> DataFrame:
        """One row per day of every period bounded on both sides."""
        bounded = self.frame(spark, label).where("first_day IS NOT NULL AND last_day IS NOT NULL")
        return bounded.select(F.explode(F.sequence("first_day", "last_day")).alias(day), label)


DEFAULT_CALENDAR = PeriodCalendar.of(fixed.CLOSED_PERIODS, fixed.OPEN_PERIOD)
