"""Window frames over one entity's history.

``History`` names the entity key, the time column and how a frame is measured:

* ``by="rows"``    a frame of 6 is the 6 neighbouring rows, whatever their dates;
* ``by="months"``  a frame of 6 is 6 calendar months, so gaps shrink it.

``row_id`` orders rows of equal time by the md5 of their id, then by the id, so that the order
is total and depends neither on the layout nor on the length of a history.

All frames share one partitioning and one ordering, so Catalyst needs a single
exchange and a single sort for any number of features.

A loan has at most one row per calendar month, which bounds its history.  Panels
that break this (many rows per key) go through ``operators.long_history``, which
cuts the long histories into segments and hands this class ``segment`` columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from loanweave.columns import KEY, TIME
from loanweave.functions.expressions import month_index, stable_hash


@dataclass(frozen=True)
class History:
    key: str = KEY
    time: str = TIME
    by: str = "rows"
    segment: str | None = None
    position: str | None = None
    row_id: str | None = None

    def __post_init__(self):
        if self.by not in ("rows", "months"):
            raise ValueError(f"frames are measured in rows or months, not {self.by!r}")
        if self.by == "months" and self.segment is not None:
            raise ValueError("segments overlap by rows, so calendar frames cannot use them")

    @property
    def partition(self) -> list[str]:
        return [self.key] if self.segment is None else [self.key, self.segment]

    @property
    def ordered(self) -> WindowSpec:
        if self.position is not None:
            order = [F.col(self.position)]
        elif self.row_id is not None:
            order = [F.col(self.time), stable_hash(self.row_id), F.col(self.row_id)]
        else:
            order = [F.col(self.time)]
        return Window.partitionBy(*self.partition).orderBy(*order)

    @property
    def so_far(self) -> WindowSpec:
        """From the first row up to and including the current one."""
        return self.ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def _measured(self, first: int, last: int) -> WindowSpec:
        if self.by == "rows":
            return self.ordered.rowsBetween(first, last)
        spec = Window.partitionBy(*self.partition).orderBy(month_index(self.time))
        return spec.rangeBetween(first, last)

    def before(self, n: int) -> WindowSpec:
        """The ``n`` rows (or months) strictly before the current one."""
        return self._measured(-n, -1)

    def after(self, n: int) -> WindowSpec:
        """The ``n`` rows (or months) strictly after the current one."""
        return self._measured(1, n)

    def value_before(self, column: str, n: int) -> Column:
        """The value ``n`` rows (or months) ago."""
        if self.by == "rows":
            return F.lag(column, n).over(self.ordered)
        return F.max(column).over(self._measured(-n, -n))

    def row_position(self) -> Column:
        """1-based position of the row in the whole history."""
        if self.position is not None:
            return F.col(self.position)
        return F.row_number().over(self.ordered)

    # Running aggregates.  A segmented history adds what earlier segments carried
    # in (columns ``_carry_<name>``) and counts only rows the segment owns.

    def running_max(self, value: Column, carry: str) -> Column:
        seen = F.max(value).over(self.so_far)
        return seen if self.segment is None else F.greatest(seen, F.col(f"_carry_{carry}"))

    def running_sum(self, value: Column, carry: str) -> Column:
        if self.segment is None:
            return F.sum(value).over(self.so_far)
        own = F.sum(F.when(F.col("_own"), value).otherwise(0)).over(self.so_far)
        return own + F.coalesce(F.col(f"_carry_{carry}"), F.lit(0))


def one_row_per_month(panel: DataFrame, history: History = History()) -> DataFrame:
    """Key and month pairs that occur more than once: empty on a well-formed panel."""
    return (
        panel.groupBy(history.key, history.time)
        .agg(F.count("*").alias("rows"))
        .filter(F.col("rows") > 1)
    )
