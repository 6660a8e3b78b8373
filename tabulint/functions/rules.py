"""Rules: what a good row looks like, declared as data and compiled to Spark columns.

Every value rule offers two forms of the same decision:

* ``violation()`` is a boolean that is never NULL, safe to count, negate and use in ``when``;
* ``accepts()`` is the filter form. It may be NULL (a filter drops NULL), and it is written so that
  Catalyst can push what Parquet understands (null tests, comparisons) down to the scan. The form that
  *looks for* bad values is not pushed: Parquet statistics may leave out NaN, so a pushed ``x > hi``
  could skip a block whose only bad value is NaN.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulint.functions.row_hash import quoted, sortable_columns
from tabulint.functions.standard_forms import as_date, as_number, as_whole


@dataclass(frozen=True)
class NotNull:
    """The column must hold a value."""

    column: str
    label: str = ""

    @property
    def name(self) -> str:
        return self.label or self.column

    def violation(self) -> Column:
        return quoted(self.column).isNull()

    def accepts(self) -> Column:
        return quoted(self.column).isNotNull()

    def failure(self) -> Column:
        return F.when(self.violation(), F.lit(self.name))


@dataclass(frozen=True)
class IsNull:
    """The column must be empty, as the record of a line that could not be read is for a sound line."""

    column: str
    label: str = ""

    @property
    def name(self) -> str:
        return self.label or self.column

    def violation(self) -> Column:
        return quoted(self.column).isNotNull()

    def accepts(self) -> Column:
        return quoted(self.column).isNull()

    def failure(self) -> Column:
        return F.when(self.violation(), F.lit(self.name))


@dataclass(frozen=True)
class Matches:
    """The text must match a regular expression (Java syntax); a NULL fails unless ``null_ok``."""

    column: str
    pattern: str
    label: str = ""
    null_ok: bool = False

    @property
    def name(self) -> str:
        return self.label or self.column

    def malformed(self) -> Column:
        """There is a text and it does not match."""
        value = quoted(self.column)
        return value.isNotNull() & ~value.rlike(self.pattern)

    def violation(self) -> Column:
        return self.malformed() if self.null_ok else self.malformed() | quoted(self.column).isNull()

    def accepts(self) -> Column:
        value = quoted(self.column)
        if self.null_ok:
            return value.isNull() | value.rlike(self.pattern)
        return value.isNotNull() & value.rlike(self.pattern)

    def failure(self) -> Column:
        return F.when(self.violation(), F.lit(self.name))

    def status(self) -> Column:
        """MISSING, INVALID_FORMAT or VALID."""
        return (
            F.when(quoted(self.column).isNull(), "MISSING")
            .when(self.malformed(), "INVALID_FORMAT")
            .otherwise("VALID")
        )


@dataclass(frozen=True)
class InRange:
    """The number must lie in ``lo..hi``, both ends included; a NULL passes unless ``null_ok=False``.

    NaN sorts above every number, so it is out of range. Set ``text=True`` for a column of strings:
    the text is read leniently and a text that is no number fails as ``<label>: not_numeric``; with
    ``whole=True`` so does a fraction (``80.0`` is whole).
    """

    column: str
    lo: float
    hi: float
    label: str = ""
    null_ok: bool = True
    text: bool = False
    counter: str = ""
    whole: bool = False

    @property
    def name(self) -> str:
        return self.label or self.column

    @property
    def counter_name(self) -> str:
        """Column name of this rule's count in a one-row summary."""
        return self.counter or f"bad_{self.name}"

    def _number(self) -> Column:
        if not self.text:
            return quoted(self.column)
        return as_whole(self.column) if self.whole else as_number(self.column)

    def _not_numeric(self) -> Column:
        return quoted(self.column).isNotNull() & self._number().isNull()

    def out_of_range(self) -> Column:
        """There is a value and it lies outside the range (or is no number at all)."""
        outside = F.coalesce(~self._number().between(self.lo, self.hi), F.lit(False))
        return outside | self._not_numeric() if self.text else outside

    def violation(self) -> Column:
        return self.out_of_range() if self.null_ok else self.out_of_range() | quoted(self.column).isNull()

    def accepts(self) -> Column:
        inside = self._number().between(self.lo, self.hi)
        return quoted(self.column).isNull() | inside if self.null_ok else inside

    def failure(self) -> Column:
        label = F.lit(self.name)
        if self.text:
            label = F.when(self._not_numeric(), F.lit(f"{self.name}: not_numeric")).otherwise(label)
        return F.when(self.violation(), label)


Rule = NotNull | IsNull | Matches | InRange


@dataclass(frozen=True)
class UniqueKey:
    """One row per key: the latest by ``order_by``, NULL last.

    Ties are decided by ``tiebreak``, then by every other column, highest first. The choice therefore
    depends on row contents alone, never on partitioning or on a task being run twice.
    ``order_as_date`` reads a text column as a date before comparing; a malformed date counts as NULL.
    NULL keys form one group.
    """

    columns: tuple[str, ...]
    order_by: str
    tiebreak: tuple[str, ...] = ()
    order_as_date: bool = False

    def order_value(self) -> Column:
        return as_date(self.order_by) if self.order_as_date else quoted(self.order_by)

    def deciding_columns(self, df: DataFrame, leading: tuple[str, ...] = ()) -> list[str]:
        """Tie-break columns in order: declared, ``leading``, then the rest of ``df``."""
        named = dict.fromkeys((*self.tiebreak, *leading, *sortable_columns(df)))
        return [c for c in named if c not in self.columns]


@dataclass(frozen=True)
class Stage:
    """A named filter step of a cleaning run: a row must pass all its rules; without rules it passes."""

    name: str
    rules: tuple[Rule, ...]

    def violation(self) -> Column:
        return reduce(or_, (rule.violation() for rule in self.rules), F.lit(False))

    def accepts(self) -> Column:
        return reduce(and_, (rule.accepts() for rule in self.rules), F.lit(True))


@dataclass(frozen=True)
class Standards:
    """Which columns get which standard form; ``day_spans`` maps a new column to (start, end).

    ``numbers`` and ``integers`` are text columns that become DOUBLE and INT; a text that is no such
    number becomes NULL, so check it first (``InRange`` with ``text``).
    """

    dates: tuple[str, ...] = ()
    day_spans: dict[str, tuple[str, str]] = field(default_factory=dict)
    codes: tuple[str, ...] = ()
    names: tuple[str, ...] = ()
    numbers: tuple[str, ...] = ()
    integers: tuple[str, ...] = ()


@dataclass(frozen=True)
class RuleSet:
    """Everything a cleaning run needs: the key, the filter stages in order, the standard forms."""

    key: UniqueKey
    stages: tuple[Stage, ...]
    standards: Standards = Standards()

    @property
    def rules(self) -> tuple[Rule, ...]:
        return tuple(rule for stage in self.stages for rule in stage.rules)
