"""Column helpers shared by the operators; all are built-in expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F

from clinchline.fixed_values import PHASES


def phases_before(phase: str) -> list[str]:
    return PHASES[: PHASES.index(phase)]


def phases_from(phase: str) -> list[str]:
    return PHASES[PHASES.index(phase) :]


def one_of(column: str | Column, names: Iterable[str]) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.isin(*names)


def none_of(column: str | Column, names: Iterable[str]) -> Column:
    return ~one_of(column, names)


def total_if(condition: Column, value: Column | int = 1) -> Column:
    """Sum of ``value`` over the rows that meet ``condition``, 0 for the others."""
    value = value if isinstance(value, Column) else F.lit(value)
    return F.sum(F.when(condition, value).otherwise(0))


def round_up(column: Column, multiple: int) -> Column:
    """Round up to the next multiple."""
    return (F.ceil(column / F.lit(multiple)) * multiple).cast("int")


def rule_value(rule: Mapping, column: Column, default: int = 0) -> Column:
    """Look a column up in a small constant table."""
    table = F.create_map(*[F.lit(x) for pair in rule.items() for x in pair])
    return F.coalesce(F.try_element_at(table, column), F.lit(default))


def any_of(column: str | Column) -> Column:
    """First non-null value of a group (deterministic: the greatest)."""
    return F.max(column)


def percent_label(part: Column, whole: Column, ceiling: str = "99.9") -> Column:
    """``part`` as a percentage of ``whole`` with one decimal, never above ``ceiling``.

    A zero ``whole`` gives the ceiling, a missing ratio is ignored by ``least``.
    """
    ratio = F.try_divide(
        (part * 100).cast("decimal(20,0)"), whole.cast("decimal(20,0)")
    )
    shown = F.least(F.round(ratio, 1).cast("decimal(22,1)"), F.lit(ceiling).cast("decimal(22,1)"))
    return F.concat(shown.cast("string"), F.lit("%"))


def column_from(column: str | Column, start: int) -> Column:
    """A text from its character ``start`` on, to its end however long it is."""
    text = F.col(column) if isinstance(column, str) else column
    return text.substr(F.lit(start), F.length(text))


def points_short(column: str) -> Column:
    """Display rule: missing points are shown as 0."""
    return F.coalesce(F.col(column), F.lit(0))
