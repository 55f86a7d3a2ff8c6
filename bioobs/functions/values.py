"""Recode, cast and date columns with R's treatment of missing values."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import Column, functions as F

from bioobs.functions.text import ColumnOrName, _col


def _value(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def case_when(*cases: tuple[Column, object]) -> Column:
    """First case that holds; NULL if none does."""
    out = F
    for condition, value in cases:
        out = out.when(condition, _value(value))
    return out


def if_else(test: Column, yes, no) -> Column:
    """Three-valued: a NULL test gives NULL."""
    return F.when(test, _value(yes)).when(~test, _value(no))


def recode_values(c: ColumnOrName, mapping: Mapping) -> Column:
    """Look the value up; anything not listed becomes NULL."""
    c = _col(c)
    return case_when(*[(c == old, new) for old, new in mapping.items()])


def replace_values(c: ColumnOrName, mapping: Mapping) -> Column:
    """Look the value up; anything not listed stays."""
    c = _col(c)
    return F.coalesce(recode_values(c, mapping), c)


def replace_when(c: ColumnOrName, *cases: tuple[Column, object]) -> Column:
    """First case that holds replaces the value; otherwise it stays."""
    return case_when(*cases).otherwise(_col(c))


def as_numeric(c: ColumnOrName) -> Column:
    """Text that is no number becomes NULL instead of an error.

    Spark would read the suffixes in ``5d`` and ``5f``; they make it no number.
    """
    c = _col(c)
    return F.when(~c.cast("string").rlike(r"(?i)[0-9.][df]\s*$"), c.try_cast("double"))


def as_logical(c: ColumnOrName) -> Column:
    """``T``/``TRUE``/``true``/``True`` and the F forms; other text is NULL."""
    c = _col(c)
    return case_when(
        (c.isin("T", "TRUE", "true", "True"), True), (c.isin("F", "FALSE", "false", "False"), False)
    )


def as_date(c: ColumnOrName) -> Column:
    return _col(c).try_cast("date")


def rebase_year(day: ColumnOrName, year: ColumnOrName) -> Column:
    """Same month and day in another year; a day that year lacks becomes NULL."""
    day = _col(day)
    text = F.format_string(
        "%04d-%02d-%02d", _col(year).cast("int"), F.month(day), F.dayofmonth(day)
    )
    return F.when(day.isNotNull() & _col(year).isNotNull(), text.try_cast("date"))


def date_parts(day: ColumnOrName) -> dict[str, Column]:
    day = _col(day)
    return {"year_obs": F.year(day), "month_obs": F.month(day), "day_obs": F.dayofmonth(day)}


def newer_than(day: ColumnOrName, as_of: date | str, days: int) -> Column:
    """Strictly later than ``as_of - days``. ``as_of`` is an argument, so a rerun agrees."""
    return _col(day).cast("date") > F.date_sub(F.lit(str(as_of)).cast("date"), days)


def coalesce_each(names: Iterable[str], value) -> dict[str, Column]:
    """The same default for several columns, ready for ``withColumns``."""
    return {n: F.coalesce(F.col(f"`{n}`"), F.lit(value)) for n in names}
