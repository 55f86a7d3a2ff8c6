"""The types of text columns, from all their values.

Every value has a set of types that can hold it, as bits; a column can have the types
that all its values share. Intersecting bits is a partial aggregate, so one pass over
the data, with one row from each task, types all columns, whatever their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bioobs.functions.values import as_date, as_logical, as_numeric
from bioobs.operators.shape import named

# narrowest first; what none of them holds is text
LOGICAL, INTEGER, DOUBLE, DATE, DATETIME, TIME = LATTICE = ("logical", "integer", "double", "date", "datetime", "time")
TEXT = "text"
BIT = {name: 1 << i for i, name in enumerate(LATTICE)}

# a number does not begin with a zero that has no meaning, or codes would lose theirs
_INTEGER = r"^[+-]?(0|[1-9][0-9]{0,17})$"
_DOUBLE = r"^[+-]?((?=\.?[0-9])(0|[1-9][0-9]*)?(\.[0-9]*)?([eE][+-]?[0-9]{1,3})?|Inf|NaN)$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_DATETIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?(Z|[+-][0-9]{2}:[0-9]{2})?$"
_TIME = r"^([01]?[0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9](\.[0-9]+)?)?$"


def fitting_types(c: Column) -> Column:
    """Bits of the types that can hold the value; NULL for a missing one."""
    day = c.rlike(_DATE) & c.try_cast("date").isNotNull()
    moment = c.rlike(_DATETIME) & c.try_cast("timestamp").isNotNull()
    bits = [
        (as_logical(c).isNotNull(), BIT[LOGICAL]),
        (c.rlike(_INTEGER), BIT[INTEGER] | BIT[DOUBLE]),
        (c.rlike(_DOUBLE), BIT[DOUBLE]),
        (day, BIT[DATE] | BIT[DATETIME]),
        (moment, BIT[DATETIME]),
        (c.rlike(_TIME), BIT[TIME]),
    ]
    found = F.lit(0)
    for test, bit in reversed(bits):
        found = F.when(test, F.lit(bit)).otherwise(found)
    return F.when(c.isNotNull(), found)


def infer_types(df: DataFrame, columns: list[str] | None = None) -> dict[str, str]:
    """The narrowest type of each text column: logical, integer, double, date, datetime, time or text.

    Runs one job over the data. A column without any value is logical.
    """
    names = df.columns if columns is None else columns
    seen = df.agg(*[F.bit_and(fitting_types(named(c))).alias(f"c{i}") for i, c in enumerate(names)]).first()
    every = sum(BIT.values())
    masks = {c: every if seen[i] is None else seen[i] for i, c in enumerate(names)}
    return {c: next((t for t in LATTICE if m & BIT[t]), TEXT) for c, m in masks.items()}


def as_inferred(c: Column, kind: str) -> Column:
    """The column as its type. Times of day stay text: Spark's tables have no settled type for them."""
    if kind == LOGICAL:
        return as_logical(c)
    if kind == INTEGER:
        return c.try_cast("bigint")
    if kind == DOUBLE:
        return F.when(c.rlike("Inf$"), F.when(c.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))).otherwise(as_numeric(c))
    if kind == DATE:
        return as_date(c)
    if kind == DATETIME:
        return c.try_cast("timestamp")
    return c
