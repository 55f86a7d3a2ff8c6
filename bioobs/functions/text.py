"""String functions whose meaning differs between R and Spark, as columns.

R's replace and remove act on the first match only; Spark's ``regexp_replace``
acts on all of them. Positions are 1-based and inclusive at both ends.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def replace_first(c: ColumnOrName, pattern: str, replacement: str) -> Column:
    r"""Replace the first match. ``\\1`` in the replacement names a group of the pattern."""
    literal = replacement.replace("$", r"\$")
    shifted = re.sub(r"\\(\d)", lambda m: "$" + str(int(m.group(1)) + 1), literal)
    return F.regexp_replace(_col(c), f"(?s)^(.*?)(?:{pattern})", "$1" + shifted)


def remove_first(c: ColumnOrName, pattern: str) -> Column:
    return replace_first(c, pattern, "")


def sub_string(c: ColumnOrName, start, end) -> Column:
    """Characters ``start..end``, both included; negatives count from the end."""
    c = _col(c)
    size = F.length(c)

    def absolute(pos):
        if isinstance(pos, int):
            return F.lit(pos) if pos >= 0 else size + F.lit(pos + 1)
        return F.when(pos < 0, size + pos + 1).otherwise(pos)

    first = F.greatest(absolute(start), F.lit(1))
    return F.substring(c, first, F.greatest(absolute(end) - first + 1, F.lit(0)))


def detect(c: ColumnOrName, pattern: str, negate: bool = False) -> Column:
    hit = _col(c).rlike(pattern)
    return ~hit if negate else hit


def keep_matching(items: ColumnOrName, pattern: str) -> Column:
    """Elements of an array that match."""
    return F.filter(_col(items), lambda x: x.rlike(pattern))


def glue(template: str, **values: ColumnOrName) -> Column:
    """Fill ``{name}`` slots with columns; a missing value prints as ``NA``."""
    parts = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2:
            parts.append(F.coalesce(_col(values[piece]).cast("string"), F.lit("NA")))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)


def path_of(*pieces: ColumnOrName) -> Column:
    return F.concat_ws("/", *[_col(p) for p in pieces])


def file_extension(path: ColumnOrName) -> Column:
    """Text after the last dot of the file name, empty if there is none."""
    return F.regexp_extract(_col(path), r"\.([^./]+)$", 1)


def file_stem(path: ColumnOrName) -> Column:
    """File name without folder and extension."""
    return F.regexp_extract(_col(path), r"([^/]*?)(?:\.[^./]+)?$", 1)


def clean_name(name: str) -> str:
    """One header in snake_case; a leading digit gets an ``x``."""
    plain = "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c))
    text = plain.replace("'", "").replace('"', "").replace("%", "_percent_").replace("#", "_number_")
    text = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", text)
    text = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", text)
    text = re.sub(r"[^0-9A-Za-z]+", "_", text).strip("_").lower()
    if not text:
        text = "x"
    return "x" + text if text[0].isdigit() else text


def clean_names(names: list[str]) -> list[str]:
    """All headers cleaned and made unique with ``_2``, ``_3`` …"""
    seen: dict[str, int] = {}
    taken: set[str] = set()
    out = []
    for name in map(clean_name, names):
        seen[name] = seen.get(name, 0) + 1
        unique = name if seen[name] == 1 else f"{name}_{seen[name]}"
        while unique in taken:
            seen[name] += 1
            unique = f"{name}_{seen[name]}"
        taken.add(unique)
        out.append(unique)
    return out
