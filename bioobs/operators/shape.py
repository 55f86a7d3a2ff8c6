"""Choosing, renaming, stacking and reshaping columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from bioobs.functions.text import clean_names


def named(name: str) -> Column:
    """The column with exactly this name, dots and all."""
    return F.col(f"`{name}`")


def cols_between(df: DataFrame, first: str, last: str) -> list[str]:
    """Names from ``first`` to ``last`` in table order, both included."""
    names = df.columns
    i, j = names.index(first), names.index(last)
    return names[i : j + 1] if i <= j else names[j : i + 1][::-1]


def starting_with(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def ending_with(df: DataFrame, suffix: str) -> list[str]:
    return [c for c in df.columns if c.endswith(suffix)]


def with_clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*clean_names(df.columns))


def drop_all_null(df: DataFrame) -> DataFrame:
    """Keep the columns that hold at least one value.

    Which columns remain depends on the data, so this runs one counting pass
    that returns a single row.
    """
    counts = df.agg(*[F.count(named(c)).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    return df.select([named(c) for i, c in enumerate(df.columns) if counts[i] > 0])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly these columns, in this order and type; a missing one is an error."""
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the input: {missing}")
    return df.select([named(f.name).cast(f.dataType).alias(f.name) for f in schema])


def relocate(df: DataFrame, wanted: Sequence[str], before: str | None = None) -> DataFrame:
    """Move the wanted columns that exist to the front, or to before another one."""
    moved = [c for c in wanted if c in df.columns]
    rest = [c for c in df.columns if c not in moved]
    at = rest.index(before) if before else 0
    return df.select([named(c) for c in rest[:at] + moved + rest[at:]])


def with_constants(df: DataFrame, values: Mapping[str, object], schema: T.StructType) -> DataFrame:
    """Literal columns; the schema types the NULL ones."""
    return df.withColumns({k: F.lit(v).cast(schema[k].dataType) for k, v in values.items()})


def pivot_longer(
    df: DataFrame, cols: Iterable[str], names_to: str, values_to: str, names_prefix: str = ""
) -> DataFrame:
    """Columns to rows, NULLs kept, with a prefix cut from the names."""
    cols = list(cols)
    ids = [named(c) for c in df.columns if c not in cols]
    long = df.unpivot(ids, [named(c) for c in cols], names_to, values_to)
    if names_prefix:
        cut = F.when(
            named(names_to).startswith(names_prefix),
            F.substring(named(names_to), F.lit(len(names_prefix) + 1), F.length(named(names_to))),
        ).otherwise(named(names_to))
        long = long.withColumn(names_to, cut)
    return long


def pivot_wider(
    df: DataFrame, ids: Sequence[str], names_from: str, values_from: str, names: Sequence[str]
) -> DataFrame:
    """Rows to columns. The name list is given, so no job has to find it."""
    return df.groupBy(*[named(c) for c in ids]).agg(
        *[
            F.max(F.when(named(names_from) == n, named(values_from))).alias(n)
            for n in names
        ]
    )


def unnest_struct(df: DataFrame, column: str) -> DataFrame:
    """Replace a struct column by its fields."""
    fields = [F.col(f"`{column}`.`{f.name}`").alias(f.name) for f in df.schema[column].dataType]
    return df.select(*[named(c) for c in df.columns if c != column], *fields)


def bind_rows(*frames: DataFrame) -> DataFrame:
    """Stack by name; absent columns become NULL and duplicates stay."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def nest(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], into: str, parts: int = 1
) -> DataFrame:
    """Collect the value columns of a group into one sorted array per group.

    A group that cannot fit one array is spread over ``parts`` rows numbered in
    the column ``part``: equal rows are counted first, which partial aggregation
    does before the shuffle, and then dealt out by hash. Every row ends up in
    exactly one array, so ``unnest_rows`` gives the input back.
    """
    counted = df.groupBy(*[named(k) for k in keys], *[named(v) for v in values]).agg(
        F.count("*").alias("copies")
    )
    item = F.struct(*[named(v) for v in values], F.col("copies"))
    part = F.pmod(F.xxhash64(*[named(v) for v in values]), F.lit(parts)).cast("int")
    return (
        counted.withColumn("part", part)
        .groupBy(*[named(k) for k in keys], "part")
        .agg(F.sort_array(F.collect_list(item)).alias(into))
    )


def unnest_rows(df: DataFrame, column: str) -> DataFrame:
    """The rows ``nest`` collected, copies included."""
    keys = [named(c) for c in df.columns if c not in (column, "part")]
    flat = df.select(*keys, F.inline(named(column)))
    flat = flat.withColumn("copies", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return flat.drop("copies")


def joined_text(
    df: DataFrame, keys: Sequence[str], value: str, into: str, separator: str
) -> DataFrame:
    """Distinct values of each group in order, glued to one text."""
    grouped = df.select(*[named(k) for k in keys], named(value)).distinct()
    glued = F.array_join(F.sort_array(F.collect_list(named(value))), separator).alias(into)
    return grouped.groupBy(*[named(k) for k in keys]).agg(glued)
