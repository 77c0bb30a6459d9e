"""Column expressions shared by the operators. All built-in, JVM-side, codegen-able."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whole_seconds(ts: str | Column) -> Column:
    """Epoch seconds of a timestamp, truncated to whole seconds.

    `unix_timestamp` works for TIMESTAMP and TIMESTAMP_NTZ alike, whereas a
    cast to long fails on TIMESTAMP_NTZ.
    """
    return F.unix_timestamp(col_of(ts))


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """(end - start) in minutes at whole-second resolution, as double."""
    return ((whole_seconds(end) - whole_seconds(start)) / 60.0).cast("double")


def is_present(c: str | Column, floating: bool = True) -> Column:
    """Pushable form of "not null (and not NaN)": `isNotNull` reaches the scan."""
    c = col_of(c)
    return c.isNotNull() & ~F.isnan(c) if floating else c.isNotNull()


def row_hash(*cols: str | Column) -> Column:
    """Hex md5 of the text of the given columns (deterministic, engine-independent
    for integer and string keys)."""
    parts = [col_of(c).cast("string") for c in cols]
    return F.md5(parts[0] if len(parts) == 1 else F.concat_ws("|", *parts))


def hash_bucket(hex_hash: Column, modulo: int, digits: int = 8) -> Column:
    """First `digits` hex digits of a hash as a number, modulo `modulo`."""
    return (F.conv(F.substring(hex_hash, 1, digits), 16, 10).cast("bigint") % modulo).cast("int")


def millionths(c: str | Column) -> Column:
    """A double as a whole number of millionths: a text key that every engine writes alike."""
    return F.round(col_of(c) * 1e6).cast("bigint")


def linear_combination(intercept: float, weights: Iterable[tuple[str, float]]) -> Column:
    """intercept + w1*x1 + w2*x2 + ..., evaluated left to right (double literals)."""
    expr = F.lit(float(intercept))
    for name, w in weights:
        expr = expr + F.col(name) * F.lit(float(w))
    return expr


def round_doubles(df, digits: int = 6, only: Iterable[str] | None = None):
    """Round double columns for presentation/comparison; operators stay unrounded."""
    names = set(only) if only is not None else None
    out = []
    for field in df.schema.fields:
        if field.dataType.typeName() == "double" and (names is None or field.name in names):
            out.append(F.round(F.col(field.name), digits).alias(field.name))
        else:
            out.append(F.col(field.name))
    return df.select(*out)


def count_at_most(edges: Column, value: Column) -> Column:
    """Number of elements of the array `edges` that are <= `value` (the bin index), for any
    number of edges; -1 for a null array.

    Never null, so a join on the result infers no `isnotnull` filter that would carry the
    search into the scan of the raw rows.
    """
    return F.coalesce(F.size(F.filter(edges, lambda e: e <= value)), F.lit(-1))
