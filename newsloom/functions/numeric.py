"""Rounding that agrees with Python's ``round(x, n)`` on doubles.

Python rounds the *exact* binary value of a double, with ties (exactly
representable midpoints such as 0.0625) going to the even neighbour. Spark's
``round``/``bround`` round the shortest decimal text of the double instead, so
0.6125 (binary value just above the midpoint) gives 0.612 under ``bround``
while Python gives 0.613. Here ``x * 10**n`` is split into a rounded product
plus its exact error (Dekker's two-product with a Veltkamp split), which tells
exactly on which side of the midpoint ``x`` lies. All steps are plain double
arithmetic, so the same SQL text runs in Spark and in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _d(v) -> str:
    return f"CAST({v} AS DOUBLE)"


def py_round_sql(x: str, digits: int = 3) -> str:
    """SQL text (Spark and DuckDB) of Python ``round(x, digits)`` for a DOUBLE expression ``x``."""
    scale = 10 ** digits
    x = f"({x})"
    p = f"({x} * {_d(scale)})"
    c = f"({_d(134217729)} * {x})"
    hi = f"({c} - ({c} - {x}))"
    lo = f"({x} - {hi})"
    err = f"((({hi} * {_d(scale)}) - {p}) + ({lo} * {_d(scale)}))"
    k = f"CAST(floor({p}) AS DOUBLE)"
    diff = f"(({p} - ({k} + {_d(0.5)})) + {err})"
    even = f"(floor({k} / {_d(2)}) * {_d(2)} = {k})"
    return (
        f"(CASE WHEN {x} IS NULL THEN NULL "
        f"WHEN {diff} > {_d(0)} THEN ({k} + {_d(1)}) / {_d(scale)} "
        f"WHEN {diff} < {_d(0)} THEN {k} / {_d(scale)} "
        f"WHEN {even} THEN {k} / {_d(scale)} "
        f"ELSE ({k} + {_d(1)}) / {_d(scale)} END)"
    )


def py_round(col: Column, digits: int = 3) -> Column:
    """Column form of :func:`py_round_sql`; the input is evaluated once."""
    from . import bind
    return bind(col.cast("double"), lambda v: _round_column(v, digits))


def _round_column(v: Column, digits: int) -> Column:
    scale = float(10 ** digits)
    p = v * F.lit(scale)
    c = F.lit(134217729.0) * v
    hi = c - (c - v)
    lo = v - hi
    err = ((hi * F.lit(scale)) - p) + (lo * F.lit(scale))
    k = F.floor(p).cast("double")
    diff = (p - (k + F.lit(0.5))) + err
    even = F.floor(k / F.lit(2.0)) * F.lit(2.0) == k
    return (F.when(v.isNull(), F.lit(None).cast("double"))
            .when(diff > 0, (k + F.lit(1.0)) / F.lit(scale))
            .when(diff < 0, k / F.lit(scale))
            .when(even, k / F.lit(scale))
            .otherwise((k + F.lit(1.0)) / F.lit(scale)))
