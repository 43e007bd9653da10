"""Numeric helpers: lenient casts and rounding that match PostgreSQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_double(c: Column) -> Column:
    """Text/number -> double; anything unparsable becomes 0.0 (reference behaviour)."""
    return F.coalesce(F.trim(c.cast("string")).try_cast("double"), F.lit(0.0))


def scaled(c: Column, scale: int) -> Column:
    """``c * 10^scale`` as an exact integer (``c`` has ``scale`` places).

    As ``decimal(28,0)``, whose sums are ``decimal(38,0)``: room for 10^10
    rows of the widest value.
    """
    return (c.cast("decimal(28,10)") * F.lit(10 ** scale)).cast("decimal(28,0)")


def _floor_div(a: Column, b: Column) -> Column:
    """Exact floor(a / b) for non-negative integer decimals (b > 0).

    ``a - pmod(a, b)`` is an exact multiple of ``b``, so the decimal division
    that follows is exact: no rounding, no correction steps.
    """
    return ((a - F.pmod(a, b)) / b).cast("decimal(38,0)")


def rounded_mean(total: Column, n: Column, scale_in: int, digits: int) -> Column:
    """ROUND(total / 10^scale_in / n, digits), exact and half away from zero.

    ``total`` is an exact integer sum of values scaled by ``10^scale_in``
    (see :func:`scaled`). PostgreSQL averages numerics exactly before
    rounding; a double average can land on the wrong side of a tie.
    Works as an aggregate or over a window. Returns a double.

    The integers are 38-digit decimals at every size.
    """
    up, down = max(digits - scale_in, 0), max(scale_in - digits, 0)
    a = F.abs(total.cast("decimal(38,0)")) * F.lit(10 ** up)
    b = n.cast("decimal(38,0)") * F.lit(10 ** down)
    q = _floor_div((a * 2 + b).cast("decimal(38,0)"), (b * 2).cast("decimal(38,0)"))
    sign = F.when(total < 0, F.lit(-1)).otherwise(F.lit(1))
    return F.when(n > 0, (q * sign).cast("double") / F.lit(float(10 ** digits)))


def mean_half_up(c: Column, scale_in: int, digits: int) -> Column:
    """Aggregate: exact ROUND(AVG(c), digits) for a decimal column of ``scale_in`` places."""
    return rounded_mean(F.sum(scaled(c, scale_in)), F.count(c), scale_in, digits)


def rounded_mean_sql(x: str, scale_in: int, digits: int, over: str = "") -> str:
    """The same exact rounded mean as DuckDB SQL text (for the oracle)."""
    up, down = max(digits - scale_in, 0), max(scale_in - digits, 0)
    t = f"SUM(CAST({x} * {10 ** scale_in} AS HUGEINT)){over}"
    n = f"COUNT({x}){over}"
    a = f"(abs({t}) * {10 ** up})"
    b = f"({n} * {10 ** down})"
    q = f"((2 * {a} + {b}) // (2 * {b}))"
    return (f"CASE WHEN {n} > 0 THEN CAST(sign({t}) * {q} AS DOUBLE) / {float(10 ** digits)} END")
