"""Numeric column helpers shared by every feature and report.

pandas ``Series.round(n)`` rounds half to even on the binary value scaled by
10**n; ``rint(x * 10**n) / 10**n`` reproduces it exactly, whereas ``F.round``
rounds half up.  Spark runs with ANSI mode on, where ``x / 0.0`` raises, so
every ratio goes through ``try_divide`` and yields null instead of inf/NaN.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rnd(c, places: int) -> Column:
    """Round half to even at ``places`` decimals (pandas ``.round``)."""
    scale = float(10 ** places)
    if places == 0:
        return F.rint(_col(c))
    return F.rint(_col(c) * F.lit(scale)) / F.lit(scale)


def div(a, b) -> Column:
    """a / b, null when b is 0 or null."""
    return F.try_divide(_col(a), _col(b))


def nan_to_null(c) -> Column:
    """pandas NaN means missing; Spark orders NaN above every number, so a
    NaN would pass ``x > 0.8``.  Map it to null at the scan."""
    c = _col(c)
    return F.when(~F.isnan(c), c)


# SQL-text forms, for long projections written with ``selectExpr`` (one parse
# per column instead of one JVM call per operator).
def rnd_sql(expr: str, places: int) -> str:
    if places == 0:
        return f"rint({expr})"
    scale = f"{10 ** places}.0D"
    return f"(rint(({expr}) * {scale}) / {scale})"


def div_sql(a: str, b: str) -> str:
    return f"try_divide({a}, {b})"
