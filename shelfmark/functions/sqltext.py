"""SQL-text building blocks shared by Spark SQL statements.

``half_up_ratio`` renders round(num / den, digits) with half-away-from-zero
rounding on integer operands, evaluated exactly (see ``exact.div_half_up``).
"""

from __future__ import annotations


def half_up_ratio(num: str, den: str, digits: int) -> str:
    scale = 10 ** digits
    n = f"(({num}) * {scale})"
    q = f"FLOOR((ABS({n}) * 2 + ({den})) / (({den}) * 2))"
    return (f"(CASE WHEN {n} < 0 THEN -{q} ELSE {q} END"
            f" / CAST({scale} AS DOUBLE))")


def dec_div(num: str, den: str, digits: int) -> str:
    """Spark SQL twin of ``exact.dec_div``."""
    return (f"CAST(ROUND(CAST(({num}) AS DECIMAL(24,4)) / CAST(({den}) AS DECIMAL(22,4)), {digits})"
            f" AS DOUBLE)")


def dec_mean(x: str, digits: int = 2) -> str:
    return dec_div(f"SUM({x})", f"NULLIF(COUNT({x}), 0)", digits)


def round_half_up_double(x: str, digits: int) -> str:
    """SQL twin of ``exact.round_half_up_double``."""
    scale = 10 ** digits
    return f"(CAST(FLOOR(({x}) * CAST({scale} AS DOUBLE) + 0.5) AS DOUBLE) / CAST({scale} AS DOUBLE))"
